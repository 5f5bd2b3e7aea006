"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them, the posterior decides.

Everything is a DataFrame expression. The rules see counts of one text. Each votes 1 (good), -1 (bad) or 0 (abstains); the votes of a
document form a pattern, of which there are at most 3 ** len(RULES). The model is fitted on the counts of all patterns of all documents
(no labels): how often a rule gives each vote on good and on bad documents, and the share of good ones. A document is kept if its
posterior probability of being good is at least `threshold` and the base conditions hold.

Defined results: a null or empty text has no words, fails the base conditions and is not kept; repeated rows each get a row; other
columns are ignored by `score` and returned as they are by `keep_good`; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabulens.llm.common import staged

SPACE = r"[\x20\x09-\x0D]+"


def _share(part: str, whole: str):
    return lambda c: F.coalesce(F.try_divide(c(part), c(whole)), F.lit(0.0))


def _within(share, low: float, high: float):
    return lambda c: (share(c) >= low) & (share(c) <= high)


#: Frequent small words of English, German, French and Spanish (fixed values).
FUNCTION_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from an or "
    "der die das und den von zu mit sich des auf ist im dem nicht ein eine als "
    "le la les de et un une du en que est pour dans qui el los las y del se por con una"
).split()
SYMBOLS, REPEATS, LINES = _share("n_symbols", "word_chars"), _share("n_repeat_words", "n_words"), _share("n_dup_lines", "n_lines")
CAPITALS, LETTERS, WORD = _share("n_upper", "n_letters"), _share("n_letters", "word_chars"), _share("word_chars", "n_words")
SMALL, ENDS, LINE = _share("n_small_words", "n_words"), _share("n_ends", "n_words"), _share("n_words", "n_lines")
#: (name, in favour, against). Each rule looks at evidence of its own, votes both ways and abstains between; so votes conflict.
RULES = (
    ("symbols", lambda c: SYMBOLS(c) <= 0.005, lambda c: SYMBOLS(c) > 0.03),
    ("letters", lambda c: LETTERS(c) >= 0.94, lambda c: LETTERS(c) < 0.88),
    ("word_length", _within(WORD, 4.4, 6.0), lambda c: (WORD(c) < 3.0) | (WORD(c) > 7.0)),
    ("small_words", lambda c: SMALL(c) >= 0.15, lambda c: SMALL(c) < 0.08),
    ("sentences", _within(ENDS, 0.05, 0.15), lambda c: (ENDS(c) < 0.03) | (ENDS(c) > 0.25)),
    ("line_length", lambda c: LINE(c) >= 15, lambda c: LINE(c) < 8),
    ("repeats", lambda c: (REPEATS(c) <= 0.05) & (LINES(c) <= 0.1), lambda c: (REPEATS(c) > 0.25) | (LINES(c) > 0.4)),
    ("capitals", _within(CAPITALS, 0.005, 0.05), lambda c: CAPITALS(c) > 0.2),
)
ITERATIONS = 25


def counts(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """The columns of docs and the counts the rules look at.

    Repeated windows are found by 64-bit hashes of three words inside the row; only rows with a repeated hash sort their windows.
    """
    p = prefix
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    df = docs.withColumn(f"{p}words", F.array_remove(F.split(text, SPACE), "")).withColumn(f"{p}lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    words, lines = F.col(f"{p}words"), F.col(f"{p}lines")
    shown = F.when(F.size(words) >= 3, F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    df = df.withColumn(f"{p}windows", F.coalesce(shown, F.array().cast("array<bigint>")))
    windows = F.col(f"{p}windows")
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    df = df.withColumn(f"{p}ordered", F.when(repeated, F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    ordered = F.col(f"{p}ordered")
    again = F.filter(ordered, lambda x, i: (x["h"] == F.get(ordered, i - 1)["h"]) | (x["h"] == F.get(ordered, i + 1)["h"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    count = lambda pattern: F.length(F.regexp_replace(text, pattern, "")).cast("long")
    new = {
        "n_words": F.size(words).cast("long"), "word_chars": F.length(F.array_join(words, "")).cast("long"), "n_symbols": count(r"[^#*$%&|<>]+"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"), "n_repeat_words": F.when(ordered.isNull(), 0).otherwise(covered).cast("long"),
        "n_small_words": F.size(F.filter(words, lambda w: F.lower(w).isin(FUNCTION_WORDS))).cast("long"),
        "n_ends": F.regexp_count(text, F.lit(r"[.!?](?=[\x20\x09-\x0D]|$)")).cast("long"),
        "n_lines": F.size(lines).cast("long"), "n_upper": count(r"\P{Lu}+"), "n_letters": count(r"\P{L}+"),
    }
    return df.withColumns({f"{p}{k}": v for k, v in new.items()}).drop(*[f"{p}{c}" for c in ("words", "lines", "windows", "ordered")])


def base_failed(prefix: str = "") -> Column:
    words, repeats = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < 50) | (100 * repeats > 50 * words)


def votes(prefix: str = "") -> list[Column]:
    """One vote per rule."""
    c = lambda n: F.col(f"{prefix}{n}")
    return [F.when(against(c), -1).when(favour(c), 1).otherwise(0) for _, favour, against in RULES]


def pattern(prefix: str = "") -> Column:
    """The votes as one number in base 3."""
    return sum(((v + 1) * 3**i for i, v in enumerate(votes(prefix))), F.lit(0))


def fit(patterns: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """(pattern, posterior) of all patterns that occur, from a column `pattern` of all documents; at most 3 ** len(RULES) rows."""
    rules = F.sequence(F.lit(0), F.lit(len(RULES) - 1))
    powers = F.array(*[F.lit(3**i) for i in range(len(RULES))])
    seen = patterns.groupBy("pattern").agg(F.count(F.lit(1)).cast("double").alias("n"))
    vote = F.transform(powers, lambda b: F.floor(F.col("pattern") / b).cast("int") % 3)
    # one row of bounded length; sorted, so that sums have one order
    model = seen.select(F.struct("pattern", vote.alias("v"), "n").alias("p")).agg(F.sort_array(F.collect_list("p")).alias("all"))
    patterns_ = F.col("all")
    # to begin with, the share of the votes in favour (one more of each kind)
    number = lambda p, vote: F.size(F.filter(p["v"], lambda x: x == vote))
    start = F.transform(patterns_, lambda p: (number(p, 2) + 1) / (number(p, 0) + number(p, 2) + 2))

    def step(r: Column) -> Column:
        joined = F.zip_with(patterns_, r, lambda p, q: F.struct(p["v"].alias("v"), (p["n"] * q).alias("g"), (p["n"] * (1 - q)).alias("b")))
        total = lambda c, keep: F.aggregate(joined, F.lit(0.0), lambda acc, x: acc + F.when(keep(x), x[c]).otherwise(0.0))
        # rates of each vote on good and on bad documents, one pseudo-count each
        rates = F.transform(rules, lambda j: F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda v: F.struct(
            F.log((total("g", lambda x: F.get(x["v"], j) == v) + 1) / (total("g", lambda x: F.lit(True)) + 3)).alias("g"),
            F.log((total("b", lambda x: F.get(x["v"], j) == v) + 1) / (total("b", lambda x: F.lit(True)) + 3)).alias("b"),
        )))
        prior = F.log((total("g", lambda x: F.lit(True)) + 1) / (total("b", lambda x: F.lit(True)) + 1))
        theta = F.array(F.struct(rates.alias("rates"), prior.alias("prior")))  # a one-element array binds the value once
        odds = lambda t, p: F.aggregate(rules, t["prior"], lambda acc, j: acc + F.get(F.get(t["rates"], j), F.get(p["v"], j))["g"] - F.get(F.get(t["rates"], j), F.get(p["v"], j))["b"])
        return F.get(F.transform(theta, lambda t: F.transform(patterns_, lambda p: 1 / (1 + F.exp(-odds(t, p))))), F.lit(0))

    posterior = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, lambda r, _: step(r))
    return model.select("all", posterior.alias("r")).select(F.explode(F.arrays_zip("all", "r")).alias("x")).select(F.col("x.all.pattern").alias("pattern"), F.col("x.r").alias("posterior"))


def score(counted: DataFrame, id_cols: list[str], threshold: float = 0.5) -> DataFrame:
    """The counts with base_failed, kept and posterior; `counted` is read twice, so it should be a stored table."""
    table = counted.withColumn("pattern", pattern())
    # at most 3 ** len(RULES) patterns, whatever the input: safe to broadcast
    scored = table.join(F.broadcast(fit(table.select("pattern"))), "pattern")
    kept = ~F.col("base_failed") & (F.col("posterior") >= threshold)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return scored.withColumn("base_failed", base_failed()).select(*id_cols, *base, "base_failed", kept.alias("kept"), "posterior", "pattern")


def keep_good(docs: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs that are kept, with their own columns. The counts are made once: rows are stored with their votes."""
    p = "_quality_"
    while any(c.lower().startswith(p) for c in docs.columns):
        p = f"_{p}"
    voted = staged(counts(docs, text_col, p).select(*[F.col(f"`{c}`") for c in docs.columns], pattern(p).alias(f"{p}of"), base_failed(p).alias(f"{p}failed")), "quality-votes")
    model = fit(voted.select(F.col(f"{p}of").alias("pattern"))).select(F.col("pattern").alias(f"{p}of"), F.col("posterior").alias(f"{p}posterior"))
    marked = voted.join(F.broadcast(model), f"{p}of")
    return marked.where(~F.col(f"{p}failed") & (F.col(f"{p}posterior") >= threshold)).select(*[F.col(f"`{c}`") for c in docs.columns])
