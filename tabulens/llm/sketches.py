"""Document fingerprints: every shingle hash below a fixed fraction of the hash range, so sketches of any two documents compare.

Everything is a DataFrame expression. Shingles are five words (fewer: the whole text), hashed to 64 bits. The sketch of a set of shingles
is exactly its hashes below the bound, so the sketch of a union is the union of sketches, and |A & B| / |A| in sketches estimates
how much of A is contained in B, however unequal their sizes. A fingerprint is written as the number of different shingles, a colon, and
the retained hashes in order, 16 hex digits each. A set of few shingles may have none below the bound; its fingerprint has a second
colon and then all its hashes, and two such sets are compared exactly.

Defined results: null texts are empty and have the fingerprint "0:"; two empty sets are alike; a set without a retained hash and one with
some are estimated to share nothing, and how much of the former the latter contains is null;
repeated rows (same id and text) are one document in the order of documents and each get a row; rows of one id with different texts
follow each other by a hash of their texts; a null id comes first; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabulens.llm.common import staged

SPACE = r"[\x20\x09-\x0D]+"
#: One in FRACTION hashes is retained.
FRACTION = 2
WORDS = 5


def with_shingles(df: DataFrame, text: str, out: str, words: int = WORDS) -> DataFrame:
    """Adds the sorted different shingle hashes of column `text` as array<bigint> `out`."""
    w = F.col(f"{out}_w")
    df = df.withColumn(f"{out}_w", F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), ""))
    many = F.transform(F.sequence(F.lit(0), F.size(w) - words), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)]))
    all_ = F.when(F.size(w) >= words, many).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, F.array_distinct(all_)).drop(f"{out}_w")


def sketch(shingles: Column, fraction: int = FRACTION) -> Column:
    """The retained hashes, in order."""
    bound = -(1 << 63) + (1 << 64) // fraction
    return F.sort_array(F.filter(shingles, lambda h: h < F.lit(bound)))


def fingerprint(all_: Column, kept: Column) -> Column:
    """The written form of a sketch of the shingles all_."""
    rest = F.when((F.size(kept) == 0) & (F.size(all_) > 0), F.concat(F.lit(":"), _hex(F.sort_array(all_)))).otherwise("")
    return F.concat(F.size(all_).cast("string"), F.lit(":"), _hex(kept), rest)


def _hex(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all; null if both sketches are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.try_divide(both.cast("double"), F.size(a) + F.size(b) - both)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of a that b has; null if the sketch of a is empty."""
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(a))


def merge(sketches: Column) -> Column:
    """Aggregate: the sketch of all documents of a group."""
    return F.sort_array(F.array_distinct(F.flatten(F.collect_set(sketches))))


def _likeness(a: str, b: str) -> Column:
    """From the sketches; from all shingles if both sketches are empty."""
    exact = F.coalesce(resemblance(F.col(f"{a}_all"), F.col(f"{b}_all")), F.lit(1.0))
    return F.coalesce(resemblance(F.col(f"{a}_s"), F.col(f"{b}_s")), exact)


def _share(a: str, b: str) -> Column:
    """From the sketches; from all shingles if both sketches are empty."""
    exact = F.when(F.size(f"{b}_s") == 0, containment(F.col(f"{a}_all"), F.col(f"{b}_all")))
    return F.coalesce(containment(F.col(f"{a}_s"), F.col(f"{b}_s")), exact)


def successors(keys: DataFrame) -> DataFrame:
    """(k, next_k) of rows (id, k) in the order of id and k, the first after the last. Partitions are cut by range and never meet in one task:
    only the first row of each does."""
    ordered = staged(keys.distinct().repartitionByRange(F.col("id").asc_nulls_first(), "k").select("id", "k", F.spark_partition_id().alias("part")), "order")
    inner = Window.partitionBy("part").orderBy(F.col("id").asc_nulls_first(), "k")
    heads = ordered.select("part", "k", F.row_number().over(inner).alias("i")).where("i = 1").select("part", "k")
    outer = Window.orderBy("part")  # one row per partition
    around = heads.select(F.col("part"), F.lead("k").over(outer).alias("head"), F.first("k").over(outer).alias("top"))
    following = ordered.select("part", "k", F.lead("k").over(inner).alias("following")).join(around.select("part", F.coalesce("head", "top").alias("head")), "part")
    return following.select("k", F.coalesce("following", "head").alias("next_k"))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: int = FRACTION) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, within_edited, within_next, next_id).

    The edited text has the last half of a document replaced by the beginning of the next one. Texts are shuffled twice, to their own row
    and to that of the document before; shingles are made where they are compared, as they take more room than the texts.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("k", F.xxhash64("doc_id", "text"))
    light = staged(rows.select("doc_id", "k", F.floor(F.length("text") / 2).cast("int").alias("half")).distinct(), "halves")
    order = successors(light.select(F.col("doc_id").alias("id"), "k"))
    before = order.join(light.select("k", "half"), "k").select(F.col("k").alias("before_k"), F.col("half").alias("before_half"), F.col("next_k").alias("k"))
    own = rows.select("doc_id", "k", "text")
    # both joins take the same columns of `own` by the same key, so its texts are shuffled once and the exchange is used again
    given = own.join(before, "k").select(
        F.col("before_k").alias("k"), "before_half", F.col("doc_id").alias("next_id"), F.col("text").alias("next")
    ).dropDuplicates(["k"])
    pairs = own.join(given, "k")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.expr("substring(next, 1, before_half)"))
    pairs = pairs.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.col("text").alias("own"), edited.alias("edited"), "next", "next_id")
    for name in ("own", "edited", "next"):
        pairs = with_shingles(pairs, name, f"{name}_all").withColumn(f"{name}_s", sketch(F.col(f"{name}_all"), fraction))
    return pairs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("own_all"), F.col("own_s")).alias("fingerprint"), fingerprint(F.col("edited_all"), F.col("edited_s")).alias("edited_fingerprint"),
        _likeness("own", "edited").alias("near_edited"), _likeness("own", "next").alias("near_next"),
        _share("own", "edited").alias("within_edited"), _share("own", "next").alias("within_next"), "next_id",
    )
