"""Date formats of text columns, inferred from the shapes of their values.

A value's shape keeps its separators; a run of four digits becomes y, of one or two digits d, any other run of digits its length, a run of
letters A (but T between date and time, Z, and the day halves AM and PM as P stay apart). One pass counts the shapes of all columns; a column of
dates has one shape, or the same with and without a fraction of seconds. Candidate formats follow from the shape: the order of year, month and
day from where the long group stands, month names from letters, and day and month, where both are short, by counting which order fits
all values. Where both orders fit every value the month comes first.
"""

from __future__ import annotations

from collections.abc import Sequence
import re
import string

from pyspark.sql import Column, DataFrame, functions as F

from tabulens.functions.columns import chunks

#: Digits, and letters without a meaning of their own in `shape`, are alike. Texts up to so many characters are counted before their shapes are taken.
_ALIKE = "123456789" + "".join(c for c in string.ascii_letters if c not in "AaPpMmTZf")
_MASKED = 40
#: Shapes looked at per column; more of them are no dates.
MAX_SHAPES = 4
_DATE = {
    "y{s}d{s}d": ["yyyy{s}M{s}d"],
    "d{s}d{s}y": ["M{s}d{s}yyyy", "d{s}M{s}yyyy"],
    "d{s}A{s}y": ["d{s}MMM{s}yyyy", "d{s}MMMM{s}yyyy"],
    "A{s}d{s}y": ["MMM{s}d{s}yyyy", "MMMM{s}d{s}yyyy"],
    "y{s}A{s}d": ["yyyy{s}MMM{s}d", "yyyy{s}MMMM{s}d"],
}
_TIME = {"": "", "d:d": "H:mm", "d:d:d": "H:mm:ss", "d:d P": "h:mm a", "d:d:d P": "h:mm:ss a", "d:dP": "h:mma", "d:d:dP": "h:mm:ssa"}
_ZONE = {"": "", "Z": "X", "+d:d": "XXX", "+y": "XX"}


def shape(c: Column) -> Column:
    c = F.trim(c)
    for pattern, by in (
        (r"(?<=\d)T(?=\d)", "\u0001"), (r"(?<=\d)Z$", "\u0002"), (r"(?<=[\d ])[AaPp][Mm]$", "\u0003"), (r"(?<=:\d\d)[.,]\d{1,9}", ".f"), (r"(?<=:\d\d(\.f)?)[+-](?=\d{2}:?\d{2}$)", "+"),
        (r"\p{L}(?<!f)[\p{L}]*|(?<![.])f[\p{L}]*", "A"), (r"(?<!\d)\d{1,2}(?!\d)", "d"), (r"(?<!\d)\d{4}(?!\d)", "y"), (r"\d+", "n"),
    ):
        c = F.regexp_replace(c, pattern, by)
    return F.translate(c, "\u0001\u0002\u0003", "TZP")


def mask(c: Column) -> Column:
    """The text with like characters made equal; its shape is the shape of the text."""
    return F.translate(c, _ALIKE, "0" * 9 + "x" * (len(_ALIKE) - 9))


def candidates(shapes: Sequence[str]) -> list[str]:
    """Formats that values of these shapes can have, best first; none if no single format covers them."""
    bare = {s.replace(".f", "") for s in shapes}
    if len(bare) != 1:
        return []
    found = re.fullmatch(r"(?P<date>\w(?P<s>[-/. ]|, )\w(?P<t>[-/. ]|, )\w)(?:(?P<by>T|, | )(?P<time>d:d(?::d)?(?: ?P)?)(?P<zone>Z|\+d:d|\+y)?)?", bare.pop())
    if found is None:
        return []
    zone = _ZONE[found["zone"] or ""]
    time = _TIME[found["time"] or ""]
    if any(".f" in s for s in shapes):
        if "ss" not in time:
            return []
        fraction = ".SSSSSSSSS" if all(".f" in s for s in shapes) else "[.SSSSSSSSS]"
        time = time.replace("ss", f"ss{fraction}")
    by = {"T": "'T'", None: ""}.get(found["by"], found["by"])
    out = []
    for pattern, formats in _DATE.items():
        # names may be followed by a comma before the year, everything else has one separator
        if pattern.format(s="|").split("|") == re.split(r", |[-/. ]", found["date"]) and (found["s"] == found["t"] or "A" in pattern):
            out += [found["s"].join(f.format(s="|").split("|")[:2]) + found["t"] + f.format(s="|").split("|")[2] + by + time + zone for f in formats]
    return out


def _parsed(c: Column, fmt: str) -> Column:
    # a fraction may have fewer digits than the format names
    if "SSSSSSSSS" in fmt:
        digits = F.rpad(F.regexp_extract(c, r"(?<=:\d\d)[.,](\d{1,9})", 1), 9, "0")
        c = F.when(c.rlike(r"(?<=:\d\d)[.,]\d"), F.regexp_replace(c, r"(?<=:\d\d)[.,]\d{1,9}", "\u0001")).otherwise(c)
        c = F.replace(c, F.lit("\u0001"), F.concat(F.lit("."), digits))
    return F.try_to_timestamp(F.trim(c), F.lit(fmt))


def infer_formats(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """The format that fits all values of a column, for the text columns that have one. Empty columns have none."""
    if not names:
        return {}
    # values of one mask have one shape, so the patterns run once a mask; long texts, whose masks can all differ, get their shape at once
    entries = [
        F.struct(F.lit(c).alias("variable"), (F.length(v) > _MASKED).alias("done"), F.when(F.length(v) > _MASKED, shape(v)).otherwise(mask(v)).alias("mask"))
        for c in names for v in (F.col(f"`{c}`"),)
    ]
    masks = df.select(F.inline(F.array(*entries))).where("mask is not null").distinct()
    # values that no date is as long as count as one shape
    long = masks.select("variable", F.when(F.col("done"), F.col("mask")).otherwise(shape(F.col("mask"))).alias("shape")).withColumn("shape", F.when(F.length("shape") <= 24, F.col("shape")).otherwise(""))
    counted = long.groupBy("variable", "shape").count().groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.slice(F.sort_array(F.collect_set(F.substring("shape", 1, 24))), 1, MAX_SHAPES).alias("shapes"))
    few = {r["variable"]: r["shapes"] for r in counted.where(F.col("n") <= MAX_SHAPES).collect()}
    tried = [(c, f) for c, shapes in few.items() for f in candidates(shapes)]
    fits: dict[str, str] = {}
    for part in chunks(tried, 20):
        row = df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & _parsed(F.col(f"`{c}`"), f).isNull()).alias(f"f{i}") for i, (c, f) in enumerate(part)]).first()
        for i, (c, f) in enumerate(part):
            if row[f"f{i}"] == 0:
                fits.setdefault(c, f)
    return fits


def to_dates(df: DataFrame, formats: dict[str, str]) -> DataFrame:
    """The columns as timestamps; what does not fit becomes NULL."""
    return df.withColumns({c: _parsed(F.col(f"`{c}`"), f) for c, f in formats.items()})
