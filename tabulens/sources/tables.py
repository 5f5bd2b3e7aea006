"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabulens.fixed_values import NA_TOKENS, NUMBER_PATTERN
from tabulens.functions.columns import chunks


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, ORC or CSV by the ending of the path (CSV with header and NA tokens)."""
    if path.endswith(".csv"):
        return read_csv(spark, path)
    return spark.read.orc(path) if path.endswith(".orc") else spark.read.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    na_tokens: Sequence[str] = tuple(NA_TOKENS),
    infer: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with header; a quote inside a quoted field is doubled. NA tokens become NULL before any value is cast.

    With `multi_line` quoted fields may hold line ends; each file is then read by one task.

    With a schema the text is read once and cast. Without one the types are inferred from a first pass in
    which the tokens are already taken out; give a schema for large files.
    """
    text = spark.read.csv(path, header=True, inferSchema=False, escape='"', multiLine=multi_line)
    text = text.select(*[_without_tokens(c, na_tokens).alias(c) for c in text.columns])
    if schema is None:
        if not infer:
            return text
        schema = infer_types(text)
    return text.select(*[_parse(f.name, f.dataType).alias(f.name) for f in schema.fields])


def _without_tokens(name: str, tokens: Sequence[str]):
    c = F.col(f"`{name}`")
    return F.when(~c.isin(list(tokens)), c)


def _parse(name: str, to: T.DataType):
    c = F.col(f"`{name}`")
    if isinstance(to, T.BooleanType):
        return F.when(F.lower(c) == "true", True).when(F.lower(c) == "false", False)
    return c if isinstance(to, T.StringType) else c.try_cast(to)


def infer_types(text: DataFrame) -> T.StructType:
    """Whole number (LONG, or DECIMAL where digits would be lost), decimal number, boolean or text, from one aggregate over the text columns.

    An empty column becomes a number, as do whole numbers with missing values (kept as LONG here).
    """
    fields: dict[str, T.DataType] = {}
    for part in chunks(text.columns, 20):
        checks = []
        for c in part:
            v = F.col(f"`{c}`")
            checks += [
                F.count(v).alias(f"n_{c}"),
                F.count_if(~v.rlike(r"^[+-]?\d+$") | (v.isNotNull() & v.try_cast("bigint").isNull())).alias(f"whole_{c}"),
                F.count_if(~v.rlike(r"^[+-]?0*\d{1,38}$")).alias(f"long_{c}"),
                F.count_if(~v.rlike(NUMBER_PATTERN)).alias(f"number_{c}"),
                F.count_if(~F.lower(v).isin("true", "false")).alias(f"bool_{c}"),
            ]
        row = text.agg(*checks).first()
        for c in part:
            if row[f"n_{c}"] == 0:
                fields[c] = T.DoubleType()
            elif row[f"whole_{c}"] == 0:
                fields[c] = T.LongType()
            elif row[f"long_{c}"] == 0:
                fields[c] = T.DecimalType(38, 0)
            elif row[f"number_{c}"] == 0:
                fields[c] = T.DoubleType()
            elif row[f"bool_{c}"] == 0:
                fields[c] = T.BooleanType()
            else:
                fields[c] = T.StringType()
    return T.StructType([T.StructField(c, fields[c]) for c in text.columns])


def read_train_test(
    spark: SparkSession, train_path: str, test_path: str, target: str
) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """Train table, test table, sorted distinct train labels, feature names."""
    train, test = read_table(spark, train_path), read_table(spark, test_path)
    labels = train.select(target).distinct().orderBy(target)
    return train, test, labels, [c for c in train.columns if c != target]


def write_table(df: DataFrame, path: str, kind: str = "parquet", mode: str = "overwrite") -> None:
    """Distributed write; there is no row-number column to write."""
    if kind == "csv":
        df.write.mode(mode).csv(path, header=True, escape='"')
    else:
        df.write.mode(mode).format(kind).save(path)


def write_result(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A small result table as one CSV file; sizes are bounded by columns, classes or grid points."""
    df.coalesce(1).write.mode(mode).csv(path, header=True)


def open_catalogue(
    spark: SparkSession, entries: Iterable[tuple[str, str, str]]
) -> tuple[list[tuple[str, DataFrame, str]], list[str]]:
    """Open (name, path, target) entries; the names of entries without a file come back as skipped."""
    opened, skipped = [], []
    for name, path, target in entries:
        try:
            opened.append((name, read_table(spark, path), target))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            skipped.append(name)
    return opened, skipped
