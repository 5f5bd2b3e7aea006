"""Column helpers: choosing columns by type, missing values, row keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

_FLOATS = (T.DoubleType, T.FloatType)
_DATES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def data_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def columns_of(df: DataFrame, *kinds: str) -> list[str]:
    """Columns of the given kinds, in table order: number, bool, text, datetime."""
    test = {
        "number": lambda t: isinstance(t, T.NumericType),
        "bool": lambda t: isinstance(t, T.BooleanType),
        "text": lambda t: isinstance(t, (T.StringType, T.VarcharType, T.CharType)),
        "datetime": lambda t: isinstance(t, _DATES),
    }
    return [f.name for f in df.schema.fields if any(test[k](f.dataType) for k in kinds)]


def value_sql(df: DataFrame, name: str) -> str:
    """The column as SQL text with NaN turned into NULL, so both count as missing."""
    return f"IF(isnan(`{name}`), NULL, `{name}`)" if isinstance(data_type(df, name), _FLOATS) else f"`{name}`"


def number_sql(df: DataFrame, name: str) -> str:
    """The column as SQL text of a double without NaN; booleans become 0 and 1."""
    if isinstance(data_type(df, name), T.BooleanType):
        return f"CAST(CAST(`{name}` AS INT) AS DOUBLE)"
    text = value_sql(df, name)
    return text if isinstance(data_type(df, name), T.DoubleType) else f"CAST({text} AS DOUBLE)"


def value(df: DataFrame, name: str) -> Column:
    return F.expr(value_sql(df, name))


def number(df: DataFrame, name: str) -> Column:
    return F.expr(number_sql(df, name))


def missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    return c.isNull() | F.isnan(c) if isinstance(data_type(df, name), _FLOATS) else c.isNull()


def any_missing(df: DataFrame, names: Sequence[str] | None = None) -> Column:
    result = F.lit(False)
    for n in names if names is not None else df.columns:
        result = result | missing(df, n)
    return result


def chunks(items: Sequence, size: int) -> Iterator[list]:
    """Slices of a column list: one aggregate over too many columns leaves code generation."""
    for i in range(0, len(items), size):
        yield list(items[i : i + size])


def key_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_text(key: str | Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in key_list(key)])


def key_hash(key: str | Sequence[str], seed: int) -> Column:
    """The md5 hex text of 'key|seed': uniform, and in the same order in every SQL engine."""
    return F.md5(F.concat(key_text(key), F.lit(f"|{seed}")))
