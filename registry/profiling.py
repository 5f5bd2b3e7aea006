"""Queries of the profiling operators."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.common import r, rounded, table, union
from tabulens.operators import dimensionality as dim, distribution as dist, granularity as gran, sparsity as spar
from tabulens.operators.project import (
    drop_incomplete_rows, drop_listed, keep_class, keep_columns, keep_kinds, numeric_with_target, outside, positive_values,
)

LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# --- inputs with missing values and extra columns ---------------------------------------------------------


def events_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_type") == "error", "Unknown").otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
    )


EVENTS_WITH_GAPS = """(SELECT event_id, ts, user_id,
  CASE WHEN event_type = 'error' THEN 'Unknown' ELSE event_type END AS event_type,
  CASE WHEN value >= 10 THEN value END AS value FROM events)"""


def orders_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    return o.withColumns({
        "o_totalprice": F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")),
        "o_orderpriority": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
        "is_open": F.col("o_orderstatus") == "O",
    })


ORDERS_WITH_GAPS = """(SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_totalprice >= 50000 THEN o_totalprice END AS o_totalprice, o_orderdate,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority,
  o_orderstatus = 'O' AS is_open FROM orders)"""


#: Columns of dates in further forms: Spark's pattern and the SQL engine's. `day_first` has days beyond 12, so its order is known.
DATE_TEXTS = {
    "day_first": ("dd.MM.yyyy HH:mm", "%d.%m.%Y %H:%M"),
    "slashes": ("yyyy/MM/dd HH:mm:ss", "%Y/%m/%d %H:%M:%S"),
    "named_month": ("dd-MMM-yyyy", "%d-%b-%Y"),
    "month_name": ("MMM dd, yyyy", "%b %d, %Y"),
    "zulu": ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ"),
    "half_day": ("M/d/yyyy h:mm a", "%-m/%-d/%Y %-I:%M %p"),
}


def typed_events(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.select(
        "event_id", "event_type", "value", "ts",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("ts_us"),
        F.when(F.col("event_type") == "error", "2024-01-01").otherwise("01/02/2024").alias("two_dates"),
        F.when(F.col("value") > 100, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "MM/dd/yyyy")).alias("mixed_dates"),
        F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("user_text"),
        (F.col("value") > 50).alias("is_big"),
        *[F.date_format("ts", f).alias(n) for n, (f, _) in DATE_TEXTS.items()],
        F.lit("x").alias("constant"),
        F.lit(None).cast("string").alias("nothing"),
    )


def _semantic_oracle() -> str:
    source = """(SELECT event_id, event_type, value, ts,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, strftime(ts, '%m/%d/%Y %I:%M:%S %p') AS ts_us,
      CASE WHEN event_type = 'error' THEN '2024-01-01' ELSE '01/02/2024' END AS two_dates,
      CASE WHEN value > 100 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%m/%d/%Y') END AS mixed_dates,
      ' ' || user_id::VARCHAR AS user_text, value > 50 AS is_big, DATE_TEXTS, 'x' AS constant, NULL::VARCHAR AS nothing FROM events)""".replace(
        "DATE_TEXTS", ", ".join(f"strftime(ts, '{f}') AS {n}" for n, (_, f) in DATE_TEXTS.items()))
    formats = ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%m/%d/%Y", "%m/%d/%Y %I:%M:%S %p", *[f for _, f in DATE_TEXTS.values()]]
    parts = []
    for c in ["event_id", "event_type", "value", "ts", "ts_text", "ts_us", "two_dates", "mixed_dates", "user_text", "is_big", *DATE_TEXTS, "constant", "nothing"]:
        if c == "ts":
            rest = "'date'"
        else:
            dates = " ".join(
                f"WHEN count_if({c} IS NOT NULL AND try_strptime({c}::VARCHAR, '{f}') IS NULL) = 0 THEN 'date'" for f in formats
            )
            rest = f"CASE WHEN count_if({c} IS NOT NULL AND try_cast(trim({c}::VARCHAR) AS DOUBLE) IS NULL) = 0 THEN 'numeric' {dates} ELSE 'symbolic' END"
        parts.append(f"SELECT '{c}' AS variable, CASE WHEN count(DISTINCT {c}) = 2 THEN 'binary' ELSE {rest} END AS type FROM {source}")
    return union(parts)


def _storage_oracle() -> str:
    parts = [f"SELECT '{c}' AS variable, 'numeric' AS type" for c in ("o_orderkey", "o_custkey", "o_totalprice", "is_open")]
    for c in ("o_orderpriority",):
        parts.append(f"SELECT '{c}' AS variable, CASE WHEN count(DISTINCT {c}) = 2 THEN 'binary' ELSE 'symbolic' END AS type FROM {ORDERS_WITH_GAPS}")
    parts.append(
        f"SELECT 'o_orderdate' AS variable, CASE WHEN count(DISTINCT o_orderdate) = 2 THEN 'binary' ELSE 'symbolic' END AS type "
        f"FROM {ORDERS_WITH_GAPS} HAVING count(DISTINCT o_orderdate) <= 50"
    )
    return union(parts)


# --- dimensionality ----------------------------------------------------------------------------------------


def a03(spark, folder):
    df = typed_events(spark, folder)
    return dim.type_table(df, dim.semantic_types(df))


def a04(spark, folder):
    df = typed_events(spark, folder)
    return dim.type_counts(df, dim.semantic_types(df))


def a05(spark, folder):
    df = orders_with_gaps(spark, folder)
    return dim.type_table(df, dim.storage_types(df, target="o_orderstatus"))


def a06(spark, folder):
    df = orders_with_gaps(spark, folder)
    return dim.type_table(df, dim.name_types(df))


# --- distribution ------------------------------------------------------------------------------------------


def _describe_sql(name: str, source: str, digits: int = 4) -> str:
    v = f"{name}::DOUBLE"
    return f"""SELECT '{name}' AS variable, count({name}) AS n, {r(f'avg({v})', 'mean', digits)}, {r(f'stddev_samp({v})', 'std', digits)},
  {r(f'min({v})', 'min', digits)}, {r(f'quantile_cont({v}, 0.25)', 'q25', digits)}, {r(f'quantile_cont({v}, 0.5)', 'q50', digits)},
  {r(f'quantile_cont({v}, 0.75)', 'q75', digits)}, {r(f'max({v})', 'max', digits)} FROM {source}"""


def _describe_all_oracle() -> str:
    parts = []
    for c in LINE_NUMBERS:
        parts.append(f"""SELECT variable, n, NULL::BIGINT AS "unique", NULL::VARCHAR AS top, NULL::BIGINT AS freq,
  mean, std, min, q25, q50, q75, max FROM ({_describe_sql(c, 'lineitem')})""")
    for c in ("l_returnflag", "l_linestatus"):
        parts.append(f"""SELECT '{c}' AS variable, sum(n)::BIGINT AS n, count(*) AS "unique", first(v ORDER BY n DESC, v) AS top, max(n) AS freq,
  NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS q25, NULL::DOUBLE AS q50, NULL::DOUBLE AS q75, NULL::DOUBLE AS max
  FROM (SELECT {c} AS v, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c})""")
    return union(parts)


def _quartiles(name: str, source: str) -> str:
    v = f"{name}::DOUBLE"
    return f"""(SELECT avg({v}) AS m, stddev_samp({v}) AS s, stddev_pop({v}) AS sp, min({v}) AS mn, max({v}) AS mx, count({v}) AS n,
  quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS q2, quantile_cont({v}, 0.75) AS q3 FROM {source})"""


def _thresholds_oracle() -> str:
    parts = []
    for c in LINE_NUMBERS:
        q = _quartiles(c, "lineitem")
        parts.append(f"SELECT '{c}' AS variable, 'stdev' AS criterion, {r('m - 2 * s', 'bottom', 4)}, {r('m + 2 * s', 'top', 4)} FROM {q}")
        parts.append(f"SELECT '{c}' AS variable, 'iqr' AS criterion, {r('q1 - 1.5 * (q3 - q1)', 'bottom', 4)}, {r('q3 + 1.5 * (q3 - q1)', 'top', 4)} FROM {q}")
    return union(parts)


def _outliers_oracle() -> str:
    parts = []
    for c in ("event_id", "user_id", "value"):
        parts.append(f"""SELECT '{c}' AS variable, count_if({c} > m + 2 * s OR {c} < m - 2 * s) AS n_stdev,
  count_if({c} > q3 + 1.5 * (q3 - q1) OR {c} < q1 - 1.5 * (q3 - q1)) AS n_iqr FROM events, {_quartiles(c, 'events')}""")
    parts.append("SELECT 'is_big' AS variable, 0 AS n_stdev, 0 AS n_iqr")
    return union(parts)


def _bins(name: str, source: str) -> str:
    return f"""(SELECT *, CASE WHEN mx = mn THEN 1 ELSE ceil((mx - mn) / CASE WHEN q3 > q1
     THEN least(2 * (q3 - q1) / pow(n, 1.0 / 3.0), (mx - mn) / (log2(n) + 1)) ELSE (mx - mn) / (log2(n) + 1) END) END::BIGINT AS k
   FROM {_quartiles(name, source)})"""


def _histogram_sql(name: str, source: str, density: bool) -> str:
    out = r("n / (total * ((mx - mn) / k))", "density", 12) if density else "n"
    return f"""SELECT '{name}' AS variable, bin, {r('mn + bin * ((mx - mn) / k)', 'lo', 4)}, {r('mn + (bin + 1) * ((mx - mn) / k)', 'hi', 4)}, {out} FROM (
  SELECT g.bin, b.mn, b.mx, b.k, b.n AS total, coalesce(c.n, 0) AS n
  FROM (SELECT *, unnest(range(k)) AS bin FROM {_bins(name, source)}) g
  JOIN {_bins(name, source)} b ON true
  LEFT JOIN (SELECT least(floor(({name} - mn) * k / (mx - mn))::BIGINT, k - 1) AS bin, count(*) AS n
             FROM {source}, {_bins(name, source)} WHERE {name} IS NOT NULL GROUP BY ALL) c ON c.bin = g.bin)"""


def a15(spark, folder):
    df = dist.histogram(table(spark, folder, "customer"), ["c_acctbal"], density=True)
    return df.select("variable", "bin", F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"), F.round("density", 12).alias("density"))


def _boxplot_oracle() -> str:
    parts = []
    for c in LINE_NUMBERS:
        lo, hi = "q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"
        parts.append(f"""SELECT '{c}' AS variable, {r('any_value(q1)', 'q1', 4)}, {r('any_value(q2)', 'med', 4)}, {r('any_value(q3)', 'q3', 4)},
  {r(f'least(min({c}) FILTER ({c} >= {lo}), any_value(q1))', 'whisker_lo', 4)}, {r(f'greatest(max({c}) FILTER ({c} <= {hi}), any_value(q3))', 'whisker_hi', 4)},
  count_if({c} < {lo} OR {c} > {hi}) AS n_fliers FROM lineitem, {_quartiles(c, 'lineitem')}""")
    return union(parts)


def _fits(c: str, source: str) -> str:
    return f"""(SELECT avg({c}) AS m, stddev_pop({c}) AS s, min({c}) AS mn,
  avg(ln({c})) FILTER ({c} > 0) AS mu, stddev_pop(ln({c})) FILTER ({c} > 0) AS sg FROM {source})"""


FITS = _fits("o_totalprice", "orders")


def a20(spark, folder):
    df = dist.density_grid(table(spark, folder, "orders"), "o_totalprice")
    return df.select("family", "bin", F.round("x", 4).alias("x"), F.round("pdf", 12).alias("pdf"))


def a20_all(spark, folder):
    df = dist.density_grids(table(spark, folder, "lineitem"), LINE_MEASURES)
    return df.select("variable", "family", "bin", F.round("x", 4).alias("x"), F.round("pdf", 9).alias("pdf"))


def _density_oracle(c: str = "o_totalprice", source: str = "orders", digits: int = 12, head: str = "") -> str:
    grid = f"""(SELECT bin, mn + (bin + 0.5) * ((mx - mn) / k) AS x FROM (SELECT *, unnest(range(k)) AS bin FROM {_bins(c, source)}))"""
    x, fits = r("x", "x", 4), _fits(c, source)
    return union([
        f"SELECT {head}'normal' AS family, bin, {x}, {r('exp(-pow((x - m) / s, 2) / 2) / (s * sqrt(2 * pi()))', 'pdf', digits)} FROM {grid}, {fits}",
        f"SELECT {head}'exponential' AS family, bin, {x}, {r('CASE WHEN x >= mn THEN exp(-(x - mn) / (m - mn)) / (m - mn) ELSE 0 END', 'pdf', digits)} FROM {grid}, {fits}",
        f"SELECT {head}'lognormal' AS family, bin, {x}, {r('CASE WHEN x > 0 THEN exp(-pow((ln(x) - mu) / sg, 2) / 2) / (x * sg * sqrt(2 * pi())) ELSE 0 END', 'pdf', digits)} FROM {grid}, {fits}",
    ])


def _fit_oracle() -> str:
    return union([
        f"SELECT '{c}' AS variable, '{family}' AS family, {r(p1, 'p1', 4)}, {r(p2, 'p2', 4)} FROM {_fits(c, 'lineitem')}"
        for c in LINE_MEASURES for family, p1, p2 in (("normal", "m", "s"), ("exponential", "mn", "m - mn"), ("lognormal", "mu", "sg"))
    ])


# --- correlation and pairs ---------------------------------------------------------------------------------


def correlated_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        *LINE_MEASURES,
        (F.col("l_extendedprice") * 1.1).alias("price_tax"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("price_plus"),
        (F.col("l_returnflag") == "R").alias("is_returned"),
        F.lit(7.0).alias("constant"),
    )


CORRELATED = """(SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_extendedprice * 1.1 AS price_tax,
  l_extendedprice + l_quantity AS price_plus, (l_returnflag = 'R')::INT AS is_returned, 7.0 AS constant FROM lineitem)"""
CORRELATED_NAMES = [*LINE_MEASURES, "price_tax", "price_plus", "is_returned", "constant"]


def _correlation_oracle() -> str:
    rows = []
    for a in CORRELATED_NAMES:
        for b in CORRELATED_NAMES:
            if "constant" in (a, b):
                value = "NULL::DOUBLE"
            else:
                value = "1.0::DOUBLE" if a == b else f"abs(corr({a}::DOUBLE, {b}::DOUBLE))"
            rows.append(f"SELECT '{a}' AS v1, '{b}' AS v2, {r(value, 'r')} FROM source" if "corr" in value else f"SELECT '{a}' AS v1, '{b}' AS v2, {value} AS r")
    return f"WITH source AS {CORRELATED}\n" + union(rows)


WIDE = {f"w{i}": (f"(l_orderkey * {i + 1} + l_partkey) % {101 + i}", i % 9) for i in range(36)}


def a21_wide(spark, folder):
    """36 columns of lineitem, most with gaps of their own."""
    wide = table(spark, folder, "lineitem").select(
        "l_quantity", F.lit(7).alias("constant"), *[F.expr(f"CASE WHEN l_linenumber <> {gap} THEN {x} END").alias(c) for c, (x, gap) in WIDE.items()]
    )
    return rounded(spar.correlation_matrix(wide, drop_incomplete=False))


def _wide_oracle() -> str:
    columns = ", ".join(f"CASE WHEN l_linenumber <> {gap} THEN {x} END AS {c}" for c, (x, gap) in WIDE.items())
    names, cells = ["l_quantity", "constant", *WIDE], []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            low, high = (a, b) if i < j else (b, a)
            value = "NULL::DOUBLE" if "constant" in (a, b) else "1.0::DOUBLE" if a == b else f"round(abs(corr({low}::DOUBLE, {high}::DOUBLE)), 6)"
            cells.append(f"{{'v1': '{a}', 'v2': '{b}', 'r': {value}}}")
    return f"""SELECT cell.v1 AS v1, cell.v2 AS v2, cell.r AS r FROM (SELECT unnest(cells) AS cell FROM (
SELECT [{', '.join(cells)}] AS cells FROM (SELECT l_quantity, 7 AS constant, {columns} FROM lineitem)))"""


def _pair_oracle(by_class: bool) -> str:
    edges = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in LINE_MEASURES)
    bins = ", ".join(f"least(floor(({c} - lo_{c}) * 10.0 / (hi_{c} - lo_{c})), 9)::BIGINT AS b_{c}" for c in LINE_MEASURES)
    cls, group = ("class, ", "l_returnflag AS class, ") if by_class else ("", "")
    parts = [
        f"SELECT '{a}' AS v1, '{b}' AS v2, {cls}b_{a} AS bx, b_{b} AS \"by\", count(*) AS n FROM binned GROUP BY {cls}b_{a}, b_{b}"
        for a, b in combinations(LINE_MEASURES, 2)
    ]
    return f"WITH binned AS (SELECT {group}{bins} FROM lineitem, (SELECT {edges} FROM lineitem))\n" + union(parts)


def a22_occupancy(spark, folder):
    return rounded(spar.pair_occupancy(spar.pair_density(table(spark, folder, "lineitem"), LINE_MEASURES)))


# --- granularity -------------------------------------------------------------------------------------------


def d02(spark, folder):
    e = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "not a date").otherwise(F.date_format("ts", "MM/dd/yyyy hh:mm:ss a")).alias("ts"),
    )
    return gran.date_variables_lenient(e, ["ts"], "MM/dd/yyyy hh:mm:ss a").drop("ts")


def d02_inferred(spark, folder):
    """The formats come from the values: one column with the day first, one with the month's name."""
    e = table(spark, folder, "events").select("event_id", F.date_format("ts", "dd.MM.yyyy HH:mm").alias("a"), F.date_format("ts", "MMM dd, yyyy").alias("b"))
    return gran.date_variables_lenient(e, ["a", "b"]).drop("a", "b")


def _levels_oracle(column: str, source: str, levels: list[str]) -> str:
    return union([
        f"SELECT '{p}' AS level, {p}({column})::BIGINT AS value, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {p}({column})"
        for p in levels
    ])


def _values_oracle(columns: dict[str, str]) -> str:
    return union([
        f"SELECT '{c}' AS variable, {c} AS value, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}" for c, t in columns.items()
    ])


QUERIES = {
    "p01_projection": lambda s, d: keep_columns(table(s, d, "lineitem"), ["l_orderkey", "l_quantity", "l_shipdate"]),
    "p02_kind_projection": lambda s, d: keep_kinds(orders_with_gaps(s, d), "number", "bool"),
    "p03_numeric_with_target": lambda s, d: numeric_with_target(table(s, d, "orders"), "o_orderstatus"),
    "p04_drop_listed": lambda s, d: drop_listed(table(s, d, "orders"), ["o_totalprice", "o_orderpriority", "not_there"]),
    "p05_drop_incomplete_rows": lambda s, d: drop_incomplete_rows(orders_with_gaps(s, d)).drop("o_orderdate"),
    "p08_keep_class": lambda s, d: keep_class(table(s, d, "orders"), "o_orderstatus", "F").drop("o_orderdate"),
    "p09_outside_limits": lambda s, d: outside(table(s, d, "events"), "value", 5.0, 150.0).select("event_id", "value"),
    "p10_positive_values": lambda s, d: positive_values(table(s, d, "customer"), "c_acctbal"),
    "a01_records_variables": lambda s, d: dim.records_and_variables(table(s, d, "lineitem")),
    "a02_missing_per_variable": lambda s, d: dim.missing_per_variable(events_with_gaps(s, d)),
    "a03_variable_types": a03,
    "a04_type_counts": a04,
    "a05_storage_types": a05,
    "a06_name_types": a06,
    "a07_dimensionality_table": lambda s, d: dim.dimensionality_table(orders_with_gaps(s, d)),
    "a08_describe_all": lambda s, d: rounded(dist.describe_all(table(s, d, "lineitem")), 4),
    "a09_describe_numeric": lambda s, d: rounded(dist.describe_numeric(table(s, d, "lineitem"), LINE_MEASURES), 4),
    "a10_outlier_thresholds": lambda s, d: rounded(dist.outlier_thresholds(table(s, d, "lineitem")), 4),
    "a11_outlier_counts": lambda s, d: dist.outlier_counts(table(s, d, "events").withColumn("is_big", F.col("value") > 50)),
    "a12a_value_counts_frequency": lambda s, d: dist.value_counts(orders_with_gaps(s, d), "o_orderpriority"),
    "a12b_value_counts_key": lambda s, d: dist.value_counts(orders_with_gaps(s, d), "o_custkey", "key"),
    "a12c_value_counts_missing": lambda s, d: dist.value_counts(orders_with_gaps(s, d), "o_orderpriority", "key", True),
    "a13_class_distribution": lambda s, d: rounded(dist.class_distribution(table(s, d, "orders"), "o_orderstatus")),
    "a14_histogram": lambda s, d: rounded(dist.histogram(table(s, d, "lineitem"), LINE_MEASURES), 4),
    "a15_density_histogram": a15,
    "a16_boxplot_statistics": lambda s, d: rounded(dist.boxplot_statistics(table(s, d, "lineitem")), 4),
    "a16_fliers": lambda s, d: dist.fliers(table(s, d, "events"), "value").select("event_id", "value"),
    "a17_a18_a19_distribution_fits": lambda s, d: rounded(dist.distribution_fits(table(s, d, "orders"), "o_totalprice").drop("label"), 4),
    "a17_a18_a19_fits_all": lambda s, d: rounded(dist.fit_table(table(s, d, "lineitem"), LINE_MEASURES).drop("label"), 4),
    "a20_density_grid": a20,
    "a20_density_grids_all": a20_all,
    "a21_correlation_wide": a21_wide,
    "a21_correlation": lambda s, d: rounded(spar.correlation_matrix(correlated_lines(s, d))),
    "a22_pair_density": lambda s, d: spar.pair_density(table(s, d, "lineitem"), LINE_MEASURES),
    "a22_pair_occupancy": a22_occupancy,
    "a23_pair_density_by_class": lambda s, d: spar.pair_density(table(s, d, "lineitem"), LINE_MEASURES, "l_returnflag"),
    "a24_distinct_counts": lambda s, d: dim.distinct_counts(table(s, d, "lineitem")),
    "a25_sorted_labels": lambda s, d: dim.sorted_labels(table(s, d, "orders"), "o_orderpriority"),
    "a26_majority_baseline": lambda s, d: rounded(dist.majority_baseline(table(s, d, "orders"), "o_orderstatus")),
    "d01_date_variables": lambda s, d: gran.date_variables(table(s, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate"]).drop("o_orderdate"),
    "d02_lenient_dates": d02,
    "d02_inferred_dates": d02_inferred,
    "d03_date_granularity": lambda s, d: gran.date_granularity(table(s, d, "events"), "ts"),
    "d03_date_granularity_frequency": lambda s, d: gran.date_granularity(table(s, d, "orders"), "o_orderdate", order="frequency"),
    "d04_property_granularity": lambda s, d: gran.property_granularity(table(s, d, "part")),
}

ORACLES = {
    "p01_projection": "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem",
    "p02_kind_projection": f"SELECT o_orderkey, o_custkey, o_totalprice, is_open FROM {ORDERS_WITH_GAPS}",
    "p03_numeric_with_target": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
    "p04_drop_listed": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders",
    "p05_drop_incomplete_rows": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, is_open
FROM {ORDERS_WITH_GAPS} WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL""",
    "p08_keep_class": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F'",
    "p09_outside_limits": "SELECT event_id, value FROM events WHERE value > 150.0 OR value < 5.0",
    "p10_positive_values": "SELECT c_acctbal FROM customer WHERE c_acctbal > 0",
    "a01_records_variables": "SELECT count(*) AS records, 11::BIGINT AS variables FROM lineitem",
    "a02_missing_per_variable": f"""SELECT * FROM ({union([
        f"SELECT '{c}' AS variable, count_if({c} IS NULL OR lower({c}::VARCHAR) = 'unknown') AS nr_missing FROM {EVENTS_WITH_GAPS}"
        for c in ('event_id', 'ts', 'user_id', 'event_type', 'value')])}) WHERE nr_missing > 0""",
    "a03_variable_types": _semantic_oracle(),
    "a04_type_counts": f"""SELECT t.type, count(v.type) AS n FROM (VALUES ('numeric'), ('binary'), ('date'), ('symbolic')) t(type)
LEFT JOIN ({_semantic_oracle()}) v ON v.type = t.type GROUP BY t.type""",
    "a05_storage_types": _storage_oracle(),
    "a06_name_types": "SELECT 'o_orderdate' AS variable, 'date' AS type UNION ALL SELECT 'o_orderstatus', 'symbolic' UNION ALL SELECT 'o_orderpriority', 'symbolic'",
    "a07_dimensionality_table": union(
        [f"SELECT 'Records' AS metric, count(*)::BIGINT AS value FROM {ORDERS_WITH_GAPS}"]
        + [f"SELECT '{m}' AS metric, {v}::BIGINT AS value" for m, v in (("Variables", 7), ("Numerical", 3), ("Boolean", 1), ("Categorical", 2), ("Datetime", 1))]
        + [f"SELECT 'Nan Instances' AS metric, count_if(o_totalprice IS NULL OR o_orderpriority IS NULL)::BIGINT AS value FROM {ORDERS_WITH_GAPS}"]
    ),
    "a08_describe_all": _describe_all_oracle(),
    "a09_describe_numeric": union([_describe_sql(c, "lineitem") for c in LINE_MEASURES]),
    "a10_outlier_thresholds": _thresholds_oracle(),
    "a11_outlier_counts": _outliers_oracle(),
    "a12a_value_counts_frequency": f"SELECT o_orderpriority AS value, count(*) AS n FROM {ORDERS_WITH_GAPS} WHERE o_orderpriority IS NOT NULL GROUP BY 1",
    "a12b_value_counts_key": "SELECT o_custkey AS value, count(*) AS n FROM orders GROUP BY 1",
    "a12c_value_counts_missing": f"SELECT o_orderpriority AS value, count(*) AS n FROM {ORDERS_WITH_GAPS} GROUP BY 1",
    "a13_class_distribution": f"SELECT o_orderstatus AS class, count(*) AS n, {r('count(*) / (SELECT count(*) FROM orders)', 'share')} FROM orders GROUP BY 1",
    "a14_histogram": union([_histogram_sql(c, "lineitem", False) for c in LINE_MEASURES]),
    "a15_density_histogram": _histogram_sql("c_acctbal", "customer", True),
    "a16_boxplot_statistics": _boxplot_oracle(),
    "a16_fliers": f"SELECT event_id, value FROM events, {_quartiles('value', 'events')} WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)",
    "a17_a18_a19_distribution_fits": union([
        f"SELECT 'normal' AS family, {r('m', 'p1', 4)}, {r('s', 'p2', 4)} FROM {FITS}",
        f"SELECT 'exponential' AS family, {r('mn', 'p1', 4)}, {r('m - mn', 'p2', 4)} FROM {FITS}",
        f"SELECT 'lognormal' AS family, {r('mu', 'p1', 4)}, {r('sg', 'p2', 4)} FROM {FITS}",
    ]),
    "a17_a18_a19_fits_all": _fit_oracle(),
    "a20_density_grid": _density_oracle(),
    "a20_density_grids_all": union([_density_oracle(c, "lineitem", 9, f"'{c}' AS variable, ") for c in LINE_MEASURES]),
    "a21_correlation_wide": _wide_oracle(),
    "a21_correlation": _correlation_oracle(),
    "a22_pair_density": _pair_oracle(False),
    "a22_pair_occupancy": f"SELECT v1, v2, count(*) AS cells, sum(n)::BIGINT AS n, {r('count(*) / 100.0', 'occupancy')} FROM ({_pair_oracle(False)}) GROUP BY v1, v2",
    "a23_pair_density_by_class": _pair_oracle(True),
    "a24_distinct_counts": union([f"SELECT '{c}' AS variable, count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in [*LINE_NUMBERS, "l_returnflag", "l_linestatus", "l_shipdate"]]),
    "a25_sorted_labels": "SELECT DISTINCT o_orderpriority AS label FROM orders",
    "a26_majority_baseline": f"SELECT {r('max(n) / sum(n)', 'share')} FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus)",
    "d01_date_variables": """SELECT o_orderkey, year(o_orderdate)::INT AS o_orderdate_year, quarter(o_orderdate)::INT AS o_orderdate_quarter,
month(o_orderdate)::INT AS o_orderdate_month, day(o_orderdate)::INT AS o_orderdate_day FROM orders""",
    "d02_lenient_dates": """SELECT event_id, year(t)::INT AS ts_year, quarter(t)::INT AS ts_quarter, month(t)::INT AS ts_month, day(t)::INT AS ts_day, hour(t)::INT AS ts_hour
FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS t FROM events)""",
    "d02_inferred_dates": "SELECT event_id, " + ", ".join(f"{part}(ts)::INT AS {c}_{part}" for c in "ab" for part in ("year", "quarter", "month", "day")) + ", hour(ts)::INT AS a_hour FROM events",
    "d03_date_granularity": _levels_oracle("ts", "events", ["year", "quarter", "month", "day", "hour"]),
    "d03_date_granularity_frequency": _levels_oracle("o_orderdate", "orders", ["year", "quarter", "month", "day"]),
    "d04_property_granularity": _values_oracle({"p_name": "part", "p_brand": "part", "p_type": "part"}),
}
