"""Descriptive statistics, outliers, histograms, box plots, distribution fits, value counts.

Every statistic of a numeric variable comes from global aggregates of bounded size: moments in one pass,
exact quartiles from `order_statistics`. Only these few numbers per variable reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabulens.fixed_values import IQR_FACTOR, NR_STDEV
from tabulens.functions.columns import chunks, columns_of, number, value
from tabulens.functions.order_statistics import exact_quantiles

# Wider aggregates leave whole-stage code generation.
_COLUMNS_PER_JOB = 11
_FITS_PER_JOB = 12


@dataclass
class Summary:
    """Moments and quartiles of one numeric variable; None where there is no value."""

    n: int
    mean: float | None
    std: float | None
    low: float | None
    high: float | None
    q25: float | None = None
    q50: float | None = None
    q75: float | None = None


def summarise(df: DataFrame, names: Sequence[str], quartiles: bool = True, exact: bool = True) -> dict[str, Summary]:
    """Summaries of numeric (or boolean) columns.

    `exact=False` takes the quartiles from the quantile sketch in the same pass as the moments.
    """
    result: dict[str, Summary] = {}
    shares = [0.25, 0.5, 0.75]
    for part in chunks(list(names), _COLUMNS_PER_JOB):
        aggregates = []
        for i, c in enumerate(part):
            v = number(df, c)
            aggregates += [
                F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"),
                F.min(v).alias(f"low{i}"), F.max(v).alias(f"high{i}"),
            ]
            if quartiles and not exact:
                aggregates.append(F.percentile_approx(v, shares, 10_000).alias(f"q{i}"))
        row = df.agg(*aggregates).first()
        for i, c in enumerate(part):
            s = Summary(row[f"n{i}"], row[f"mean{i}"], row[f"std{i}"], row[f"low{i}"], row[f"high{i}"])
            if quartiles and not exact and s.n:
                s.q25, s.q50, s.q75 = row[f"q{i}"]
            result[c] = s
    if quartiles and exact:
        found = exact_quantiles(df, {c: number(df, c) for c in names}, {c: result[c].n for c in names}, shares)
        for c in names:
            result[c].q25, result[c].q50, result[c].q75 = found[c]
    return result


def describe_numeric(
    df: DataFrame,
    names: Sequence[str] | None = None,
    exact: bool = True,
    summaries: dict[str, Summary] | None = None,
) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per number column."""
    names = list(names) if names is not None else columns_of(df, "number")
    summaries = summaries or summarise(df, names, exact=exact)
    rows = [
        (c, s.n, s.mean, s.std, s.low, s.q25, s.q50, s.q75, s.high) for c in names if (s := summaries[c])
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "variable string, n bigint, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double",
    )


def top_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value (smallest on a tie) and its frequency per variable."""
    return (
        _pairs(df, names).filter(F.col("value").isNotNull())
        .groupBy("variable", "value").agg(F.count("*").alias("n"))
        .groupBy("variable").agg(
            F.sum("n").alias("n"),
            F.count("*").alias("unique"),
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
            F.max("n").alias("freq"),
        )
    )


def _pairs(df: DataFrame, names: Sequence[str]) -> DataFrame:
    entries = [
        F.struct(F.lit(c).alias("variable"), value(df, c).cast("string").alias("value")) for c in names
    ]
    return df.select(F.inline(F.array(*entries)))


def describe_all(df: DataFrame, exact: bool = True, summaries: dict[str, Summary] | None = None) -> DataFrame:
    """The numeric summary and the top-value summary of text and boolean columns in one table."""
    spark = df.sparkSession
    numeric = describe_numeric(df, exact=exact, summaries=summaries).select(
        "variable", "n",
        F.lit(None).cast("bigint").alias("unique"), F.lit(None).cast("string").alias("top"),
        F.lit(None).cast("bigint").alias("freq"),
        "mean", "std", "min", "q25", "q50", "q75", "max",
    )
    others = columns_of(df, "text", "bool")
    if not others:
        return numeric
    empty = [F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    names = spark.createDataFrame([(c,) for c in others], "variable string")
    text = names.join(top_values(df, others), "variable", "left").select(
        "variable", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("unique", F.lit(0)).alias("unique"),
        "top", "freq", *empty,
    )
    return numeric.unionByName(text)


def thresholds(s: Summary, criterion: str, factor: float | None = None) -> tuple[float, float] | None:
    """(bottom, top) of one variable by standard deviations or by the inter-quartile range."""
    if criterion == "stdev":
        if s.std is None:
            return None
        width = (NR_STDEV if factor is None else factor) * s.std
        return s.mean - width, s.mean + width
    if s.q25 is None:
        return None
    width = (IQR_FACTOR if factor is None else factor) * (s.q75 - s.q25)
    return s.q25 - width, s.q75 + width


def outlier_thresholds(
    df: DataFrame, names: Sequence[str] | None = None, nr_stdev: float = NR_STDEV, iqr_factor: float = IQR_FACTOR
) -> DataFrame:
    names = list(names) if names is not None else columns_of(df, "number")
    rows = []
    for c, s in summarise(df, names).items():
        for criterion, factor in (("stdev", nr_stdev), ("iqr", iqr_factor)):
            bottom, top = thresholds(s, criterion, factor) or (None, None)
            rows.append((c, criterion, bottom, top))
    return df.sparkSession.createDataFrame(rows, "variable string, criterion string, bottom double, top double")


def outlier_counts(
    df: DataFrame,
    names: Sequence[str] | None = None,
    nr_stdev: float = NR_STDEV,
    iqr_factor: float = IQR_FACTOR,
    summaries: dict[str, Summary] | None = None,
) -> DataFrame:
    """Values strictly outside the thresholds per variable; boolean variables count none."""
    names = list(names) if names is not None else columns_of(df, "number", "bool")
    numbers = [c for c in names if c in columns_of(df, "number")]
    summaries = summaries or summarise(df, numbers)
    result = None
    for part in chunks(names, _COLUMNS_PER_JOB):
        aggregates, entries = [], []
        for c in part:
            cells = [F.lit(c).alias("variable")]
            for criterion, factor in (("stdev", nr_stdev), ("iqr", iqr_factor)):
                limits = thresholds(summaries[c], criterion, factor) if c in numbers else None
                v = number(df, c)
                flag = (v < limits[0]) | (v > limits[1]) if limits else F.lit(False)
                aggregates.append(F.count_if(flag).alias(f"{criterion}_{c}"))
                cells.append(F.col(f"`{criterion}_{c}`").alias(f"n_{criterion}"))
            entries.append(F.struct(*cells))
        rows = df.agg(*aggregates).select(F.inline(F.array(*entries)))
        result = rows if result is None else result.unionAll(rows)
    return result


def value_counts(df: DataFrame, column: str, order: str = "frequency", with_missing: bool = False) -> DataFrame:
    """Counts per value in frequency order (ties by value) or key order, with or without missing values."""
    counted = df.select(value(df, column).alias("value")).groupBy("value").agg(F.count("*").alias("n"))
    if not with_missing:
        counted = counted.filter(F.col("value").isNotNull())
    if order == "frequency":
        return counted.orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return counted.orderBy(F.asc_nulls_last("value"))


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows and share per class; the total comes from the few class rows, not from the table again."""
    counted = value_counts(df.select(F.col(target).cast("string").alias(target)), target, "key")
    total = counted.agg(F.sum("n")).scalar()
    return counted.select(F.col("value").alias("class"), "n", (F.col("n") / total).alias("share"))


def majority_baseline(df: DataFrame, target: str) -> DataFrame:
    """Share of the most frequent class."""
    counted = df.groupBy(target).agg(F.count("*").alias("n"))
    return counted.agg((F.max("n") / F.sum("n")).alias("share"))


@dataclass
class Bins:
    low: float
    high: float
    count: int

    @property
    def width(self) -> float:
        return (self.high - self.low) / self.count


def automatic_bins(s: Summary) -> Bins | None:
    """Equal-width bins: the smaller of the Freedman-Diaconis and the Sturges width.

    Without spread between the quartiles the Sturges width is taken; a constant gets one bin of width one.
    """
    if not s.n:
        return None
    spread = s.high - s.low
    if spread == 0:
        return Bins(s.low - 0.5, s.high + 0.5, 1)
    sturges = spread / (math.log2(s.n) + 1)
    freedman = 2.0 * (s.q75 - s.q25) / s.n ** (1.0 / 3.0)
    width = min(freedman, sturges) if freedman > 0 else sturges
    return Bins(s.low, s.high, max(1, math.ceil(spread / width)))


def bin_number(v: Column, bins: Bins) -> Column:
    """Bin of a value, zero-based; the last bin includes its upper edge."""
    place = F.floor((v - F.lit(bins.low)) * F.lit(float(bins.count)) / F.lit(bins.high - bins.low))
    return F.least(place, F.lit(bins.count - 1)).cast("bigint")


def histogram(
    df: DataFrame, names: Sequence[str], density: bool = False, summaries: dict[str, Summary] | None = None
) -> DataFrame:
    """(variable, bin, lo, hi, n) for all variables in one counting pass, empty bins included."""
    summaries = summaries or summarise(df, names)
    bins = {c: b for c in names if (b := automatic_bins(summaries[c]))}
    spark = df.sparkSession
    if not bins:
        return spark.createDataFrame([], "variable string, bin bigint, lo double, hi double, n bigint")
    entries = [
        F.struct(F.lit(c).alias("variable"), bin_number(number(df, c), b).alias("bin")) for c, b in bins.items()
    ]
    counted = (
        df.select(F.inline(F.array(*entries))).filter(F.col("bin").isNotNull())
        .groupBy("variable", "bin").agg(F.count("*").alias("n"))
    )
    grid = _bin_grid(spark, bins)
    result = grid.join(counted, ["variable", "bin"], "left").select(
        "variable", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n")
    )
    if not density:
        return result
    totals = {c: summaries[c].n for c in bins}
    scale = F.element_at(
        F.create_map(*[F.lit(x) for c, b in bins.items() for x in (c, float(totals[c]) * b.width)]), F.col("variable")
    )
    return result.select("variable", "bin", "lo", "hi", (F.col("n") / scale).alias("density"))


def _bin_grid(spark: SparkSession, bins: dict[str, Bins]) -> DataFrame:
    grid = None
    for c, b in bins.items():
        step = F.lit((b.high - b.low) / b.count)
        rows = spark.range(b.count).select(
            F.lit(c).alias("variable"), F.col("id").alias("bin"),
            (F.lit(b.low) + F.col("id") * step).alias("lo"), (F.lit(b.low) + (F.col("id") + 1) * step).alias("hi"),
        )
        grid = rows if grid is None else grid.unionAll(rows)
    return grid


def boxplot_statistics(
    df: DataFrame,
    names: Sequence[str] | None = None,
    factor: float = IQR_FACTOR,
    summaries: dict[str, Summary] | None = None,
) -> DataFrame:
    """Quartiles, whiskers (last values inside the fences) and fliers per variable."""
    names = list(names) if names is not None else columns_of(df, "number")
    summaries = {c: s for c, s in (summaries or summarise(df, names)).items() if s.n and c in names}
    result = None
    for part in chunks(list(summaries), _COLUMNS_PER_JOB):
        aggregates, entries = [], []
        for i, c in enumerate(part):
            s, v = summaries[c], number(df, c)
            low, high = thresholds(s, "iqr", factor)
            aggregates += [
                F.min(F.when(v >= low, v)).alias(f"lo{i}"), F.max(F.when(v <= high, v)).alias(f"hi{i}"),
                F.count_if((v < low) | (v > high)).alias(f"out{i}"),
            ]
            # A whisker never ends inside the box, also when the fence falls between two values.
            entries.append(F.struct(
                F.lit(c).alias("variable"), F.lit(s.q25).alias("q1"), F.lit(s.q50).alias("med"), F.lit(s.q75).alias("q3"),
                F.least(F.col(f"lo{i}"), F.lit(s.q25)).alias("whisker_lo"),
                F.greatest(F.col(f"hi{i}"), F.lit(s.q75)).alias("whisker_hi"),
                F.col(f"out{i}").alias("n_fliers"),
            ))
        rows = df.agg(*aggregates).select(F.inline(F.array(*entries)))
        result = rows if result is None else result.unionAll(rows)
    return result


def fliers(df: DataFrame, name: str, factor: float = IQR_FACTOR) -> DataFrame:
    """The rows drawn as single points of a box plot."""
    low, high = thresholds(summarise(df, [name])[name], "iqr", factor)
    v = number(df, name)
    return df.filter((v < low) | (v > high))


@dataclass
class Fit:
    family: str
    label: str
    p1: float
    p2: float

    def density(self, x: Column) -> Column:
        if self.family == "normal":
            return F.exp(-F.pow((x - self.p1) / self.p2, F.lit(2.0)) / 2) / (self.p2 * math.sqrt(2 * math.pi))
        if self.family == "exponential":
            return F.when(x >= self.p1, F.exp(-(x - self.p1) / self.p2) / self.p2).otherwise(0.0)
        inside = F.exp(-F.pow((F.ln(x) - self.p1) / self.p2, F.lit(2.0)) / 2)
        return F.when(x > 0, inside / (x * (self.p2 * math.sqrt(2 * math.pi)))).otherwise(0.0)


def fit_all(df: DataFrame, names: Sequence[str]) -> dict[str, list[Fit]]:
    """Normal, exponential and log-normal maximum-likelihood fits of each variable, from one aggregate per group of columns.

    Parameters are (mean, population deviation), (minimum, mean - minimum) and (mean, deviation) of the
    logarithm of the positive values. A family that the values don't allow is left out.
    """
    result = {}
    for part in chunks(list(names), _FITS_PER_JOB):
        aggregates = []
        for i, c in enumerate(part):
            v = number(df, c)
            log_v = F.when(v > 0, F.ln(v))
            aggregates += [
                F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_pop(v).alias(f"dev{i}"), F.min(v).alias(f"low{i}"),
                F.count(log_v).alias(f"n_log{i}"), F.avg(log_v).alias(f"mu{i}"), F.stddev_pop(log_v).alias(f"sigma{i}"),
            ]
        row = df.agg(*aggregates).first()
        for i, c in enumerate(part):
            n, mean, dev, low, n_log, mu, sigma = (row[f"{k}{i}"] for k in ("n", "mean", "dev", "low", "n_log", "mu", "sigma"))
            fits = result.setdefault(c, [])
            if n and dev > 0:
                fits.append(Fit("normal", f"Normal({mean:.1f},{dev:.2f})", mean, dev))
            if n and mean - low > 0:
                fits.append(Fit("exponential", f"Exp({1 / (mean - low):.2f})", low, mean - low))
            if n_log > 1 and sigma > 0:
                fits.append(Fit("lognormal", f"LogNor({mu:.1f},{sigma:.2f})", mu, sigma))
    return result


def fit_distributions(df: DataFrame, name: str) -> list[Fit]:
    """The fits of one variable."""
    return fit_all(df, [name])[name]


def fit_table(df: DataFrame, names: Sequence[str], fits: dict[str, list[Fit]] | None = None) -> DataFrame:
    """(variable, family, label, p1, p2) of all variables."""
    rows = [(c, f.family, f.label, f.p1, f.p2) for c, found in (fits or fit_all(df, names)).items() for f in found]
    return df.sparkSession.createDataFrame(rows, "variable string, family string, label string, p1 double, p2 double")


def density_grids(
    df: DataFrame, names: Sequence[str], fits: dict[str, list[Fit]] | None = None, summaries: dict[str, Summary] | None = None
) -> DataFrame:
    """(variable, family, bin, x, pdf): fitted densities at the bin centres of all variables; beside the summaries one pass over the rows."""
    fits, summaries = fits or fit_all(df, names), summaries or summarise(df, names)
    result = None
    for c in names:
        if not (fits[c] and (bins := automatic_bins(summaries[c]))):
            continue
        step = (bins.high - bins.low) / bins.count
        centres = df.sparkSession.range(bins.count).select(F.col("id").alias("bin"), (F.lit(bins.low) + (F.col("id") + 0.5) * F.lit(step)).alias("x"))
        entries = [F.struct(F.lit(c).alias("variable"), F.lit(f.family).alias("family"), F.col("bin"), F.col("x"), f.density(F.col("x")).alias("pdf")) for f in fits[c]]
        rows = centres.select(F.inline(F.array(*entries)))
        result = rows if result is None else result.unionAll(rows)
    return df.sparkSession.createDataFrame([], "variable string, family string, bin bigint, x double, pdf double") if result is None else result


def distribution_fits(df: DataFrame, name: str) -> DataFrame:
    rows = [(f.family, f.label, f.p1, f.p2) for f in fit_distributions(df, name)]
    return df.sparkSession.createDataFrame(rows, "family string, label string, p1 double, p2 double")


def density_grid(df: DataFrame, name: str) -> DataFrame:
    """Fitted densities at the centres of the automatic histogram bins."""
    return density_grids(df, [name]).drop("variable")
