"""Column and class profiles: one pass over the data each, small results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as val
from ..session import scratch_path
from ..sources.tables import checkpoint_table
from .ordering import counted_percentiles, percentiles


def _rows(df: DataFrame, names: Sequence[str], fields: Sequence[str], key: str) -> DataFrame:
    """Turn one wide row (``<field>_<i>``) into one row per name, without another shuffle."""
    items = [
        F.struct(F.lit(n).alias(key), *[F.col(f"{f}_{i}").alias(f) for f in fields]) for i, n in enumerate(names)
    ]
    return df.select(F.inline(F.array(*items)))


def completeness_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Percentage of present values per column."""
    aggs = [(F.count(c) / val.none_if(F.count(F.lit(1)), 0) * 100).alias(f"pct_{i}") for i, c in enumerate(cols)]
    return _rows(df.agg(*aggs), cols, ["pct"], "column")


def value_counts(df: DataFrame, c: str, keep_null: bool = False) -> DataFrame:
    rows = df if keep_null else df.filter(F.col(c).isNotNull())
    counts = rows.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("pct", F.col("n") / total * 100)


def describe_numeric(df: DataFrame, c: str) -> DataFrame:
    """Count, mean, median, extremes and the share of negative values, as one row."""
    x = F.col(c)
    stats = df.agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.avg((x < 0).cast("int")).alias("negative_share"),
    )
    return stats.withColumn("median", percentiles(df, c, [0.5]).select("p0").scalar())


def share_where(df: DataFrame, cond: Column, name: str) -> DataFrame:
    return df.agg(F.avg(cond.cast("int")).alias(name))


def winsorize(df: DataFrame, c: str, low: float, high: float, out: str | None = None) -> DataFrame:
    """Clip to two percentiles of the column."""
    limits = percentiles(df, c, [low, high])
    a, b = limits.select("p0").scalar(), limits.select("p1").scalar()
    return df.withColumn(out or c, val.clip_range(F.col(c), a, b))


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed; empty bins are not listed."""
    present = df.filter(F.col(c).isNotNull())
    span = present.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias("s")).scalar()
    low = span["lo"]
    width = (span["hi"] - span["lo"]) / bins
    position = F.when(width > 0, F.least(F.floor((F.col(c) - low) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = present.groupBy(position.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "bin", "n", (low + width * F.col("bin")).alias("from"), (low + width * (F.col("bin") + 1)).alias("to")
    )


def box_stats(df: DataFrame, c: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and the count beyond them."""
    q = percentiles(df, c, [0.25, 0.5, 0.75])
    box = q.select(F.struct(F.col("p0").alias("q1"), F.col("p1").alias("median"), F.col("p2").alias("q3")).alias("b"))
    edges = box.scalar()
    reach = (edges["q3"] - edges["q1"]) * 1.5
    x = F.col(c)
    inside = (x >= edges["q1"] - reach) & (x <= edges["q3"] + reach)
    return df.filter(x.isNotNull()).agg(
        F.max(edges["q1"]).alias("q1"), F.max(edges["median"]).alias("median"), F.max(edges["q3"]).alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.sum((~inside).cast("bigint")).alias("outliers"),
    )


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows that have both, in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"r_{i}") for i, (a, b) in enumerate(pairs)])
    upper = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r_{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    lower = [F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"r_{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    same = [F.struct(F.lit(a).alias("a"), F.lit(a).alias("b"), F.lit(1.0).alias("r")) for a in cols]
    return wide.select(F.inline(F.array(*upper, *lower, *same)))


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(F.col(c).alias("value")).filter("value IS NOT NULL").distinct()


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of different present values per column."""
    wide = df.agg(*[F.countDistinct(c).alias(f"n_{i}") for i, c in enumerate(cols)])
    return _rows(wide, cols, ["n"], "column")


def threshold_counts(df: DataFrame, c: str, thresholds: Sequence[float]) -> DataFrame:
    """Counts and shares at or above, and below, several thresholds."""
    x = F.col(c)
    aggs = [F.count(x).alias("_n")]
    for i, t in enumerate(thresholds):
        aggs += [
            F.coalesce(F.sum((x >= t).cast("bigint")), F.lit(0)).alias(f"above_{i}"),
            F.coalesce(F.sum((x < t).cast("bigint")), F.lit(0)).alias(f"below_{i}"),
        ]
    wide = df.agg(*aggs)
    items = [
        F.struct(
            F.lit(float(t)).alias("threshold"), F.col(f"above_{i}").alias("above"), F.col(f"below_{i}").alias("below"),
            (F.col(f"above_{i}") / val.none_if(F.col("_n"), 0)).alias("share_above"),
        )
        for i, t in enumerate(thresholds)
    ]
    return wide.select(F.inline(F.array(*items)))


def confidence_by_class(df: DataFrame, pred: str, confidence: str) -> DataFrame:
    return df.groupBy(F.col(pred).alias("class")).agg(
        F.avg(confidence).alias("mean"), F.min(confidence).alias("min"), F.count(F.lit(1)).alias("n")
    )


def completion_report(df: DataFrame, source: str, confidence: str, level: str | None = None) -> DataFrame:
    """Rows per provenance with mean and median confidence."""
    groups = ([level] if level else []) + [source]
    stats = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.avg(confidence).alias("mean"))
    medians = percentiles(df, confidence, [0.5], groups).select(
        *[F.col(g).alias(f"_o_{g}") for g in groups], F.col("p0").alias("median")
    )
    cond = F.lit(True)
    for g in groups:
        cond = cond & stats[g].eqNullSafe(medians[f"_o_{g}"])
    return stats.join(medians, cond, "left").select(*groups, "n", "mean", "median")


def year_profile(df: DataFrame, c: str, floor: int, as_of: int) -> DataFrame:
    """Count per year inside the window, with the age of that year's network."""
    rows = df.filter(F.col(c).between(floor, as_of))
    return rows.groupBy(F.col(c).alias("year")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "age", F.lit(as_of) - F.col("year")
    )


def year_summary(df: DataFrame, c: str, floor: int, as_of: int) -> DataFrame:
    """One row; years are counted first and written, so that each text is read for its year a single time."""
    years = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    rows = checkpoint_table(years, scratch_path(df.sparkSession, "years")).filter(F.col(c).between(floor, as_of))
    mean = F.sum(F.col(c) * F.col("_n")) / F.sum("_n")
    stats = rows.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), mean.alias("mean_year"), (as_of - mean).alias("mean_age"))
    return stats.withColumn("median_year", counted_percentiles(rows, c, [0.5]).select("p0").scalar())


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def count_where(df: DataFrame, conds: Mapping[str, Column]) -> DataFrame:
    """Rows meeting each condition, one row per condition."""
    names = list(conds)
    wide = df.agg(
        *[F.coalesce(F.sum(conds[n].cast("bigint")), F.lit(0)).alias(f"n_{i}") for i, n in enumerate(names)]
    )
    return _rows(wide, names, ["n"], "test")
