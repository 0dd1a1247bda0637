"""Ranks, running totals and exact percentiles without a single-task window.

A window with no partition key puts a whole table into one task. Here an ordered job
is cut into value ranges first: splitters come from a bounded sample of the distinct
keys, each row finds its range by a few comparisons, totals per range give the offset
of each range, and only the work inside a range is ordered. The range of a row depends
on its value alone, so results are the same in every run and partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import none_if
from ..session import work_units

SAMPLE_PER_RANGE = 16


def splitters(df: DataFrame, key: str, ranges: int) -> list:
    """Cut values from the keys with the smallest hashes: at most 16 per range reach the driver."""
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    sample = keys.orderBy(F.xxhash64(key), key).limit(ranges * SAMPLE_PER_RANGE).collect()
    values = sorted(row[0] for row in sample)
    step = max(1, len(values) // ranges)
    return values[step::step] if len(values) >= 2 * ranges else []


def range_of(c: Column, cuts: Sequence) -> Column:
    """Number of cuts at or below the value, by bisection in generated code."""

    def branch(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(c < F.lit(cuts[middle]), branch(low, middle)).otherwise(branch(middle + 1, high))

    return branch(0, len(cuts))


def _same(a: DataFrame, b: DataFrame, names: Sequence[str]):
    cond = F.lit(True)
    for n in names:
        cond = cond & a[n].eqNullSafe(b[f"_o_{n}"])
    return cond


def prefix_totals(
    df: DataFrame, key: str, measures: Sequence[str], groups: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Add ``before_<measure>``: the total over all smaller keys (larger ones if descending).

    Keys must be unique within a group and not null; collapse duplicates first, which
    also takes the weight off a hot key.
    """
    cuts = splitters(df, key, work_units(df.sparkSession))
    placed = df.withColumn("_range", range_of(F.col(key), cuts))
    by = [*groups, "_range"]
    totals = placed.groupBy(*by).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    way = F.desc if descending else F.asc
    # One row per group and range: at most a thousand per group.
    outer = Window.partitionBy(*groups).orderBy(way("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_o_{c}") for c in by],
        *[F.coalesce(F.sum(f"_t_{m}").over(outer), F.lit(0)).alias(f"_b_{m}") for m in measures],
    )
    inner = Window.partitionBy(*by).orderBy(way(key)).rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumns({f"_w_{m}": F.coalesce(F.sum(m).over(inner), F.lit(0)) for m in measures})
    joined = ranked.join(offsets, _same(ranked, offsets, by), "left")
    return joined.select(
        *df.columns, *[(F.col(f"_w_{m}") + F.col(f"_b_{m}")).alias(f"before_{m}") for m in measures]
    )


def dense_index(df: DataFrame, key: str, name: str) -> DataFrame:
    """Zero-based position of each row in the order of a unique key."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    return prefix_totals(counted, key, ["_one"]).withColumnRenamed("before__one", name).drop("_one")


def percentiles(df: DataFrame, c: str, shares: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """Exact percentiles with linear interpolation as columns ``p0``, ``p1``, ... and ``n``."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(*groups, c).agg(F.count(F.lit(1)).alias("_n"))
    return counted_percentiles(counts, c, shares, groups)


def counted_percentiles(counts: DataFrame, c: str, shares: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """``percentiles`` of values that come once for each group, with their number ``_n``."""
    running = prefix_totals(counts, c, ["_n"], groups)
    sizes = counts.groupBy(*groups).agg(F.sum("_n").alias("_total"))
    if groups:
        other = sizes.select(*[F.col(g).alias(f"_o_{g}") for g in groups], "_total")
        placed = running.join(other, _same(running, other, groups))
    else:
        placed = running.withColumn("_total", sizes.scalar())

    def at(index: Column) -> Column:
        hit = (F.col("before__n") <= index) & (index < F.col("before__n") + F.col("_n"))
        return F.max(F.when(hit, F.col(c)))

    aggs = []
    for i, q in enumerate(shares):
        spot = (F.col("_total") - 1) * F.lit(float(q))
        aggs += [at(F.floor(spot)).alias(f"_lo{i}"), at(F.ceil(spot)).alias(f"_hi{i}")]
    picked = placed.groupBy(*groups).agg(F.max("_total").alias("n"), *aggs)
    out = []
    for i, q in enumerate(shares):
        spot = (F.col("n") - 1) * F.lit(float(q))
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((low + (high - low) * (spot - F.floor(spot))).alias(f"p{i}"))
    return picked.select(*groups, "n", *out)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key; Spark keeps one row per key and task before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def best_per_group(df: DataFrame, keys: Sequence[str], metric: str, tie: Sequence[str]) -> DataFrame:
    """Row of the largest metric per key; ties go to the smallest tie columns."""
    return first_by(df, keys, [F.desc_nulls_last(metric), *[F.asc_nulls_last(t) for t in tie]])


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score, from the highest down, with both rates."""
    steps = df.groupBy(score).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
        F.sum((F.col(label) == 0).cast("bigint")).alias("neg"),
    )
    running = prefix_totals(steps, score, ["pos", "neg"], descending=True)
    totals = steps.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return running.select(
        F.col(score).alias("threshold"),
        (F.col("before_pos") / none_if(totals.select("p").scalar(), 0)).alias("tpr_before"),
        (F.col("before_neg") / none_if(totals.select("n").scalar(), 0)).alias("fpr_before"),
        ((F.col("before_pos") + F.col("pos")) / none_if(totals.select("p").scalar(), 0)).alias("tpr"),
        ((F.col("before_neg") + F.col("neg")) / none_if(totals.select("n").scalar(), 0)).alias("fpr"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the curve by the trapezoid rule, as one row."""
    points = roc_points(df, label, score)
    area = (F.col("fpr") - F.col("fpr_before")) * (F.col("tpr") + F.col("tpr_before")) / 2
    return points.agg(F.sum(area).alias("auc"))
