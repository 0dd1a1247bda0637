"""Category codes, scaling and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import presets as P
from .ordering import dense_index
from .profiles import class_counts


def fit_codes(df: DataFrame, c: str) -> DataFrame:
    """Alphabetical codes from 0 as ``(value, code)``; a missing category counts as one of its own."""
    filled = F.coalesce(F.col(c).cast("string"), F.lit(P.FILLED_CATEGORY))
    return dense_index(df.select(filled.alias("value")).distinct(), "value", "code").select(
        "value", F.col("code").cast("int").alias("code")
    )


def apply_codes(df: DataFrame, c: str, codes: DataFrame, out: str, known: str | None = None) -> DataFrame:
    """Code of each row; a category the codes lack takes the first. ``known`` flags the others."""
    table = codes.select(F.col("value").alias("_v"), F.col("code").alias("_c"))
    keyed = df.withColumn("_k", F.coalesce(F.col(c).cast("string"), F.lit(P.FILLED_CATEGORY)))
    joined = keyed.join(table, F.col("_k") == F.col("_v"), "left")
    if known:
        joined = joined.withColumn(known, F.col("_c").isNotNull())
    return joined.withColumn(out, F.coalesce(F.col("_c"), F.lit(0))).drop("_k", "_v", "_c")


def decode(df: DataFrame, c: str, codes: DataFrame, out: str) -> DataFrame:
    table = codes.select(F.col("value").alias(out), F.col("code").alias("_c"))
    return df.join(table, F.col(c).cast("int") == F.col("_c"), "left").drop("_c")


def fit_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row of means and population deviations; a constant column is divided by one."""
    aggs = []
    for c in cols:
        sd = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"mean_{c}"), F.when(sd > 0, sd).otherwise(F.lit(1.0)).alias(f"sd_{c}")]
    return df.agg(*aggs)


def apply_scale(df: DataFrame, cols: Sequence[str], scale: DataFrame) -> DataFrame:
    fit = scale.select(F.struct("*").alias("s")).scalar()
    return df.withColumns({c: (F.col(c) - fit[f"mean_{c}"]) / fit[f"sd_{c}"] for c in cols})


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)`` with weight ``total / (classes * n)``."""
    counts = class_counts(df, label)
    whole = counts.agg(F.struct(F.sum("n").alias("t"), F.count(F.lit(1)).alias("k")).alias("s")).scalar()
    return counts.withColumn("weight", whole["t"] / (whole["k"] * F.col("n")))


def with_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = balanced_weights(df, label).select(F.col(label).alias("_l"), F.col("weight").alias(out))
    return df.join(weights, F.col(label) == F.col("_l")).drop("_l")
