"""Dictionary joins, write-back by key and membership."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as val

# A lookup is a frame (key, value). No join below carries a broadcast hint: Spark
# broadcasts a lookup whose size it knows or measures to be below its threshold,
# and otherwise joins by shuffle, where adaptive execution splits a hot key.


def recode(df: DataFrame, c: str, lookup: DataFrame, out: str | None = None) -> DataFrame:
    """Replace a trimmed text by its lookup value; null where there is none.

    A lookup has no order of its own, so of a repeated key the largest value holds; rows are never doubled.
    """
    out = out or c
    pairs = lookup.groupBy(F.col("key").alias("_key")).agg(F.max("value").alias("_value"))
    keyed = df.withColumn("_text", val.trim_text(F.col(c)))
    joined = keyed.join(pairs, F.col("_text") == F.col("_key"), "left")
    return joined.withColumn(out, F.col("_value")).drop("_text", "_key", "_value")


def unmapped(df: DataFrame, c: str, lookup: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Distinct trimmed values the lookup lacks, null tokens left out."""
    seen = df.select(val.trim_text(F.col(c)).alias("value")).filter(
        F.col("value").isNotNull() & ~F.col("value").isin(list(tokens))
    )
    return seen.distinct().join(lookup.select(F.col("key").alias("value")), "value", "left_anti")


def preflight(
    sources: Sequence[tuple[DataFrame, Mapping[str, str | None]]],
    lookups: Mapping[str, DataFrame],
    tokens: Sequence[str],
    number_text: Sequence[str] = (),
) -> DataFrame:
    """Values of every source, under its own column names, that the lookups lack.

    ``sources`` pairs a frame with its mapping from attribute to column; attributes in
    ``number_text`` are compared in their shortest number form.
    """
    spark = sources[0][0].sparkSession
    report = None
    for attr, lookup in lookups.items():
        seen = None
        for df, mapping in sources:
            column = mapping.get(attr)
            if not column or column.lower() not in {c.lower() for c in df.columns}:
                continue
            text = F.col(column)
            text = val.normalize_number_text(text, tokens) if attr in number_text else val.trim_text(text)
            part = df.select(text.alias("value")).distinct()
            seen = part if seen is None else seen.union(part)
        if seen is None:
            continue
        missing = unmapped(seen, "value", lookup, tokens).select(F.lit(attr).alias("attribute"), "value")
        report = missing if report is None else report.union(missing)
    return report if report is not None else spark.createDataFrame([], "attribute string, value string")


def merge_back(base: DataFrame, updates: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Take new values by key where they are present, else keep the old ones.

    Of several updates of a key the one with the largest values holds; rows are never doubled.
    """
    best = updates.groupBy(F.col(key).alias("_id")).agg(F.max(F.struct(*cols)).alias("_new"))
    fresh = best.select("_id", *[F.col(f"_new.{c}").alias(f"_new_{c}") for c in cols])
    joined = base.join(fresh, F.col(key) == F.col("_id"), "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in cols}).select(*base.columns)


def flag_members(df: DataFrame, key: str, members: DataFrame, name: str) -> DataFrame:
    """Whether the key occurs among the members."""
    ids = members.select(F.col(key).alias("_id")).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(ids, F.col(key) == F.col("_id"), "left")
    return joined.withColumn(name, F.coalesce(F.col("_hit"), F.lit(False))).drop("_id", "_hit")


def mode_value(df: DataFrame, c: str, token: str | None = None) -> DataFrame:
    """Most frequent value as a one-row frame; the smallest among equals."""
    rows = df.filter(F.col(c).isNotNull())
    if token is not None:
        rows = rows.filter(F.col(c) != token)
    counts = rows.groupBy(F.col(c).alias("value")).count()
    return counts.orderBy(F.desc("count"), F.asc("value")).limit(1).select("value")


def fill_token_with_mode(df: DataFrame, c: str, token: str) -> DataFrame:
    """Replace a token by the mode; null cells and an absent mode leave the row as it is."""
    mode = mode_value(df, c, token).scalar()
    return df.withColumn(c, F.when(F.col(c) == token, F.coalesce(mode, F.col(c))).otherwise(F.col(c)))
