"""Projection and schema operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def harmonize(
    df: DataFrame, mapping: Mapping[str, str | None], types: Mapping[str, str], extra: Sequence[str] = ()
) -> DataFrame:
    """Rename a source's own columns to the unified attributes and add the absent ones as null.

    ``mapping`` gives the source column of each attribute. If two attributes name the
    same source column the later one gets it. ``extra`` columns pass through.
    """
    present = {c.lower() for c in df.columns}
    owner = {src: attr for attr, src in mapping.items() if src and src.lower() in present}
    source = {attr: src for src, attr in owner.items()}
    out = []
    for attr, kind in types.items():
        if attr in source:
            out.append(F.col(source[attr]).cast(kind).alias(attr))
        elif attr.lower() in present and attr not in owner and attr not in mapping.values():
            out.append(F.col(attr).cast(kind).alias(attr))
        else:
            out.append(F.lit(None).cast(kind).alias(attr))
    return df.select(*out, *[F.col(c) for c in extra])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column one frame lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def tag(df: DataFrame, **consts) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in consts.items()})


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name (names compare without case)."""
    unique = [f"_{i}" for i in range(len(df.columns))]
    first: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        first.setdefault(name.lower(), i)
    positional = df.toDF(*unique)
    return positional.select(*[F.col(unique[i]).alias(df.columns[i]) for i in first.values()])


def keep_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    present = {c.lower() for c in df.columns}
    return df.select(*[c for c in cols if c.lower() in present])


def drop_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def set_where(df: DataFrame, cond: Column, name: str, value: Column) -> DataFrame:
    """Assign under a mask; a null condition leaves the row alone."""
    old = F.col(name) if name in df.columns else F.lit(None)
    return df.withColumn(name, F.when(cond, value).otherwise(old))


def with_row_id(df: DataFrame, keys: Sequence[str], name: str = "row_id") -> DataFrame:
    """Identity from the natural key, the same in every run and partitioning."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys]
    return df.withColumn(name, F.md5(F.concat_ws("|", *parts)))


def stringify_complex(df: DataFrame, keep: Sequence[str] = ("geom",)) -> DataFrame:
    """Dates, timestamps and nested values as text for a flat sink; null stays null."""
    flat = (T.NumericType, T.StringType, T.BooleanType)
    return df.select(
        *[
            F.col(f.name)
            if isinstance(f.dataType, flat) or f.name in keep
            else F.col(f.name).cast("string").alias(f.name)
            for f in df.schema.fields
        ]
    )
