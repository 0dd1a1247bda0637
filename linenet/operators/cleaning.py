"""Table-level cleaning and filtering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as geo
from ..functions import values as val


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def nullify_tokens(df: DataFrame, tokens: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Null for every cell of a text column that is exactly a token."""
    names = _strings(df) if cols is None else cols
    return df.withColumns({c: val.nullify(F.col(c), tokens) for c in names})


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns are read as numbers; numeric ones only lose NaN and infinities."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out: dict[str, Column] = {}
    for c in cols:
        if isinstance(kinds[c], T.StringType):
            out[c] = val.to_double(F.col(c))
        elif isinstance(kinds[c], T.NullType):
            out[c] = F.lit(None).cast("double")
        else:
            out[c] = val.finite(F.col(c).cast("double"))
    return df.withColumns(out)


def zero_to_null(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.withColumns({c: val.zero_to_null(F.col(c)) for c in cols if c not in keep})


def labels_to_null(df: DataFrame, c: str, labels: Sequence) -> DataFrame:
    return df.withColumn(c, val.nullify(F.col(c), labels))


def filter_valid_lines(df: DataFrame, min_length: float, geom: str = "geom") -> DataFrame:
    g = F.col(geom)
    return df.filter(geo.is_line(g) & geo.longer_than(g, min_length))


def completeness(df: DataFrame, cols: Sequence[str], name: str = "completeness") -> DataFrame:
    return df.withColumn(name, val.present_share([F.col(c) for c in cols]))


def filter_complete(df: DataFrame, cols: Sequence[str], threshold: float) -> tuple[DataFrame, DataFrame]:
    """Rows at or above the threshold, and the others."""
    share = val.present_share([F.col(c) for c in cols])
    return df.filter(share >= threshold), df.filter(share < threshold)


def gate(df: DataFrame, label: str, confidence: str, threshold: float) -> DataFrame:
    return df.filter(F.col(label).isNotNull() & (F.col(confidence) >= threshold))


def filter_in(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """Rows whose value, read as a number, is one of the listed ones."""
    return coerce_numeric(df, [c]).filter(F.col(c).isin([float(v) for v in values]))


def filled(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row telling for each column, and for all together, whether it holds any value.

    ``max`` over the test needs no second pass and keeps one boolean per task.
    """
    tests = {c: F.coalesce(F.max(F.col(c).isNotNull()), F.lit(False)) for c in cols}
    flags = df.agg(*[test.alias(c) for c, test in tests.items()])
    every = F.lit(True)
    for c in cols:
        every = every & F.col(c)
    return flags.withColumn("all_filled", every)


def is_filled(df: DataFrame, cols: Sequence[str]) -> bool:
    """Whether a step can be skipped because all its columns exist and hold values."""
    if not {c.lower() for c in cols} <= {c.lower() for c in df.columns}:
        return False
    # One probe per column stops at the first value found.
    return all(bool(df.filter(F.col(c).isNotNull()).select(c).take(1)) for c in cols)
