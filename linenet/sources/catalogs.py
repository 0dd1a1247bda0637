"""Scans over many sources: one mapping row per owner, or one part per department."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import harmonize, union_all
from .files import exists
from .tables import read_table


def open_source(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path) if path.lower().endswith(".csv") else spark.read.parquet(path)


def scan_catalog(
    spark: SparkSession, catalog: DataFrame, base: str, types: Mapping[str, str],
    name: str = "name", folder: str = "folder", file: str = "file", tag: str = "city", extra: Sequence[str] = (),
) -> tuple[DataFrame | None, DataFrame]:
    """Union of all sources of a catalog under the unified schema, and a report.

    A blank name is passed over; a missing or unreadable source is reported and the
    others go on. The driver reads the catalog a part at a time, one row per source; the sources
    themselves stay lazy and are pruned by what is asked of them.
    """
    frames, report = [], []
    for row in catalog.toLocalIterator():
        label = (row[name] or "").strip()
        if not label or label == "nan":
            continue
        path = "/".join(p for p in (base.rstrip("/"), row[folder], row[file]) if p)
        if not exists(spark, path):
            report.append((label, "missing"))
            continue
        try:
            raw = open_source(spark, path)
            mapping = {a: row[a] for a in types if a in row.asDict()}
            frames.append(harmonize(raw, mapping, types, extra).withColumn(tag, F.lit(label)))
            report.append((label, "read"))
        except Exception as e:  # noqa: BLE001 - one bad source must not stop the rest
            report.append((label, f"failed: {type(e).__name__}"))
    out = spark.createDataFrame(report, f"{tag} string, status string")
    return (union_all(frames) if frames else None), out


def scan_parts(spark: SparkSession, pattern: str, part: str = "department", regex: str = r"Dept_([^/]+?)(?:\.|/)") -> DataFrame:
    """One read over the parts of a layer, with the part's name taken from its path."""
    return spark.read.parquet(pattern).withColumn(part, F.regexp_extract(F.input_file_name(), regex, 1))
