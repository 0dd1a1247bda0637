"""Delimited tables, lookup sheets and result tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from ..functions import values as val
from ..operators.ordering import first_by
from ..operators.schema import stringify_complex
from .files import is_folder


# Spark reads Latin-1 but not Windows-1252, which differs from it in the bytes 0x80 to 0x9F.
_WINDOWS = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def _as_windows(df: DataFrame) -> DataFrame:
    old, new = "".join(_WINDOWS), "".join(_WINDOWS.values())
    named = df.toDF(*[c.translate(str.maketrans(_WINDOWS)) for c in df.columns])
    texts = [f.name for f in named.schema.fields if f.dataType.typeName() == "string"]
    return named.withColumns({c: F.translate(F.col(c), old, new) for c in texts})


def _is_utf8(encoding: str) -> bool:
    return encoding.upper() in ("UTF-8", "UTF8")


def _file_path(uri: str) -> str:
    """A file as the reader takes it: signs of a URI undone, those of a pattern escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _read_as(reader: DataFrameReader, paths: str | list[str], encoding: str) -> DataFrame:
    if encoding.lower() in ("cp1252", "windows-1252"):
        return _as_windows(reader.option("encoding", "ISO-8859-1").csv(paths))
    return reader.option("encoding", encoding).csv(paths)


def read_table(
    spark: SparkSession, path: str, encodings: Sequence[str] = ("UTF-8", "ISO-8859-1"), schema: str | None = None
) -> DataFrame:
    """Delimited text with a header; a file that does not decode is read in the last encoding.

    Every file is judged by itself: only UTF-8 can be told from the bytes, since a
    single-byte encoding fits anything, and the reader replaces bytes it cannot decode
    instead of failing. Files of both kinds under one path are matched by column names, a
    column some of them lack is null there. The driver holds the names of files, as the reader does.
    """
    reader = spark.read.option("sep", ";").option("header", True)
    if schema:
        reader = reader.schema(schema)
    first, last = encodings[0], encodings[-1]
    if len(encodings) == 1 or not _is_utf8(first):
        return _read_as(reader, path, first)
    lines = spark.read.text(path)
    found = lines.filter(~F.is_valid_utf8("value")).select(F.input_file_name().alias("f")).distinct().collect()
    broken = {row["f"] for row in found}
    if not broken:
        return _read_as(reader, path, first)
    whole = set(lines.inputFiles()) - broken
    if not whole:
        return _read_as(reader, path, last)
    if is_folder(spark, path):
        reader = reader.option("basePath", path)
    good, other = ([_file_path(f) for f in sorted(files)] for files in (whole, broken))
    return _read_as(reader, good, first).unionByName(_read_as(reader, other, last), allowMissingColumns=True)


def write_table(df: DataFrame, path: str) -> None:
    """Delimited text with a header, geometry left out and nested values as text."""
    flat = stringify_complex(df.drop("geom")).write.option("sep", ";").option("header", True)
    flat.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_lookup(
    spark: SparkSession, path: str, key: str, value: str, columns: Sequence[str] | None = None, position: str | None = None
) -> DataFrame:
    """Lookup sheet as ``(key, value)`` with trimmed keys; the last row of a repeated key wins.

    ``columns`` names the columns of a sheet without a header; ``position`` is the column
    that tells the order of rows, else the order within the file is used.
    """
    if columns:
        raw = spark.read.option("sep", ";").schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    else:
        raw = spark.read.option("sep", ";").option("header", True).csv(path)
    order = val.to_double(F.col(position)) if position else F.monotonically_increasing_id()
    rows = raw.select(val.trim_text(F.col(key)).alias("key"), val.trim_text(F.col(value)).alias("value"), order.alias("_at"))
    return first_by(rows.filter(F.col("key").isNotNull()), ["key"], [F.desc("_at")]).select("key", "value")


def class_edges(table: DataFrame, edge: str, label: str, most: int = 100_000) -> tuple[list[float], list[str]]:
    """Sorted thresholds and labels of a class sheet; their counts must fit.

    The sheet becomes a list on the driver, so one of more than ``most`` rows is an error; no row is left out.
    """
    if (n := table.count()) > most:
        raise ValueError(f"a class sheet of {n} rows; at most {most} fit")
    rows = table.select(F.col(edge).alias("e"), F.col(label).cast("string").alias("l")).collect()
    edges = sorted(float(r["e"]) for r in rows if r["e"] is not None)
    labels = [r["l"] for r in rows if r["l"] is not None]
    # Numbered labels are put in order; a sheet read in parts has no order of its own.
    if all(label.lstrip("-").isdigit() for label in labels):
        labels.sort(key=int)
    if len(labels) != len(edges) + 1:
        raise ValueError(f"{len(labels)} labels for {len(edges) + 1} intervals")
    return edges, labels


def append_results(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Add result rows to a table partitioned by experiment."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def checkpoint_table(df: DataFrame, path: str) -> DataFrame:
    """Write a frame to the shared folder and go on from the written table."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
