"""Raster tiles kept as ASCII grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as val

# Patterns of file names, upper and lower case alike.
RASTER_FILES = "*.{[aA][sS][cC],[tT][iI][fF],[tT][iI][fF][fF]}"
GRID_FILES = "*.[aA][sS][cC]"


def list_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Raster files below a folder as ``(stem, path)``; of equal stems the last path wins."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", RASTER_FILES).load(folder).select("path")
    )
    return files.groupBy(val.file_stem(F.col("path")).alias("stem")).agg(F.max("path").alias("path"))


def pick_tiles(tiles: DataFrame, names: DataFrame, c: str = "name") -> DataFrame:
    """A list of names against the inventory; ``path`` is null for a name not found."""
    wanted = names.select(val.file_stem(val.trim_text(F.col(c))).alias("stem")).filter("stem <> ''").distinct()
    return wanted.join(tiles, "stem", "left")


def _header(name: str) -> Column:
    return val.to_double(F.regexp_extract("value", rf"(?im)^\s*{name}\s+(\S+)", 1))


def _grids(spark: SparkSession, folder: str) -> DataFrame:
    raw = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", GRID_FILES).text(folder, wholetext=True).withColumn("path", F.input_file_name())
    )
    half = F.coalesce(_header("cellsize") / 2, F.lit(0.0))
    x0 = F.coalesce(_header("xllcorner"), _header("xllcenter") - half)
    y0 = F.coalesce(_header("yllcorner"), _header("yllcenter") - half)
    return raw.select(
        val.file_stem(F.col("path")).alias("tile_id"), "value",
        x0.alias("xmin"), y0.alias("ymin"), _header("cellsize").alias("cell"),
        _header("nrows").cast("int").alias("nrows"), _header("ncols").cast("int").alias("ncols"),
        _header("nodata_value").alias("nodata"),
    )


def tile_index(spark: SparkSession, folder: str) -> DataFrame:
    """Bounds, cell size and shape per tile; a file without a full header is left out."""
    g = _grids(spark, folder)
    return g.select(
        "tile_id", "xmin", "ymin", (F.col("xmin") + F.col("ncols") * F.col("cell")).alias("xmax"),
        (F.col("ymin") + F.col("nrows") * F.col("cell")).alias("ymax"), "cell", "nrows", "ncols", "nodata",
    ).filter(F.col("xmax").isNotNull() & F.col("ymax").isNotNull())


def read_ascii_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of every grid as ``(tile_id, row, col, value)``, null where there is no data."""
    g = _grids(spark, folder)
    body = F.filter(F.split("value", r"\r?\n"), lambda line: line.rlike(r"^\s*[-+.\d]"))
    rows = g.select("tile_id", "nodata", F.posexplode(body).alias("row", "_line"))
    cells = rows.select("tile_id", "nodata", "row", F.posexplode(F.split(F.trim("_line"), r"\s+")).alias("col", "_v"))
    number = val.to_double(F.col("_v"))
    return cells.select("tile_id", "row", "col", F.when(~number.eqNullSafe(F.col("nodata")), number).alias("value"))
