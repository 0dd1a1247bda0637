"""Views over the given tables that give every operator something to work on.

The SQL reads the same in Spark and in DuckDB, so a check can use one text on both
sides. Every view covers its whole table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geometry as geo
from .session import local_rows

KEY = (
    "concat(CAST(l_orderkey AS STRING),'-',CAST(l_linenumber AS STRING),'-',CAST(l_partkey AS STRING),'-',"
    "CAST(l_suppkey AS STRING),'-',CAST(CAST(round(l_extendedprice*100) AS BIGINT) AS STRING))"
)
YEAR_TEXT = "CAST(year(l_shipdate)-l_partkey%60 AS STRING)"

VIEWS = {
    "fx_segments": f"""
SELECT {KEY} AS seg_id, concat('C',CAST(l_suppkey % 25 AS STRING)) AS city,
  CAST((l_partkey*37) % 1000 AS DOUBLE) AS x0,
  CAST((l_partkey*11) % 1000 + l_suppkey % 4 AS DOUBLE) AS y0,
  CAST((l_partkey*37) % 1000 AS DOUBLE) + l_quantity - 24.5 AS x1,
  CAST((l_partkey*11) % 1000 + l_suppkey % 4 AS DOUBLE) + l_linenumber*4 - 14 AS y1,
  CASE l_partkey % 8 WHEN 0 THEN 'PVC' WHEN 1 THEN ' PVC ' WHEN 2 THEN 'BETON' WHEN 3 THEN 'INCONNU' WHEN 4 THEN ''
    WHEN 5 THEN NULL WHEN 6 THEN 'GRES' ELSE 'AMIANTE?' END AS material_raw,
  CASE l_suppkey % 4 WHEN 0 THEN 'EU' WHEN 1 THEN 'EP' WHEN 2 THEN 'UN' ELSE 'NC' END AS effluent_raw,
  CASE l_partkey % 9 WHEN 0 THEN '000000200' WHEN 1 THEN '9.5600' WHEN 2 THEN '300.0' WHEN 3 THEN 'DN400'
    WHEN 4 THEN 'nan' WHEN 5 THEN '2000' WHEN 6 THEN NULL WHEN 7 THEN '150' ELSE '1e3' END AS diameter_raw,
  CASE l_partkey % 7 WHEN 0 THEN concat('15/10/',{YEAR_TEXT}) WHEN 1 THEN concat({YEAR_TEXT},'/01/31')
    WHEN 2 THEN concat({YEAR_TEXT},'-09-02T00:00:00') WHEN 3 THEN concat({YEAR_TEXT},'.0')
    WHEN 4 THEN concat('pose ',{YEAR_TEXT}) WHEN 5 THEN 'NC' ELSE NULL END AS age_raw,
  CASE WHEN l_orderkey%5=0 THEN NULL ELSE 150.0 + l_discount*100 END AS level_up,
  CASE WHEN l_orderkey%7=0 THEN NULL WHEN l_orderkey%11=0 THEN CAST(0.0 AS DOUBLE) ELSE 150.0 + l_tax*100 END AS level_down,
  CASE WHEN l_orderkey%19=0 THEN 0.0 ELSE l_quantity END AS length_raw,
  CASE WHEN l_orderkey%3=0 THEN NULL WHEN l_orderkey%7=0 THEN (150.0 + l_discount*100)/l_quantity*100
    ELSE (l_discount-0.05)*150 END AS slope_raw,
  CASE WHEN l_orderkey%4=0 THEN NULL ELSE l_quantity/10 END AS depth_up,
  CASE WHEN l_orderkey%6=0 THEN NULL ELSE l_quantity/8 END AS depth_down,
  CASE WHEN l_orderkey%9=0 THEN NULL ELSE 152.0 + l_discount*50 END AS ground,
  CASE WHEN l_partkey%10=0 THEN NULL ELSE concat('M',CAST(l_partkey AS STRING)) END AS node_up,
  CASE WHEN l_suppkey%10=0 THEN NULL ELSE concat('M',CAST((l_partkey+l_suppkey)%2000 AS STRING)) END AS node_down
FROM lineitem""",
    "fx_manholes": """
SELECT concat('M',CAST(p_partkey AS STRING)) AS mh_id,
  CAST((p_partkey*37) % 1000 AS DOUBLE) AS x, CAST((p_partkey*11) % 1000 AS DOUBLE) AS y,
  CASE WHEN p_partkey%9=0 THEN NULL ELSE CAST(150.0 + p_size/10.0 AS DOUBLE) END AS ground,
  CASE WHEN p_partkey%8=0 THEN NULL WHEN p_partkey%17=0 THEN CAST(160.0 AS DOUBLE) ELSE CAST(148.0 + p_size/20.0 AS DOUBLE) END AS invert,
  CASE WHEN p_partkey%3=0 THEN NULL ELSE CAST(1.0 + (p_size%5)*0.5 AS DOUBLE) END AS depth
FROM part""",
    # Boxes overlap by 20 m; box 12 is a small one, which leaves a gap around it.
    "fx_hazard": """
SELECT n_nationkey AS poly_id,
  CAST(n_nationkey%5*200.0-10 + CASE WHEN n_nationkey=12 THEN 90.0 ELSE 0.0 END AS DOUBLE) AS xmin,
  CAST(n_nationkey%5*200.0+210 - CASE WHEN n_nationkey=12 THEN 90.0 ELSE 0.0 END AS DOUBLE) AS xmax,
  CAST(floor(n_nationkey/5.0)*200.0-10 + CASE WHEN n_nationkey=12 THEN 90.0 ELSE 0.0 END AS DOUBLE) AS ymin,
  CAST(floor(n_nationkey/5.0)*200.0+210 - CASE WHEN n_nationkey=12 THEN 90.0 ELSE 0.0 END AS DOUBLE) AS ymax,
  n_regionkey%3+1 AS level
FROM nation""",
    # 100 columns of 10 m and as many rows as the events fill, in tiles of 50 x 50.
    "fx_cells": """
SELECT CAST(floor(CAST(event_id AS DOUBLE)/5000)*2 + floor(CAST(event_id%100 AS DOUBLE)/50) AS INT) AS tile_id,
  CAST(floor(CAST(event_id AS DOUBLE)/100) AS INT) AS grow, CAST(event_id%100 AS INT) AS gcol,
  CAST(floor(CAST(event_id AS DOUBLE)/100) % 50 AS INT) AS row, CAST(event_id%50 AS INT) AS col,
  CASE WHEN event_type='error' THEN CAST(-9999.0 AS DOUBLE) ELSE value END AS value
FROM events""",
    "fx_tiles": """
SELECT tile_id, CAST((tile_id%2)*500.0 AS DOUBLE) AS xmin, CAST(500.0 - floor(tile_id/2.0)*500.0 AS DOUBLE) AS ymin,
  CAST((tile_id%2)*500.0 + 500.0 AS DOUBLE) AS xmax, CAST(1000.0 - floor(tile_id/2.0)*500.0 AS DOUBLE) AS ymax,
  CAST(10.0 AS DOUBLE) AS cell, 50 AS nrows, 50 AS ncols
FROM (SELECT DISTINCT tile_id FROM fx_cells) t""",
    "fx_results": """
SELECT o_orderpriority AS target, o_orderstatus AS level, concat('m',CAST(o_custkey%4 AS STRING)) AS model,
  o_orderkey AS run_id, round(o_totalprice/1000000,4) AS f1
FROM orders""",
    "fx_predictions": f"""
SELECT {KEY} AS id, CAST(l_linenumber%4 AS INT) AS label,
  CAST(CASE WHEN l_discount>0.03 THEN l_linenumber%4 ELSE (l_linenumber+l_partkey)%4 END AS INT) AS pred,
  CAST(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END AS INT) AS label_bin, l_discount*10 AS score
FROM lineitem""",
}

# List positions differ between the engines, so this view has two texts.
FEATURES = ["f1", "f2", "f3", "f4", "f5", "f6"]


def _features(first: int) -> str:
    cells = ", ".join(
        f"CASE WHEN (vec_id*7+{k}) % 11 = 0 THEN NULL ELSE CAST(embedding[{k - 1 + first}] AS DOUBLE) END AS f{k}"
        for k in range(1, 7)
    )
    return f"""
SELECT vec_id, {cells}, CAST(label % 4 + 1 AS INT) AS class,
  CASE WHEN vec_id % 13 = 0 THEN NULL ELSE concat('k',CAST(label % 3 AS STRING)) END AS kind
FROM embeddings"""


SPARK_VIEWS = {**VIEWS, "fx_features": _features(0)}
DUCK_VIEWS = {**VIEWS, "fx_features": _features(1)}
NEEDS = {"fx_tiles": ["fx_cells"]}

# Lookups and class edges of the fixture views.
MATERIALS = {"PVC": "PP/PE", "BETON": "BETON", "GRES": "GRES"}
EFFLUENTS = {"EU": "EU", "EP": "EP", "UN": "UNITAIRE"}
DIAMETERS = {"200": "200", "300": "300", "150": "150", "1000": "1000", "9.56": "9.56"}
AGE_EDGES = [1950.0, 1970.0, 1990.0, 2010.0, 2025.0]
AGE_LABELS = ["1", "2", "3", "4", "5", "6"]
DEPTH_EDGES = [1.0, 2.0, 3.0, 4.0]
DEPTH_LABELS = ["1", "2", "3", "4", "5"]


def values_sql(pairs: dict[str, str]) -> str:
    """A lookup as inline rows, for the SQL side."""
    rows = ", ".join(f"('{k}','{v}')" for k, v in pairs.items())
    return f"(SELECT * FROM (VALUES {rows}) AS v(key, value))"


class Data:
    """The fixture views over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str, spread: bool = False) -> DataFrame:
        text = SPARK_VIEWS[name]
        base = text.rsplit("FROM ", 1)[1].split(")")[0].strip()
        source = self.view(base) if base.startswith("fx_") else self.table(base)
        source = self.spread(source) if spread else source
        head, tail = text.rsplit(f"FROM {base}", 1)
        return self.spark.sql(f"{head}FROM {{source}}{tail}", source=source)

    def segments(self, spread: bool = False) -> DataFrame:
        return self.view("fx_segments", spread)

    def spread(self, df: DataFrame) -> DataFrame:
        """Over all cores, if the scan has fewer tasks: a test file is a single row group.

        A real table is read in many splits, and this then does nothing.
        """
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    def lines(self) -> DataFrame:
        """Segments with their geometry beside the four coordinates."""
        seg = self.segments(spread=True)
        return seg.withColumn("geom", geo.two_point_line(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))

    def hazard(self) -> DataFrame:
        box = geo.box_ring(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
        return self.view("fx_hazard").select("poly_id", F.col("level").alias("value"), box.alias("rings"))

    def cells(self) -> DataFrame:
        value = F.when(F.col("value") != -9999.0, F.col("value"))
        return self.view("fx_cells").select("tile_id", "row", "col", value.alias("value"))

    def lookup(self, pairs: dict[str, str]) -> DataFrame:
        columns = {"key": list(pairs), "value": list(pairs.values())}
        return local_rows(self.spark, columns, {"key": pa.string(), "value": pa.string()})
