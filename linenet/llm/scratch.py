"""Tables in the folder the cluster shares, written to cut a long plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from linenet.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again; lost executors don't lose it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
