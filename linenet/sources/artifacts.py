"""Store of fitted things: models, code tables, donor tables and settings.

Every save goes into a folder of its own, and a manifest that names it is written last. So
a store holds all parts of one save or, to its readers, none: a save that ends half way
leaves what was there before. Former saves stay for those who still read them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .files import exists, names_in, read_small, write_small

MANIFEST = "_manifest-"


def save_artifacts(spark: SparkSession, path: str, models: Mapping, tables: Mapping[str, DataFrame], settings: dict) -> None:
    folder = f"parts-{uuid.uuid4().hex}"
    for name, model in models.items():
        PipelineModel([model]).write().save(f"{path}/{folder}/{name}")
    for name, df in tables.items():
        df.write.parquet(f"{path}/{folder}/{name}")
    manifest = {"folder": folder, "models": list(models), "tables": list(tables), "settings": settings}
    number = sum(n.startswith(MANIFEST) for n in names_in(spark, path)) + 1
    write_small(spark, f"{path}/{MANIFEST}{number:08d}", json.dumps(manifest))


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """What the last whole save left, or None."""
    made = [n for n in names_in(spark, path) if n.startswith(MANIFEST)]
    if not made:
        return None
    return json.loads(read_small(spark, f"{path}/{made[-1]}"))


def missing_artifacts(spark: SparkSession, path: str, names: Sequence[str]) -> list[str]:
    """Names not in the store; a level with any missing is skipped by the caller."""
    manifest = read_manifest(spark, path)
    folder = f"{path}/{manifest['folder']}" if manifest else path
    return [n for n in names if not exists(spark, f"{folder}/{n}")]


def load_artifacts(spark: SparkSession, path: str, models: Sequence[str], tables: Sequence[str]):
    """Models, tables and settings as stored."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no whole save in {path}")
    folder = f"{path}/{manifest['folder']}"
    return (
        {n: PipelineModel.load(f"{folder}/{n}").stages[0] for n in models},
        {n: spark.read.parquet(f"{folder}/{n}") for n in tables},
        manifest["settings"],
    )
