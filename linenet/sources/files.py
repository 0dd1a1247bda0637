"""Existence checks, small files and swaps on the shared file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where) and files.getFileStatus(where).isDirectory()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    files, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def move(spark: SparkSession, old: str, new: str) -> None:
    """Give a file or folder a new name, which must be free."""
    files, source = _at(spark, old)
    _, target = _at(spark, new)
    if files.exists(target) or not files.rename(source, target):
        raise FileExistsError(f"{old} can't become {new}")


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is whole as soon as it has its name."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    files, where = _at(spark, draft)
    out = files.create(where, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    move(spark, draft, path)


def read_small(spark: SparkSession, path: str) -> str:
    files, where = _at(spark, path)
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put a whole new folder in the place of another.

    Only names change, so the place is empty for no longer than that takes; if the second change fails, the
    first is taken back. The former folder is removed at the end.
    """
    if not exists(spark, path):
        return move(spark, new, path)
    folder, name = path.rstrip("/").rsplit("/", 1)
    former = f"{folder}/.{name}-{uuid.uuid4().hex}"
    move(spark, path, former)
    try:
        move(spark, new, path)
    except Exception:
        move(spark, former, path)
        raise
    files, where = _at(spark, former)
    files.delete(where, True)
    return None
