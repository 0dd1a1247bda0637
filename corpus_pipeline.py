"""A corpus in five stages: language ID, line deduplication, near-duplicates, mixing and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linenet.llm import langid, linededup, mixing, packing, simhash
from linenet.llm.queries import tokenizer_path
from linenet.llm.scratch import written
from linenet.session import ship


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a language can be told; null and empty texts and those without a letter go.

    Every other row stays as it is, repeated ones and those with a null ``doc_id`` or ``lang`` too. No rows give no rows.
    """
    ship(spark)
    return langid.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, all but one word, go; so do documents that lost lines and have no word left.

    Earlier is by ``doc_id``, null first, then by the text's hash and the line's number. Null and wordless texts lose
    nothing and stay; rows that repeat an id and a text count as one and get the same lines. No rows give no rows.
    """
    ship(spark)
    return linededup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id.

    Near copies are linked by SimHash fingerprints of three-word shingles that differ in two bits at most. Rows that repeat an id
    and a text are reduced to one, those with a null id all stay, one for each text; null and wordless texts are one
    group. No rows give no rows.
    """
    ship(spark)
    return simhash.keep_one(docs, radius=2, size=3)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice.

    A null source is a source, the last in order; null and wordless texts count nothing in theirs; rows that repeat one
    another are taken alike. No rows give no rows.
    """
    ship(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with the columns of ``op5``.

    Null and empty texts are an end mark alone, repeated rows are packed each, a null ``doc_id`` stays null. No rows give
    no rows.
    """
    ship(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash", near_duplicates), ("mixing", mixture), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
