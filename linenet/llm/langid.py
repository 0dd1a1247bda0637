"""Language identification with a blended-spectrum string kernel and Nyström landmarks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from linenet.llm import text as T
from linenet.llm.scratch import written

ORDERS = (1, 2, 3, 4)
WIDTH = 1 << 12
SLICE = 1 << 18
ROWS = 512
_LETTER = regex.compile(r"\p{L}")


def presence(s: T.Slice) -> np.ndarray:
    """Which hashed character grams each text has, one block of columns for each gram length.

    A block has length one (a text without a gram has zeros), so the product of two rows is the
    blended-spectrum presence kernel: the mean over gram lengths of shared grams over the root of both counts.
    A-Z count as a-z and any white space as one blank.
    """
    data = np.where((s.data >= 65) & (s.data <= 90), s.data + 32, s.data).astype(np.uint8)
    data[T.is_space(data)] = 32
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    row = s.row_of(begins)
    code = np.zeros(len(begins), np.uint64)
    ends = np.append(begins[1:], len(data))
    for i in range(4):  # a character has at most four bytes
        has = begins + i < ends
        code[has] = (code[has] << np.uint64(8)) | data[begins[has] + i]
    out = np.zeros((s.rows, len(ORDERS) * WIDTH), np.float32)
    for k, size in enumerate(ORDERS):
        grams, at = T.grams(code, row, size)
        block = out[:, k * WIDTH : (k + 1) * WIDTH]
        block[row[at], (grams >> np.uint64(20)).astype(np.int64) & (WIDTH - 1)] = 1
    _normalise(out)
    return out


def _normalise(rows: np.ndarray) -> None:
    for k in range(len(ORDERS)):
        block = rows[:, k * WIDTH : (k + 1) * WIDTH]
        block /= np.sqrt(np.maximum(block.sum(1, keepdims=True), 1) * len(ORDERS))


@dataclass
class LanguageModel:
    """One column of weights for each class, in order of the class names."""

    classes: list[str]
    weights: np.ndarray


def _solve(features: np.ndarray, landmarks: np.ndarray, labels: np.ndarray, n_classes: int, ridge: float) -> np.ndarray:
    """One-versus-rest kernel ridge regression in the Nyström space of the landmarks."""
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = (features @ landmarks.T).astype(np.float64) @ root
    aim = np.where(labels[:, None] == np.arange(n_classes), 1.0, 0.0)
    weight = (len(labels) / (n_classes * np.bincount(labels, minlength=n_classes)[labels]))[:, None]
    beta = np.linalg.solve((phi * weight).T @ phi + ridge * np.eye(phi.shape[1]), (phi * weight).T @ aim)
    return landmarks.T @ (root @ beta).astype(np.float32)  # kernel with the landmarks, mapped, times weights


def fit(labelled: DataFrame, rows_each: int = 500, max_classes: int = 1000, n_landmarks: int = 256, ridge: float = 1.0) -> LanguageModel | None:
    """Learn from ``text`` and ``lang``.

    The fit takes at most ``rows_each`` labelled texts of each language, those of the least hash of
    the text (equal texts count once), and the first of each language in turn as ``n_landmarks`` landmarks. Rows
    without a language or without a word teach nothing. Returns nothing if there is no row to learn from;
    more than ``max_classes`` languages are an error.
    """
    usable = labelled.where("lang is not null and text rlike '[^\\\\s]'").select("text", "lang")
    classes = [r.lang for r in usable.groupBy("lang").agg(F.lit(1)).select("lang").orderBy("lang").limit(max_classes + 1).collect()]
    if len(classes) > max_classes:
        raise ValueError(f"more than {max_classes} languages")
    if not classes:
        return None
    hashed = usable.withColumn("_h", F.xxhash64("text"))
    least = Window.partitionBy("lang").orderBy("_h")
    once = hashed.select("lang", "_h").distinct().withColumn("_rank", F.row_number().over(least)).where(F.col("_rank") <= rows_each)
    # Stored first, so that Spark knows how few they are and doesn't move the texts for the join.
    once = written(once.select("lang", "_h"), "chosen-texts")
    chosen = hashed.join(once, ["lang", "_h"]).groupBy("lang", "_h").agg(F.min("text").alias("text"))
    found = chosen.mapInArrow(_rows_of_grams, "lang string, h long, grams array<int>").orderBy("lang", "h").toArrow().combine_chunks()
    grams = found.column("grams").combine_chunks()
    sizes = np.diff(grams.offsets.to_numpy())
    labels = np.searchsorted(np.array(classes, object), np.array(found.column("lang").to_pylist(), object))
    features = np.zeros((len(labels), len(ORDERS) * WIDTH), np.float32)
    features[np.repeat(np.arange(len(labels)), sizes), grams.flatten().to_numpy()] = 1
    _normalise(features)
    turn = np.concatenate([np.arange(n) for n in np.bincount(labels, minlength=len(classes))])
    marks = features[np.argsort(turn, kind="stable")[:n_landmarks]]
    return LanguageModel(classes, _solve(features, marks, labels, len(classes), ridge))


def _rows_of_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in T.slices(batch.column("text"), SLICE, ROWS):
            grams = [np.flatnonzero(r).astype(np.int32) for r in presence(s)]
            told = [batch.column(k).slice(s.first, s.rows) for k in ("lang", "_h")]
            yield pa.record_batch([*told, pa.array(grams, pa.list_(pa.int32()))], names=["lang", "h", "grams"])


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """All columns and ``lang_pred`` and ``score``.

    ``score`` is the regression's value of the class, cut to 0 to 1. A null text, a text without a
    letter or a missing model gives ``und`` and 0; of equal values the first class by name wins. Columns of
    these names that are there already are replaced.
    """
    rest = docs.drop("lang_pred", "score")
    if model is None:
        return rest.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            found = [t.as_py() is not None and _LETTER.search(t.as_py()) is not None for t in texts]
            best, value = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for s in T.slices(texts, SLICE, ROWS):
                product = presence(s) @ model.weights
                here = slice(s.first, s.first + s.rows)
                best[here], value[here] = product.argmax(1), product.max(1)
            lang = pa.array([model.classes[b] if f else "und" for b, f in zip(best, found)], pa.string())
            score = pa.array(np.where(found, np.clip(value, 0, 1), 0.0))
            yield pa.record_batch([*batch.columns, lang, score], names=[*batch.schema.names, "lang_pred", "score"])

    at = rest.columns.index("text")
    schema = StructType([*rest.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rest.mapInArrow(scored, schema)


def split_held_out(docs: DataFrame) -> DataFrame:
    """Add ``held_out``: whether the checksum of ``doc_id`` as text is a multiple of five.

    A null ``doc_id`` counts as an empty text, whose checksum is zero.
    """
    return docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0)


def identify(docs: DataFrame, **options: float) -> DataFrame:
    """Learn from the rows that are not held out and predict for every row."""
    told = split_held_out(docs)
    return predict(told, fit(told.where("not held_out").select("text", "lang"), **options))


def accepted(docs: DataFrame, **options: float) -> DataFrame:
    """The rows of ``docs`` of which a language is told; those whose prediction is ``und`` go.

    These are null and empty texts and those without a letter, and every row if no row has a language to learn from. Short
    and very long texts stay. Repeated rows are judged each; a null ``doc_id`` is one like any other. No rows give no
    rows. Columns are those of ``docs``, whatever they are called.
    """
    own = [c if c in ("doc_id", "text", "lang") else f"_c{i}" for i, c in enumerate(docs.columns)]
    told = identify(docs.toDF(*own), **options)
    return told.where("lang_pred <> 'und'").select(*own).toDF(*docs.columns)
