"""Quality rules: plain counts, and a hashed n-gram likelihood ratio that judges every text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linenet.llm import text as T
from linenet.llm.scratch import written

BUCKETS = 1 << 14
ORDERS = (1, 2)
SYMBOLS = b"#*$%&|<>"
BINS, LOW, HIGH = 8192, -16.0, 16.0


def _buckets(s: T.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts, and bucket and row of each of their one- and two-word grams."""
    starts, ends = s.words()
    rows, hashes = s.row_of(starts), s.hashes(starts, ends)
    found = [T.grams(hashes, rows, size) for size in ORDERS]
    bucket = np.concatenate([h & np.uint64(BUCKETS - 1) for h, _ in found]).astype(np.int64)
    return starts, rows, hashes, bucket, np.concatenate([rows[at] for _, at in found])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        trusted = np.asarray(batch.column("trusted").to_numpy(zero_copy_only=False), np.int64)
        for s in T.slices(batch.column("text")):
            _, _, _, bucket, row = _buckets(s)
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            total[1] += np.bincount(bucket, trusted[s.first + row], BUCKETS).astype(np.int64)
    at = np.flatnonzero(total[0])
    yield pa.record_batch({"bucket": pa.array(at, pa.int32()), "raw": pa.array(total[0][at]), "trusted": pa.array(total[1][at])})


def likelihood_ratios(docs: DataFrame, trusted_ids: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """The logarithm of the trusted over the raw share of each of the hashed buckets.

    Counts cover every text: all of ``docs`` are the raw corpus, those whose ``doc_id`` is in
    ``trusted_ids`` the target. A task sends one row for each bucket it met (at most 16 384), and the
    driver gets the sums of the same number of buckets. Without any trusted text all are zero.
    """
    trusted = trusted_ids.select("doc_id").where("doc_id is not null").distinct().withColumn("trusted", F.lit(1))
    # Labels grow with the documents: one plan at every size, which sorts and spills, instead of a copy of all ids per task.
    told = docs.select("doc_id", "text").join(trusted.hint("merge"), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(0)).alias("trusted"))
    sums = told.mapInArrow(_counts, "bucket int, raw long, trusted long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in sums.collect():
        raw[row.bucket], target[row.bucket] = row.raw, row.trusted
    if not target.sum():
        return np.zeros(BUCKETS)
    share = lambda x: np.log((x + smoothing) / (x.sum() + smoothing * BUCKETS))
    return share(target) - share(raw)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key is there twice or more."""
    _, back, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[back] > 1


def measure(batch: pa.RecordBatch, ratios: np.ndarray, window: int = 8) -> dict[str, np.ndarray]:
    """The plain counts and the score of every text of a batch."""
    out = {k: np.zeros(len(batch), np.float64 if k == "score" else np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")}
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    for s in T.slices(batch.column("text")):
        here = slice(s.first, s.first + s.rows)
        starts, rows, hashes, bucket, of = _buckets(s)
        out["n_words"][here] = np.bincount(rows, minlength=s.rows)
        out["word_chars"][here] = s.per_row(((s.data & 0xC0) != 0x80) & ~T.is_space(s.data))
        out["n_symbols"][here] = s.per_row(symbol[s.data])
        total, n = np.bincount(of, ratios[bucket], s.rows), np.bincount(of, minlength=s.rows)
        out["score"][here] = np.where(n > 0, total / np.maximum(n, 1), 0.0)

        begin, end = s.runs(s.data != 10)
        filled = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
        begin, end = begin[filled], end[filled]
        line_row = s.row_of(begin)
        keys = np.unique(s.hashes(begin, end) ^ T.mixed(line_row.astype(np.uint64), 7), return_index=True)[1]
        out["n_dup_lines"][here] = np.bincount(line_row, minlength=s.rows) - np.bincount(line_row[keys], minlength=s.rows)

        grams, at = T.grams(hashes, rows, window)
        at = at[_repeated(grams ^ T.mixed(rows[at].astype(np.uint64), 11))]
        cover = np.zeros(len(starts) + 1, np.int64)
        cover[at] += 1
        np.subtract.at(cover, at + window, 1)
        out["n_repeat_words"][here] = np.bincount(rows[np.cumsum(cover)[:-1] > 0], minlength=s.rows)
    return out


def score_documents(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``doc_id``, the plain counts and ``score``, the mean ratio of a text's one- and two-word grams."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"doc_id": batch.column("doc_id"), **{k: pa.array(v) for k, v in measure(batch, ratios).items()}})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double")


def fit_threshold(scores: DataFrame, labels: DataFrame, least_kept: float = 0.995) -> float:
    """The score below which texts go, from all labelled documents.

    Of the cuts that keep ``least_kept`` of the trusted documents, the one with the largest gap between
    the kept shares of both kinds; the lowest of equal ones, moved down to the middle of an empty stretch.
    Scores meet in 8 192 bins, so the driver gets a bounded table. Nothing is cut if one kind is missing.
    """
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    spot = F.least(F.greatest(F.floor((F.col("score") - LOW) / (HIGH - LOW) * BINS), F.lit(0)), F.lit(BINS - 1))
    counts = np.zeros((2, BINS))
    for row in scores.select("doc_id", "score").join(one, "doc_id").groupBy(F.expr("int(quality > 0)").alias("good"), spot.cast("int").alias("bin")).count().collect():
        counts[row.good, row.bin] = row["count"]
    if not counts.sum(1).all():
        return float("-inf")
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(counts, 1)], 1) / counts.sum(1, keepdims=True)
    gain = np.where(below[1] <= 1 - least_kept, below[0] - below[1], -1.0)
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return LOW + (HIGH - LOW) * float(best[len(best) // 2]) / BINS


def quality_rules(docs: DataFrame, labels: DataFrame, least_kept: float = 0.995) -> DataFrame:
    """Judge every document: plain counts, ``base_failed``, ``score`` and ``kept``.

    Trusted target: the documents with ``quality`` 1. Null, empty and blank texts have no words and fail
    the base rules; a null ``doc_id`` is judged like any other and is never a labelled one; repeated rows are
    judged each; of several labels of a document the best holds; further columns are not returned.
    Without labels of both kinds only the base rules hold.
    """
    ratios = likelihood_ratios(docs, labels.where("quality = 1"))
    scores = written(score_documents(docs, ratios), "quality")
    threshold = fit_threshold(scores, labels, least_kept)
    failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    return scores.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
