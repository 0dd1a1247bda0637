"""Importance resampling towards a target: hashed word features counted once for each distinct line."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linenet.llm import text as T
from linenet.llm.scratch import written
from linenet.session import local_rows

BUCKETS = 10_000
# Longer words are hashed one by one, all others together, byte by byte.
LONG_WORD = 64
# A line with at least this share of all lines goes to every task, so these are at most 10 000 rows.
HOT = 10_000


@lru_cache(maxsize=1)
def _steps() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = (value >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (value & np.uint32(1)))
    return value


def crc32(so_far: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of ranges of bytes, each going on from that of what comes before it."""
    steps, size = _steps(), ends - starts
    out = so_far.astype(np.uint32)
    order = np.argsort(-np.minimum(size, LONG_WORD + 1), kind="stable")
    many = int((size > LONG_WORD).sum())
    for i in order[:many].tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(out[i]))
    order = order[many:]
    size, at, state = size[order], starts[order], ~out[order]
    left = np.searchsorted(-size, -np.arange(1, LONG_WORD + 2), "right")
    for i, n in enumerate(left):
        if not n:
            break
        c = state[:n]
        state[:n] = steps[(c ^ data[at[:n] + i]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out[order] = ~state
    return out


def _after_blank(crc: np.ndarray) -> np.ndarray:
    c = ~crc
    return ~(_steps()[(c ^ np.uint32(32)) & np.uint32(255)] ^ (c >> np.uint32(8)))


def lowered(s: T.Slice) -> T.Slice:
    upper = (s.data >= 65) & (s.data <= 90)
    return T.Slice(s.first, np.where(upper, s.data + 32, s.data).astype(np.uint8), s.offsets)


def words_of(s: T.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the words of lower-cased texts: letters, digits and all beyond ASCII."""
    d = s.data
    return s.runs(((d >= 48) & (d <= 57)) | ((d >= 97) & (d <= 122)) | (d >= 128))


def features(s: T.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every word and every two neighbouring words of a text, in order of rows."""
    s = lowered(s)
    starts, ends = words_of(s)
    rows = s.row_of(starts)
    one = crc32(np.zeros(len(starts), np.uint32), s.data, starts, ends)
    next_ = np.flatnonzero(rows[1:] == rows[:-1])
    two = crc32(_after_blank(one[next_]), s.data, starts[next_ + 1], ends[next_ + 1])
    row = np.concatenate([rows, rows[next_]])
    order = np.argsort(row, kind="stable")
    return row[order], (np.concatenate([one, two]) % np.uint32(BUCKETS))[order].astype(np.uint16)


def _lists(rows: np.ndarray, buckets: np.ndarray, n: int) -> list[bytes]:
    ends = np.searchsorted(rows, np.arange(n + 1)) * 2
    body = buckets.astype("<u2").tobytes()
    return [body[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _line_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in T.slices(batch.column("line")):
            here = batch.slice(s.first, s.rows)
            yield pa.record_batch([here.column("key"), here.column("times"), pa.array(_lists(*features(s), s.rows), pa.binary())], names=["key", "times", "buckets"])


def _heads(names: list[str]):
    """Words of every text, and the buckets of two neighbouring words with a line's end between them."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch.column("text")):
                s = lowered(s)
                starts, ends = words_of(s)
                rows = s.row_of(starts)
                line = np.searchsorted(np.flatnonzero(s.data == 10), starts)
                at = np.flatnonzero((rows[1:] == rows[:-1]) & (line[1:] != line[:-1]))
                left = crc32(np.zeros(len(at), np.uint32), s.data, starts[at], ends[at])
                both = crc32(_after_blank(left), s.data, starts[at + 1], ends[at + 1])
                n = pa.array(np.bincount(rows, minlength=s.rows).astype(np.int64))
                cross = pa.array(_lists(rows[at], (both % np.uint32(BUCKETS)).astype(np.uint16), s.rows), pa.binary())
                here = batch.slice(s.first, s.rows)
                yield pa.record_batch([*(here.column(c) for c in names), n, cross], names=[*names, "n_words", "buckets"])

    return told


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a column of lists, and how many each row has."""
    size = np.array([len(x) for x in column.to_pylist()], np.int64) // 2
    return np.frombuffer(b"".join(column.to_pylist()), "<u2"), size


def _listed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each bucket a task met: every list counts ``times``."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for at in range(0, len(batch), 4096):
            part = batch.slice(at, 4096)
            bucket, size = _flat(part.column("buckets"))
            np.add.at(total, bucket, np.repeat(part.column("times").to_numpy(), size))
    yield _told(total)


def _text_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for s in T.slices(batch.column("text")):
            total += np.bincount(features(s)[1], minlength=BUCKETS)
    yield _told(total)


def _told(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.record_batch({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at])})


def _summed(counts: DataFrame) -> np.ndarray:
    """At most 10 000 rows come to the driver."""
    total = np.zeros(BUCKETS, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row.bucket] = row.n
    return total


def gains_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousands of the logarithm of the target's over the corpus's share of each bucket, each with one added."""
    top = (target + 1.0) * (float(raw.sum()) + len(raw))
    bottom = (raw + 1.0) * (float(target.sum()) + len(raw))
    return np.floor(1000 * np.log(top / bottom)).astype(np.int64)


def _gained(gains: np.ndarray, names: list[str]):
    """How many features a list has and what they gain together."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                bucket, size = _flat(part.column("buckets"))
                total = np.concatenate([[0], np.cumsum(gains[bucket])])
                ends = np.cumsum(size)
                yield pa.record_batch([*(part.column(c) for c in names), pa.array(size), pa.array(total[ends] - total[ends - size])], names=[*names, "n", "gain"])

    return told


def weigh(docs: DataFrame, target: DataFrame, seed: int = 7) -> DataFrame:
    """``row`` (a number of the row), ``doc_id``, ``text_key``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every row, written.

    Features are single words and two neighbouring words of the whole text, hashed into 10 000 buckets. A bucket's gain
    compares its count in the texts of ``target`` with that in all of ``docs``; a row's weight is the floored mean of its
    features' gains, its score adds Gumbel noise that depends on seed and ``doc_id``.

    Texts are cut at newlines. Equal lines meet in one row, whose features are hashed once: their counts are multiplied
    by the line's occurrences, and their sum of gains is joined to every row that has the line. Features that reach across
    a line's end are counted and summed by document. A line with a ten-thousandth of all lines or more is one
    of at most 10 000, which go to every task; others are joined by a shuffle on their digests.
    """
    key = F.transform(F.filter(F.split("text", "\n"), lambda x: x != ""), lambda x: F.unhex(F.md5(x)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    told = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.xxhash64("text").alias("text_key"), F.coalesce(key, F.array().cast("array<binary>")).alias("keys"))
    names = ["row", "doc_id", "text_key", "keys"]
    heads = written(told.mapInArrow(_heads(names), f"row long, doc_id {kind}, text_key long, keys array<binary>, n_words long, buckets binary"), "resample-texts")
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''").groupBy("line").agg(F.count("*").alias("times"))
    lines = written(lines.select(F.unhex(F.md5("line")).alias("key"), "times", "line").mapInArrow(_line_features, "key binary, times long, buckets binary"), "resample-lines")

    listed = lines.select("times", "buckets").union(heads.select(F.lit(1).cast("long").alias("times"), "buckets"))
    raw = _summed(listed.mapInArrow(_listed_counts, "bucket int, n long"))
    wanted = _summed(target.select("text").mapInArrow(_text_counts, "bucket int, n long"))
    gains = gains_of(raw, wanted)

    everything = lines.agg(F.sum("times")).first()[0] or 0
    summed = lambda t: t.select("key", "buckets").mapInArrow(_gained(gains, ["key"]), "key binary, n long, gain long")
    often = F.col("times") * HOT >= everything
    held = heads.select("row", F.explode("keys").alias("key")).join(F.broadcast(summed(lines.where(often))), "key", "left")
    rest = held.where("n is null").select("row", "key").join(summed(lines.where(~often)), "key")
    within = held.where("n is not null").select("row", "n", "gain").union(rest.select("row", "n", "gain"))
    across = heads.select("row", "buckets").mapInArrow(_gained(gains, ["row"]), "row long, n long, gain long")
    sums = within.union(across).groupBy("row").agg(F.sum("n").alias("n_features"), F.sum("gain").alias("_gain"))

    chance = (F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    weight = F.when(F.col("n_features") > 0, F.expr("(_gain - pmod(_gain, n_features)) div n_features")).otherwise(F.lit(0)).cast("long")
    joined = heads.select("row", "doc_id", "text_key", "n_words").join(sums, "row").withColumn("weight", weight)
    return written(joined.select("row", "doc_id", "text_key", "n_words", "n_features", "weight", (F.col("weight") + F.floor(-1000 * F.log(-F.log(chance)))).alias("score")), "resample-scores")


def ranked(scores: DataFrame, share: int = 25, least_words: int = 20) -> DataFrame:
    """The rows of ``weigh`` with ``rank``, from 1 by falling score; null for those not drawn.

    Of the rows with at least ``least_words`` words, ``share`` percent, rounded down, are drawn; ties go to the smaller
    ``doc_id``, null first, then to fewer words, features and the row's number. Scores are whole numbers of a range that no
    corpus widens much (gains and noise are logarithms), so the driver sums up counts by score, and rows are ordered
    inside one score only.
    """
    fit = F.col("n_words") >= least_words
    counts = sorted((-r.score, r["count"]) for r in scores.where(fit).groupBy("score").count().collect())
    number = np.array([n for _, n in counts], np.int64)
    before = np.cumsum(number) - number
    drawn = int(number.sum()) * share // 100
    use = [(-s, int(b)) for (s, _), b in zip(counts, before) if b < drawn]
    if not use:
        return scores.withColumn("rank", F.lit(None).cast("long"))
    starts = local_rows(scores.sparkSession, {"score": [s for s, _ in use], "_before": [b for _, b in use]}, {"score": pa.int64(), "_before": pa.int64()})
    order = Window.partitionBy("score").orderBy(F.asc_nulls_first("doc_id"), "n_words", "n_features", "row")
    top = scores.where(fit & (F.col("score") >= use[-1][0])).join(starts, "score").withColumn("rank", F.col("_before") + F.row_number().over(order))
    top = top.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long")).select(*scores.columns, "rank")
    return top.union(scores.where(~fit | (F.col("score") < use[-1][0])).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``; see ``weigh`` and ``ranked``.

    A null, empty or wordless text has no features, weight 0 and is never drawn. A null ``doc_id`` draws its noise as an
    empty one. Rows that repeat an id and a text are rows of their own with one score, ranked one after the other.
    No rows give no rows; without any target text all its counts are zero. Other columns are not read.
    """
    return ranked(weigh(docs, target, seed), share, least_words).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` that ``resample`` draws, with all their columns, whatever these are called.

    Of rows that repeat an id and a text as many stay as were drawn.
    """
    chosen = ranked(weigh(docs, target, seed), share, least_words).where("rank is not null").groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    taken = written(chosen.select(F.col("doc_id").alias("_id"), "text_key", "n"), "resample-drawn")
    own = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*own)
    doc, text = own[docs.columns.index("doc_id")], own[docs.columns.index("text")]
    plain = plain.withColumn("_key", F.xxhash64(text))
    met = plain.join(taken, plain[doc].eqNullSafe(taken["_id"]) & (plain["_key"] == taken["text_key"]))
    place = F.row_number().over(Window.partitionBy(doc, "_key").orderBy(F.lit(0)))
    return met.withColumn("_place", place).where("_place <= n").select(*own).toDF(*docs.columns)
