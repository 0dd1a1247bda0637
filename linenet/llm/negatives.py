"""Hard negatives by exact integer scores: Strassen products of tiles, and heaps that merge."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linenet.llm.scratch import written

# Rows of a cell: so many anchors meet so many candidates in one task at a time.
ANCHORS, CANDIDATES = 1024, 4096
# Candidates multiplied at once, and the inner length below which a product isn't halved again.
STRIP, LEAF = 1024, 16
LONG = (1 << 63) - 1
NONE = -LONG - 1


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two integer matrices of any shape by seven half-size products a level.

    Sides are padded with zeros to an even length at each level. On int64 all sums wrap around, so the result is exact
    if its entries fit; on Python integers it always is.
    """
    (n, k), m = a.shape, b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    a = np.pad(a, ((0, n % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, m % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2  # noqa: E741
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), a.dtype)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def _integers(vectors: pa.Array, scale: int, width: int) -> np.ndarray:
    """floor(scale * x) of every component, shorter vectors padded with zeros; Python integers where int64 won't do."""
    ends = vectors.offsets.to_numpy()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(ends)
    row = np.repeat(np.arange(len(size)), size)
    col = np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], size)
    largest = np.abs(flat).max(initial=0.0)
    if largest * scale < 2.0**62:
        out = np.zeros((len(size), width), np.int64)
        out[row, col] = np.floor(flat * scale).astype(np.int64)
        return out
    out = np.zeros((len(size), width), object)
    out[row, col] = [math.floor(x * scale) if abs(x) < 2.0**53 else int(x) * scale for x in flat.tolist()]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows as int64; a score beyond that range counts as its end."""
    bound = max(1, a.shape[1]) * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if bound <= LONG:
        return strassen(a.astype(np.int64), np.ascontiguousarray(b.astype(np.int64).T))
    exact = strassen(a.astype(object), b.astype(object).T)
    return np.vectorize(lambda x: max(-LONG, min(LONG, x)), otypes=[np.int64])(exact)


class Heap:
    """The first ``k`` of each of some rows by falling score, then rising id. Heaps of parts merge into that of the whole."""

    def __init__(self, rows: int, k: int) -> None:
        self.k = k
        self.row, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(rows, NONE)

    def add(self, scores: np.ndarray, ids: np.ndarray, use: np.ndarray) -> None:
        """Take in a matrix of scores, a column for each id, as far as marked."""
        use &= scores >= self.floor[:, None]
        if scores.shape[1] > self.k:
            told = np.where(use, scores, NONE)
            use &= scores >= np.partition(told, -self.k, axis=1)[:, -self.k, None]
        row, col = np.nonzero(use)
        self.merge(row, scores[row, col], ids[col])

    def merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = np.concatenate([self.row, row]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, ~score, row))
        row, score, ids = row[order], score[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        self.row, self.score, self.id = row[keep], score[keep], ids[keep]
        last = place == self.k - 1
        self.floor[row[last]] = score[last]


def _usable(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    vec = F.col(vec_col)
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    told = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), vec.alias("vec"))
    return told.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad).distinct()


def _cells(rows: DataFrame, parts: int, others: int, names: tuple[str, str]) -> DataFrame:
    """Every row once for each cell of its part: its own part is dealt by hash, the other side's are all."""
    own = F.pmod(F.xxhash64("id", "label", "vec"), F.lit(parts)).cast("int")
    return rows.withColumn(names[0], own).withColumn(names[1], F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def _strips(anchors: pa.Table, rows: pa.Table, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Scores, ids, equal labels and equal ids of a cell, some candidates at a time."""
    anchors, rows = anchors.combine_chunks(), rows.combine_chunks()
    vecs = [t.column("vec").combine_chunks() if isinstance(t.column("vec"), pa.ChunkedArray) else t.column("vec") for t in (anchors, rows)]
    width = max(int(np.diff(v.offsets.to_numpy()).max(initial=0)) for v in vecs)
    a, b = (_integers(v, scale, width) for v in vecs)
    labels = pa.chunked_array([*anchors.column("label").chunks, *rows.column("label").chunks]).dictionary_encode().combine_chunks()
    code = np.concatenate([c.indices.to_numpy() for c in (labels.chunks if isinstance(labels, pa.ChunkedArray) else [labels])])
    mine, code = code[: len(a)], code[len(a) :]
    own, ids = anchors.column("id").to_numpy(), rows.column("id").to_numpy()
    for at in range(0, len(b), STRIP):
        part = slice(at, at + STRIP)
        yield products(a, b[part]), ids[part], mine[:, None] == code[None, part], own[:, None] == ids[None, part]


def _of(anchors: pa.Table, name: str, rows: np.ndarray) -> pa.Array:
    return pa.array(anchors.column(name).to_numpy()[rows], pa.int64())


def _positives(scale: int, k: int):
    def found(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        heap = Heap(len(anchors), k)
        if len(anchors) and len(rows):
            for scores, ids, same, self_ in _strips(anchors, rows, scale):
                heap.add(scores, ids, same & ~self_)
        told = {"anchor_id": _of(anchors, "id", heap.row), "at": _of(anchors, "at", heap.row)}
        return pa.table({**told, "positive_id": pa.array(heap.id, pa.int64()), "positive_score": pa.array(heap.score, pa.int64())})

    return found


def window_of(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest integer from ``low`` to ``high`` hundredths of a score, without overflow."""
    whole, rest = score // 100, score % 100
    return whole * low - (-rest * low // 100), whole * high + rest * high // 100


def _negatives(scale: int, k: int, low: int, high: int):
    def found(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        lists = anchors.column("positives").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        base, of = np.repeat(np.arange(len(size)), size), flat.field("id").to_numpy()
        least, most = window_of(flat.field("score").to_numpy(), low, high)
        first = np.cumsum(size) - size
        heap = Heap(len(base), k)
        if len(base) and len(rows):
            for scores, ids, same, self_ in _strips(anchors, rows, scale):
                for slot in range(int(size.max())):
                    own = np.flatnonzero(size > slot)
                    pair = first[own] + slot
                    here = scores[own]
                    use = ~same[own] & ~self_[own] & (here >= least[pair, None]) & (here <= most[pair, None])
                    one = Heap(len(own), k)
                    one.floor = heap.floor[pair]
                    one.add(here, ids, use)
                    heap.merge(pair[one.row], one.score, one.id)
        pair = heap.row
        told = {"anchor_id": _of(anchors, "id", base[pair]), "at": _of(anchors, "at", base[pair]), "positive_id": pa.array(of[pair], pa.int64())}
        told["positive_score"] = pa.array(flat.field("score").to_numpy()[pair], pa.int64())
        return pa.table({**told, "negative_id": pa.array(heap.id, pa.int64()), "negative_score": pa.array(heap.score, pa.int64())})

    return found


def _first(rows: DataFrame, by: list[str], score: str, ident: str, k: int) -> DataFrame:
    """The heaps of all cells merged; Spark keeps ``k`` rows of a key in each task before it shuffles."""
    best = Window.partitionBy(*by).orderBy(F.desc(score), ident)
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, id_col: str, vec_col: str, label_col: str, is_anchor: Column, scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    A score is the integer inner product of two vectors' components floor(``scale`` * x). An anchor is a row for which
    ``is_anchor``, a condition on the column ``id``, holds; its positives are the first ``positives`` other rows of its
    label, and for each of these the first ``negatives`` rows of another label count whose score is from ``low`` to
    ``high`` hundredths of the positive's. Higher scores come first, ties by smaller id.

    All anchors meet all candidates in cells of about 1 024 by 4 096 rows, dealt by hash, so a common label or vector
    fills no task. Scores are computed twice, for positives and for the windows that depend on them, and never stored.

    Rows with a null id, label or vector or a null or non-finite component take no part; rows that repeat all three count
    once, further ones of an id count each, and no row of the anchor's own id is its positive or negative. Shorter vectors are
    padded with zeros, an empty one scores zero with all. Components of any finite size are exact; a score beyond a
    long counts as the largest or smallest long. No rows, or no anchors, give no rows; other columns are not read.
    """
    used = written(_usable(rows, id_col, vec_col, label_col), "negatives-rows")
    # An id with several vectors is several anchors, told apart by a hash of the row.
    begun = written(used.where(is_anchor).withColumn("at", F.xxhash64("label", "vec")), "negatives-anchors")
    chunks = max(1, -(-used.count() // CANDIDATES))
    groups = max(1, -(-begun.count() // ANCHORS))
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), groups * chunks // 4)
    cell = ["group", "chunk"]
    there = _cells(used, chunks, groups, ("chunk", "group")).repartition(tasks, *cell).groupBy(*cell)

    def met(anchors: DataFrame, kernel, schema: str) -> DataFrame:
        here = _cells(anchors, groups, chunks, ("group", "chunk")).repartition(tasks, *cell).groupBy(*cell)
        return here.cogroup(there).applyInArrow(kernel, schema)

    anchor, pair = "anchor_id long, at long", "positive_id long, positive_score long"
    near = _first(met(begun, _positives(scale, positives), f"{anchor}, {pair}"), ["anchor_id", "at"], "positive_score", "positive_id", positives)
    lists = near.groupBy(F.col("anchor_id").alias("id"), "at").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    begun = written(begun.join(lists, ["id", "at"]), "negatives-positives")
    far = met(begun, _negatives(scale, negatives, low, high), f"{anchor}, {pair}, negative_id long, negative_score long")
    far = _first(far, ["anchor_id", "at", "positive_id", "positive_score"], "negative_score", "negative_id", negatives)
    return far.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
