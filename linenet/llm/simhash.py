"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from linenet.llm import text as T
from linenet.llm.components import connected_components
from linenet.llm.scratch import written

BITS = 64
SHINGLES_AT_ONCE = 100_000


def _shingles(s: T.Slice, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one blank between, and begin, end and row of every shingle."""
    upper = (s.data >= 65) & (s.data <= 90)
    data = np.where(upper, s.data + 32, s.data).astype(np.uint8)
    starts, ends = s.words()
    rows = s.row_of(starts)
    inside = ~T.is_space(data)
    keep = inside.copy()
    after = ends[ends < len(data)]
    keep[after] = True
    place = np.cumsum(keep) - 1
    data[~inside] = 32
    begin, stop = place[starts], place[ends - 1] + 1
    many = np.flatnonzero(rows[: max(0, len(rows) - size + 1)] == rows[size - 1 :])
    n = np.bincount(rows, minlength=s.rows)
    first = np.searchsorted(rows, np.flatnonzero((n > 0) & (n < size)))
    few = rows[first]
    row = np.concatenate([rows[many], few])
    order = np.argsort(row, kind="stable")
    b = np.concatenate([begin[many], begin[first]])[order]
    e = np.concatenate([stop[many + size - 1], stop[first + n[few] - 1]])[order]
    return data[keep].tobytes(), b, e, row[order]


def fingerprints_of(s: T.Slice, size: int, seed: int) -> np.ndarray:
    """The fingerprint of every text of a slice; zero for a text without words."""
    body, begin, end, row = _shingles(s, size)
    ones, n = np.zeros((s.rows, BITS), np.int64), np.bincount(row, minlength=s.rows)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(row), SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        h = np.array([digest(body[i:j], seed) for i, j in zip(begin[part].tolist(), end[part].tolist())], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own, first = np.unique(row[part], return_index=True)
        ones[own] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    set_ = (2 * ones > n[:, None]).astype(np.uint8)
    return np.packbits(set_, axis=1, bitorder="little").reshape(-1).view(np.int64)


def fingerprints(docs: DataFrame, size: int = 3, seed: int = 42) -> DataFrame:
    """Every row's columns without the text, and ``fingerprint`` as a long.

    A null, empty or blank text has no word and the fingerprint zero; a column of that name is replaced.
    """
    rest = [c for c in docs.columns if c not in ("text", "fingerprint")]

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints_of(s, size, seed) for s in T.slices(batch.column(len(rest)))]
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.record_batch([*batch.columns[: len(rest)], pa.array(values)], names=[*rest, "fingerprint"])

    schema = StructType([docs.schema[c] for c in rest] + [StructField("fingerprint", LongType())])
    return docs.select(*rest, "text").mapInArrow(marked, schema)


def _ball(radius: int) -> list[int]:
    """All masks of at most so many of the 64 bits."""
    found = [0]
    for _ in range(radius):
        found = list(dict.fromkeys([*found, *(m ^ (1 << b) for m in found for b in range(BITS))]))
    return [m - (1 << BITS) if m >> 63 else m for m in found]


def near_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``a`` and ``b``: enough links between distinct fingerprints to join all within ``radius`` bits.

    Every fingerprint goes to all variants within half the radius, rounded up for the smaller side; two
    within an even radius share a variant. For a variant shared by several, each is linked to the
    least of them and the link is verified. With an even radius those who share a variant are all within
    the radius of one another, so no link between two of them is lost, and a variant has at most as many
    members as its ball, so no key is hot. An odd radius is an error.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = F.array(*[F.lit(m).cast("long") for m in _ball(radius // 2)])
    balls = prints.select(F.col("fingerprint").alias("a"), F.explode(masks).alias("mask")).select("a", F.col("a").bitwiseXOR(F.col("mask")).alias("variant"))
    shared = balls.groupBy("variant").agg(F.min("a").alias("b"), F.max("a").alias("most")).where("b < most").select("variant", "b")
    links = balls.join(written(shared, "variants"), "variant").where("a <> b").select("a", "b").distinct()
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _grouped(docs: DataFrame, radius: int, size: int) -> DataFrame:
    marked = written(fingerprints(docs, size), "fingerprints")
    least = written(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "prints")
    nodes = connected_components(near_links(least, radius), "a", "b").withColumnRenamed("node", "fingerprint")
    named = least.join(nodes, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = written(named.join(ids, "component").select("fingerprint", "component_id"), "classes")
    return marked.join(classes, "fingerprint")


def near_groups(docs: DataFrame, radius: int = 2, size: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id`` of every row.

    The component's id is the least ``doc_id`` in it; documents with a null id take part and count for
    nothing in that, so a component of such documents alone has a null id. Equal fingerprints are always in
    one component, repeated rows too. No rows give no rows; further columns are not returned.
    """
    return _grouped(docs.select("doc_id", "text"), radius, size).select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, radius: int = 2, size: int = 3) -> DataFrame:
    """The rows of ``docs`` without those whose ``doc_id`` isn't the least of their component.

    Rows that repeat an id and a text are reduced to one of them; if an id has several texts, each
    is judged. Rows with a null id can't be the one that stays or goes and all stay, one for each text.
    Null and empty texts have the fingerprint zero and form a component like any other. No rows give no rows. Columns
    are those of ``docs``, whatever they are called.

    Texts are read twice and move only to meet the ids of rows that go or repeat.
    """
    own = [f"_c{i}" for i in range(len(docs.columns))]
    doc, text = (F.col(own[docs.columns.index(c)]) for c in ("doc_id", "text"))
    rows = docs.toDF(*own).withColumn("_text", F.xxhash64(text))
    told = _grouped(rows.select(doc.alias("doc_id"), "_text", text.alias("text")), radius, size)
    goes = F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(False))
    few = told.groupBy(F.col("doc_id").alias("_id"), F.col("_text").alias("_of")).agg(F.max(goes).alias("_goes"), F.count("*").alias("_n"))
    few = written(few.where("_goes or _n > 1").drop("_n"), "near-copies")
    met = rows.join(few, doc.eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_of")), "left")
    repeats = met.where("_goes = false").withColumn("_place", F.row_number().over(Window.partitionBy("_id", "_of").orderBy("_of")))
    return met.where("_goes is null").select(*own).union(repeats.where("_place = 1").select(*own)).toDF(*docs.columns)
