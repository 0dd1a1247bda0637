"""Line deduplication by a deletion-neighbourhood join on words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from linenet.llm import text as T
from linenet.llm.scratch import written
from linenet.session import scratch_path

MIN_WORDS = 5
ENDS = ["k1", "k2", "k3", "k4"]


class _Lines:
    """The lines with a word of some texts: row, number in the text, range of words, and running hashes."""

    def __init__(self, s: T.Slice) -> None:
        starts, ends = s.words()
        begin, end = s.runs(s.data != 10)
        first, last = np.searchsorted(starts, begin), np.searchsorted(starts, end)
        some = last > first
        self.begin, self.end, self.first, self.last = begin[some], end[some], first[some], last[some]
        self.n = self.last - self.first
        self.row = s.row_of(self.begin)
        breaks = np.concatenate([[0], np.cumsum(s.data == 10)])
        self.pos = breaks[self.begin] - breaks[s.offsets[self.row]]
        self.words = s.hashes(starts, ends)
        self.up, self.down = T.powers(len(starts) + 1)
        self.sums = [self._running(self.words), self._running(T.mixed(self.words, 3))]

    def _running(self, values: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[: len(values)], dtype=np.uint64)])

    def of(self, first: np.ndarray, last: np.ndarray, which: int = 0) -> np.ndarray:
        """A number for each range of words; mix it before use as a key."""
        total = self.sums[which]
        return (total[last] - total[first]) * self.down[first]

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        return T.mixed(self.of(self.first, self.last), 1).view(np.int64), T.mixed(self.of(self.first, self.last, 1), 2).view(np.int64)

    def ends(self) -> list[pa.Array]:
        """Keys of the first and of the last h words, h from a quarter to half of the line.

        Two lines at most one word apart share the first or the last h words if h is at most half of the
        shorter; a line takes the h of its own length and that of one word less.
        """
        out, seen = [], None
        for n in (self.n, self.n - 1):
            h = 1 << np.maximum(np.log2(np.maximum(n, 2) / 2).astype(np.int64), 0)
            use = (self.n >= MIN_WORDS) & (n >= MIN_WORDS - 1) & (h != seen if seen is not None else True)
            for tag, a, b in ((5, self.first, np.minimum(self.first + h, self.last)), (6, np.maximum(self.last - h, self.first), self.last)):
                key = T.mixed(self.of(a, b) + h.astype(np.uint64), tag)
                out.append(pa.array(key.view(np.int64), mask=~np.broadcast_to(use, len(key))))
            seen = h
        return out


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in T.slices(batch.column("text")):
            x = _Lines(s)
            at = pa.array(s.first + x.row)
            told = [batch.column(c).take(at) for c in ("doc_id", "_text", "_doc")]
            yield pa.record_batch([*told, pa.array(x.pos, pa.int32()), *map(pa.array, x.ids()), *x.ends()], names=["doc_id", "_text", "_doc", "pos", "h1", "h2", *ENDS])


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked lines of each text, with their words."""
    for batch in batches:
        asked = batch.column("asked").to_pylist()
        for s in T.slices(batch.column("text")):
            x = _Lines(s)
            width = int(x.pos.max(initial=0)) + 1
            want = np.array([(r * width + p) for r in range(s.rows) for p in asked[s.first + r] if p < width], np.int64)
            use = np.flatnonzero(np.isin(x.row * width + x.pos, want))
            at = pa.array(s.first + x.row[use])
            body = s.data.tobytes()
            lines = [b" ".join(body[a:b].split()).decode() for a, b in zip(x.begin[use].tolist(), x.end[use].tolist())]
            told = [batch.column(c).take(at) for c in ("doc_id", "_text")]
            yield pa.record_batch([*told, pa.array(x.pos[use], pa.int32()), *(pa.array(h[use]) for h in x.ids()), pa.array(lines, pa.string())], names=["doc_id", "_text", "pos", "h1", "h2", "line"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line whole (``at`` -1) and without each one of its words, as a key."""
    names = ["h1", "doc_id", "_text", "pos"]
    for batch in batches:
        for s in T.slices(batch.column("line"), 1 << 18):
            x = _Lines(s)
            line = np.repeat(np.arange(len(x.n)), x.n)
            word = np.arange(len(line))
            at = word - x.first[line]
            before = x.of(x.first[line], word)
            after = x.of(word + 1, np.maximum(x.last[line], word + 1)) * x.up[at]
            key = np.concatenate([x.of(x.first, x.last), before + after])
            size = np.concatenate([x.n, x.n[line] - 1]).astype(np.uint64)
            rows = pa.array(s.first + np.concatenate([x.row, x.row[line]]))
            where = pa.array(np.concatenate([np.full(len(x.n), -1), at]), pa.int32())
            yield pa.record_batch([pa.array(T.mixed(key + size, 9).view(np.int64)), where, *(batch.column(c).take(rows) for c in names)], names=["key", "at", *names])


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether one word put in, left out or changed makes one list the other, or none has to be."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 1


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("late_line").to_pylist(), batch.column("early_line").to_pylist())
        yield pa.record_batch({"h1": batch.column("late").filter(pa.array([within_one(a.split(" "), b.split(" ")) for a, b in pairs], pa.bool_()))})


def _co_located(docs: DataFrame) -> DataFrame:
    """The rows in a bucketed table in the shared folder, so that the two joins that need texts don't move them again.

    ``_doc``, a hash of id and text, is the key; what is joined to it also carries id and text hash, which are
    compared after the join.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = docs.withColumn("_text", F.xxhash64("text")).withColumn("_doc", F.xxhash64("doc_id", "text"))
    path = scratch_path(spark, "documents")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    marked.repartition(buckets, "_doc").write.option("path", path).bucketBy(buckets, "_doc").saveAsTable(name)
    return spark.table(name)


def _place(df: DataFrame) -> Column:
    return F.struct("doc_id", "_text", "pos")


def _by_doc(lines: DataFrame, name: str) -> DataFrame:
    """The places of lines, listed by ``_doc``; a document's lines are as many as it has at most."""
    return lines.groupBy("_doc").agg(F.collect_set(F.struct("doc_id", "_text", "pos")).alias(name))


def _own(places: str) -> Column:
    """The numbers of a row's own lines among those of its ``_doc``."""
    own = F.filter(places, lambda p: (p["_text"] == F.col("_text")) & p["doc_id"].eqNullSafe(F.col("doc_id")))
    return F.transform(own, lambda p: p["pos"])


def near_lines(docs: DataFrame, listed: DataFrame, firsts: DataFrame) -> DataFrame:
    """``h1`` of the distinct lines with an earlier one that is one word apart.

    Only lines that share their first or last words with another line are asked for their words and
    emit the variants without each one word. Lines with an equal variant from which the same word is gone differ
    in that word; a variant equal to a whole line has one word more. Each is paired with the earliest
    of its group, or with that whole line, so pairs are as many as variants at most, and is then verified.
    """
    keys = listed.select(F.explode(F.filter(F.array(*ENDS), lambda k: k.isNotNull())).alias("key"), "h1", "h2")
    shared = written(keys.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("key"), "shared-ends")
    asked = keys.join(shared, "key").select("h1", "h2").distinct().join(firsts, ["h1", "h2"]).select("_doc", "first.*")
    asked = written(_by_doc(asked, "places"), "asked-lines")
    once = docs.join(asked, "_doc").select("doc_id", "_text", "text", _own("places").alias("asked"))
    doc = docs.schema["doc_id"].dataType
    told = StructType([StructField("doc_id", doc), StructField("_text", LongType()), StructField("pos", IntegerType()), StructField("h1", LongType()), StructField("h2", LongType()), StructField("line", StringType())])
    lines = written(once.mapInArrow(_chosen, told).dropDuplicates(["h1", "h2"]), "lines")
    kind = StructType([StructField("key", LongType()), StructField("at", IntegerType()), StructField("h1", LongType()), *told.fields[:3]])
    variants = written(lines.mapInArrow(_variants, kind), "variants")
    place = _place(variants)
    cut, whole = variants.where("at >= 0"), variants.where("at < 0")
    groups = cut.groupBy("key", "at").agg(F.min("h1").alias("a"), F.max("h1").alias("b"), F.min(F.struct(place.alias("place"), "h1")).getField("h1").alias("early"))
    groups = written(groups.where("a <> b").select("key", "at", "early"), "variant-groups")
    changed = cut.join(groups, ["key", "at"]).where("h1 <> early").select(F.col("h1").alias("late"), "early")
    short = whole.select("key", F.col("h1").alias("h"), place.alias("p"))
    longer = cut.select("key", "h1", place.alias("place")).join(short, "key").where("h <> h1")
    later = F.col("place") > F.col("p")
    longer = longer.select(F.when(later, F.col("h1")).otherwise(F.col("h")).alias("late"), F.when(later, F.col("h")).otherwise(F.col("h1")).alias("early"))
    pairs = written(changed.union(longer).distinct(), "line-pairs")
    late = lines.select(F.col("h1").alias("late"), F.col("line").alias("late_line"))
    early = lines.select(F.col("h1").alias("early"), F.col("line").alias("early_line"))
    return pairs.join(late, "late").join(early, "early").mapInArrow(_verified, "h1 long").distinct()


def removed_lines(docs: DataFrame) -> DataFrame:
    """``_doc`` and ``removed``, the places of the lines that go, of the co-located rows."""
    doc = docs.schema["doc_id"].dataType
    fields = [StructField("doc_id", doc), StructField("_text", LongType()), StructField("_doc", LongType()), StructField("pos", IntegerType())]
    told = StructType([*fields, *[StructField(h, LongType()) for h in ("h1", "h2", *ENDS)]])
    listed = written(docs.select("doc_id", "_text", "_doc", "text").mapInArrow(_listed, told), "all-lines")
    firsts = written(listed.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "_text", "pos", "_doc")).alias("first"), F.count("*").alias("n")).withColumn("_doc", F.col("first._doc")).withColumn("first", F.struct("first.doc_id", "first._text", "first.pos")), "first-lines")
    near = written(near_lines(docs, listed, firsts).withColumn("near", F.lit(True)), "near-lines")
    gone = firsts.join(near, "h1", "left").where("near or n > 1").select("h1", "h2", "first", "near")
    here = listed.join(gone, ["h1", "h2"]).where(F.col("near").isNotNull() | ~_place(listed).eqNullSafe(F.col("first")))
    return _by_doc(here, "removed")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the lines that are left in ``text``, and ``_removed``, how many went.

    A line goes if an earlier one has the same words, or the same but for one word put in, left out or
    changed and at least five words each; white space between words does not count. Earlier is by
    ``doc_id`` (null first), then the text's hash, then the line's number, whether or not the earlier line itself
    goes. Lines without a word stay. Rows that repeat an id and a text count as one and get the same lines.
    A null text stays null. No rows give no rows; other columns stay, and names that begin with an underscore
    are reserved.
    """
    marked = _co_located(docs)
    gone = written(removed_lines(marked), "removed-lines")
    joined = marked.join(gone, "_doc", "left").withColumn("_own", F.coalesce(_own("removed"), F.array().cast("array<int>")))
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_own"))
    text = F.when(F.size("_own") == 0, F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    return joined.select(*[(text.alias("text") if c == "text" else marked[c]) for c in docs.columns], F.size("_own").alias("_removed"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the lines that are left; rows that lost lines and have no word left go."""
    return dedup_lines(docs).where("_removed <= 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'").select(*docs.columns)
