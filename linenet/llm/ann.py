"""Approximate nearest neighbours: NN-descent builds a neighbour graph, queries walk it greedily."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linenet.llm.scratch import written

BLOCK = 2048
GROUP = 128


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id`` and ``vec`` (double, scaled by a power of two) of the rows that take part.

    Null or empty vectors, those with a null or non-finite component, and zero vectors don't; nor do rows
    with a null id.
    """
    vec = F.col(vec_col).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    told = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("raw"), vec.alias("vec")).where(F.col("id").isNotNull() & (F.size("vec") > 0) & ~bad)
    # Divided by a power of two near their largest component, which is exact and leaves cosines as they are, squares neither
    # vanish nor overflow.
    scale = F.pow(F.lit(2.0), F.floor(F.log2(F.array_max(F.transform("vec", F.abs)))))
    scaled = told.where(F.exists("vec", lambda x: x != 0)).withColumn("scale", scale)
    return scaled.select("id", F.transform("vec", lambda x: x / F.col("scale")).alias("vec"))


def _even(vectors: DataFrame) -> DataFrame:
    """Shorter vectors padded with zeros to the longest."""
    least, most = vectors.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if least == most:
        return vectors
    padded = F.concat("vec", F.array_repeat(F.lit(0.0), F.lit(most) - F.size("vec")))
    return written(vectors.select("id", padded.alias("vec")).distinct(), "ann-padded")


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The direction of each vector in half precision."""
    for batch in batches:
        if not len(batch):
            continue
        x = _matrix(batch.column("vec"))
        x = x / np.abs(x).max(1, keepdims=True)
        x = x / np.sqrt((x * x).sum(1, keepdims=True))
        half = x.astype(np.float16)
        yield pa.record_batch([batch.column("id"), pa.array([r.tobytes() for r in half], pa.binary())], names=["id", "half"])


def _best(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row."""
    k = min(k, sims.shape[1])
    return np.argpartition(-sims, k - 1, axis=1)[:, :k]


def _block(k: int):
    """The k nearest of each vector among those of its block; blocks come one after another."""

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def told() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            ids = table.column("id").to_numpy()
            x = np.frombuffer(b"".join(table.column("half").to_pylist()), np.float16).reshape(len(ids), -1).astype(np.float32)
            sims = x @ x.T
            np.fill_diagonal(sims, -2)
            at = _best(sims, k)
            u, v, s = np.repeat(ids, at.shape[1]), ids[at].reshape(-1), np.take_along_axis(sims, at, 1).reshape(-1)
            keep = u != v
            return pa.record_batch({"u": pa.array(u[keep]), "v": pa.array(v[keep]), "sim": pa.array(s[keep])})

        for batch in batches:
            block = batch.column("block").to_numpy()
            ends = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for a, b in zip(ends[:-1], ends[1:]):
                if b > a and held and held[-1].column("block")[-1].as_py() != block[a]:
                    yield told()
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield told()

    return within


def _local_join(keep: int):
    """Compare the members of each group and give, for each, the nearest it doesn't know to be worse than its list."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            flat = lists.flatten()
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            v, least, new, half = (flat.field(i) for i in range(4))
            v, least, new = v.to_numpy(), least.to_numpy(), new.to_numpy(zero_copy_only=False)
            if not len(v):
                continue
            x = np.frombuffer(b"".join(half.to_pylist()), np.float16).reshape(len(v), -1).astype(np.float32)
            out: list[list[np.ndarray]] = [[], [], []]
            for a, b in zip(ends[:-1], ends[1:]):
                fresh = new[a:b]
                if b - a < 2 or not fresh.any():
                    continue
                sims = x[a:b] @ x[a:b].T
                useful = (fresh[:, None] | fresh[None, :]) & (sims > least[a:b, None]) & (v[a:b, None] != v[None, a:b])
                sims[~useful] = -2
                at = _best(sims, keep)
                s = np.take_along_axis(sims, at, 1)
                row, col = np.nonzero(s > -2)
                out[0].append(v[a:b][row])
                out[1].append(v[a:b][at[row, col]])
                out[2].append(s[row, col])
            u, w, s = (np.concatenate(o) if o else np.zeros(0, d) for o, d in zip(out, (np.int64, np.int64, np.float32)))
            yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(w, pa.int64()), "sim": pa.array(s, pa.float32())})

    return joined


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The k best distinct neighbours of each node; an edge that was there before is not new."""
    once = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    best = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


@dataclass
class Index:
    """``nodes``: one for each distinct vector (``id`` is the least of its rows, ``vec``, its length ``norm``); ``members``: up to
    ``spare`` least ids of a node; ``edges``: from ``u`` to its near ``v``."""

    nodes: DataFrame
    members: DataFrame
    edges: DataFrame


def build(vectors: DataFrame, k: int = 40, rounds: int = 8, enough: float = 0.002, spare: int = 6) -> Index:
    """NN-descent over all distinct vectors.

    Equal vectors are one node. Lists begin with the nearest inside two blocks of about 2 048 vectors, dealt by
    two hashes of the id. A round joins every node's list and those that list it with
    their vectors, compares the members of a group with each other (neighbours of neighbours) and merges what is
    better into the lists. The group of a node that very many list is split by hash into parts of about 128;
    nothing is left out. Rounds end when less than ``enough`` of all list entries change.
    """
    norm = F.sqrt(_dot(F.col("vec"), F.col("vec"))).alias("norm")
    classed = written(vectors.groupBy("vec").agg(F.min("id").alias("node"), F.count("*").alias("n")).select("node", "vec", "n", norm), "ann-classes")
    nodes = classed.select(F.col("node").alias("id"), "vec", "norm")
    repeated = classed.where("n > 1").select("node", "vec")
    least = Window.partitionBy("node").orderBy("id")
    more = vectors.join(repeated, "vec").select("node", "id").distinct().withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= spare)
    members = written(more.select("node", "id").union(classed.where("n = 1").select("node", F.col("node").alias("id"))), "ann-members")
    halves = written(nodes.mapInArrow(_unit, "id long, half binary"), "ann-halves")
    parts = max(1, -(-halves.count() // BLOCK))

    def begun(seed: int) -> DataFrame:
        dealt = halves.withColumn("block", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(parts)))
        return dealt.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(_block(k), "u long, v long, sim float")

    graph = written(_top(begun(1).union(begun(2)).withColumn("new", F.lit(True)), k), "ann-graph")
    vec = halves.select(F.col("id").alias("v"), "half")
    for _ in range(rounds):
        # The similarity a newcomer has to beat; a short list takes all.
        least_ = graph.groupBy("u").agg(F.when(F.max("rank") >= k, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("least"))
        both = graph.select(F.col("u").alias("pivot"), "v", "new").union(graph.select(F.col("v").alias("pivot"), F.col("u").alias("v"), "new"))
        both = both.groupBy("pivot", "v").agg(F.max("new").alias("new"))
        size = both.groupBy("pivot").agg(F.count("*").alias("n"))
        dealt = both.join(size, "pivot").withColumn("part", F.pmod(F.xxhash64("v", "pivot"), F.ceil(F.col("n") / GROUP)))
        told = vec.join(least_.withColumnRenamed("u", "v"), "v", "left").withColumn("least", F.coalesce("least", F.lit(-2.0).cast("float")))
        groups = dealt.join(told, "v").groupBy("pivot", "part").agg(F.collect_list(F.struct("v", "least", "new", "half")).alias("members"))
        found = groups.select("members").mapInArrow(_local_join(k // 4), "u long, v long, sim float").withColumn("new", F.lit(True))
        old = graph.select("u", "v", "sim", F.lit(False).alias("new"))
        graph = written(_top(old.union(found), k), "ann-graph")
        changed = graph.agg(F.avg(F.col("new").cast("int"))).first()[0]
        if changed is None or changed < enough:
            break
    # For the walk a node also knows those of the nodes listing it that are nearest.
    back = _top(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim", "new"), k)
    edges = written(graph.select("u", "v").union(back.select("u", "v")).distinct(), "ann-edges")
    return Index(nodes, members, edges)


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)


def search(index: Index, queries: DataFrame, k: int = 5, beam: int = 200, width: int = 32, rounds: int = 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the nearest found, none of them the query itself.

    ``queries`` has ``query_id`` and ``entry``, the node of its vector, where it begins; equal queries walk once. A
    round scores, in double precision on the vectors given, the neighbours of the best ``width`` nodes of each
    walk's beam that were not walked yet; it is done when its ``beam`` best are walked. Ties go to the smaller id.
    A walk is one row: the nodes it has met, at most ``rounds`` times ``width`` lists of them, and the best of these.
    """
    nodes = index.nodes.select(F.col("id").alias("v"), F.col("vec").alias("there"), F.col("norm").alias("there_norm"))
    edges = index.edges.select("u", F.col("v").alias("w"))
    ready = "array<struct<far:double,v:bigint,walked:boolean>>"

    def scored(pairs: DataFrame) -> DataFrame:
        """One row for each walk with what it has met now; ``far`` is the cosine, turned round."""
        cosine = _dot(F.col("vec"), F.col("there")) / (F.col("norm") * F.col("there_norm"))
        met = F.struct((-cosine).alias("far"), "v", F.lit(False).alias("walked"))
        return pairs.join(nodes, "v").select("entry", met.alias("met")).groupBy("entry").agg(F.collect_list("met").alias("met"))

    def following(state: DataFrame) -> DataFrame:
        """The state after what was met, with the nodes to walk next, which count as walked."""
        met = F.coalesce("met", F.array().cast(ready))
        best = F.slice(F.sort_array(F.concat("best", met)), 1, max(beam, k + 1))
        state = state.select("entry", "vec", "norm", F.concat("seen", F.transform(met, lambda x: x.v)).alias("seen"), best.alias("best"))
        open_ = F.slice(F.filter(F.slice("best", 1, beam), lambda x: ~x.walked), 1, width)
        state = state.withColumn("turn", F.transform(open_, lambda x: x.v))
        mark = F.transform("best", lambda x: F.struct(x.far.alias("far"), x.v.alias("v"), (x.walked | F.array_contains("turn", x.v)).alias("walked")))
        return written(state.withColumn("best", mark), "ann-walk")

    entries = queries.select("entry").distinct()
    asked = written(index.nodes.join(entries, F.col("id") == F.col("entry")).select("entry", "vec", "norm", F.col("entry").alias("v")), "ann-asked")
    begin = asked.select("entry", "vec", "norm", F.array().cast("array<bigint>").alias("seen"), F.array().cast(ready).alias("best"))
    state = following(begin.join(scored(asked), "entry", "left"))
    for _ in range(rounds):
        walking = state.where(F.size("turn") > 0)
        if walking.isEmpty():
            break
        turn = walking.select("entry", F.explode("turn").alias("u"))
        near = turn.join(edges, "u").groupBy("entry").agg(F.collect_set("w").alias("near"))
        fresh = walking.join(near, "entry").select("entry", "vec", "norm", F.explode(F.array_except("near", "seen")).alias("v"))
        state = following(state.join(scored(fresh), "entry", "left"))
    # A node stands for all rows with its vector; more of the least than asked for are never needed.
    best = state.select("entry", F.explode(F.slice("best", 1, k + 1)).alias("x")).select("entry", F.col("x.v").alias("node"), (-F.col("x.far")).alias("score"))
    found = best.join(index.members.withColumnRenamed("id", "vec_id"), "node")
    first = Window.partitionBy("entry").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k + 1).drop("rank")
    rows = queries.join(found, "entry").where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(rows: DataFrame, id_col: str, vec_col: str, every: int = 50, k: int = 5, **options: float) -> DataFrame:
    """Search the rows whose id is a multiple of ``every`` among all rows, each from its own node of the graph.

    Of rows that repeat an id and a vector one counts; an id with several vectors has each of them. Rows left out
    (see ``usable``) are neither queries nor found. Shorter vectors are padded with zeros. Fewer rows than ``k`` give
    all of them; no rows give no rows.
    """
    vectors = _even(written(usable(rows, id_col, vec_col).distinct(), "ann-vectors"))
    index = build(vectors, spare=k + 1, **options)
    nodes = index.nodes.select(F.col("vec"), F.col("id").alias("entry"))
    queries = written(vectors.where(F.col("id") % every == 0).join(nodes, "vec").groupBy(F.col("id").alias("query_id")).agg(F.min("entry").alias("entry")), "ann-queries")
    return search(index, queries, k)
