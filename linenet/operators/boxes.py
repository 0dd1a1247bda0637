"""A tree of boxes over points with missing values, built and walked level by level by joins.

A node with too many points is cut at the quantiles of its widest feature, those equal to
a cut and those without the feature apart, until every leaf is small. A level is one table
with a row for each node, which holds the boxes of its parts: neither the number of boxes
nor that of points has a bound, and no box reaches the driver.

A box knows the least and largest value of each feature and how many points have it. The
distance is squared, over the features both sides have, scaled up by the share compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import checkpoint_table

WAYS = 8  # quantiles a node is cut at, less one: at most 16 parts with the equal and the missing ones
STEP_ROWS = 8_192  # rows that go on from a node together


@dataclass(frozen=True)
class BoxTree:
    roots: DataFrame  # (node, leaf), one for each group
    levels: Sequence[DataFrame]  # (node, kids) of the nodes that are cut
    leaves: DataFrame  # the points with the ``node`` that holds them
    features: int


def _value(i: int | Column) -> Column:
    return F.nanvl(F.get("vec", F.lit(i) if isinstance(i, int) else i), F.lit(None).cast("double"))


def _widest(d: int) -> Column:
    """Feature that parts the points most, -1 if they are all alike."""
    n, places = F.col("n"), []
    for i in range(d):
        low, high, has = (F.get(c, F.lit(i)) for c in ("lo", "hi", "has"))
        width = F.when(high > low, (high - low) * has / n).when((has > 0) & (has < n), 0.0).otherwise(-1.0)
        places.append(F.struct(width.alias("w"), F.lit(-i).alias("i")))
    best = F.array_max(F.array(*places))
    return F.when(best["w"] >= 0, -best["i"]).otherwise(-1)


def _measured(points: DataFrame, d: int, most: int) -> DataFrame:
    boxes = points.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.min(_value(i)) for i in range(d)]).alias("lo"),
        F.array(*[F.max(_value(i)) for i in range(d)]).alias("hi"),
        F.array(*[F.count(_value(i)) for i in range(d)]).alias("has"),
    )
    feature = F.when(F.col("n") > most, _widest(d)).otherwise(-1)
    return boxes.withColumn("feature", feature).withColumn("leaf", F.col("feature") < 0)


def build(points: DataFrame, d: int, most: int) -> BoxTree:
    """Tree over ``(..., grp, vec)`` with a root for each group; missing features are NaN.

    A leaf holds at most ``most`` points, or points that are all equal. Each level takes
    its cuts from all points of a node, so a dense place gets as many levels as it needs.
    """
    spark = points.sparkSession
    now, levels, leaves, roots = points.withColumn("node", F.col("grp").cast("string")), [], [], None
    while True:
        boxes = checkpoint_table(_measured(now, d, most), scratch_path(spark, "boxes"))
        if roots is None:
            roots = boxes.select("node", "leaf")
        else:
            kid = F.struct("node", "leaf", "n", "lo", "hi", "has")
            parent = F.regexp_replace("node", r"\.[^.]*$", "").alias("parent")
            kids = boxes.groupBy(parent).agg(F.collect_list(kid).alias("kids")).withColumnRenamed("parent", "node")
            levels.append(checkpoint_table(kids, scratch_path(spark, "kids")))
        leaves.append(now.join(boxes.filter("leaf").select("node"), "node", "left_semi"))
        cut = boxes.filter("NOT leaf").select("node", "feature")
        if not cut.take(1):
            return BoxTree(roots, levels, reduce(DataFrame.unionByName, leaves), d)
        rest = now.join(cut, "node").withColumn("_x", _value(F.col("feature")))
        shares = [j / WAYS for j in range(1, WAYS)]
        cuts = rest.groupBy("node").agg(F.array_distinct(F.percentile_approx("_x", shares, 1000)).alias("_cuts"))
        passed = F.size(F.filter("_cuts", lambda c: F.col("_x") >= c)) + F.size(F.filter("_cuts", lambda c: F.col("_x") > c))
        part = F.when(F.col("_x").isNull(), F.lit("none")).otherwise(passed.cast("string"))
        moved = rest.join(cuts, "node").select(*points.columns, F.concat_ws(".", "node", part).alias("node"))
        now = checkpoint_table(moved, scratch_path(spark, "parts"))


def _vectors(column: pa.ChunkedArray, d: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().reshape(-1, d)


def least(vec: np.ndarray, lo: np.ndarray, hi: np.ndarray, has: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Smallest squared distance a point of each box can have to each vector, infinite if none can be compared.

    Features every point has count in any case. Of those some points have, the ones that
    lower the mean count, the smallest first.
    """
    d = vec.shape[1]
    v = vec[:, None, :]
    with np.errstate(invalid="ignore", over="ignore"):
        gaps = np.fmax(np.fmax(lo - v, v - hi), 0) ** 2
    usable = ~np.isnan(v) & (has > 0)
    sure = usable & (has == n[:, None])
    total, count = np.where(sure, gaps, 0).sum(axis=2), sure.sum(axis=2)
    best = np.where(count > 0, total / np.maximum(count, 1), np.inf)
    # Behind those that count, which are the smallest, come infinite ones.
    some = np.sort(np.where(usable & ~sure, gaps, np.inf), axis=2)
    for j in range(d):
        total = total + some[:, :, j]
        best = np.minimum(best, total / (count + j + 1))
    return best * d


def _kids(level: pa.Table) -> tuple[list, ...]:
    """Names, whether they are leaves, and boxes of the parts of one node, by name."""
    kids = sorted(level.column("kids")[0].as_py(), key=lambda kid: kid["node"])
    boxes = (np.array([kid[c] for kid in kids], float) for c in ("lo", "hi", "has", "n"))
    return [kid["node"] for kid in kids], [kid["leaf"] for kid in kids], *boxes


def _stepper(keep: Sequence[str], d: int, choose):
    """Rows of a node with the parts of it they go on to: ``choose`` tells which, as places of rows and parts."""

    def step(asked: pa.Table, level: pa.Table) -> pa.Table:
        rows = asked.select(list(keep))
        if not len(asked) or not len(level):
            none = {"node": pa.array([], pa.string()), "leaf": pa.array([], pa.bool_())}
            return pa.table({**{c: rows.column(c).slice(0, 0) for c in keep}, **none})
        names, ends, lo, hi, has, n = _kids(level)
        vec, slot = _vectors(asked.column("vec"), d), asked.column("slot").to_numpy()
        low = least(vec, lo, hi, has, n)
        # Points of each part that have the feature asked for; slot -1 asks for none.
        holds = np.where(slot[:, None] < 0, n, has[:, np.maximum(slot, 0)].T)
        row, kid = choose(asked, low, holds)
        out = rows.take(pa.array(row))
        return out.append_column("node", pa.array(names, pa.string()).take(pa.array(kid))).append_column(
            "leaf", pa.array(ends, pa.bool_()).take(pa.array(kid))
        )

    return step


def meet(rows: DataFrame, held: DataFrame, most: int):
    """Rows and what is held at their ``node``, grouped to be worked on together.

    A node many rows come to is copied to several tasks, each with a share of them.
    """
    load = rows.groupBy(F.col("node").alias("_b")).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_s"))
    same = F.col("node") == F.col("_b")
    salt = F.pmod(F.xxhash64(*rows.columns), F.col("_s")).cast("int")
    left = rows.join(load, same).withColumn("salt", salt).drop("_b", "_s")
    right = held.join(load, same).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("_s") - 1))).drop("_b", "_s")
    return left.groupBy("node", "salt").cogroup(right.groupBy("node", "salt"))


def _walk(tree: BoxTree, asked: DataFrame, choose) -> DataFrame:
    """The leaves each row comes to. A level is worked on in arrays, node by node; its rows are written once."""
    spark, keep = asked.sparkSession, asked.columns
    at = asked.join(tree.roots, F.col("grp").cast("string") == F.col("node")).select(*keep, "node", "leaf")
    if not tree.levels:
        return at.filter("leaf").drop("leaf")
    step = _stepper(keep, tree.features, choose)
    at = checkpoint_table(at, scratch_path(spark, "walk"))
    ended = [at.filter("leaf")]
    for level in tree.levels:
        pairs = meet(at.filter("NOT leaf").drop("leaf"), level, STEP_ROWS)
        at = checkpoint_table(pairs.applyInArrow(step, at.schema), scratch_path(spark, "walk"))
        ended.append(at.filter("leaf"))
    return reduce(DataFrame.unionByName, ended).drop("leaf")


def closest_leaf(tree: BoxTree, asked: DataFrame, k: int) -> DataFrame:
    """One leaf for each row of ``(..., grp, vec, slot)``, by the part of least distance among those with ``k`` points to offer."""

    def choose(_asked: pa.Table, low: np.ndarray, holds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        enough = np.where(holds < k, np.inf, low)
        # Where none has enough, the nearest counts; the first name among equals.
        kid = np.where(np.isfinite(enough).any(axis=1), enough.argmin(axis=1), low.argmin(axis=1))
        return np.arange(len(kid)), kid

    return _walk(tree, asked, choose)


def leaves_within(tree: BoxTree, asked: DataFrame) -> DataFrame:
    """Every leaf that can hold a point at most ``reach`` away (squared; null: any that can be compared)."""

    def choose(asked: pa.Table, low: np.ndarray, holds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        reach = asked.column("reach").to_numpy()
        limit = np.where(np.isnan(reach), np.inf, reach)
        return np.nonzero((holds > 0) & np.isfinite(low) & (low <= limit[:, None]))

    return _walk(tree, asked, choose)
