"""Exact nearest neighbours between rows with missing values, and what builds on them.

The distance is Euclidean over the features both rows have, scaled up by the share of
features compared. Donors lie in the leaves of a tree of boxes (``boxes.py``). A query
first searches the leaf its features lead to, and then, down the tree again, those that
can hold a row nearer than the k-th found. No leaf is skipped that could matter, so the
answer is that of comparing everything, without doing so.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import checkpoint_table
from . import boxes

BLOCK_ROWS = 4_096  # donors a leaf holds, and one task at a time
QUERY_ROWS = 8_192  # queries one task holds at a time
MATRIX_ROWS = 256  # queries compared in one matrix operation


def _vector(cols: Sequence[str]) -> Column:
    nan = F.lit(float("nan"))
    return F.array(*[F.coalesce(F.col(c).cast("double"), nan) for c in cols])


def _group(name: str | None) -> Column:
    return F.xxhash64(F.col(name)) if name else F.lit(0).cast("bigint")


def _distinct_donors(donors: DataFrame, keep: int) -> DataFrame:
    """At most ``keep`` rows, those with the smallest ids, of each set of equal rows.

    Ties go to the smaller id, so the others can never be chosen. Spark applies the
    limit inside every task before it shuffles: a value held by a third of all rows
    moves ``keep`` rows per task.
    """
    w = Window.partitionBy("grp", "vec").orderBy("donor_id")
    return donors.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= keep).drop("_n")


def _exact(q: np.ndarray, donors: np.ndarray) -> np.ndarray:
    """Distance of each pair of rows, infinite if they share no feature."""
    total, shared = np.zeros(len(q)), np.zeros(len(q))
    for f in range(q.shape[1]):
        diff = q[:, f] - donors[:, f]
        use = ~np.isnan(diff)
        total += np.where(use, diff, 0) ** 2
        shared += use
    return np.sqrt(np.where(shared > 0, total * (q.shape[1] / np.maximum(shared, 1)), np.inf))


class _Pool:
    """Donors compared with blocks of queries: a product of matrices tells which pairs may count, these are measured exactly."""

    def __init__(self, donors: np.ndarray):
        have = ~np.isnan(donors)
        self.donors, zero = donors, np.where(have, donors, 0)
        with np.errstate(over="ignore"):
            squares = zero**2
        self.right = np.concatenate([have, squares, zero], axis=1).T.astype(float)
        self.have = have.T.astype(float)
        self.size = squares.sum(axis=1).max(initial=0)

    def rough(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances, and how much those of a query may be off; infinite if no feature is shared."""
        has = ~np.isnan(q)
        zero = np.where(has, q, 0)
        shared = has.astype(float) @ self.have
        total = np.concatenate([zero**2, has, -2 * zero], axis=1) @ self.right
        total *= q.shape[1] / np.where(shared > 0, shared, np.nan)
        total[shared == 0] = np.inf
        off = ((zero**2).sum(axis=1) + self.size) * (1e-12 * q.shape[1])
        # Too large for squares: every pair is measured.
        off[~(off < 1e280)] = np.inf
        return total, off

    def closest(self, q: np.ndarray, k: int, reach: np.ndarray, barred: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, position and distance of the k nearest of each query, the earlier position first among equals.

        ``reach`` is a squared distance that k donors, here or elsewhere, don't exceed, NaN if none is known.
        """
        with np.errstate(invalid="ignore", over="ignore"):
            near, off = self.rough(q)
            if barred is not None:
                near[barred] = np.inf
            limit, open_ = reach.copy(), np.isnan(reach)
            if near.shape[1] > k and open_.any():
                limit[open_] = np.partition(near[open_], k - 1, axis=1)[:, k - 1]
            limit = np.where(np.isnan(limit) | np.isinf(off), np.inf, limit + off * 2)
            use = ~(near > limit[:, None]) | np.isinf(off)[:, None]
            if barred is not None:
                use &= ~barred
            rows, at = np.nonzero(use)
            dist = _exact(q[rows], self.donors[at])
        fits = np.isfinite(dist)
        rows, at, dist = rows[fits], at[fits], dist[fits]
        order = np.lexsort((at, dist, rows))
        rows, at, dist = rows[order], at[order], dist[order]
        best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        return rows[best], at[best], dist[best]


def _searcher(k: int, skip_self: bool):
    def search(_key, queries: pd.DataFrame, donors: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(donors):
            donors = donors.sort_values("donor_id", ignore_index=True)
            ids, have = donors["donor_id"].to_numpy(), np.array(donors["vec"].tolist(), float)
            for slot, same in queries.groupby("slot"):
                places = np.flatnonzero(~np.isnan(have[:, slot])) if slot >= 0 else np.arange(len(have))
                pool = _Pool(have[places])
                for start in range(0, len(same) if len(places) else 0, MATRIX_ROWS):
                    part = same.iloc[start:start + MATRIX_ROWS]
                    barred = part["query_id"].to_numpy()[:, None] == ids[places] if skip_self else None
                    reach = part["reach"].to_numpy(dtype=float, na_value=np.nan)
                    rows, at, dist = pool.closest(np.array(part["vec"].tolist(), float), k, reach, barred)
                    best = places[at]
                    features = have[best, slot][:, None] if slot >= 0 else have[best]
                    found.append(pd.DataFrame({
                        "query_id": part["query_id"].to_numpy()[rows], "slot": np.int32(slot),
                        "distance": dist, "donor_id": ids[best], "features": list(features),
                    }))
        # Types are stated because a leaf may find nothing at all.
        nothing = pd.DataFrame({c: pd.Series(dtype=object) for c in ("query_id", "slot", "distance", "donor_id", "features")})
        found = [f for f in found if len(f)]
        out = pd.concat(found, ignore_index=True) if found else nothing
        return out.astype({"slot": "int32", "distance": "float64"})

    return search


def _search(visits: DataFrame, leaves: DataFrame, k: int, skip_self: bool) -> DataFrame:
    """The k best of each leaf for each row that visits it, no farther than its ``reach`` (squared) if that is not null."""
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((visits, "query_id"), (leaves, "donor_id"))}
    schema = f"query_id {kinds['query_id']}, slot int, distance double, donor_id {kinds['donor_id']}, features array<double>"
    pairs = boxes.meet(visits.select("query_id", "slot", "vec", "reach", "node"), leaves.select("donor_id", "vec", "node"), QUERY_ROWS)
    return pairs.applyInPandas(_searcher(k, skip_self), schema)


def _nearest(queries: DataFrame, donors: DataFrame, cols: Sequence[str], k: int, per_column: bool, skip_self: bool) -> DataFrame:
    """Neighbours as ``(query_id, slot, rank, distance, donor_id, features)``.

    ``queries`` is ``(query_id, grp, vec)`` and ``donors`` ``(donor_id, grp, vec)``. With
    ``per_column`` there is a slot per missing feature, filled from the donors that have
    it; otherwise slot -1 stands for the whole row.
    """
    spark, d = queries.sparkSession, len(cols)
    reach = k + 1 if skip_self else k
    pool = checkpoint_table(_distinct_donors(donors, reach), scratch_path(spark, "donors"))
    # More points than copies kept of one of them can always be parted.
    tree = boxes.build(pool, d, max(BLOCK_ROWS, reach))
    slots = F.lit(-1)
    if per_column:
        slots = F.explode(F.filter(F.sequence(F.lit(0), F.lit(d - 1)), lambda i: F.isnan(F.get("vec", i))))
    asked = queries.withColumn("slot", slots)
    first = boxes.closest_leaf(tree, asked, reach).withColumn("reach", F.lit(None).cast("double"))
    found = _search(first, tree.leaves, k, skip_self)
    if tree.levels:
        first = checkpoint_table(first, scratch_path(spark, "first"))
        found = checkpoint_table(_search(first, tree.leaves, k, skip_self), scratch_path(spark, "found"))
        # The k-th distance found so far bounds the search; without k of them every leaf counts.
        far = F.max("distance")
        bound = F.when(F.count(F.lit(1)) >= k, far * far * (1 + 1e-9) + 1e-300)
        bounds = found.groupBy(F.col("query_id").alias("_q"), F.col("slot").alias("_s")).agg(bound.alias("reach"))
        same = (F.col("query_id") == F.col("_q")) & (F.col("slot") == F.col("_s"))
        again = first.drop("reach").withColumnRenamed("node", "seen").join(bounds, same, "left").drop("_q", "_s")
        visits = boxes.leaves_within(tree, again).filter(F.col("node") != F.col("seen"))
        found = found.unionByName(_search(visits, tree.leaves, k, skip_self))
    w = Window.partitionBy("query_id", "slot").orderBy("distance", "donor_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def nearest_rows(
    queries: DataFrame, donors: DataFrame, cols: Sequence[str], k: int, id_col: str, group: str | None = None
) -> DataFrame:
    """The k nearest other rows of each row, within the group if one is named."""
    asked = queries.select(F.col(id_col).alias("query_id"), _group(group).alias("grp"), _vector(cols).alias("vec"))
    held = donors.select(F.col(id_col).alias("donor_id"), _group(group).alias("grp"), _vector(cols).alias("vec"))
    return _nearest(asked, held, cols, k, per_column=False, skip_self=True).drop("slot")


def knn_impute(df: DataFrame, donors: DataFrame, cols: Sequence[str], k: int, id_col: str) -> DataFrame:
    """Fill each missing feature with the mean over its k nearest donors that have it.

    Present values are untouched; where no donor can be compared the donors' mean stands
    in. Rows with equal features share one search.
    """
    missing = " OR ".join(f"`{c}` IS NULL" for c in cols)
    key = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("double").cast("string"), F.lit("-")) for c in cols]))
    keyed = df.withColumn("_key", key)
    asked = keyed.filter(missing).select(
        F.col("_key").alias("query_id"), F.lit(0).cast("bigint").alias("grp"), _vector(cols).alias("vec")
    ).dropDuplicates(["query_id"])
    held = donors.select(F.col(id_col).alias("donor_id"), F.lit(0).cast("bigint").alias("grp"), _vector(cols).alias("vec"))
    near = _nearest(asked, held, cols, k, per_column=True, skip_self=False)
    value = F.get("features", F.lit(0))
    filled = near.groupBy(F.col("query_id").alias("_q")).agg(
        *[F.avg(F.when(F.col("slot") == i, value)).alias(f"_f{i}") for i in range(len(cols))]
    )
    means = donors.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).alias("m")).scalar()
    joined = keyed.join(filled, F.col("_key") == F.col("_q"), "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"_f{i}"), means[c]) for i, c in enumerate(cols)}
    ).select(*df.columns)
