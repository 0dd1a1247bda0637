"""Ordered, sampled and neighbour operators against plain computations, with hot keys and any partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linenet.operators import boxes
from linenet.operators import encoding as en
from linenet.operators import neighbours as nb
from linenet.operators import ordering as od
from linenet.operators import sampling as sp


@pytest.fixture(scope="module")
def skewed():
    """A third of all rows share one value."""
    rng = np.random.default_rng(7)
    x = np.round(rng.lognormal(0, 1, 6000), 3)
    x[::3] = 1.234
    return x


@pytest.mark.parametrize("parts", [1, 7])
def test_percentiles_exact(spark, skewed, parts):
    df = spark.createDataFrame([(float(v),) for v in skewed], "v double").repartition(parts)
    qs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    row = od.percentiles(df, "v", qs).first()
    assert [row[f"p{i}"] for i in range(len(qs))] == pytest.approx(list(np.quantile(skewed, qs)), abs=1e-12)
    assert row["n"] == len(skewed)


def test_percentiles_by_group_with_null_group(spark, skewed):
    rows = [(None if i % 5 == 0 else f"g{i % 2}", float(v)) for i, v in enumerate(skewed)]
    out = {r["g"]: r["p0"] for r in od.percentiles(spark.createDataFrame(rows, "g string, v double"), "v", [0.5], ["g"]).collect()}
    for g in (None, "g0", "g1"):
        assert out[g] == pytest.approx(np.median([v for h, v in rows if h == g]))


def test_empty_input(spark):
    none = spark.createDataFrame([], "v double, k string")
    assert od.percentiles(none, "v", [0.5]).first()["p0"] is None
    assert od.dense_index(none.select("k"), "k", "i").count() == 0
    assert en.fit_codes(none, "k").count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_dense_index_is_global_order(spark, parts):
    keys = [f"k{i * 7919 % 5000}" for i in range(5000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(parts)
    got = {r["k"]: r["i"] for r in od.dense_index(df, "k", "i").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_split_and_folds_exact_with_hot_class(spark):
    rows = [(i, "hot" if i % 3 else f"c{i % 5}") for i in range(3000)] + [(-1, None)]
    df = spark.createDataFrame(rows, "id int, y string")
    size = {r["y"]: r["n"] for r in df.groupBy("y").agg(F.count("*").alias("n")).collect()}
    one = sp.stratified_split(df.repartition(1), "y", 0.2, "id", 1).filter("is_test")
    seven = sp.stratified_split(df.repartition(7), "y", 0.2, "id", 1).filter("is_test")
    assert {r["id"] for r in one.collect()} == {r["id"] for r in seven.collect()}
    assert {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()} == {
        y: round(n * 0.2) for y, n in size.items() if round(n * 0.2)
    }
    folds = sp.stratified_folds(df, "y", 3, "id", 1).groupBy("y", "fold").agg(F.count("*").alias("n")).collect()
    for y, n in size.items():
        sizes = [r["n"] for r in folds if r["y"] == y]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 or n < 3


def brute(rows, donors, k):
    out = rows.copy()
    d = rows.shape[1]
    for i, q in enumerate(rows):
        diff = donors - q
        shared = (~np.isnan(diff)).sum(1)
        dist = np.sqrt(np.where(shared > 0, d / np.maximum(shared, 1) * np.nansum(diff**2, 1), np.inf))
        for c in np.flatnonzero(np.isnan(q)):
            pool = [j for j in range(len(donors)) if not np.isnan(donors[j, c]) and np.isfinite(dist[j])]
            best = sorted(pool, key=lambda j: (dist[j], j))[:k]
            out[i, c] = donors[best, c].mean() if best else np.nanmean(donors[:, c])
    return out


@pytest.mark.parametrize("block", [4096, 64, 8])
def test_knn_impute_is_exact(spark, monkeypatch, block):
    """One leaf, and trees of several levels; a third of the donors are equal."""
    monkeypatch.setattr(nb, "BLOCK_ROWS", block)
    monkeypatch.setattr(nb, "QUERY_ROWS", 50)
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(600, 3)), 3)
    x[::3] = x[0]
    x[rng.random(x.shape) < 0.15] = np.nan
    x[5] = np.nan
    cols = ["a", "b", "c"]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    donors = df.filter("id % 2 = 0")
    got = {r["id"]: [r[c] for c in cols] for r in nb.knn_impute(df, donors, cols, 7, "id").collect()}
    want = brute(x, x[::2], 7)
    assert len(got) == len(x)
    for i in range(len(x)):
        assert got[i] == pytest.approx(want[i].tolist(), abs=1e-9), i


def test_few_leaves_of_many_are_visited(spark):
    """Twelve features that may be missing, rows around some hundred places: what may be near is a small share."""
    rng = np.random.default_rng(5)
    x = rng.normal(scale=20, size=(100, 12))[rng.integers(0, 100, 20_000)] + rng.normal(size=(20_000, 12))
    x[rng.random(x.shape) < 0.08] = np.nan
    points = spark.createDataFrame([(i, 0, [float(v) for v in r]) for i, r in enumerate(x)], "donor_id int, grp long, vec array<double>")
    tree = boxes.build(points, 12, 64)
    sizes = {r["node"]: r["n"] for r in tree.leaves.groupBy("node").agg(F.count("*").alias("n")).collect()}
    assert sum(sizes.values()) == len(x) and max(sizes.values()) <= 64 and len(tree.levels) >= 3
    queries = x[:40]
    diff = x[None] - queries[:, None]
    shared = (~np.isnan(diff)).sum(2)
    dist = np.where(shared > 0, 12 / np.maximum(shared, 1) * np.nansum(diff**2, 2), np.inf)
    kth = np.sort(dist, axis=1)[:, 5]
    asked = spark.createDataFrame(
        [(i, 0, [float(v) for v in q], -1, float(kth[i] * (1 + 1e-9))) for i, q in enumerate(queries)],
        "query_id int, grp long, vec array<double>, slot int, reach double",
    )
    visits = boxes.leaves_within(tree, asked).select("query_id", "node").collect()
    at = {r["donor_id"]: r["node"] for r in tree.leaves.select("donor_id", "node").collect()}
    seen = {(r["query_id"], r["node"]) for r in visits}
    assert all((i, at[j]) in seen for i in range(len(queries)) for j in np.flatnonzero(dist[i] <= kth[i]))
    assert sum(sizes[r["node"]] for r in visits) < 0.15 * len(queries) * len(x)


def test_few_donors(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 10.0), (3, 3.0, 20.0)], "id int, a double, b double")
    got = {r["id"]: r["b"] for r in nb.knn_impute(df, df, ["a", "b"], 7, "id").collect()}
    assert got == {1: 15.0, 2: 10.0, 3: 20.0}


@pytest.mark.parametrize("parts", [1, 5])
def test_smote_between_neighbours(spark, parts):
    rng = np.random.default_rng(2)
    pts = [(i, "big", *map(float, rng.normal(size=2))) for i in range(60)]
    pts += [(100 + i, "small", *map(float, rng.normal(5, 1, size=2))) for i in range(17)]
    pts += [(300, "lone", 0.0, 0.0)]
    df = spark.createDataFrame(pts, "id int, y string, a double, b double").repartition(parts)
    made = sp.smote(df, "y", ["a", "b"], "id", 5, 9, {"small": 60, "lone": 9, "big": 10}).collect()
    assert len(made) == 43 and {r["y"] for r in made} == {"small"}
    small = np.array([p[2:] for p in pts if p[1] == "small"])
    for r in made:
        base = np.array(next(p[2:] for p in pts if p[0] == r["base_id"]))
        near = small[np.argsort(((small - base) ** 2).sum(1))[1:6]]
        p = np.array([r["a"], r["b"]])
        # On the straight piece from the base to one of its five neighbours.
        gaps = [np.linalg.norm(p - base) + np.linalg.norm(p - n) - np.linalg.norm(base - n) for n in near]
        assert min(gaps) < 1e-9
    again = sp.smote(df.repartition(3), "y", ["a", "b"], "id", 5, 9, {"small": 60}).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, made))


def test_roc_against_pairs(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 500)
    s = np.round(rng.random(500) * 0.5 + y * 0.2, 2)
    s[::3] = 0.5
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    assert od.auc(df, "y", "s").first()["auc"] == pytest.approx(want)
