"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from linenet.llm import ann


def exact(ids, x, k=5, every=50):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = unit @ unit[i]
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    table = rows.toPandas()
    x = np.stack(table.embedding.to_numpy()).astype(np.float64)
    want = exact(table.vec_id.to_numpy(), x)
    place = {v: i for i, v in enumerate(table.vec_id)}
    got = {}
    for r in sorted(ann.nearest(rows, "vec_id", "embedding").collect(), key=lambda r: (r.query_id, r.rank)):
        a, b = x[place[r.query_id]], x[place[r.vec_id]]
        assert r.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    found = sum(len(set(got[q]) & {v for v, _ in want[q]}) for q in want)
    assert found >= 0.95 * 5 * len(want)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [0.9, 0.1]), (4, [0.0, 1.0]), (5, [1.0, 0.0]), (6, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0])]
    rows += [(100, None), (150, [0.0, 0.0]), (200, [float("nan"), 1.0]), (250, [None, 1.0]), (300, [float("inf"), 1.0]), (None, [1.0, 1.0]), (9, []), (0, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, id int, rank int")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in ann.nearest(df, "vec_id", "embedding").collect())
    assert got == [(0, i + 1, v) for i, v in enumerate([1, 2, 5, 6, 7])] + [(50, i + 1, v) for i, v in enumerate([0, 1, 2, 5, 6])]
    few = df.where("vec_id in (0, 3, 4)")
    assert [(r.vec_id, r.rank) for r in ann.nearest(few, "vec_id", "embedding").orderBy("rank").collect()] == [(3, 1), (4, 2)]
    assert ann.nearest(df.where("false"), "vec_id", "embedding").count() == 0
