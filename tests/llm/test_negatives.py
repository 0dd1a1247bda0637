"""Hard negatives against a plain version, Strassen products against plain ones."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linenet.llm import negatives
from linenet.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, score string, at string"
LONG = 2**63 - 1


def plain(rows, every, positives=5, count=10):
    used = {(i, label, tuple(v)) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, label, [math.floor(256 * x) if abs(x) < 2**53 else 256 * int(x) for x in v]) for i, label, v in used]
    score = lambda p, q: max(-LONG, min(LONG, sum(x * y for x, y in zip(p, q))))
    out = Counter()
    for a, label, v in whole:
        if a % every:
            continue
        all_ = sorted(((-score(v, w), i, other) for i, other, w in whole if i != a), key=lambda x: x[:2])
        for ps, p, _ in [x for x in all_ if x[2] == label][:positives]:
            fit = [x for x in all_ if x[2] != label and 30 * -ps <= 100 * -x[0] <= 90 * -ps]
            for rank, (ns, n, _) in enumerate(fit[:count], 1):
                out[a, p, rank, n, -ps, -ns] += 1
    return out


def got(df):
    return Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def mined(spark, rows, every=10, **options):
    table = spark.createDataFrame([(*r, 1, "s", "x") for r in rows], SCHEMA)
    return got(negatives.mine(table, "vec_id", "embedding", "label", F.col("id") % every == 0, **options))


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 0, 7), (40, 33, 70), (64, 64, 64), (130, 65, 91)])
def test_strassen(shape):
    rng = np.random.default_rng(1)
    n, k, m = shape
    a, b = rng.integers(-(1 << 20), 1 << 20, (n, k)), rng.integers(-(1 << 20), 1 << 20, (k, m))
    assert (negatives.strassen(a, b, 8) == a @ b).all()
    assert (negatives.strassen(a.astype(object), b.astype(object), 8) == a @ b).all()


def test_heaps_merge():
    rng = np.random.default_rng(2)
    scores, ids = rng.integers(0, 6, (9, 200)), rng.permutation(200)
    heap = negatives.Heap(9, 7)
    for at in range(0, 200, 33):
        heap.add(scores[:, at : at + 33], ids[at : at + 33], np.ones_like(scores[:, at : at + 33], bool))
    for row in range(9):
        want = sorted(zip((-scores[row]).tolist(), ids.tolist()))[:7]
        assert [(-s, i) for s, i in zip(heap.score[heap.row == row], heap.id[heap.row == row])] == want


def test_windows():
    for s in (*range(-300, 300), LONG, LONG - 57, -LONG):
        low, high = negatives.window_of(np.array([s]), 30, 90)
        assert low[0] == -(-30 * s // 100) and high[0] == 90 * s // 100


@pytest.mark.parametrize("cell", [(1024, 4096), (4, 32)])
def test_against_plain(spark, monkeypatch, cell):
    monkeypatch.setattr(negatives, "ANCHORS", cell[0])
    monkeypatch.setattr(negatives, "CANDIDATES", cell[1])
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-0.2, 1) for _ in range(20)], rng.choice([0, 0, 0, 1, 2])) for i in range(400)]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(60)]
    assert mined(spark, rows) == plain(rows, 10)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [0.5, 0.5], 2), (1, [1.0], 1), (2, [], 2), (3, None, 1), (4, [None, 1.0], 1), (5, [nan, 1.0], 1), (6, [1.0, inf], 2),
        (7, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (8, [3.0, 2.0, 1.0], 1), (9, [0.3, 0.4], 2), (10, [0.0, 0.0], 2), (11, [1.0, 2.0], 1), (12, [1.0, 2.0], 2), (20, [-1.0, -1.0], 2), (-10, [0.4, 0.9], 3),
    ]
    want = plain(rows, 10)
    assert want and mined(spark, rows) == want
    huge = [(i, [v, 1.0], i % 2) for i, v in enumerate([1e300, 1e18, -1e300, 3e12, 2.5e7, 1e200, 5e-324, 1.0, 7e17, 1e9, 4.0, 1e16] * 3)]
    assert mined(spark, huge) == plain(huge, 10)
    assert mined(spark, []) == Counter()
    assert mined(spark, [(1, [1.0], 1)]) == Counter()
    assert mined(spark, [(10, [1.0], 1)]) == Counter()


def test_query(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op11_hard_negatives"](spark, folder)
    assert dict(found.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert got(found) == plain(rows, 100)
