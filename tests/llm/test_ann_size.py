"""Recall of the nearest neighbours where first lists are far from whole: many blocks, vectors like those of the tables."""

import numpy as np

from linenet.llm import ann
from tests.llm.test_ann import exact

N = 20_000


def alike(spark, n):
    """Ids and ``n`` vectors drawn from mean and deviation of each label of the table, in the labels' shares."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x, label = np.stack(table.embedding.to_numpy()).astype(np.float64), table.label.to_numpy()
    rng = np.random.default_rng(3)
    drawn = rng.choice(label, n)
    out = np.empty((n, x.shape[1]))
    for one in np.unique(label):
        own = drawn == one
        out[own] = rng.normal(x[label == one].mean(0), x[label == one].std(0), (own.sum(), x.shape[1]))
    return np.arange(n), out


def recall(spark, ids, x):
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>").repartition(8)
    want = exact(ids, x)
    got = {}
    for r in ann.nearest(rows, "vec_id", "embedding").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    return sum(len(got[q] & {v for v, _ in want[q]}) for q in want) / (5 * len(want))


def test_recall_in_many_blocks(spark):
    assert N > 8 * ann.BLOCK
    found = recall(spark, *alike(spark, N))
    print(f"recall at {N} vectors: {found:.4f}")
    assert found >= 0.95
