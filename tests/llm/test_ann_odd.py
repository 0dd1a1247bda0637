"""Nearest neighbours of vectors of odd sizes and lengths."""

import math

import pytest

from linenet.llm import ann


def test_tiny_huge_and_ragged_vectors(spark):
    # Powers of two, so that vectors of one direction tie to the last bit.
    rows = [(0, [2.0**-660, 0.0]), (1, [2.0**660, 0.0]), (2, [1.0, 0.0]), (3, [5e-324, 5e-324]), (50, [2.0**990, 2.0**990]), (100, [3.0, 4.0, 12.0]), (101, [2.0]), (102, [0.0, 0.0, -1e-310]), (150, [0.0]), (151, [])]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()
    used = {i: [x / max(map(abs, v)) for x in [*v, 0.0, 0.0, 0.0][:3]] for i, v in rows if any(v)}

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    for q in (0, 50, 100):
        want = sorted((-round(cosine(used[q], v), 12), i) for i, v in used.items() if i != q)[:5]
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == q)
        assert [(i, s) for _, i, s in got] == [(i, pytest.approx(-s, abs=1e-12)) for s, i in want]
    assert {r.query_id for r in found} == {0, 50, 100}
