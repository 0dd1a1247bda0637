"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linenet.llm import resample
from linenet.llm import text as T

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def plain(docs, target):
    raw, want = (Counter(bucket(f) for t in texts for f in plain_features(t)[1]) for texts in ([t for _, t in docs], target))
    s, t = sum(raw.values()), sum(want.values())
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1) * (s + 10_000) / ((raw[b] + 1) * (t + 10_000))))
    told = []
    for doc, text in docs:
        n, found = plain_features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        told.append((doc, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((x for x in told if x[1] >= 20), key=lambda x: (-x[4], x[0] is not None, x[0] or 0, x[1], x[2]))
    out, drawn = Counter(), len(fit) * 25 // 100
    for rank, x in enumerate(fit, 1):
        out[(*x, rank if rank <= drawn else None)] += 1
    return out + Counter((*x, None) for x in told if x[1] < 20)


def got(df):
    return Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 0.5) for i, t in rows], "doc_id long, text string, n long, rank string, score double")


def test_features_are_whole():
    rng = random.Random(5)
    texts = ["".join(rng.choice("aZé 1.\n☃-𝒳\x00\x7f`{/:@[") for _ in range(rng.randrange(80))) for _ in range(300)] + ["", "x" * 300 + " " + "Yé" * 100, "a" * 64 + " " + "b" * 65]
    for s in T.slices(__import__("pyarrow").array(texts), 400):
        rows, buckets = resample.features(s)
        for r in range(s.rows):
            assert Counter(buckets[rows == r].tolist()) == Counter(map(bucket, plain_features(texts[s.first + r])[1]))


@pytest.mark.parametrize("hot", [10_000, 1, 3])
def test_against_plain(spark, monkeypatch, hot):
    """Lines that many documents share, lines met once, copies, hot lines on either side of the cut."""
    monkeypatch.setattr(resample, "HOT", hot)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)] + ["Été", "x" * 90]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [line(9) for _ in range(5)]
    docs = [(i, "\n".join(rng.choice([rng.choice(shared), shared[0], line(rng.randrange(0, 12)), "", " . "]) for _ in range(rng.randrange(1, 9)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(150)] + [(5000, "\n".join(line(30) for _ in range(900)))]
    target = [line(15) for _ in range(9)] + [shared[1]] * 4
    other = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert got(resample.resample(table(spark, docs).repartition(7), other)) == plain(docs, target)


def test_awkward_rows(spark, odd_docs, no_docs):
    other = spark.createDataFrame([("one two three",), (None,), ("",)], "text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = plain(docs, ["one two three"])
    assert got(resample.resample(odd_docs, other)) == want
    assert got(resample.resample(odd_docs, other.where("false"))) == plain(docs, [])
    assert resample.resample(no_docs, other).count() == 0
    same = [(4, "a b " * 15)] * 9 + [(None, "a b " * 15)] * 3
    assert got(resample.resample(table(spark, same), other)) == plain(same, ["one two three"])
    kept = resample.drawn_documents(table(spark, same), other)
    assert kept.columns == ["doc_id", "text", "n", "rank", "score"] and kept.count() == 3


def test_drawn_documents(spark, documents):
    other = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = resample.resample(documents, other).where("rank is not null")
    found = resample.drawn_documents(documents, other)
    assert found.columns == documents.columns
    assert Counter(r.doc_id for r in found.collect()) == Counter(r.doc_id for r in want.collect())
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert all(texts[r.doc_id] == r.text for r in found.where(F.col("doc_id").isNotNull()).collect())


def test_gains():
    raw, want = np.array([0, 5, 9, 100]), np.array([0, 5, 0, 3])
    told = [math.floor(1000 * math.log((t + 1) * (114 + 4) / ((s + 1) * (8 + 4)))) for s, t in zip(raw.tolist(), want.tolist())]
    assert resample.gains_of(raw, want).tolist() == told
