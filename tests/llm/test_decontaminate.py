"""Decontamination against a plain version; the automaton against all substrings."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linenet.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=10):
    """``{words of a window: ids}`` looked up at every place of every text."""
    known = {}
    for i, text in items:
        w = words(text)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            known.setdefault(tuple(w[at : at + window]), set()).add(i)
    sizes = {len(k) for k in known}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (here := tuple(w[at : at + n])) in known:
                    hit |= set(range(at, at + n))
                    found |= known[here]
        out.append((doc, len(w), hit, tuple(sorted(str(i) for i in found if i is not None))))
    return out


def told(docs, items, window=10):
    return Counter((d, n, len(hit), found) for d, n, hit, found in plain(docs, items, window))


def got(df):
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect())


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, hits string, found int, n_words int"),
        spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, words int"),
    )


@pytest.mark.parametrize("seed", range(6))
def test_automaton_knows_substrings(seed):
    rng = random.Random(seed)
    items = [[rng.randrange(3) for _ in range(rng.randrange(0, 25))] for _ in range(8)]
    made = decontaminate.Automaton.of([(str(i), np.array(x, np.uint64)) for i, x in enumerate(items)], 4)
    assert len(made.length) <= 2 * sum(map(len, items)) + 1
    text = [made.words.tolist().index(x) for x in (rng.randrange(3) for _ in range(200)) if x in made.words]
    state, length = made.walk(np.array(text), np.array([0]), np.array([len(text)]))
    inside = {tuple(x[a:b]) for x in items for a in range(len(x)) for b in range(a, len(x) + 1)}
    real = [int(made.words[x]) for x in text]
    for i in range(len(text)):
        n = int(length[i])
        assert tuple(real[i + 1 - n : i + 1]) in inside and (n > i or tuple(real[i - n : i + 1]) not in inside)
        assert made.length[made.link[state[i]]] < n <= made.length[state[i]]


@pytest.mark.parametrize("shard", [1 << 17, 60])
def test_against_plain(spark, monkeypatch, shard):
    """Long runs of shared words, items inside items, short items, items in pieces, several passes over the texts."""
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 40 if shard < 100 else 1 << 15)
    monkeypatch.setattr(decontaminate, "AT_ONCE", 3)
    rng = random.Random(8)
    name = [f"W{i}" for i in range(5)] + ["ñandú", "x" * 70]
    line = lambda n, k=7: " ".join(rng.choice(name[:k]) for _ in range(n))
    items = [(i, line(rng.randrange(5, 30))) for i in range(25)] + [(100, line(300)), (101, "W1"), (102, "w2, W3"), (103, None), (104, "!"), (None, line(12))]
    items += [(105, items[3][1]), (106, items[3][1] + " W0 " + items[4][1])]
    docs = [(i, ", ".join(rng.choice([line(rng.randrange(1, 9)), rng.choice(items[:26])[1], "other things", rng.choice(items[:26])[1][3:60]]) for _ in range(rng.randrange(1, 9)))) for i in range(120)]
    docs += [(500, items[25][1] * 40), (501, "w1"), (502, ("unknown " + items[5][1] + " ") * 50), (None, items[6][1]), (503, None), (503, None)]
    for some in (items, [x for x in items if x[0] is None or x[0] not in (101, 102)], items[:1]):
        for window in (10, 3):
            d, i = frames(spark, docs, some)
            assert got(decontaminate.overlaps(d.repartition(5), i, window=window)) == told(docs, some, window)


def test_cut(spark):
    passage = "One two three four five six seven eight nine ten eleven"
    items = [(1, passage), (2, "short item here")]
    filler = " ".join(f"f{i}" for i in range(40))
    docs = [(1, f"{filler}. {passage}! {filler}"), (2, passage), (3, None), (4, ""), (5, f"a SHORT, item;here {filler}"), (6, filler), (None, f"{passage.upper()} {filler}")]
    d, i = frames(spark, docs, items)
    found = decontaminate.decontaminated(d, i)
    assert found.columns == d.columns
    assert {r.doc_id: r.text for r in found.collect()} == {1: f"{filler}. ! {filler}", 3: None, 4: "", 5: f"a  {filler}", 6: filler, None: f" {filler}"}
    assert {r.doc_id for r in decontaminate.decontaminated(d, i, most=1.0).collect()} == {1, 2, 3, 4, 5, 6, None}
    assert decontaminate.decontaminated(d, i.where("false")).count() == len(docs)


def test_awkward_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(1, "beta gamma delta epsilon zeta eta theta iota kappa lambda"), (1, "no id at all"), (2, "WORD " * 12), (3, "x" * 200_000), (3, "x" * 200_000), (4, "same same")]
    _, i = frames(spark, [], items)
    assert got(decontaminate.overlaps(odd_docs, i)) == told(docs, items)
    assert got(decontaminate.overlaps(odd_docs, i.where("false"))) == told(docs, [])
    assert decontaminate.overlaps(no_docs, i).count() == 0
    assert decontaminate.decontaminated(odd_docs, i.where(F.col("item_id") == 9)).count() == odd_docs.count()


def test_tables(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    want = told(docs, [(r.item_id, r.text) for r in items.collect()])
    assert got(decontaminate.overlaps(documents, items)) == want and any(x[2] for x in want)
