"""Line deduplication against a plain version."""

import random
from collections import Counter

import pytest
import xxhash

from linenet.llm.linededup import dedup_lines, deduplicated, within_one


def plain(rows):
    """Kept text and number of lines that went, of distinct (id, text)."""
    keyed = sorted({((r.doc_id is not None, r.doc_id), xxhash.xxh64_intdigest((r.text or "").encode(), 42) if r.text is not None else 42, r.text) for r in rows}, key=lambda k: (k[0], k[1] - (k[1] >> 63 << 64)))
    earlier, out = [], {}
    for (_, doc), _, text in keyed:
        if text is None:
            out[doc, text] = (None, 0)
            continue
        kept, gone = [], 0
        for line in text.split("\n"):
            words = line.encode().split()
            same = any(words == e or (min(len(words), len(e)) >= 5 and within_one(words, e)) for e in earlier)
            if words:
                earlier.append(words)
            if words and same:
                gone += 1
            else:
                kept.append(line)
        out[doc, text] = ("\n".join(kept), gone)
    return out


def test_within_one():
    a = "a b c d e".split()
    assert within_one(a, a) and within_one(a, a[1:]) and within_one(a, ["x", *a]) and within_one(a, a[:2] + ["x"] + a[3:])
    assert not within_one(a, a[::-1]) and not within_one(a, a[2:]) and not within_one(a, ["x", *a[1:4], "y"])


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(1)
    base = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 12))] for _ in range(60)]
    rows = []
    for doc in range(80):
        text = []
        for _ in range(rng.randint(0, 9)):
            words = list(rng.choice(base))
            kind = rng.randint(0, 4)
            at = rng.randrange(len(words))
            words = [words, words[:at] + words[at + 1 :], words[:at] + ["new"] + words[at:], words[:at] + [f"w{doc}"] + words[at + 1 :], words][kind]
            text.append(rng.choice([" ", "  ", "\t"]).join(words))
        rows.append((rng.choice([doc, doc, None]), "\n".join(text), "clash", 1))
    return spark.createDataFrame(rows + rows[:5], "doc_id long, text string, line string, pos int")


@pytest.mark.parametrize("table", ["lines", "odd_docs", "no_docs"])
def test_lines(table, request):
    docs = request.getfixturevalue(table)
    rows = docs.collect()
    want = plain(rows)
    found = dedup_lines(docs)
    assert found.columns == [*docs.columns, "_removed"]
    got = Counter((r.doc_id, r.text, r._removed) for r in found.collect())
    assert got == Counter((r.doc_id, *want[r.doc_id, r.text]) for r in rows)
    left = Counter((r.doc_id, r.text) for r in deduplicated(docs).collect())
    assert left == Counter((d, t) for d, t, n in got.elements() if n == 0 or (t and t.strip()))
