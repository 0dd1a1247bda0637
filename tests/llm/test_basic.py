"""Quality rules, SimHash, mixing, packing and language ID against plain versions."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
import xxhash

from linenet.llm import langid, mixing, packing, quality, simhash
from linenet.llm.queries import QUERIES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


def plain_quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    cover = {i + j for i, w in enumerate(windows) if w in often for j in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 20 or 100 * len(cover) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(cover), failed


def check_quality(docs, got):
    want = Counter((r.doc_id, *plain_quality(r.text)) for r in docs.collect())
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert found == want


def test_quality_counts(spark, documents, odd_docs, no_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.quality_rules(documents, labels).collect()
    check_quality(documents, got)
    told = {r.doc_id: r.quality for r in labels.collect()}
    junk = [r for r in got if told.get(r.doc_id) == 0]
    good = [r for r in got if told.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(r.kept for r in junk) <= 0.2 * len(junk)
    assert all(not (r.kept and r.base_failed) for r in got)
    none = labels.where("false")
    got = quality.quality_rules(odd_docs, none).collect()
    check_quality(odd_docs, got)
    assert all(r.kept != r.base_failed for r in got)
    assert quality.quality_rules(no_docs, none).count() == 0


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def plain_groups(rows):
    prints = {i: plain_fingerprint(r.text) for i, r in enumerate(rows)}
    parent = {p: p for p in prints.values()}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(list(parent), 2):
        if (a ^ b).bit_count() <= 2:
            parent[root(a)] = root(b)
    least = defaultdict(lambda: None)
    for i, p in prints.items():
        d = rows[i].doc_id
        if d is not None:
            c = root(p)
            least[c] = d if least[c] is None else min(least[c], d)
    return Counter((rows[i].doc_id, p, least[root(p)]) for i, p in prints.items())


@pytest.mark.parametrize("table", ["documents", "odd_docs", "no_docs"])
def test_simhash(table, request):
    docs = request.getfixturevalue(table)
    want = plain_groups(docs.collect())
    got = Counter((r.doc_id, r.fingerprint & (2**64 - 1), r.component_id) for r in simhash.near_groups(docs).collect())
    assert got == want
    stay = simhash.keep_one(docs)
    assert stay.columns == docs.columns
    rows = {(r.doc_id, r.text) for r in docs.collect()}
    kept = Counter(r.doc_id for r in stay.collect() if (r.doc_id, r.text) in rows)
    heads = {d for d, _, c in want if d is not None and d == c}
    assert {d for d in kept if d is not None} == heads and all(n == 1 for d, n in kept.items() if d is not None)


def test_keep_one_with_clashing_names(spark):
    rows = [(1, "a b c d", 1, "x", 2), (1, "a b c d", 1, "x", 2), (2, "A b C d", 3, "y", 4), (None, "a b c d", 5, "z", 6), (None, "a b c d", 5, "z", 6), (3, "other words are here", 7, "w", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text long, fingerprint string, component_id long")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and Counter(map(tuple, kept.collect())) == Counter([rows[0], rows[3], rows[5]])


def test_simhash_links_are_whole(spark):
    base = [0, 1, 3, 7, 15, -1, -2, 1 << 40, (1 << 40) + 5, (1 << 63) - 1, -(1 << 63), 0b1100, 0b110011]
    got = simhash.connected_components(simhash.near_links(spark.createDataFrame([(b,) for b in base], "fingerprint long")), "a", "b")
    found = {r.node: r.component for r in got.collect()}
    want = {}
    for a in base:
        reach, todo = {a}, [a]
        while todo:
            x = todo.pop()
            for y in base:
                if y not in reach and ((x ^ y) & (2**64 - 1)).bit_count() <= 2:
                    reach.add(y)
                    todo.append(y)
        if len(reach) > 1:
            want[a] = min(reach)
    assert found == want


def plain_targets(sizes, weights=(3, 1, 2), share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    out, rest, free = {}, share * sum(sizes.values()), set(names)
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if rest * w[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: rest * w[s] / total for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        rest -= sum(out[s] for s in over)
        free -= over
    return out


@pytest.mark.parametrize("table", ["documents", "odd_docs", "no_docs"])
def test_mixing(table, request):
    docs = request.getfixturevalue(table)
    rows = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r._size) for r in rows) == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in docs.collect())
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r._size
        taken[r.source] += r._copies * r._size
        largest[r.source] = max(largest[r.source], r._size)
        assert 0 <= r._copies <= 2
    want = plain_targets(sizes)
    for r in rows:
        assert r._source_size == sizes[r.source] and r._target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= (1.01 if table == "odd_docs" else 0.51) * largest[s] + 1
    again = Counter((r.doc_id, r._copies) for r in mixing.mix(docs.repartition(5)).collect())
    assert again == Counter((r.doc_id, r._copies) for r in rows)
    assert mixing.mixed_documents(docs).count() == sum(r._copies for r in rows)


@pytest.mark.parametrize("table", ["documents", "odd_docs", "no_docs"])
def test_packing(table, request):
    from tokenizers import Tokenizer

    docs = request.getfixturevalue(table)
    tok = Tokenizer.from_file(tokenizer_path())
    ids = Counter()
    for r in docs.collect():
        ids[r.doc_id, *tok.encode(r.text or "", add_special_tokens=False).ids, 2] += 1
    pieces = packing.pack(docs.repartition(40), tokenizer_path(), open_windows=4).collect()
    by_doc = {k[0]: k[1:] for k in ids}
    total = defaultdict(int)
    places = defaultdict(list)
    for p in pieces:
        part = by_doc[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)) and p.length > 0
        assert p.doc_tokens == len(by_doc[p.doc_id])
        total[p.doc_id] += p.length
        places[p.sequence_id].append((p.offset, p.length))
    assert total == {k: sum(len(i) - 1 for i in ids.elements() if i[0] == k) for k in by_doc}
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    if table == "documents":
        assert len(places) <= 1 + 1.03 * sum(total.values()) / 4096


def test_ids_of_words_are_ids_of_texts():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    for text in ("a\x01b \x01 c", "<|endoftext|>x it's I'LL\u00a0we're \x1c y", "\u0301e \u212b \u1e9e \u0130 \u2028 z\u3000q", "𝒳☃ 12a3 !!?", ""):
        want = b"".join(i.to_bytes(4, "little") for i in tok.encode(text, add_special_tokens=False).ids)
        assert packing.token_ids([text.encode()], tokenizer_path()) == [want]


def test_language(documents, odd_docs, no_docs):
    rows = langid.identify(documents).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    odd = langid.identify(odd_docs).collect()
    assert len(odd) == 14
    for r in odd:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    assert langid.identify(no_docs).count() == 0
    assert {r.lang_pred for r in langid.predict(odd_docs, None).collect()} == {"und"}


def test_accepted_keeps_all_with_letters(spark, odd_docs, documents):
    kept = langid.accepted(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter(tuple(r) for r in odd_docs.collect() if any(c.isalpha() for c in r.text or ""))
    clean = documents.where("lang is not null and text rlike '[a-zA-Z]'")
    rows = clean.limit(60).collect()
    long_ = " ".join(r.text for r in rows if r.lang == "fr") * 40
    docs = spark.createDataFrame([(r.doc_id, r.text, r.lang, "a", 0.5, "b") for r in rows] + [(-1, "A.", "en", "a", 0.1, "b"), (-2, long_, "fr", "a", 0.1, "b")], "doc_id long, text string, lang string, lang_pred string, score double, held_out string")
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and Counter(map(tuple, kept.collect())) == Counter(map(tuple, docs.collect()))


def test_queries_have_the_asked_columns(spark):
    columns = {
        "op4_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        "op9_simhash": ["doc_id", "fingerprint", "component_id"],
        "op10_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    }
    for name, want in columns.items():
        assert set(want) <= set(QUERIES[name](spark, "/root/testdata/sf0.001").columns)
