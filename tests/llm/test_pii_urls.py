"""Personal data and URL filters against plain versions, and the SQL of the queries."""

import hashlib
import re
from collections import Counter

import pytest

from linenet.llm import pii, urlfilter
from linenet.llm.queries import ORACLES, QUERIES, URL_RULES
from tests import compare

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def good(kind, m):
    n = sum(c in "0123456789" for c in m)
    return {"email": True, "ip": kind == "ip" and max(map(int, m.split("."))) <= 255, "card": 16 <= n <= 19 and luhn(m), "phone": 8 <= n <= 15}[kind]


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m[0])]


HARD = [
    "a@b.com_x@c.de y@z a..b@c-d.e.f. @x.y %+-@1.2", "1.2.3.4.5.6.7.8 999.1.1.1.5.6.7.8 007.1.2.3 256.1.1.1 1.2.3 1.2.3.", "4111 1111 1111 1111 4111-1111-1111-1111, 4111  1111 1111 1111 1",
    "4111111111111111 4111111111111111", "5 4111111111111111 x 41111111111111112 y", "+1 (456) 555-2186 +12 +1..... +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +49 30 1234567)", "é𝒳☃ a@b.co 𝒳 10.0.0.1",
    "x" * 50_000 + "@" + "y." * 20_000 + "z", "1" * 50_000, "1." * 20_000, "+1" * 10_000, "call 212-555-0199 or card 378282246310005", None, "",
]


def test_base_spans(spark, documents, odd_docs, no_docs):
    hard = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string").withColumn("base", pii.F.lit("clash")).withColumn("found", pii.F.lit(1))
    for docs in (documents, odd_docs, hard, no_docs):
        texts = Counter((r.doc_id, ",".join(plain_spans(r.text))) for r in docs.collect())
        rows = pii.find_pii(docs).collect()
        assert Counter((r.doc_id, ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.base)) for r in rows) == texts
        assert all(set(r.base) <= set(r.spans) for r in rows)


def test_labelers_add_spans_with_evidence(spark):
    rows = [(i, f"please call 212-555-{1000 + i} now, or phone +1 212 555 {2000 + i}") for i in range(200)]
    rows += [(1000 + i, f"order 312-555-{1000 + i} was sent") for i in range(200)]
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(len(found[i]) == 2 for i in range(200))
    assert not any(found[1000 + i] for i in range(200))


def test_query_columns(spark):
    rows = QUERIES["op3_pii"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k + ":") for x in base) for k in PLAIN]
        assert set(base) <= set(r.spans.split(",")) if base else True


def test_urls(spark):
    link, move = '<link rel="canonical" href="{}">', '<META http-equiv=refresh content="0; URL={}">'
    rows = [
        (1, "http://A.Example.net/x", None), (2, "https://a.example.net/en/1?q#f", ""), (3, "https://b.example.com/de/x", "x"), (4, "http://n.example.com/fr/x", "<p>"),
        (5, "http://h1.com/a", link.format("http://h2.com/b?x=1&amp;y=2")), (6, "https://h2.com/b?x=1&y=2#z", move.format("//bad.net/z")), (7, "http://h3.com/", link.format("http://h1.com/a")),
        (8, "http://h4.com/p/q", link.format("../r")), (9, "http://h5.org/fr/1", link.format("http://h6.com/")), (10, "http://h6.com", move.format("http://other.net/")), (11, "http://h7.com/t", link.format("/u")),
        (12, None, link.format("http://bad.net/")), (13, "no scheme", "x"), (14, "http://bad.net/z", None), (None, "http://h1.com/a", None), (5, "http://h1.com/a", link.format("http://h2.com/b?x=1&amp;y=2")),
        (15, "http://net/en", ""), (16, "http://xnet/", ""), (17, "http://h7.com/u", move.format("http://h7.com/t")),
    ]
    pages = spark.createDataFrame([(*r, "c", "d") for r in rows], "page_id long, url string, html string, rule string, node string")
    rules = spark.createDataFrame([*URL_RULES, URL_RULES[0]], "rule_host string, rule_path string, verdict string")
    found = {(r.page_id, r.host): (r.path, r.rule, r.verdict) for r in urlfilter.filter_urls(pages, rules).collect()}
    assert urlfilter.filter_urls(pages, rules).count() == len(rows)
    assert found[1, "a.example.net"] == ("/x", "net/", "block") and found[2, "a.example.net"] == ("/en/1", "example.net/en/", "allow")
    assert found[3, "b.example.com"] == ("/de/x", "example.com/de/", "block") and found[4, "n.example.com"] == ("/fr/x", None, "allow")
    for i, h in ((5, "h1.com"), (6, "h2.com"), (7, "h3.com"), (None, "h1.com")):
        assert found[i, h][1:] == (None, "block")
    assert found[9, "h5.org"][1:] == ("org/fr/", "allow") and found[10, "h6.com"][1:] == (None, "allow")
    for i in (8, 11, 12, 13, 16, 17):
        assert [v for (k, _), v in found.items() if k == i][0][1:] == (None, "allow")
    assert found[12, ""] == ("", None, "allow") and found[15, "net"][1:] == ("net/", "block")
    assert urlfilter.filter_urls(pages.where("false"), rules).count() == 0


@pytest.mark.parametrize("name", sorted(set(ORACLES)))
def test_sql(spark, name, monkeypatch):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    assert compare.difference(spark, "/root/testdata/sf0.01", name) is None
