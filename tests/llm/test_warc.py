"""Archives against a plain reader, with magic in payloads and splits in every place."""

import base64
import hashlib
from collections import Counter

import pytest

from linenet.llm import warc
from linenet.llm.queries import warc_pages

EVIL = "a\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.0\r\n"


@pytest.fixture
def pages(spark):
    html = ["plain", EVIL, None, "", "plain", EVIL * 30, "\r\nWARC/1.", "WARC/1.0\r\n", "é☃" * 500, "\r\nWARC/1.0\r\nWARC/1.0\r\n\r\n", "plain"]
    rows = [(i, f"http://h/{i}\r\nx", h, "c") for i, h in enumerate(html)] + [(None, None, "null id", "c"), (3, "again", "", "c")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def want(rows):
    best, out = {}, Counter()
    for r in rows:
        body = (r.html or "").encode()
        best[body] = max(best.get(body, -1), -1 if r.page_id is None else r.page_id)
    for r in rows:
        body = (r.html or "").encode()
        own = r.page_id is None and best[body] == -1 or r.page_id == best[body]
        out[r.page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if own else "revisit", None if own else best[body]] += 1
    return out


@pytest.mark.parametrize("split", ["128m", "1000b", "150b"])
def test_round_trip(spark, pages, split):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = Counter(map(tuple, warc_pages(pages.coalesce(2)).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want(pages.collect())


def test_empty_table(spark, pages):
    assert warc_pages(pages.where("false")).count() == 0


def test_payloads_come_back(spark, pages, tmp_path):
    warc.write_warc(pages, f"{tmp_path}/w", "page_id", "url", "html")
    raw = [r.payload.decode() for r in warc.read_warc(spark, f"{tmp_path}/w").where("type = 'response'").collect()]
    assert set(raw) == {r.html or "" for r in pages.collect()}


def test_broken_chain_ends_there(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    broken = record.replace(b"Length: 3", b"Length: 4")
    (tmp_path / "a.warc").write_bytes(record * 3 + broken + record)
    (tmp_path / "b.warc").write_bytes(b"junk\r\n" + record)
    assert warc.read_warc(spark, str(tmp_path)).count() == 4
