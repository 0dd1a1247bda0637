"""WARC archives: written by Spark's text writer, read in splits by verified boundary chains."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linenet.llm.scratch import written

BREAK = "\r\n"
GAP = BREAK * 2
# Text between two of these is a segment: every record but a file's first begins after one.
MAGIC = BREAK + "WARC/1."
HEAD = re.compile(rb"(?:WARC/1\.)?[01]\r\n((?:[^\r\n]+\r\n)+)\r\n")
FIELD = re.compile(rb"^([A-Za-z0-9-]+):[ \t]*([^\r\n]*)\r\n", re.M)
DIGITS = "0123456789abcdefghijklmnopqrstuv"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a payload in upper-case base32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.lower(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32)), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def write_warc(records: DataFrame, path: str, id_col: str, uri_col: str, payload_col: str, least_bytes: int = 0) -> None:
    """Write one record for each row.

    Of payloads of at least ``least_bytes`` bytes that are equal, the one with the largest id becomes a
    response and the others revisits, which hold no payload and name the response and the payload's length and
    digest; smaller ones are responses. Rows that repeat the largest id are all responses. A null payload is
    an empty one, a null address an empty one; line breaks in an address become blanks. A null
    id comes before all others and is written empty. An empty table writes no record. Spark's text writer
    makes the files: a record ends in two line breaks, which is what the writer puts between rows.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    told = records.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload"))
    told = told.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload"))
    # Copies only: where all payloads differ the table is empty, and Spark joins it by its size.
    copies = told.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("kept"))
    copies = written(copies.where("n > 1").select("digest", "kept"), "payload-copies")
    told = told.join(copies, "digest", "left")
    revisit = (F.col("bytes") >= least_bytes) & F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.col("bytes").cast("string"), F.lit(GAP))
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit(f"WARC/1.0{BREAK}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{BREAK}WARC-Record-ID: "), name("id"),
        F.lit(f"{BREAK}WARC-Target-URI: "), F.regexp_replace(F.coalesce("uri", F.lit("")), "[\\r\\n]", " "),
        F.when(revisit, F.concat(F.lit(f"{BREAK}WARC-Refers-To: "), name("kept"), F.lit(f"{BREAK}WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))).otherwise(""),
        F.lit(f"{BREAK}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit(f"{BREAK}Content-Type: application/http; msgtype=response{BREAK}Content-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(GAP),
    )
    told.select(F.concat(head.cast("binary"), http.cast("binary"), body).cast("string").alias("value")).write.text(path, lineSep=GAP)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The stretches between magics, in order inside each split of each file."""
    text = spark.read.option("lineSep", MAGIC).option("recursiveFileLookup", "true").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("file_size"), F.col("value").cast("binary").alias("value")
    )


def _head(value: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """Length of a record's head, counted from its magic, and its fields; none if it isn't one."""
    found = HEAD.match(value)
    if not found:
        return None
    fields = {k.lower(): v for k, v in FIELD.findall(found[1] + b"\r\n")}
    if not fields.get(b"content-length", b"").isdigit() or b"warc-type" not in fields:
        return None
    return found.end() + (0 if value[:1] == b"W" else len(MAGIC) - 2), fields


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each candidate: its place in the split and where its successor would begin; and one for the split."""
    split, at = None, 0
    rows: list[tuple] = []

    def ended() -> None:
        if split is not None:
            rows.append((*split, None, None, at))

    def batch_of() -> pa.RecordBatch:
        names = ("file", "block", "file_size", "place", "next", "total")
        kinds = (pa.string(), *[pa.int64()] * 5)
        out = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)], names=names)
        rows.clear()
        return out

    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in ("file", "block", "file_size")])
        for key, value in zip(keys, batch.column("value")):
            if key != split:
                ended()
                split, at = key, 0
            value = value.as_py()
            if told := _head(value):
                # A segment that begins with the whole magic is the first of its file.
                begin = at - (0 if value[:1] == b"W" else len(MAGIC) - 2)
                rows.append((*split, begin, begin + told[0] + int(told[1][b"content-length"]) + len(GAP), None))
            at += len(value) + len(MAGIC)
        yield batch_of()
    ended()
    yield batch_of()


def boundary_chain(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The splits of all files, and the records reachable from the start of their file.

    Splits have ``file``, ``block``, ``base`` (where their first segment begins) and ``end``; records ``file``,
    ``block``, ``begin`` and ``next``. Tasks emit candidates, each with the place of its successor; places count
    from the split's first segment, whose own place is the sum of what earlier splits of the file hold.
    Successors are then doubled: a round joins the reached records with the map of 2^k steps and the map with
    itself, so rounds grow with the logarithm of the records of the longest file. A magic inside a payload
    is a candidate that nothing reaches.
    """
    found = _segments(spark, path).mapInArrow(_places, "file string, block long, file_size long, place long, next long, total long")
    found = written(found, "candidates")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = found.where("total is not null").groupBy("file", "block").agg(F.sum("total").alias("total"))
    bases = totals.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    bases = written(bases.select("file", "block", "base", (F.col("base") + F.col("total")).alias("end")), "splits")
    told = found.where("place is not null").join(bases, ["file", "block"])
    told = told.select("file", "block", (F.col("base") + F.col("place")).alias("begin"), (F.col("base") + F.col("next")).alias("next"))
    return bases, written(_reachable(written(told, "records")), "chain")


def _reachable(told: DataFrame) -> DataFrame:
    step = told.select("file", "begin", "next")
    reached = told.where("begin = 0").select("file", "begin")
    while not step.isEmpty():
        ahead = reached.join(step, ["file", "begin"]).select("file", F.col("next").alias("begin"))
        reached = written(reached.union(ahead).distinct(), "reached")
        onward = step.select("file", F.col("begin").alias("next"), F.col("next").alias("far"))
        step = written(step.join(onward, ["file", "next"]).select("file", "begin", F.col("far").alias("next")), "steps")
    return told.join(reached, ["file", "begin"], "left_semi")


RECORD = "file string, offset long, type string, record_id string, target_uri string, refers_to string, payload_digest string, http_length long, payload binary"
FIELDS = (b"warc-type", b"warc-record-id", b"warc-target-uri", b"warc-refers-to", b"warc-payload-digest")


def _record(file: str, offset: int, raw: bytes) -> tuple:
    told = _head(raw)
    lead = 0 if raw[:1] == b"W" else len(MAGIC) - 2
    head, fields = told
    block = raw[head - lead : head - lead + int(fields[b"content-length"])]
    length, payload = None, block
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        http, _, payload = block.partition(GAP.encode())
        found = dict((k.lower(), v) for k, v in FIELD.findall(http + b"\r\n")).get(b"content-length", b"")
        length = int(found) if found.isdigit() else None
    values = [fields[k].decode("utf-8", "replace") if k in fields else None for k in FIELDS]
    return (file, offset, *values, length, payload)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 9
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    names = [f.split()[0] for f in RECORD.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _walk(whole: bool):
    """Go along the chain inside each split and give its whole records, or else the pieces of those that go on."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at, upto, begin, parts, goes_on = None, 0, 0, None, [], False
        rows: list[tuple] = []

        def leave() -> None:
            nonlocal parts
            if not parts:
                return
            end = parts[-1][0] + len(parts[-1][1])
            if begin >= 0 and end >= upto - len(GAP):
                if whole:
                    rows.append(_record(key[0], begin, MAGIC.encode().join(v for _, v in parts)))
            elif not whole:
                rows.extend((key[0], begin if begin >= 0 else -1 - begin, place, value + MAGIC.encode()) for place, value in parts)
            parts = []

        def told() -> pa.RecordBatch:
            if whole:
                out = _batch(rows)
            else:
                columns = list(zip(*rows)) if rows else [()] * 4
                out = pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.binary()))], names=["file", "offset", "place", "piece"])
            rows.clear()
            return out

        for batch in batches:
            names = ("file", "block", "base", "entry", "before")
            for *now, value in zip(*[batch.column(c).to_pylist() for c in (*names, "value")]):
                if now[:2] != key:
                    leave()
                    # What comes before the split's first record belongs to the last record of an earlier one.
                    key, at, upto = now[:2], now[2], now[3] if now[3] is not None else 1 << 62
                    begin = -1 - now[4] if now[4] is not None else None
                here = at - (0 if value[:1] == b"W" and at == 0 else len(MAGIC) - 2)
                if here == upto:
                    leave()
                    head, fields = _head(value)
                    begin, upto = here, here + head + int(fields[b"content-length"]) + len(GAP)
                if begin is not None:
                    parts.append((at, value))
                at += len(value) + len(MAGIC)
            yield told()
        leave()
        yield told()

    return walk


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below a path, as ``file``, ``offset``, type and address fields, and the payload.

    Only records of a boundary chain that begins at the start of its file count; bytes after a broken
    link of it give no record, and a file that begins with anything else gives none. Files are read in
    splits. A record whose payload holds the magic is put together again, across splits only where the chain
    shows that such a record is there. Null payloads don't exist in an archive: an empty one is empty bytes. No
    file or an empty one gives no row.
    """
    splits, chain = boundary_chain(spark, path)
    first = chain.groupBy("file", "block").agg(F.min("begin").alias("entry"), F.max("begin").alias("last"), F.max("next").alias("upto"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    told = splits.join(first, ["file", "block"], "left").withColumn("before", F.last("last", ignorenulls=True).over(earlier))
    open_ = F.max("upto").over(earlier) - len(GAP) > F.col("base") - len(MAGIC)
    told = written(told.select("file", "block", "base", "entry", F.when(open_, F.col("before")).alias("before")), "entries")
    ordered = _segments(spark, path).drop("file_size").withColumn("seq", F.monotonically_increasing_id())
    ordered = ordered.join(told, ["file", "block"]).sortWithinPartitions("file", "block", "seq")
    records = ordered.mapInArrow(_walk(True), RECORD)
    if told.where("before is not null").isEmpty():
        return records
    pieces = ordered.mapInArrow(_walk(False), "file string, offset long, place long, piece binary")
    joined = pieces.groupBy("file", "offset").agg(F.sort_array(F.collect_list(F.struct("place", "piece"))).alias("pieces"))
    raw = joined.select("file", "offset", F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p.piece)).alias("raw"))
    return records.union(raw.mapInArrow(_parse, RECORD))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _batch([_record(*row) for row in zip(*[c.to_pylist() for c in batch.columns])])
