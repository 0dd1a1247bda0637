"""The named queries of this folder and the SQL that checks them, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linenet.llm import ann, decontaminate, langid, linededup, mixing, negatives, packing, pii, quality, resample, simhash, urlfilter, warc
from linenet.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the vocabulary lies; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def warc_pages(pages: DataFrame) -> DataFrame:
    """Write every page to archives, read these back and tell what the records say."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    warc.write_warc(pages, path, "page_id", "url", "html")
    read = warc.read_warc(spark, path)
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    page = lambda c: F.when(number(c) != "", number(c)).cast("long")
    revisit = F.col("type") == "revisit"
    return read.select(
        page("record_id").alias("page_id"),
        F.when(revisit, F.col("http_length")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.substring("payload_digest", 6, 32)).otherwise(warc.base32_sha1(F.col("payload"))).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, page("refers_to")).alias("refers_to"),
    )


_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + (((('0x' || substr(hex || '00', 1 + (5 * i) // 4, 3))::INTEGER) >> (7 - (5 * i) % 4)) & 31)::INTEGER, 1)), '')"""


@query(
    "op1_warc",
    f"""WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS kept FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> kept THEN kept END AS refers_to FROM d""",
)
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc_pages(table(spark, folder, "pages"))


_LINES = r"""
l AS (SELECT doc_id, i - 1 AS pos, list_filter(regexp_split_to_array(parts[i], '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
d AS (SELECT w, min((doc_id, pos)) AS first FROM l WHERE len(w) > 0 GROUP BY w),
v AS (SELECT w, first, list_concat(w[:i - 1], w[i + 1:]) AS rest, i FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) >= 5)),
changed AS (SELECT w, first > min(first) OVER (PARTITION BY rest, i) AS late FROM v),
longer AS (SELECT v.w AS long, d.w AS short, v.first > d.first AS late FROM v JOIN d ON v.rest = d.w WHERE len(d.w) >= 5),
near AS (SELECT w FROM changed WHERE late UNION SELECT CASE WHEN late THEN long ELSE short END FROM longer)
"""


@query(
    "op2_line_dedup",
    f"""WITH {_LINES}
SELECT t.doc_id, coalesce(k.n, 0) AS n_removed, CASE WHEN k.n IS NULL THEN t.text ELSE coalesce(k.text, '') END AS text FROM documents t LEFT JOIN (
  SELECT l.doc_id, (count(*) FILTER (gone))::INTEGER AS n, string_agg(string_split(o.text, chr(10))[l.pos + 1], chr(10) ORDER BY l.pos) FILTER (NOT gone) AS text FROM (
    SELECT l.doc_id, l.pos, len(l.w) > 0 AND ((l.doc_id, l.pos) <> d.first OR l.w IN (FROM near)) AS gone FROM l LEFT JOIN d ON l.w = d.w) l
  JOIN documents o ON o.doc_id = l.doc_id GROUP BY l.doc_id HAVING bool_or(gone)) k ON k.doc_id = t.doc_id""",
)
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", F.col("_removed").alias("n_removed"), "text")


def _is(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


@query("op3_pii")
def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(table(spark, folder, "documents"))
    told = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(F.transform(kinds, _is(k)), False)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(told(F.col("base")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_packing")
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


@query("op6_language_id")
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = langid.identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query("op7_nearest")
def op7_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), "vec_id", "embedding")


# The rules the query applies: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query(
    "op8_url_filters",
    """WITH RECURSIVE p AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '^[\\s\\S]*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
b AS (SELECT p.*, (SELECT max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, verdict := verdict))
  FROM rules WHERE (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)) AS r FROM p)
SELECT page_id, host, path, r.rule AS rule, coalesce(r.verdict, 'allow') AS verdict FROM b""",
)
def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string")
    return urlfilter.filter_urls(table(spark, folder, "pages"), rules)


@query("op9_simhash")
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_groups(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_mixing")
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    told = mixing.mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return told.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken")
    )


_MINED = """WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10"""


@query("op11_hard_negatives", _MINED)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), "vec_id", "embedding", "label", F.col("id") % 100 == 0)


_ALNUM = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_FEATURES = "unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature"


@query(
    "op12_importance_resampling",
    f"""WITH RECURSIVE tab(i, v, k) AS (SELECT i, i, 0 FROM range(256) t(i) UNION ALL SELECT i, xor(v >> 1, 3988292384 * (v & 1)), k + 1 FROM tab WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM tab WHERE k = 8),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_ALNUM}, []) AS w FROM documents),
items AS (SELECT {_ALNUM} AS w FROM benchmark),
f AS (SELECT r, {_FEATURES} FROM docs), g AS (SELECT {_FEATURES} FROM items),
names AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT feature FROM f UNION SELECT feature FROM g)),
told AS (SELECT feature, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INTEGER, 2))::BIGINT),
  lambda c, b: xor(c >> 8, t[1 + xor(c & 255, b)]), 4294967295), 4294967295) % 10000 AS bucket FROM names, crc),
s AS (SELECT bucket, count(*) AS s FROM f JOIN told USING (feature) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM g JOIN told USING (feature) GROUP BY bucket),
gains AS (SELECT s.bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000)::DOUBLE) / ((s + 1)::DOUBLE * ((SELECT count(*) FROM g) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t ON t.bucket = s.bucket),
n AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS total FROM f JOIN told USING (feature) JOIN gains USING (bucket) GROUP BY r),
w AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END AS weight FROM docs LEFT JOIN n USING (r)),
v AS (SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM w),
d AS (SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_words, n_features) END AS place FROM v)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
  CASE WHEN place <= (SELECT count(*) FROM v WHERE n_words >= 20) * 25 // 100 THEN place END::BIGINT AS rank FROM d""",
)
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    told = resample.resample(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark").select("text"))
    return told.select("doc_id", "n_features", "weight", "score", "rank")


@query(
    "op13_decontamination",
    f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_ALNUM}, []) AS w FROM documents), items AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
hits AS (SELECT r, i, d.n, item_id FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM p))) d JOIN p USING (gram)),
words AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS at FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)""",
)
def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark").select("item_id", "text"))
    items = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
