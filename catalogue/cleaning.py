"""Queries for schema, cleaning, lookup and value operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from linenet import fixtures as X
from linenet import presets as P
from linenet.functions import values as val
from linenet.operators import cleaning as cl
from linenet.operators import lookups as lk
from linenet.operators import rules as ru
from linenet.operators import schema as sc
from linenet.operators.ordering import dense_index

from .base import d6, query, r6

TOKENS = ", ".join(f"'{t}'" for t in P.NULL_TOKENS)
BLANK = r"' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def trimmed(c: str) -> str:
    return f"trim({c}, {BLANK})"


def number(c: str) -> str:
    """Number in a text, else null."""
    t = trimmed(c)
    return f"(CASE WHEN regexp_matches({t}, '{NUMBER}') THEN try_cast({t} AS DOUBLE) END)"


def number_text(c: str) -> str:
    t, n = trimmed(c), number(c)
    return (
        f"(CASE WHEN {t} IN ({TOKENS}) OR {n} IS NULL THEN {t} "
        f"WHEN {n} = floor({n}) THEN CAST(CAST({n} AS HUGEINT) AS VARCHAR) "
        f"ELSE rtrim(rtrim(CAST(CAST(round({n}, 6) AS DECIMAL(28,6)) AS VARCHAR), '0'), '.') END)"
    )


def year_of(c: str) -> str:
    """Year of a date text in the formats of the views, else a year inside the text."""
    t = f"(CASE WHEN {trimmed(c)} NOT IN ({TOKENS}) THEN {trimmed(c)} END)"
    shapes = [
        (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{2}:\d{2}$", "%Y-%m-%dT%H:%M:%S"),
        (r"^\d{4}-\d{1,2}-\d{1,2}$", "%Y-%m-%d"),
        (r"^\d{4}/\d{1,2}/\d{1,2}$", "%Y/%m/%d"),
        (r"^\d{1,2}/\d{1,2}/\d{4}$", "%d/%m/%Y"),
        (r"^\d{4}$", "%Y"),
    ]
    parsed = " ".join(
        f"WHEN regexp_matches({t}, '{s}') THEN CAST(year(try_strptime({t}, '{f}')) AS INT)" for s, f in shapes
    )
    found = f"CAST(nullif(regexp_extract({t}, '((?:18|19|20)\\d{{2}})', 1), '') AS INT)"
    return f"coalesce(CASE {parsed} END, {found})"


def cut_sql(c: str, edges, labels, right: bool) -> str:
    op = "<=" if right else "<"
    arms = " ".join(f"WHEN {c} {op} {e} THEN '{label}'" for e, label in zip(edges, labels))
    return f"(CASE WHEN {c} IS NULL THEN NULL {arms} ELSE '{labels[-1]}' END)"


# ---------------------------------------------------------------- schema

OWN_NAMES = {"Materiau": "material_raw", "Longueur": "length_raw", "Pente": "slope_raw", "Diametre": "diameter_raw",
             "nom_rue": "absent_name", "id_troncon": "seg_id", "X_amont": "x0", "X_aval": "x0"}
TYPES = {"id_troncon": "string", "Materiau": "string", "Longueur": "double", "Pente": "double", "Diametre": "string",
         "nom_rue": "string", "X_amont": "double", "X_aval": "double"}


@query("harmonize_schema", f"""SELECT seg_id AS id_troncon, material_raw AS Materiau, length_raw AS Longueur,
  {d6('slope_raw')} AS Pente, diameter_raw AS Diametre, CAST(NULL AS VARCHAR) AS nom_rue,
  CAST(NULL AS DOUBLE) AS X_amont, x0 AS X_aval FROM fx_segments""")
def _(d):
    return sc.harmonize(d.segments(), OWN_NAMES, TYPES).withColumn("Pente", r6("Pente"))


@query("dedupe_columns", "SELECT seg_id, level_up AS Cote_TN FROM fx_segments")
def _(d):
    doubled = d.segments().select("seg_id", "level_up", "level_down").toDF("seg_id", "Cote_TN", "COTE_TN")
    return sc.dedupe_columns(doubled)


@query("keep_columns", "SELECT seg_id, city, length_raw FROM fx_segments")
def _(d):
    return sc.keep_columns(d.segments(), ["seg_id", "city", "Traffic", "length_raw"])


@query("row_identity", """SELECT seg_id, md5(concat_ws('|', city, seg_id, coalesce(material_raw, chr(0)))) AS row_id
  FROM fx_segments""")
def _(d):
    return sc.with_row_id(d.segments(), ["city", "seg_id", "material_raw"]).select("seg_id", "row_id")


# ---------------------------------------------------------------- filters and values

@query("min_length", f"""SELECT seg_id, {d6('sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0))', 3)} AS length FROM fx_segments
  WHERE round(sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)), 3) >= 5.0""")
def _(d):
    from linenet.functions.geometry import line_length

    return d.lines().select("seg_id", F.round(line_length(F.col("geom")), 3).alias("length")).filter("length >= 5.0")


@query("train_rows", "SELECT vec_id, class, kind FROM fx_features WHERE kind IS NOT NULL")
def _(d):
    return d.view("fx_features").filter(F.col("kind").isNotNull()).select("vec_id", "class", "kind")


@query("class_membership", f"""SELECT seg_id, {number('diameter_raw')} AS diameter_raw FROM fx_segments
  WHERE {number('diameter_raw')} IN (200, 300, 1000)""")
def _(d):
    return cl.filter_in(d.segments().select("seg_id", "diameter_raw"), "diameter_raw", [200, 300, 1000])


@query("confidence_gate", "SELECT id, label, score FROM fx_predictions WHERE label IS NOT NULL AND score >= 0.7")
def _(d):
    return cl.gate(d.view("fx_predictions"), "label", "score", P.MIN_LABEL_CONFIDENCE).select("id", "label", "score")


SHARE = "((CASE WHEN {0} IS NULL THEN 0 ELSE 1 END)".format("level_up") + "".join(
    f" + (CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in ("level_down", "slope_raw", "ground", "depth_up")
) + ") / 5.0"
MEASURES = ["level_up", "level_down", "slope_raw", "ground", "depth_up"]


@query("row_completeness", f"""SELECT seg_id, {d6(SHARE)} AS completeness, {SHARE} >= 0.7 AS kept FROM fx_segments""")
def _(d):
    scored = cl.completeness(d.segments(), MEASURES)
    return scored.select("seg_id", r6("completeness").alias("completeness"), (F.col("completeness") >= 0.7).alias("kept"))


def _null_token(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ({TOKENS}) THEN {c} END AS {c}"


@query("nullify_tokens", f"""SELECT {', '.join(_null_token(c) for c in ('seg_id', 'material_raw', 'effluent_raw', 'diameter_raw', 'age_raw'))}
  FROM fx_segments""")
def _(d):
    cols = ["seg_id", "material_raw", "effluent_raw", "diameter_raw", "age_raw"]
    return cl.nullify_tokens(d.segments().select(cols), P.NULL_TOKENS)


@query("coerce_numeric", f"SELECT seg_id, {number('diameter_raw')} AS diameter_raw, length_raw FROM fx_segments")
def _(d):
    return cl.coerce_numeric(d.segments().select("seg_id", "diameter_raw", "length_raw"), ["diameter_raw", "length_raw"])


@query("zero_to_null", f"""SELECT seg_id, nullif(level_down, 0) AS level_down, nullif(length_raw, 0) AS length_raw,
  {d6('slope_raw')} AS slope_raw FROM fx_segments""")
def _(d):
    cols = ["level_down", "length_raw", "slope_raw"]
    out = cl.zero_to_null(d.segments().select("seg_id", *cols), cols, keep=["slope_raw"])
    return out.withColumn("slope_raw", r6("slope_raw"))


@query("range_to_null", f"""SELECT seg_id,
  CASE WHEN {number('diameter_raw')} BETWEEN 100 AND 1500 THEN {number('diameter_raw')} END AS diameter,
  CASE WHEN depth_up > 0 AND depth_up <= 4 THEN depth_up END AS depth,
  {d6('CASE WHEN abs(slope_raw) <= 5 THEN slope_raw END')} AS slope FROM fx_segments""")
def _(d):
    return d.segments().select(
        "seg_id",
        val.within(val.to_double(F.col("diameter_raw")), *P.DIAMETER_RANGE).alias("diameter"),
        val.within(F.col("depth_up"), 0.0, 4.0, low_open=True).alias("depth"),
        r6(val.within(F.col("slope_raw"), -5.0, 5.0)).alias("slope"),
    )


@query("extreme_labels", f"""WITH c AS (SELECT seg_id, {cut_sql('depth_up', X.DEPTH_EDGES, X.DEPTH_LABELS, True)} AS k FROM fx_segments)
  SELECT seg_id, CASE WHEN k NOT IN ('1','5') THEN k END AS depth_class FROM c""")
def _(d):
    classed = d.segments().select(
        "seg_id", val.cut(F.col("depth_up"), X.DEPTH_EDGES, X.DEPTH_LABELS, right=True).alias("depth_class")
    )
    return cl.labels_to_null(classed, "depth_class", P.EXTREME_DEPTH_CLASSES)


@query("log_features", f"""SELECT seg_id,
  {d6('CASE WHEN slope_raw IS NOT NULL THEN ln(1 + greatest(slope_raw, 0.0)) END')} AS slope_log,
  {d6('ln(1 + greatest(length_raw, 0.0))')} AS length_log, {d6('length_raw')} AS length_back FROM fx_segments""")
def _(d):
    logs = d.segments().select(
        "seg_id", val.log_length(F.col("slope_raw")).alias("slope_log"), val.log_length(F.col("length_raw")).alias("length_log")
    )
    return logs.select("seg_id", r6("slope_log").alias("slope_log"), r6("length_log").alias("length_log"),
                       r6(F.expm1("length_log")).alias("length_back"))


@query("skip_if_filled", """SELECT count(level_up) > 0 AS level_up, count(material_raw) > 0 AS material_raw,
  count(CASE WHEN material_raw = 'FONTE' THEN 1 END) > 0 AS never, false AS all_filled FROM fx_segments""")
def _(d):
    seg = d.segments().withColumn("never", F.when(F.col("material_raw") == "FONTE", F.lit(1)))
    return cl.filled(seg, ["level_up", "material_raw", "never"])


@query("label_codes", """SELECT seg_id, CASE length_raw % 7 WHEN 2 THEN '1950-1970' WHEN 3 THEN '1970-1990'
  WHEN 4 THEN '1990-2010' WHEN 5 THEN '2010-2025' END AS label FROM fx_segments""")
def _(d):
    return d.segments().select("seg_id", val.label_of((F.col("length_raw") % 7).cast("int"), P.AGE_RANGES).alias("label"))


@query("normalize_number_text", f"SELECT seg_id, {number_text('diameter_raw')} AS diameter FROM fx_segments")
def _(d):
    return d.segments().select("seg_id", val.normalize_number_text(F.col("diameter_raw"), P.NULL_TOKENS).alias("diameter"))


@query("install_year", f"SELECT seg_id, {year_of('age_raw')} AS year FROM fx_segments")
def _(d):
    return d.segments(spread=True).select("seg_id", val.install_year(F.col("age_raw"), P.NULL_TOKENS).alias("year"))


@query("mean_pair", f"""SELECT seg_id, {d6('(depth_up + depth_down) / 2')} AS strict,
  {d6('coalesce((depth_up + depth_down) / 2, depth_up, depth_down)')} AS skipping,
  {d6('(x0 + x1) / 2')} AS x_mid FROM fx_segments""")
def _(d):
    up, down = F.col("depth_up"), F.col("depth_down")
    return d.segments().select(
        "seg_id", r6(val.mean_strict(up, down)).alias("strict"), r6(val.mean_skip_null(up, down)).alias("skipping"),
        r6(val.mean_strict(F.col("x0"), F.col("x1"))).alias("x_mid"),
    )


@query("cut_left", f"""SELECT seg_id, {cut_sql('length_raw', [10.0, 20.0, 30.0], ['a', 'b', 'c', 'd'], False)} AS k FROM fx_segments""")
def _(d):
    return d.segments().select("seg_id", val.cut(F.col("length_raw"), [10.0, 20.0, 30.0], list("abcd"), right=False).alias("k"))


@query("cut_right", f"""SELECT seg_id, {cut_sql('length_raw', [10.0, 20.0, 30.0], ['a', 'b', 'c', 'd'], True)} AS k FROM fx_segments""")
def _(d):
    return d.segments().select("seg_id", val.cut(F.col("length_raw"), [10.0, 20.0, 30.0], list("abcd"), right=True).alias("k"))


@query("recode_target", """SELECT seg_id, CAST(CASE WHEN s <> 0 THEN s - 1 END AS INT) AS n1,
  CAST(CASE WHEN s <> 0 THEN s = 4 END AS INT) AS n2, CAST(CASE WHEN s <> 0 THEN s >= 3 END AS INT) AS n3
  FROM (SELECT seg_id, CAST(length_raw AS INT) % 5 AS s FROM fx_segments) t""")
def _(d):
    state = F.col("length_raw").cast("int") % 5
    return d.segments().select(
        "seg_id", *[val.recode_state(state, lv.name).alias(f"n{i}") for i, lv in enumerate(P.STATE_LEVELS, 1)]
    )


# ---------------------------------------------------------------- lookups

@query("recode_lookup", f"""SELECT s.seg_id, m.value AS material, e.value AS effluent FROM fx_segments s
  LEFT JOIN {X.values_sql(X.MATERIALS)} m ON {trimmed('s.material_raw')} = m.key
  LEFT JOIN {X.values_sql(X.EFFLUENTS)} e ON {trimmed('s.effluent_raw')} = e.key""")
def _(d):
    seg = d.segments().select("seg_id", "material_raw", "effluent_raw")
    out = lk.recode(lk.recode(seg, "material_raw", d.lookup(X.MATERIALS), "material"), "effluent_raw", d.lookup(X.EFFLUENTS), "effluent")
    return out.select("seg_id", "material", "effluent")


@query("unmapped_values", f"""SELECT DISTINCT {trimmed('material_raw')} AS value FROM fx_segments
  WHERE {trimmed('material_raw')} NOT IN ({TOKENS}) AND {trimmed('material_raw')} NOT IN ('PVC','BETON','GRES')""")
def _(d):
    return lk.unmapped(d.segments(), "material_raw", d.lookup(X.MATERIALS), P.NULL_TOKENS)


@query("preflight_report", f"""SELECT DISTINCT 'Materiau' AS attribute, {trimmed('material_raw')} AS value FROM fx_segments
  WHERE {trimmed('material_raw')} NOT IN ({TOKENS}) AND {trimmed('material_raw')} NOT IN ('PVC','BETON','GRES')
  UNION ALL SELECT DISTINCT 'Nature_effluent', {trimmed('effluent_raw')} FROM fx_segments
  WHERE {trimmed('effluent_raw')} NOT IN ({TOKENS}) AND {trimmed('effluent_raw')} NOT IN ('EU','EP','UN')
  UNION ALL SELECT DISTINCT 'Diametre', {number_text('diameter_raw')} FROM fx_segments
  WHERE {number_text('diameter_raw')} NOT IN ({TOKENS}) AND {number_text('diameter_raw')} NOT IN ('200','300','150','1000','9.56')""")
def _(d):
    seg = d.segments()
    odd = F.substring("city", 2, 9).cast("int") % 2 == 1
    renamed = seg.filter(odd).select(F.col("material_raw").alias("MAT"), F.col("diameter_raw").alias("DIAM"), "effluent_raw")
    sources = [
        (seg.filter(~odd), {"Materiau": "material_raw", "Nature_effluent": "effluent_raw", "Diametre": "diameter_raw"}),
        (renamed, {"Materiau": "MAT", "Nature_effluent": "effluent_raw", "Diametre": "DIAM"}),
    ]
    lookups = {"Materiau": d.lookup(X.MATERIALS), "Nature_effluent": d.lookup(X.EFFLUENTS), "Diametre": d.lookup(X.DIAMETERS)}
    return lk.preflight(sources, lookups, P.NULL_TOKENS, number_text=["Diametre"])


@query("lookup_load", f"""WITH named AS (
    SELECT DISTINCT {trimmed('material_raw')} AS key FROM fx_segments WHERE {trimmed('material_raw')} <> '')
  SELECT key, key || '-b' AS value FROM named""")
def _(d):
    """The sheet lists every value twice, the second time with the label that must win."""
    from linenet.session import scratch_path
    from linenet.sources.tables import read_lookup

    text = val.trim_text(F.col("material_raw"))
    names = d.segments().select(text.alias("k")).filter(F.col("k") != "").distinct()
    lines = names.select(
        F.explode(F.array(*[F.concat(F.lit(pad), F.col("k"), F.lit(f" ;{i};"), F.col("k"), F.lit(tail))
                            for i, (pad, tail) in enumerate([(" ", "-a"), ("", "-b")])])).alias("value"),
    )
    path = scratch_path(d.spark, "lookup")
    lines.write.text(path)
    return read_lookup(d.spark, path, "k", "v", columns=["k", "pos", "v"], position="pos")


@query("class_edges", f"""WITH e AS (SELECT DISTINCT (p_size // 10) * 10.0 AS edge FROM part)
  SELECT p_partkey, (SELECT count(*) FROM e WHERE edge <= p_size) AS class FROM part""")
def _(d):
    """Edges come from a class table that itself comes from the data."""
    from linenet.sources.tables import class_edges

    part = d.table("part")
    edges = part.select((F.floor(F.col("p_size") / 10) * 10.0).alias("max")).distinct()
    # One label more than there are edges, numbered from the bottom.
    last = edges.agg(F.max("max").alias("max")).withColumn("max", F.lit(None).cast("double"))
    table = edges.union(last)
    ordered = dense_index(table.withColumn("_k", F.coalesce("max", F.lit(1e300))), "_k", "label").select(
        "max", F.col("label").cast("string").alias("label")
    )
    cuts, labels = class_edges(ordered, "max", "label")
    return part.select("p_partkey", val.cut(F.col("p_size"), cuts, labels, right=False).cast("bigint").alias("class"))


@query("merge_back", """SELECT s.seg_id, coalesce(m.ground, s.ground) AS ground FROM fx_segments s
  LEFT JOIN fx_manholes m ON m.mh_id = s.node_up""")
def _(d):
    seg = d.segments().select("seg_id", "node_up", "ground")
    fresh = d.view("fx_manholes").select(F.col("mh_id").alias("node_up"), "ground")
    return lk.merge_back(seg, fresh, "node_up", ["ground"]).select("seg_id", "ground")


@query("semi_member", """SELECT seg_id, coalesce(node_down IN (SELECT mh_id FROM fx_manholes WHERE depth IS NOT NULL), false) AS known
  FROM fx_segments""")
def _(d):
    members = d.view("fx_manholes").filter("depth IS NOT NULL").select(F.col("mh_id").alias("node_down"))
    return lk.flag_members(d.segments(), "node_down", members, "known").select("seg_id", "known")


@query("fill_mode", """WITH m AS (SELECT effluent_raw AS v, count(*) AS n FROM fx_segments
    WHERE effluent_raw <> 'NC' GROUP BY 1 ORDER BY n DESC, v LIMIT 1)
  SELECT seg_id, CASE WHEN effluent_raw = 'NC' THEN (SELECT v FROM m) ELSE effluent_raw END AS effluent_raw FROM fx_segments""")
def _(d):
    return lk.fill_token_with_mode(d.segments().select("seg_id", "effluent_raw"), "effluent_raw", "NC")


# ---------------------------------------------------------------- rules on attributes

FILE_UP, FILE_DOWN, LEN = "level_up", "nullif(level_down, 0)", "nullif(length_raw, 0)"
SLOPE_SQL = f"""WITH s0 AS (SELECT seg_id, {FILE_UP} AS a, CASE WHEN level_down IS NULL THEN ground ELSE level_down END AS b,
    {LEN} AS n, slope_raw AS s FROM fx_segments),
  s1 AS (SELECT seg_id, a, b, n, CASE WHEN s IS NOT NULL AND a IS NOT NULL AND (b IS NULL OR b = 0) AND n > 0
      AND abs(abs(s) - abs(a / n * 100)) < 0.01 THEN NULL ELSE s END AS s FROM s0),
  s2 AS (SELECT seg_id, a, b, n, CASE WHEN s IS NOT NULL AND b IS NOT NULL AND (a IS NULL OR a = 0) AND n > 0
      AND abs(abs(s) - abs(b / n * 100)) < 0.01 THEN NULL ELSE s END AS s FROM s1),
  s3 AS (SELECT seg_id, a, b, n, CASE WHEN s IS NULL AND a IS NOT NULL AND b IS NOT NULL AND b <> 0 AND n > 0
      THEN (a - b) / n * 100 ELSE s END AS s FROM s2),
  s4 AS (SELECT seg_id, a, b, CASE WHEN a > b AND s < 0 THEN abs(s) ELSE s END AS s FROM s3),
  s5 AS (SELECT seg_id, a, b, CASE WHEN a < b AND s > 0 THEN -abs(s) ELSE s END AS s FROM s4)
  SELECT seg_id, {d6('CASE WHEN abs(s) > 10 THEN NULL ELSE s END')} AS slope FROM s5"""


@query("slope_rules", SLOPE_SQL)
def _(d):
    seg = cl.zero_to_null(d.segments(spread=True), ["length_raw"])
    out = ru.slope_rules(seg, "level_up", "level_down", "slope_raw", "length_raw", fill=("level_up", "ground"))
    return out.select("seg_id", r6("slope_raw").alias("slope"))


DEPTH_SQL = f"""WITH f AS (SELECT seg_id, coalesce(
    CASE WHEN depth_up > 2 THEN depth_up + 3 END, (depth_up + depth_down) / 2, depth_up, depth_down,
    ground - (level_up + nullif(level_down, 0)) / 2, (ground + level_up) / 2 - (level_up + nullif(level_down, 0)) / 2) AS z FROM fx_segments)
  SELECT seg_id, {cut_sql('z', X.DEPTH_EDGES, X.DEPTH_LABELS, True)} AS depth_class,
  {d6('CASE WHEN z > 0 AND z <= 10 THEN z END')} AS depth_final FROM f"""


@query("depth_fallback", DEPTH_SQL)
def _(d):
    seg = cl.zero_to_null(d.segments(), ["level_down"]).withColumn(
        "measured", F.when(F.col("depth_up") > 2, F.col("depth_up") + 3)
    )
    out = ru.depth_fallback(
        seg, X.DEPTH_EDGES, X.DEPTH_LABELS, "measured", ("depth_up", "depth_down"), ("level_up", "level_down"),
        "ground", ("ground", "level_up"),
    )
    return out.select("seg_id", "depth_class", r6("depth_final").alias("depth_final"))


@query("age_class", f"""WITH y AS (SELECT seg_id, {year_of('age_raw')} AS install_year FROM fx_segments),
  k AS (SELECT seg_id, install_year, {cut_sql('install_year', X.AGE_EDGES, X.AGE_LABELS, False)} AS c FROM y)
  SELECT seg_id, install_year, CASE WHEN c NOT IN ('1','6') THEN c END AS age_class FROM k""")
def _(d):
    dated = ru.age_class(d.segments(), "age_raw", X.AGE_EDGES, X.AGE_LABELS)
    return cl.labels_to_null(dated, "age_class", P.EXTREME_AGE_CLASSES).select("seg_id", "install_year", "age_class")
