"""Queries for profiles, ranks and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from linenet import presets as P
from linenet.functions import values as val
from linenet.operators import ordering as od
from linenet.operators import profiles as pr

from .base import d6, query, r6
from .cleaning import year_of

NUM = ["level_up", "level_down", "slope_raw", "length_raw", "depth_up"]


@query("completeness_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {d6(f'count({c}) * 100.0 / count(*)')} AS pct FROM fx_segments" for c in [*NUM, "material_raw"]))
def _(d):
    return pr.completeness_profile(d.segments(), [*NUM, "material_raw"]).withColumn("pct", r6("pct"))


@query("value_counts", f"""WITH c AS (SELECT material_raw AS value, count(*) AS n FROM fx_segments WHERE material_raw IS NOT NULL GROUP BY 1)
  SELECT value, n, {d6('n * 100.0 / (SELECT sum(n) FROM c)')} AS pct FROM c""")
def _(d):
    return pr.value_counts(d.segments(), "material_raw").withColumn("pct", r6("pct"))


@query("describe_numeric", f"""SELECT count(slope_raw) AS n, {d6('avg(slope_raw)')} AS mean, {d6('min(slope_raw)')} AS min,
  {d6('max(slope_raw)')} AS max, {d6('median(slope_raw)')} AS median,
  {d6('avg(CASE WHEN slope_raw < 0 THEN 1.0 WHEN slope_raw >= 0 THEN 0.0 END)')} AS negative_share FROM fx_segments""")
def _(d):
    out = pr.describe_numeric(d.segments(), "slope_raw")
    return out.select("n", *[r6(c).alias(c) for c in ("mean", "min", "max", "median", "negative_share")])


@query("winsorize", f"""WITH q AS (SELECT quantile_cont(slope_raw, 0.01) AS lo, quantile_cont(slope_raw, 0.99) AS hi FROM fx_segments)
  SELECT seg_id, {d6('CASE WHEN slope_raw IS NOT NULL THEN least(greatest(slope_raw, lo), hi) END')} AS slope FROM fx_segments, q""")
def _(d):
    return pr.winsorize(d.segments(), "slope_raw", 0.01, 0.99, "slope").select("seg_id", r6("slope").alias("slope"))


@query("histogram", f"""WITH s AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 60 AS w FROM orders)
  SELECT CAST(least(floor((o_totalprice - lo) / w), 59) AS INT) AS bin, count(*) AS n,
  {d6('min(lo + w * least(floor((o_totalprice - lo) / w), 59))', 4)} AS "from",
  {d6('min(lo + w * (least(floor((o_totalprice - lo) / w), 59) + 1))', 4)} AS "to" FROM orders, s GROUP BY 1""")
def _(d):
    out = pr.histogram(d.table("orders"), "o_totalprice", 60)
    return out.withColumns({"from": r6("from", 4), "to": r6("to", 4)})


@query("box_stats", f"""WITH q AS (SELECT quantile_cont(slope_raw, 0.25) AS q1, quantile_cont(slope_raw, 0.5) AS m,
    quantile_cont(slope_raw, 0.75) AS q3 FROM fx_segments),
  r AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
  SELECT {d6('max(q1)')} AS q1, {d6('max(m)')} AS median, {d6('max(q3)')} AS q3,
  {d6('min(CASE WHEN slope_raw BETWEEN lo AND hi THEN slope_raw END)')} AS whisker_low,
  {d6('max(CASE WHEN slope_raw BETWEEN lo AND hi THEN slope_raw END)')} AS whisker_high,
  count(CASE WHEN slope_raw NOT BETWEEN lo AND hi THEN 1 END) AS outliers FROM fx_segments, r""")
def _(d):
    out = pr.box_stats(d.segments(), "slope_raw")
    return out.select("outliers", *[r6(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")])


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {d6(f'corr({a}, {b})')} AS r FROM fx_segments"
    for a in NUM for b in NUM if a != b) + "".join(f" UNION ALL SELECT '{a}', '{a}', 1.0::DOUBLE" for a in NUM))
def _(d):
    return pr.corr_matrix(d.segments(), NUM).withColumn("r", r6("r"))


@query("distinct_values", "SELECT DISTINCT diameter_raw AS value FROM fx_segments WHERE diameter_raw IS NOT NULL")
def _(d):
    return pr.distinct_values(d.segments(), "diameter_raw")


@query("distinct_counts", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n FROM fx_segments" for c in ("city", "node_up", "material_raw")))
def _(d):
    return pr.distinct_counts(d.segments(), ["city", "node_up", "material_raw"])


THRESHOLDS = [0.5, 0.7, 0.8]


@query("threshold_counts", " UNION ALL ".join(
    f"""SELECT {t}::DOUBLE AS threshold, count(CASE WHEN score >= {t} THEN 1 END) AS above, count(CASE WHEN score < {t} THEN 1 END) AS below,
    {d6(f'count(CASE WHEN score >= {t} THEN 1 END) * 1.0 / count(score)')} AS share_above FROM fx_predictions""" for t in THRESHOLDS))
def _(d):
    return pr.threshold_counts(d.view("fx_predictions"), "score", THRESHOLDS).withColumn("share_above", r6("share_above"))


@query("confidence_by_class", f"""SELECT pred AS class, {d6('avg(score)')} AS mean, {d6('min(score)')} AS min, count(*) AS n
  FROM fx_predictions GROUP BY 1""")
def _(d):
    out = pr.confidence_by_class(d.view("fx_predictions"), "pred", "score")
    return out.withColumns({"mean": r6("mean"), "min": r6("min")})


@query("completion_report", f"""SELECT CASE WHEN label_bin = 1 THEN 'original' ELSE 'predit_m' END AS source, label AS level,
  count(*) AS n, {d6('avg(score)')} AS mean, {d6('median(score)')} AS median FROM fx_predictions GROUP BY 1, 2""")
def _(d):
    tagged = d.view("fx_predictions").select(
        F.when(F.col("label_bin") == 1, F.lit("original")).otherwise(F.lit("predit_m")).alias("source"),
        F.col("label").alias("level"), "score",
    )
    out = pr.completion_report(tagged, "source", "score", "level")
    return out.withColumns({"mean": r6("mean"), "median": r6("median")})


@query("year_profile", f"""WITH y AS (SELECT {year_of('age_raw')} AS year FROM fx_segments)
  SELECT year, count(*) AS n, 2025 - year AS age FROM y WHERE year BETWEEN 1880 AND 2025 GROUP BY year""")
def _(d):
    dated = d.segments().select(val.install_year(F.col("age_raw"), P.NULL_TOKENS).alias("y"))
    return pr.year_profile(dated, "y", P.YEAR_FLOOR, 2025)


@query("year_summary", f"""WITH y AS (SELECT {year_of('age_raw')} AS year FROM fx_segments)
  SELECT count(*) AS n, {d6('avg(year)')} AS mean_year, {d6('2025 - avg(year)')} AS mean_age, {d6('median(year)')} AS median_year
  FROM y WHERE year BETWEEN 1880 AND 2025""")
def _(d):
    dated = d.segments().select(val.install_year(F.col("age_raw"), P.NULL_TOKENS).alias("y"))
    out = pr.year_summary(dated, "y", P.YEAR_FLOOR, 2025)
    return out.select("n", *[r6(c).alias(c) for c in ("mean_year", "mean_age", "median_year")])


@query("best_per_group", """SELECT target, level, model, run_id, f1 FROM (SELECT *, row_number() OVER
    (PARTITION BY target, level ORDER BY f1 DESC NULLS LAST, model, run_id) AS rn FROM fx_results) t WHERE rn = 1""")
def _(d):
    return od.best_per_group(d.view("fx_results"), ["target", "level"], "f1", ["model", "run_id"])


@query("dedupe_first", """SELECT node_up, seg_id FROM (SELECT node_up, seg_id, row_number() OVER
    (PARTITION BY node_up ORDER BY seg_id) AS rn FROM fx_segments) t WHERE rn = 1""")
def _(d):
    return od.first_by(d.segments().select("node_up", "seg_id"), ["node_up"], [F.asc("seg_id")])


@query("node_index", """SELECT node, row_number() OVER (ORDER BY node) - 1 AS node_index
  FROM (SELECT DISTINCT node_down AS node FROM fx_segments WHERE node_down IS NOT NULL) t""")
def _(d):
    nodes = d.segments().select(F.col("node_down").alias("node")).filter("node IS NOT NULL").distinct()
    return od.dense_index(nodes, "node", "node_index")


ROC_SQL = """WITH s AS (SELECT score, sum(label_bin) AS pos, sum(1 - label_bin) AS neg FROM fx_predictions GROUP BY 1),
  c AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, neg FROM s WINDOW w AS (ORDER BY score DESC)),
  t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM s),
  r AS (SELECT score AS threshold, tp / p AS tpr, fp / n AS fpr, (tp - pos) / p AS tpr_before, (fp - neg) / n AS fpr_before FROM c, t)"""


@query("roc_curve", f"""{ROC_SQL} SELECT threshold, {d6('tpr')} AS tpr, {d6('fpr')} AS fpr, {d6('tpr_before')} AS tpr_before,
  {d6('fpr_before')} AS fpr_before FROM r""")
def _(d):
    out = od.roc_points(d.view("fx_predictions"), "label_bin", "score")
    return out.select("threshold", *[r6(c).alias(c) for c in ("tpr", "fpr", "tpr_before", "fpr_before")])


@query("roc_auc", f"{ROC_SQL} SELECT {d6('sum((fpr - fpr_before) * (tpr + tpr_before) / 2)')} AS auc FROM r")
def _(d):
    return od.auc(d.view("fx_predictions"), "label_bin", "score").select(r6("auc").alias("auc"))
