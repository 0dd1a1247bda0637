"""Queries for encoding, splitting, imputation, balancing and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from linenet import presets as P
from linenet.fixtures import FEATURES
from linenet.operators import encoding as en
from linenet.operators import evaluate as evl
from linenet.operators import neighbours as nb
from linenet.operators import sampling as sp
from linenet.session import scratch_path
from linenet.sources.tables import checkpoint_table

from .base import QUERIES, d6, query, r6



def rounded(cols):
    return [r6(c).alias(c) for c in cols]


# ---------------------------------------------------------------- encoding and scaling

CODES = "codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code FROM (SELECT DISTINCT coalesce({c}, 'INCONNU') AS v FROM {t}) q)"


@query("label_encode", f"""WITH {CODES.format(c='material_raw', t='fx_segments')}
  SELECT seg_id, code, v AS back FROM fx_segments JOIN codes ON v = coalesce(material_raw, 'INCONNU')""")
def _(d):
    seg = d.segments().select("seg_id", "material_raw")
    codes = en.fit_codes(seg, "material_raw")
    coded = en.apply_codes(seg, "material_raw", codes, "code")
    return en.decode(coded, "code", codes, "back").select("seg_id", "code", "back")


@query("encode_fallback", """WITH codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code FROM
    (SELECT DISTINCT coalesce(material_raw, 'INCONNU') AS v FROM fx_segments WHERE effluent_raw = 'EU') q)
  SELECT s.seg_id, coalesce(c.code, 0) AS code, c.code IS NOT NULL AS known FROM fx_segments s
  LEFT JOIN codes c ON c.v = coalesce(s.material_raw, 'INCONNU') || CASE WHEN s.effluent_raw = 'EP' THEN '?' ELSE '' END""")
def _(d):
    seg = d.segments().select("seg_id", "material_raw", "effluent_raw")
    codes = en.fit_codes(seg.filter("effluent_raw = 'EU'"), "material_raw")
    mark = F.when(F.col("effluent_raw") == "EP", F.lit("?")).otherwise(F.lit(""))
    text = F.concat(F.coalesce("material_raw", F.lit(P.FILLED_CATEGORY)), mark)
    out = en.apply_codes(seg.withColumn("material_raw", text), "material_raw", codes, "code", known="known")
    return out.select("seg_id", "code", "known")


@query("standard_scale", "SELECT vec_id, " + ", ".join(
    d6(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()") + f" AS {c}" for c in FEATURES) + " FROM fx_features")
def _(d):
    x = d.view("fx_features")
    return en.apply_scale(x, FEATURES, en.fit_scale(x, FEATURES)).select("vec_id", *rounded(FEATURES))


@query("class_weights", f"""WITH c AS (SELECT label, count(*) AS n FROM fx_predictions GROUP BY 1)
  SELECT label, n, {d6('(SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n)')} AS weight FROM c""")
def _(d):
    return en.balanced_weights(d.view("fx_predictions"), "label").withColumn("weight", r6("weight"))


# ---------------------------------------------------------------- splits

RANKED = """r AS (SELECT {id} AS id, {label} AS label, row_number() OVER (PARTITION BY {label} ORDER BY md5('42|' || {id}), CAST({id} AS VARCHAR)) AS rn,
  count(*) OVER (PARTITION BY {label}) AS n FROM {t})"""


@query("stratified_split", f"WITH {RANKED.format(id='id', label='label', t='fx_predictions')} SELECT id, label, rn <= round(n * 0.2) AS is_test FROM r")
def _(d):
    rows = d.view("fx_predictions").select("id", "label")
    return sp.stratified_split(rows, "label", P.TEST_SHARE, "id", P.SEED)


@query("stratified_folds", f"""WITH {RANKED.format(id='id', label='label', t='fx_predictions')}
  SELECT id, label, CAST(CASE WHEN rn > floor(n * 1 / 3.0) THEN 1 ELSE 0 END + CASE WHEN rn > floor(n * 2 / 3.0) THEN 1 ELSE 0 END AS INT) AS fold FROM r""")
def _(d):
    rows = d.view("fx_predictions").select("id", "label")
    return sp.stratified_folds(rows, "label", P.FOLDS, "id", P.SEED)


# ---------------------------------------------------------------- neighbours

def _impute_sql(k: int) -> str:
    shared = " + ".join(f"(CASE WHEN q.{c} IS NOT NULL AND d.{c} IS NOT NULL THEN 1 ELSE 0 END)" for c in FEATURES)
    total = " + ".join(f"coalesce(pow(q.{c} - d.{c}, 2), 0)" for c in FEATURES)
    parts = []
    for c in FEATURES:
        parts.append(
            f"{c}_v AS (SELECT vec_id, avg({c}) AS v FROM (SELECT p.vec_id, d.{c}, row_number() OVER (PARTITION BY p.vec_id ORDER BY p.dist, p.did) AS rn "
            f"FROM pairs p JOIN fx_features d ON d.vec_id = p.did JOIN fx_features q ON q.vec_id = p.vec_id "
            f"WHERE d.{c} IS NOT NULL AND q.{c} IS NULL) t WHERE rn <= {k} GROUP BY 1)"
        )
    picked = ", ".join(d6(f"coalesce(f.{c}, {c}_v.v, (SELECT avg({c}) FROM fx_features))") + f" AS {c}" for c in FEATURES)
    joins = " ".join(f"LEFT JOIN {c}_v ON {c}_v.vec_id = f.vec_id" for c in FEATURES)
    return f"""WITH pairs AS (SELECT q.vec_id, d.vec_id AS did, sqrt(6.0 / ({shared}) * ({total})) AS dist
      FROM fx_features q, fx_features d WHERE ({shared}) > 0), {', '.join(parts)}
      SELECT f.vec_id, {picked} FROM fx_features f {joins}"""


@query("knn_impute", _impute_sql(P.NEIGHBOURS_IMPUTE))
def _(d):
    x = d.view("fx_features").select("vec_id", *FEATURES)
    return nb.knn_impute(x, x, FEATURES, P.NEIGHBOURS_IMPUTE, "vec_id").select("vec_id", *rounded(FEATURES))


@query("imputed_cache", _impute_sql(3))
def _(d):
    x = d.view("fx_features").select("vec_id", *FEATURES)
    path = scratch_path(d.spark, "imputed")
    checkpoint_table(nb.knn_impute(x, x, FEATURES, 3, "vec_id"), path)
    return d.spark.read.parquet(path).select("vec_id", *rounded(FEATURES))


def complete_rows(d):
    """Features with the missing ones set to zero, for the steps that need none missing."""
    return d.view("fx_features").fillna(0.0, FEATURES).select("vec_id", "class", *FEATURES)


@query("smote_plan", """WITH c AS (SELECT class, count(*) AS n FROM fx_features GROUP BY 1),
  m AS (SELECT class, n, CASE WHEN n > 1 THEN (SELECT max(n) FROM c) - n ELSE 0 END AS make FROM c)
  SELECT class, n, CAST(make AS BIGINT) AS make, CAST(floor(make / n) AS BIGINT) AS each, CAST(make % n AS BIGINT) AS extra FROM m""")
def _(d):
    return sp.smote_plan(d.view("fx_features"), "class")


def _smote_sql(k: int, seed: int) -> str:
    zeroed = ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in FEATURES)
    dist = " + ".join(f"pow(b.{c} - o.{c}, 2)" for c in FEATURES)
    drawn = ", ".join(d6(f"m.{c} + m.gap * (o.{c} - m.{c})") + f" AS {c}" for c in FEATURES)
    return f"""WITH x AS (SELECT vec_id, class, {zeroed} FROM fx_features),
      sizes AS (SELECT class, count(*) AS n FROM x GROUP BY 1),
      plan AS (SELECT class, n, (SELECT max(n) FROM sizes) - n AS make FROM sizes WHERE n > 1),
      turn AS (SELECT x.*, make // n + CASE WHEN row_number() OVER (PARTITION BY x.class ORDER BY md5('{seed}|' || vec_id), CAST(vec_id AS VARCHAR)) <= make % n
        THEN 1 ELSE 0 END AS copies FROM x JOIN plan ON x.class = plan.class WHERE make > 0),
      near AS (SELECT * FROM (SELECT b.vec_id, o.vec_id AS other, row_number() OVER (PARTITION BY b.vec_id ORDER BY sqrt({dist}), o.vec_id) - 1 AS place
        FROM turn b JOIN x o ON b.class = o.class AND b.vec_id <> o.vec_id WHERE b.copies > 0) q WHERE place < {k}),
      found AS (SELECT vec_id, count(*) AS many FROM near GROUP BY 1),
      drawn AS (SELECT *, md5('{seed}|' || vec_id || '|' || copy) AS draw FROM (SELECT *, unnest(range(0, CAST(copies AS BIGINT))) AS copy FROM turn) t),
      m AS (SELECT d.*, CAST('0x' || substr(draw, 1, 7) AS BIGINT) % many AS pick, CAST('0x' || substr(draw, 9, 7) AS BIGINT) / 268435456.0 AS gap
        FROM drawn d JOIN found ON found.vec_id = d.vec_id)
      SELECT m.vec_id AS base_id, m.copy, m.class, {drawn} FROM m JOIN near ON near.vec_id = m.vec_id AND near.place = m.pick JOIN x o ON o.vec_id = near.other"""


@query("smote_rows", _smote_sql(P.NEIGHBOURS_SMOTE, P.SEED))
def _(d):
    made = sp.smote(complete_rows(d), "class", FEATURES, "vec_id", P.NEIGHBOURS_SMOTE, P.SEED)
    return made.select("base_id", "copy", "class", *rounded(FEATURES))


# ---------------------------------------------------------------- evaluation

@query("confusion_matrix", f"""SELECT label, pred, count(*) AS n, {d6('count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY label)')} AS share
  FROM fx_predictions GROUP BY 1, 2""")
def _(d):
    return evl.confusion(d.view("fx_predictions"), "label", "pred").withColumn("share", r6("share"))


@query("classification_report", f"""WITH c AS (SELECT DISTINCT label AS class FROM fx_predictions UNION SELECT DISTINCT pred FROM fx_predictions),
  s AS (SELECT class, (SELECT count(*) FROM fx_predictions WHERE label = class AND pred = class) AS tp,
    (SELECT count(*) FROM fx_predictions WHERE pred = class) AS pn, (SELECT count(*) FROM fx_predictions WHERE label = class) AS ln FROM c),
  m AS (SELECT class, ln AS support, CASE WHEN pn > 0 THEN tp * 1.0 / pn ELSE 0 END AS p, CASE WHEN ln > 0 THEN tp * 1.0 / ln ELSE 0 END AS r,
    CASE WHEN pn + ln > 0 THEN 2.0 * tp / (pn + ln) ELSE 0 END AS f FROM s)
  SELECT CAST(class AS VARCHAR) AS class, {d6('p')} AS precision, {d6('r')} AS recall, {d6('f')} AS f1, support FROM m
  UNION ALL SELECT 'macro', {d6('avg(p)')}, {d6('avg(r)')}, {d6('avg(f)')}, CAST(sum(support) AS BIGINT) FROM m
  UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT {d6('avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END)')} AS a, count(*) AS n FROM fx_predictions) t""")
def _(d):
    out = evl.classification_report(d.view("fx_predictions"), "label", "pred")
    return out.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


# ---------------------------------------------------------------- models and completion

def ready(d):
    """Features without gaps, a zero-based label and an id, for the learners."""
    from linenet.operators.models import assemble

    rows = complete_rows(d).withColumn("label", (F.col("class") - 1).cast("int"))
    return assemble(rows, FEATURES).select(F.col("vec_id").alias("id"), "label", "features")


SMALL = {
    "forest": {"numTrees": 12, "maxDepth": 5, "subsamplingRate": 0.8},
    "extra_trees": {"numTrees": 12, "maxDepth": 5},
    "boosting": {"maxIter": 4, "maxDepth": 3, "stepSize": 0.1},
    "adaboost": {"rounds": 4, "maxDepth": 2},
    "tree": {"maxDepth": 5, "impurity": "entropy"},
}


def _train(kind):
    def run(d):
        from linenet.operators.models import predict_with_confidence, train

        rows = checkpoint_table(ready(d), scratch_path(d.spark, "rows"))
        model = train(rows, kind, SMALL[kind])
        return predict_with_confidence(model, rows).select("id", "label", F.col("prediction").cast("int").alias("pred"), "confidence")

    return run


for _kind in SMALL:
    query(f"train_{_kind}")(_train(_kind))


@query("early_stopping", """WITH v AS (SELECT CASE WHEN coalesce(f1, 0) <= 0 THEN 0 WHEN coalesce(f2, 0) <= 0 THEN 1 ELSE 2 END AS label FROM fx_features)
  SELECT label, count(*) AS n, CAST(round(count(*) * 0.15) AS BIGINT) AS n_held, true AS stopped FROM v GROUP BY 1""")
def _(d):
    """Classes that two features tell apart: rows held back of each, and whether its booster ended before the last round."""
    from linenet.operators.models import assemble, rounds_of, train_stopping

    rule = F.when(F.col("f1") <= 0, 0).when(F.col("f2") <= 0, 1).otherwise(2)
    rows = assemble(complete_rows(d).withColumn("label", rule), FEATURES).select(F.col("vec_id").alias("id"), "label", "features")
    rows = checkpoint_table(rows, scratch_path(d.spark, "rows"))
    made = rounds_of(train_stopping(rows, {"maxIter": 20, "maxDepth": 3, "stepSize": 0.5, "validationTol": 0.2}, "id"))
    stopped = F.element_at(F.array(*[F.lit(n < 20) for n in made]), F.col("label") + 1)
    held = sp.stratified_split(rows, "label", P.VALIDATION_SHARE, "id", P.SEED, out="held")
    counts = held.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("held").cast("bigint")).alias("n_held"))
    return counts.withColumn("stopped", stopped)


@query("predict_confidence")
def _(d):
    """Rows per predicted class with their confidence, trained on one part and read on the other."""
    from linenet.operators.models import predict_with_confidence, train
    from linenet.operators.profiles import confidence_by_class

    rows = checkpoint_table(sp.stratified_split(ready(d), "label", P.TEST_SHARE, "id", P.SEED), scratch_path(d.spark, "rows"))
    model = train(rows.filter("NOT is_test"), "forest", SMALL["forest"])
    return confidence_by_class(predict_with_confidence(model, rows.filter("is_test")), "prediction", "confidence")


@query("feature_importance")
def _(d):
    from linenet.operators.models import importance_table, train

    return importance_table(train(ready(d), "forest", SMALL["forest"]), FEATURES, d.spark)


@query("random_search")
def _(d):
    from linenet.operators.models import random_search

    space = {"maxDepth": [2, 4], "minInstancesPerNode": [1, 5], "impurity": ["gini", "entropy"]}
    _, _, scores = random_search(ready(d), "tree", space, 3, "id")
    rows = [(s["maxDepth"], s["minInstancesPerNode"], s["impurity"], f1) for s, f1 in scores]
    return d.spark.createDataFrame(rows, "depth int, leaf int, impurity string, f1 double")


@query("artifact_kinds", " UNION ALL ".join(f"SELECT vec_id AS id, '{k}' AS kind, true AS same FROM fx_features" for k in sorted(SMALL)))
def _(d):
    """Every kind of learner, stored and read again: does each row get the same class and confidence?"""
    from linenet.operators.models import predict_with_confidence, train
    from linenet.sources import artifacts as ar

    rows, path = checkpoint_table(ready(d), scratch_path(d.spark, "rows")), scratch_path(d.spark, "artifacts")
    models = {kind: train(rows, kind, SMALL[kind]) for kind in sorted(SMALL)}
    ar.save_artifacts(d.spark, path, models, {}, {})
    stored, _, _ = ar.load_artifacts(d.spark, path, list(models), [])
    out = None
    for kind, model in models.items():
        there = predict_with_confidence(stored[kind], rows).select(F.col("id").alias("_id"), F.struct("prediction", "confidence").alias("there"))
        here = predict_with_confidence(model, rows).select("id", F.struct("prediction", "confidence").alias("here"))
        same = here.join(there, F.col("id") == F.col("_id")).select("id", F.lit(kind).alias("kind"), (F.col("here") == F.col("there")).alias("same"))
        out = same if out is None else out.union(same)
    return out


@query("artifact_round_trip")
def _(d):
    """Predictions of a stored forest next to those of the one that was stored."""
    from linenet.operators.models import predict_with_confidence, train
    from linenet.sources import artifacts as ar

    rows, path = ready(d), scratch_path(d.spark, "artifacts")
    model = train(rows, "forest", SMALL["forest"])
    donors = d.view("fx_features").select("vec_id", *FEATURES)
    ar.save_artifacts(d.spark, path, {"model": model}, {"donors": donors}, {"features": FEATURES})
    models, tables, settings = ar.load_artifacts(d.spark, path, ["model"], ["donors"])
    there = predict_with_confidence(models["model"], rows).select("id", F.col("prediction").alias("stored"))
    here = predict_with_confidence(model, rows).select("id", "prediction")
    kept = tables["donors"].select(F.col("vec_id").alias("id"), *settings["features"])
    return here.join(there, "id").join(kept, "id")


def inventory(d):
    """Features with a text label and a state that some rows lack, and a category."""
    return d.view("fx_features").select(
        "vec_id", *FEATURES, "kind",
        F.when(F.col("vec_id") % 4 != 0, F.concat(F.lit("MAT"), F.col("class").cast("string"))).alias("Materiau"),
        F.when(F.col("vec_id") % 3 != 0, F.col("class") + 1).alias("classe_age"),
        F.when(F.col("vec_id") % 5 != 0, F.col("class")).alias("etat"),
    )


def _inputs():
    from linenet.plans.completion import Features

    return Features(FEATURES, ["kind"], logs=["f1"])


@query("complete_material")
def _(d):
    from linenet.plans import completion as co

    rows, ins = inventory(d), _inputs()
    fit = co.fit_completion(rows, "Materiau", ins, "vec_id", "forest", SMALL["forest"], text_target=True)
    return co.complete(rows, "Materiau", fit, ins, "vec_id", threshold=P.COMPLETE_MATERIAL)


@query("complete_age")
def _(d):
    from linenet.plans import completion as co

    rows, ins = inventory(d), _inputs()
    fit = co.fit_completion(rows, "classe_age", ins, "vec_id", "forest", SMALL["forest"])
    known = F.coalesce(F.col("classe_age").isin(2, 3, 4, 5), F.lit(False))
    return co.complete(rows, "classe_age", fit, ins, "vec_id", known=known)


@query("complete_state")
def _(d):
    from linenet.functions.values import recode_state
    from linenet.plans import completion as co

    rows, ins = inventory(d), _inputs()
    fits = {}
    for level in P.STATE_LEVELS:
        coded = rows.withColumn("code", recode_state(F.col("etat"), level.name))
        fits[level.name] = co.fit_completion(coded, "code", ins, "vec_id", "extra_trees", SMALL["extra_trees"], name="ExtraTrees")
    return co.complete_levels(rows, "etat", fits, ins, "vec_id")


PRESENT = " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in [*FEATURES, "kind"])


@query("completion_split", f"""WITH v AS (SELECT vec_id, ({PRESENT}) / 7.0 AS share FROM fx_features)
  SELECT vec_id, CASE WHEN vec_id % 4 <> 0 THEN 'original' WHEN share >= 0.7 THEN 'predict' ELSE 'excluded' END AS material,
  CASE WHEN vec_id % 3 <> 0 THEN 'original' ELSE 'predict' END AS age,
  CASE WHEN vec_id % 5 <> 0 THEN 'original' WHEN share >= 0.5 THEN 'predict' ELSE 'excluded' END AS state FROM v""")
def _(d):
    from linenet.plans.completion import split_rows

    rows, ins = inventory(d), _inputs()
    out = split_rows(rows, F.col("Materiau").isNotNull(), ins, P.COMPLETE_MATERIAL).withColumnRenamed("part", "material")
    out = split_rows(out, F.col("classe_age").isNotNull(), ins, None).withColumnRenamed("part", "age")
    out = split_rows(out, F.col("etat").isNotNull(), ins, P.COMPLETE_STATE).withColumnRenamed("part", "state")
    return out.select("vec_id", "material", "age", "state")


MATERIAL_PARTS = f"""SELECT vec_id, CASE WHEN vec_id % 4 <> 0 THEN 'MAT' || class END AS known,
  CASE WHEN vec_id % 4 <> 0 THEN 'original' WHEN ({PRESENT}) / 7.0 >= 0.7 THEN 'predict' ELSE 'excluded' END AS part FROM fx_features"""
AGE_PARTS = """SELECT vec_id, CASE WHEN vec_id % 3 <> 0 AND class + 1 IN (2, 3, 4, 5) THEN class + 1 END AS known FROM fx_features"""
STATE_PARTS = f"""SELECT vec_id, CASE WHEN vec_id % 5 <> 0 AND class IN (1, 2, 3, 4) THEN class END AS known,
  CASE WHEN vec_id % 5 <> 0 AND class IN (1, 2, 3, 4) THEN 'original' WHEN ({PRESENT}) / 7.0 >= 0.5 THEN 'predict' ELSE 'excluded' END AS part FROM fx_features"""


def _source_sql(part: str, model: str) -> str:
    return f"CASE {part} WHEN 'original' THEN '{P.SOURCE_ORIGINAL}' WHEN 'predict' THEN '{P.SOURCE_PREDICTED}{model}' ELSE '{P.SOURCE_EXCLUDED}' END"


def _settled(c: str) -> list:
    """What does not depend on a model: values and confidence of known and left-out rows, provenance, and whether a value is there."""
    source = F.col(f"{c}_source")
    original = source == P.SOURCE_ORIGINAL
    return [
        F.when(original, F.col(c)).alias(f"{c}_known"), source,
        F.when(~source.startswith(P.SOURCE_PREDICTED), F.col(f"{c}_confiance")).alias(f"{c}_sure"), F.col(c).isNotNull().alias(f"{c}_filled"),
    ]


@query("material_provenance", f"""WITH p AS ({MATERIAL_PARTS})
  SELECT vec_id, known AS "Materiau_known", {_source_sql("part", "forest")} AS "Materiau_source",
  CASE WHEN part = 'original' THEN CAST(1 AS DOUBLE) END AS "Materiau_sure", part <> 'excluded' AS "Materiau_filled" FROM p""")
def _(d):
    return QUERIES["complete_material"](d.spark, d.folder).select("vec_id", *_settled("Materiau"))


@query("age_provenance", f"""WITH p AS (SELECT vec_id, known, CASE WHEN known IS NULL THEN 'predict' ELSE 'original' END AS part FROM ({AGE_PARTS}) q)
  SELECT vec_id, known AS "classe_age_known", {_source_sql("part", "forest")} AS "classe_age_source",
  CASE WHEN part = 'original' THEN CAST(1 AS DOUBLE) END AS "classe_age_sure", TRUE AS "classe_age_filled" FROM p""")
def _(d):
    return QUERIES["complete_age"](d.spark, d.folder).select("vec_id", *_settled("classe_age"))


STATE_CODES = {"EDS_n1": "known", "EDS_n2": "CAST(known = 4 AS INTEGER)", "EDS_n3": "CAST(known >= 3 AS INTEGER)"}


@query("state_provenance", f"WITH p AS ({STATE_PARTS}) SELECT vec_id, " + ", ".join(
    f"""{code} AS "{c}_known", {_source_sql("part", "ExtraTrees")} AS "{c}_source",
  CASE part WHEN 'original' THEN CAST(1 AS DOUBLE) WHEN 'excluded' THEN CAST(0 AS DOUBLE) END AS "{c}_sure", part <> 'excluded' AS "{c}_filled\""""
    for c, code in STATE_CODES.items()) + " FROM p")
def _(d):
    return QUERIES["complete_state"](d.spark, d.folder).select("vec_id", *(x for c in STATE_CODES for x in _settled(c)))


def _level_sql(c: str) -> str:
    return f"""{STATE_CODES[c]} AS "{c}_known", {_source_sql("part", "ExtraTrees")} AS "{c}_source",
  CASE part WHEN 'original' THEN CAST(1 AS DOUBLE) WHEN 'excluded' THEN CAST(0 AS DOUBLE) END AS "{c}_sure", part <> 'excluded' AS "{c}_filled\""""


@query("state_from_store", f"""WITH p AS ({STATE_PARTS}) SELECT vec_id, 'EDS_n1,EDS_n3' AS levels, {_level_sql("EDS_n1")}, {_level_sql("EDS_n3")} FROM p""")
def _(d):
    """Completion from a store that holds the first and the third level; the second is passed over."""
    from linenet.plans import completion as co

    rows, ins, path = inventory(d), _inputs(), scratch_path(d.spark, "store")
    there = [level for level in P.STATE_LEVELS if level.column != "EDS_n2"]
    co.stored_levels(rows, "etat", path, ins, "vec_id", "extra_trees", SMALL["extra_trees"], there, name="ExtraTrees")
    out = co.complete_levels(rows, "etat", co.load_levels(d.spark, path), ins, "vec_id")
    levels = ",".join(level.column for level in P.STATE_LEVELS if level.column in out.columns)
    return out.select("vec_id", F.lit(levels).alias("levels"), *(x for level in there for x in _settled(level.column)))


@query("experiment_grid")
def _(d):
    from linenet.plans.experiment import best_models, run_grid

    results = run_grid(
        inventory(d), {"etat": True, "autre": False}, [level.name for level in P.STATE_LEVELS], SMALL, _inputs(),
        "vec_id", scratch_path(d.spark, "results"), balance=True,
    )
    best = best_models(results).select("target", "level", F.col("model").alias("best"))
    return results.join(best, ["target", "level"]).drop("seconds")
