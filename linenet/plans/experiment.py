"""Comparison of learners over targets and levels."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import presets as P
from ..functions import values as val
from ..operators import cleaning as cl
from ..operators import encoding as en
from ..operators.evaluate import macro_scores
from ..operators.models import assemble, predict_with_confidence, random_search, train, train_stopping
from ..operators.neighbours import knn_impute
from ..operators.ordering import auc, best_per_group
from ..operators.sampling import smote, stratified_split
from ..session import scratch_path
from ..sources.tables import append_results, checkpoint_table
from .completion import Features, _encode, fit_tables

RESULT = "target string, level string, model string, accuracy double, f1 double, precision double, recall double, auc double, seconds double, status string"


def prepare(
    df: DataFrame, target: str, level: str, features: Features, id_col: str,
    threshold: float = P.COMPLETE_STATE, balance: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows ``(id, label, features)`` of one experiment.

    Rows are split before anything is learnt from them: codes, donors and synthetic rows
    come from the train part alone.
    """
    spark = df.sparkSession
    rows = cl.filter_in(df, target, P.TARGET_VALUES)
    rows = rows.withColumn("label", val.recode_state(F.col(target).cast("int"), level))
    rows, _ = cl.filter_complete(rows, features.all, threshold)
    marked = stratified_split(rows.select(id_col, "label", *features.all), "label", P.TEST_SHARE, id_col, P.SEED)
    marked = checkpoint_table(marked, scratch_path(spark, "split"))
    learn = marked.filter(~F.col("is_test"))
    codes = fit_tables(learn, features.categories)
    coded = checkpoint_table(
        _encode(marked, features, codes).select(id_col, "label", "is_test", *features.encoded), scratch_path(spark, "coded")
    )
    filled = checkpoint_table(
        knn_impute(coded, coded.filter(~F.col("is_test")), features.encoded, P.NEIGHBOURS_IMPUTE, id_col), scratch_path(spark, "filled")
    )
    parts = assemble(filled, features.encoded)
    learn = parts.filter(~F.col("is_test")).select(F.col(id_col).cast("string").alias("id"), "label", "features")
    if balance:
        made = smote(filled.filter(~F.col("is_test")), "label", features.encoded, id_col, P.NEIGHBOURS_SMOTE, P.SEED)
        extra = assemble(made, features.encoded).select(
            F.concat_ws("#", F.col("base_id").cast("string"), F.col("copy").cast("string")).alias("id"), "label", "features"
        )
        learn = learn.union(extra)
    test = parts.filter("is_test").select(F.col(id_col).cast("string").alias("id"), "label", "features")
    return checkpoint_table(learn, scratch_path(spark, "learn")), test


def run_grid(
    df: DataFrame, targets: Mapping[str, bool], levels: Sequence[str], kinds: Mapping[str, Mapping], features: Features,
    id_col: str, path: str, search: Mapping[str, Mapping] | None = None, draws: int = 0, balance: bool = False,
) -> DataFrame:
    """Every active target, level and learner; results are appended to one table as they come.

    What an earlier run left in the table goes first.
    ``kinds`` maps a learner to its settings, ``search`` to a space it is tuned over. A
    failing cell is recorded and the rest goes on, and so is every cell of a level that can't be
    prepared; an absent target is an error. AdaBoost takes no class weights, boosting
    with given settings ends early by a validation part. The
    driver loops over the cells only: preparing, fitting and scoring are Spark jobs.
    """
    spark = df.sparkSession
    absent = [t for t, on in targets.items() if on and t not in df.columns]
    if absent:
        raise ValueError(f"target columns not found: {absent}")
    spark.createDataFrame([], RESULT).write.mode("overwrite").partitionBy("target", "level").parquet(path)
    for target in (t for t, on in targets.items() if on):
        for level in levels:
            start = time.time()
            try:
                learn, test = prepare(df, target, level, features, id_col, balance=balance)
                weighted = checkpoint_table(en.with_weights(learn, "label"), scratch_path(spark, "weighted"))
            except Exception as e:  # noqa: BLE001 - one failing level must not stop the grid
                rows = [(target, level, kind, None, None, None, None, None, time.time() - start, f"failed: {type(e).__name__}") for kind in kinds]
                append_results(spark.createDataFrame(rows, RESULT), path, ["target", "level"])
                continue
            for kind, params in kinds.items():
                start = time.time()
                try:
                    weight = None if kind == "adaboost" else "weight"
                    if search and kind in search:
                        model, _, _ = random_search(weighted, kind, search[kind], draws, "id", weight=weight)
                    elif kind == "boosting":
                        model = train_stopping(weighted, params, "id", weight=weight)
                    else:
                        model = train(weighted, kind, params, weight=weight)
                    scored = checkpoint_table(
                        predict_with_confidence(model, test).select("label", F.col("prediction").cast("int").alias("pred"), "confidence"),
                        scratch_path(spark, "scored"),
                    )
                    m = macro_scores(scored, "label", "pred").first()
                    area = None
                    if level != P.STATE_LEVELS[0].name:
                        positive = F.when(F.col("pred") == 1, F.col("confidence")).otherwise(1 - F.col("confidence"))
                        area = auc(scored.withColumn("score", positive), "label", "score").first()["auc"]
                    row = (target, level, kind, m["accuracy"], m["f1"], m["precision"], m["recall"], area, time.time() - start, "ok")
                except Exception as e:  # noqa: BLE001 - one failing cell must not stop the grid
                    row = (target, level, kind, None, None, None, None, None, time.time() - start, f"failed: {type(e).__name__}")
                append_results(spark.createDataFrame([row], RESULT), path, ["target", "level"])
    return spark.read.schema(RESULT).parquet(path)


def best_models(results: DataFrame) -> DataFrame:
    """Best learner per target and level by F1, ties by name."""
    return best_per_group(results.filter(F.col("status") == "ok"), ["target", "level"], "f1", ["model"])
