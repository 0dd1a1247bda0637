"""Fill missing attributes by a trained model, with provenance and confidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets as P
from ..functions import values as val
from ..operators import encoding as en
from ..operators.models import assemble, predict_with_confidence, train
from ..operators.neighbours import knn_impute
from ..operators.schema import drop_suffix
from ..session import scratch_path
from ..sources.artifacts import load_artifacts, missing_artifacts, read_manifest, save_artifacts
from ..sources.tables import checkpoint_table


@dataclass(frozen=True)
class Features:
    """Inputs of a model: measures, categories, and measures taken as logarithms."""

    numeric: Sequence[str]
    categories: Sequence[str]
    logs: Sequence[str] = ()

    @property
    def all(self) -> list[str]:
        return [*self.numeric, *self.categories]

    @property
    def encoded(self) -> list[str]:
        return [*self.numeric, *[f"{c}_enc" for c in self.categories]]


@dataclass(frozen=True)
class Fitted:
    """What training leaves behind: the model, the category codes and the imputation donors."""

    model: object
    codes: Mapping[str, DataFrame]
    donors: DataFrame
    labels: DataFrame | None
    name: str


def split_rows(df: DataFrame, known: Column, features: Features, threshold: float | None) -> DataFrame:
    """Part of each row: ``original``, ``predict`` or ``excluded`` for too few values."""
    enough = F.lit(True)
    if threshold is not None:
        enough = val.present_share([F.col(c) for c in features.all]) >= threshold
    return df.withColumn(
        "part", F.when(known, F.lit("original")).when(enough, F.lit("predict")).otherwise(F.lit("excluded"))
    )


def _encode(df: DataFrame, features: Features, codes: Mapping[str, DataFrame]) -> DataFrame:
    out = df.withColumns({c: val.log_length(F.col(c)) for c in features.logs})
    for c in features.categories:
        out = en.apply_codes(out, c, codes[c], f"{c}_enc")
    return out.withColumns({c: F.col(c).cast("double") for c in features.encoded})


def fit_tables(rows: DataFrame, categories: Sequence[str]) -> dict[str, DataFrame]:
    """Code tables, written once: later joins read a file of known size, not the training rows."""
    return {c: checkpoint_table(en.fit_codes(rows, c), scratch_path(rows.sparkSession, "codes")) for c in categories}


def fit_completion(
    df: DataFrame, target: str, features: Features, id_col: str, kind: str, params: Mapping,
    text_target: bool = False, name: str | None = None,
) -> Fitted:
    """Train on rows whose target is known. The target is a zero-based code or, if
    ``text_target``, a label that is encoded first."""
    rows = df.filter(F.col(target).isNotNull()).select(id_col, target, *features.all)
    codes = fit_tables(rows, features.categories)
    labels = fit_tables(rows, [target])[target] if text_target else None
    rows = en.apply_codes(rows, target, labels, "label") if text_target else rows.withColumn("label", F.col(target).cast("int"))
    donors = checkpoint_table(
        _encode(rows, features, codes).select(id_col, "label", *features.encoded), scratch_path(df.sparkSession, "train")
    )
    filled = knn_impute(donors, donors, features.encoded, P.NEIGHBOURS_IMPUTE, id_col)
    ready = checkpoint_table(assemble(filled, features.encoded).select("label", "features"), scratch_path(df.sparkSession, "ready"))
    model = train(ready, kind, params)
    return Fitted(model, codes, donors.drop("label"), labels, name or kind)


def save_fitted(spark: SparkSession, path: str, fitted: Fitted) -> None:
    """Store all of it, or nothing that counts."""
    tables = {"donors": fitted.donors, **{f"codes_{i}": codes for i, codes in enumerate(fitted.codes.values())}}
    if fitted.labels is not None:
        tables["labels"] = fitted.labels
    save_artifacts(spark, path, {"model": fitted.model}, tables, {"name": fitted.name, "categories": list(fitted.codes)})


def load_fitted(spark: SparkSession, path: str) -> Fitted | None:
    """What ``save_fitted`` left, or None if there is no whole save or one of its parts is gone."""
    manifest = read_manifest(spark, path)
    if manifest is None or missing_artifacts(spark, path, [*manifest["models"], *manifest["tables"]]):
        return None
    models, tables, settings = load_artifacts(spark, path, manifest["models"], manifest["tables"])
    codes = {c: tables[f"codes_{i}"] for i, c in enumerate(settings["categories"])}
    return Fitted(models["model"], codes, tables["donors"], tables.get("labels"), settings["name"])


def stored_completion(df: DataFrame, path: str, target: str, features: Features, id_col: str, kind: str, params: Mapping, **options) -> Fitted:
    """``fit_completion``, unless the store already holds its result."""
    spark = df.sparkSession
    found = load_fitted(spark, path)
    if found is None:
        save_fitted(spark, path, fit_completion(df, target, features, id_col, kind, params, **options))
        found = load_fitted(spark, path)
    return found


def stored_levels(
    df: DataFrame, target: str, path: str, features: Features, id_col: str, kind: str, params: Mapping,
    levels: Sequence[P.StateLevel] = P.STATE_LEVELS, name: str | None = None,
) -> dict[str, Fitted]:
    """A model per state level, each in a folder of its own below ``path``; only those not there are trained."""
    return {
        level.name: stored_completion(
            df.withColumn("_code", val.recode_state(F.col(target), level.name)), f"{path}/{level.name}", "_code", features, id_col,
            kind, params, name=name,
        )
        for level in levels
    }


def load_levels(spark: SparkSession, path: str, levels: Sequence[P.StateLevel] = P.STATE_LEVELS) -> dict[str, Fitted]:
    """The levels whose store is whole; ``complete_levels`` passes over the others."""
    found = {level.name: load_fitted(spark, f"{path}/{level.name}") for level in levels}
    return {name: fitted for name, fitted in found.items() if fitted is not None}


def _predictions(df: DataFrame, fitted: Fitted, features: Features, id_col: str) -> DataFrame:
    encoded = _encode(df.select(id_col, *features.all), features, fitted.codes).select(id_col, *features.encoded)
    filled = knn_impute(encoded, fitted.donors, features.encoded, P.NEIGHBOURS_IMPUTE, id_col)
    scored = predict_with_confidence(fitted.model, assemble(filled, features.encoded))
    if fitted.labels is not None:
        scored = en.decode(scored, "prediction", fitted.labels, "_label").withColumn("prediction", F.col("_label"))
    return scored.select(F.col(id_col).alias("_id"), F.col("prediction").alias("_pred"), F.col("confidence").alias("_conf"))


def complete(
    df: DataFrame, target: str, fitted: Fitted, features: Features, id_col: str, known: Column | None = None,
    threshold: float | None = None,
) -> DataFrame:
    """Known values stay with confidence 1; others are predicted; rows with too few values stay empty.

    All input columns are returned as they came in.
    """
    known = F.col(target).isNotNull() if known is None else known
    parts = split_rows(df, known, features, threshold)
    made = _predictions(parts.filter(F.col("part") == "predict"), fitted, features, id_col)
    joined = parts.join(made, F.col(id_col) == F.col("_id"), "left")
    kind = df.schema[target].dataType.simpleString()
    source = (
        F.when(F.col("part") == "original", F.lit(P.SOURCE_ORIGINAL))
        .when(F.col("part") == "predict", F.lit(P.SOURCE_PREDICTED + fitted.name))
        .otherwise(F.lit(P.SOURCE_EXCLUDED))
    )
    out = joined.withColumns(
        {
            target: F.when(F.col("part") == "original", F.col(target)).otherwise(F.col("_pred").cast(kind)),
            f"{target}_source": source,
            f"{target}_confiance": F.when(F.col("part") == "original", F.lit(1.0)).otherwise(F.col("_conf")),
        }
    )
    return drop_suffix(out.drop("part", "_id", "_pred", "_conf"), "_enc")


def complete_levels(
    df: DataFrame, target: str, fitted: Mapping[str, Fitted], features: Features, id_col: str,
    levels: Sequence[P.StateLevel] = P.STATE_LEVELS, threshold: float = P.COMPLETE_STATE,
) -> DataFrame:
    """Three columns per level: value, provenance and confidence.

    A level without a model is passed over. Original states are written in the same
    numbering as predicted ones.
    """
    known = F.coalesce(F.col(target).isin(P.TARGET_VALUES), F.lit(False))
    parts = split_rows(df, known, features, threshold)
    out = parts
    for level in levels:
        if level.name not in fitted:
            continue
        fit = fitted[level.name]
        made = _predictions(parts.filter(F.col("part") == "predict"), fit, features, id_col)
        joined = out.join(made, F.col(id_col) == F.col("_id"), "left")
        original = val.recode_state(F.col(target), level.name) + level.offset
        out = joined.withColumns(
            {
                level.column: F.when(F.col("part") == "original", original).otherwise(F.col("_pred").cast("int") + level.offset),
                f"{level.column}_source": F.when(F.col("part") == "original", F.lit(P.SOURCE_ORIGINAL))
                .when(F.col("part") == "predict", F.lit(P.SOURCE_PREDICTED + fit.name))
                .otherwise(F.lit(P.SOURCE_EXCLUDED)),
                f"{level.column}_confiance": F.when(F.col("part") == "original", F.lit(1.0)).otherwise(
                    F.coalesce(F.col("_conf"), F.lit(0.0))
                ),
            }
        ).drop("_id", "_pred", "_conf")
    return out.drop("part")
