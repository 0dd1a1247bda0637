"""Scores of predicted classes, from the table of label and prediction counts."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Counts per pair, with each label's share going to each prediction."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("label")))


def class_scores(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall and F1 per class; a score with nothing to divide by is 0."""
    counts = df.groupBy(F.col(label).alias("l"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(F.col("l").alias("class"), F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(F.lit(0)).alias("hit"),
                         F.col("n").alias("labelled"), F.lit(0).cast("bigint").alias("predicted")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("hit"),
                         F.lit(0).cast("bigint").alias("labelled"), F.col("n").alias("predicted")),
            )
        )
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("hit", "labelled", "predicted")])

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    hit, lab, pre = (F.col(c) for c in ("hit", "labelled", "predicted"))
    return sums.select(
        "class", ratio(hit, pre).alias("precision"), ratio(hit, lab).alias("recall"),
        ratio(hit * 2.0, lab + pre).alias("f1"), lab.alias("support"), "hit",
    )


def macro_scores(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: accuracy and the plain means over classes."""
    return class_scores(df, label, pred).agg(
        (F.sum("hit") / F.sum("support")).alias("accuracy"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("n"),
    )


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Scores per class, then a ``macro`` and an ``accuracy`` row."""
    scores = class_scores(df, label, pred)
    rows = scores.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    m = macro_scores(df, label, pred)
    macro = m.select(F.lit("macro").alias("class"), "precision", "recall", "f1", F.col("n").alias("support"))
    a = F.col("accuracy")
    total = m.select(F.lit("accuracy").alias("class"), a.alias("precision"), a.alias("recall"), a.alias("f1"), F.col("n").alias("support"))
    return rows.unionByName(macro).unionByName(total)


class MacroF1(Evaluator):
    """Mean F1 over classes, for Spark's cross-validator (whose own F1 is weighted)."""

    def __init__(self, label: str = "label", pred: str = "prediction"):
        super().__init__()
        self.label, self.pred = label, pred

    def _evaluate(self, dataset: DataFrame) -> float:
        score = macro_scores(dataset, self.label, self.pred).first()["f1"]
        return float(score) if score is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True
