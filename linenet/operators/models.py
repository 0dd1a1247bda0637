"""Tree learners on tables: training, prediction with confidence, seeded search."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import presets as P
from ..session import scratch_path
from ..sources.tables import checkpoint_table
from .evaluate import MacroF1
from .sampling import stratified_folds, stratified_split

REWRITE = 10  # rounds of adaptive boosting between two writes of the rows

KINDS = ("forest", "extra_trees", "boosting", "adaboost", "tree")


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector; the columns must hold no nulls by now."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


class _Rounds(Params):
    rounds = Param(Params._dummy(), "rounds", "number of trees", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "weight of each tree's vote", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of each tree", TypeConverters.toInt)


class AdaptiveBoost(Estimator, _Rounds, HasLabelCol, HasFeaturesCol, HasPredictionCol, HasSeed):
    """Multi-class adaptive boosting of shallow trees (the SAMME rule).

    Each round fits one distributed tree on weighted rows, takes the weighted error in one
    aggregate, and raises the weights of the rows it got wrong. The weight of a row follows from
    the trees since the rows were last written, in one expression; every ``REWRITE`` rounds
    the rows are written anew, so neither the work of a round nor the plan grows with the rounds.
    """

    @keyword_only
    def __init__(self, *, rounds=50, learningRate=1.0, maxDepth=1, labelCol="label", featuresCol="features",
                 predictionCol="prediction", seed=P.SEED):
        super().__init__()
        self._setDefault(rounds=50, learningRate=1.0, maxDepth=1, seed=P.SEED)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> AdaptiveBoostModel:
        spark = dataset.sparkSession
        label, features = self.getLabelCol(), self.getFeaturesCol()
        rate = self.getOrDefault(self.learningRate)
        size = dataset.agg((F.max(label) + 1).cast("int").alias("k"), F.count(F.lit(1)).alias("n")).first()
        k, n = max(2, size["k"]), size["n"]
        rows = dataset.select(F.col(label).cast("double").alias(label), features).withColumn("_w", F.lit(1.0 / n))
        rows = checkpoint_table(rows, scratch_path(spark, "boost"))
        tree = DecisionTreeClassifier(
            labelCol=label, featuresCol=features, weightCol="_w", maxDepth=self.getOrDefault(self.maxDepth),
            predictionCol="_pred", probabilityCol="_prob", rawPredictionCol="_raw", seed=self.getSeed(),
        )
        trees, votes, fresh = FlatTrees(), [], FlatTrees()
        gains = np.zeros(0)
        weighted, scale = rows, 1.0
        for turn in range(self.getOrDefault(self.rounds)):
            fitted = tree.fit(weighted)
            scored = fitted.transform(weighted).withColumn("_miss", (F.col("_pred") != F.col(label)).cast("double"))
            sums = scored.agg(F.sum(F.col("_w") * F.col("_miss")).alias("e"), F.sum("_w").alias("t")).first()
            error = sums["e"] / sums["t"]
            useless, perfect = error >= 1 - 1 / k, error <= 0
            if useless and votes:
                break
            vote = 1.0 if useless or perfect else rate * float(_log((1 - error) / error) + _log(k - 1))
            trees.add(fitted)
            votes.append(vote)
            gain = vote * fitted.featureImportances.toArray()
            gains = gain if turn == 0 else gains + gain
            if useless or perfect:
                break
            fresh.add(fitted)
            missed = F.zip_with(
                fresh.leaves(features), _numbers(votes[-len(fresh.roots):], "double"),
                lambda c, v: F.when(c != F.col(label), v).otherwise(F.lit(0.0)),
            )
            scale *= sums["t"]  # keeps the weights near 1/n
            heavier = F.col("_w") * F.exp(F.aggregate(missed, F.lit(0.0), lambda a, b: a + b)) / F.lit(float(scale))
            weighted = rows.withColumn("_w", heavier)
            if len(fresh.roots) == REWRITE:
                rows = weighted = checkpoint_table(weighted, scratch_path(spark, "boost"))
                fresh, scale = FlatTrees(), 1.0
        return AdaptiveBoostModel.of(trees, votes, k, gains, features, self.getPredictionCol())


def _log(x: float) -> float:
    import math

    return math.log(x) if x > 0 else 0.0


def _numbers(values: Sequence, kind: str) -> Column:
    """A list of any length as one literal; the text of a float says it exactly."""
    return F.split(F.lit(",".join(repr(v) for v in values)), ",").cast(f"array<{kind}>")


class FlatTrees:
    """Trees as arrays over all their nodes: the feature asked (-1 in a leaf), the threshold, both children, the class.

    Rows are scored by one expression whose size does not depend on the number of trees.
    """

    def __init__(self, feature=(), threshold=(), left=(), right=(), leaf=(), roots=(), depth=0):
        self.feature, self.threshold, self.left, self.right = list(feature), list(threshold), list(left), list(right)
        self.leaf, self.roots, self.depth = list(leaf), list(roots), int(depth)

    def add(self, tree) -> None:
        """Append a fitted tree over measures."""
        self.roots.append(len(self.feature))
        self.depth = max(self.depth, tree.depth)
        waiting = [(tree._java_obj.rootNode(), None, None)]
        while waiting:
            node, side, parent = waiting.pop()
            at = len(self.feature)
            if parent is not None:
                side[parent] = at
            inner = node.subtreeDepth() > 0
            if inner and not hasattr(node.split(), "threshold"):
                raise ValueError("a tree that splits by categories; give measures or codes without nominal metadata")
            self.feature.append(int(node.split().featureIndex()) if inner else -1)
            self.threshold.append(float(node.split().threshold()) if inner else 0.0)
            self.left.append(0)
            self.right.append(0)
            self.leaf.append(int(node.prediction()))
            if inner:
                waiting += [(node.leftChild(), self.left, at), (node.rightChild(), self.right, at)]

    def leaves(self, features: str) -> Column:
        """Class each tree gives, as an array."""
        feature, threshold = _numbers(self.feature, "int"), _numbers(self.threshold, "double")
        left, right, leaf = _numbers(self.left, "int"), _numbers(self.right, "int"), _numbers(self.leaf, "int")
        steps = F.array_repeat(F.lit(0), self.depth)

        def fall(x: Column, root: Column) -> Column:
            def step(at: Column, _: Column) -> Column:
                asked = F.get(feature, at)
                below = F.when(F.get(x, asked) <= F.get(threshold, at), F.get(left, at)).otherwise(F.get(right, at))
                return F.when(asked < 0, at).otherwise(below)

            return F.get(leaf, F.aggregate(steps, root, step))

        # The vector is unpacked once a row, by its name in the outer function.
        unpacked = F.array(vector_to_array(F.col(features)))
        return F.transform(unpacked, lambda x: F.transform(_numbers(self.roots, "int"), lambda root: fall(x, root)))[0]


class AdaptiveBoostModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Flat trees with their votes; the class with the largest vote wins. All of it are parameters, so it can be stored."""

    feature = Param(Params._dummy(), "feature", "feature a node asks, -1 in a leaf", TypeConverters.toListInt)
    threshold = Param(Params._dummy(), "threshold", "largest value that goes left", TypeConverters.toListFloat)
    left = Param(Params._dummy(), "left", "left child", TypeConverters.toListInt)
    right = Param(Params._dummy(), "right", "right child", TypeConverters.toListInt)
    leaf = Param(Params._dummy(), "leaf", "class of a node", TypeConverters.toListInt)
    roots = Param(Params._dummy(), "roots", "first node of each tree", TypeConverters.toListInt)
    depth = Param(Params._dummy(), "depth", "depth of the deepest tree", TypeConverters.toInt)
    votes = Param(Params._dummy(), "votes", "vote of each tree", TypeConverters.toListFloat)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)
    gains = Param(Params._dummy(), "gains", "importance of each feature, by votes", TypeConverters.toListFloat)

    @classmethod
    def of(cls, trees: FlatTrees, votes, classes: int, gains, features: str, prediction: str) -> AdaptiveBoostModel:
        made = cls()
        made._set(**vars(trees), votes=list(votes), classes=classes, gains=[float(g) for g in gains])
        return made._set(featuresCol=features, predictionCol=prediction)

    def flat(self) -> FlatTrees:
        return FlatTrees(**{n: self.getOrDefault(n) for n in vars(FlatTrees())})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        votes, k = self.getOrDefault(self.votes), self.getOrDefault(self.classes)
        total = sum(votes) or 1.0
        shares = [v / total for v in votes]
        cast = dataset.withColumn("_cast", F.zip_with(
            self.flat().leaves(self.getFeaturesCol()), _numbers(shares, "double"), lambda c, v: F.struct(c.alias("c"), v.alias("v"))
        ))

        def score(c: Column) -> Column:
            given = F.transform("_cast", lambda one: F.when(one["c"] == c, one["v"]).otherwise(one["v"] * (-1.0 / (k - 1))))
            return F.aggregate(given, F.lit(0.0), lambda a, b: a + b)

        scored = cast.withColumn("_score", F.transform(F.sequence(F.lit(0), F.lit(k - 1)), score))
        probability = softmax(F.transform("_score", lambda v: v / (k - 1)))
        best = (F.array_position("_score", F.array_max("_score")) - 1).cast("double")
        return scored.withColumn("probability", array_to_vector(probability)).withColumn(self.getPredictionCol(), best).drop("_score", "_cast")


def softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    raised = F.transform(scores, lambda s: F.exp(s - top))
    return F.transform(raised, lambda v: v / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def estimator(kind: str, params: Mapping, classes: int = 2, label: str = "label", weight: str | None = None) -> Estimator:
    """Untrained learner of a kind.

    Extra trees have no class of their own in Spark: they are a forest without bootstrap.
    Gradient boosting is binary, so several classes are learnt one against the rest.
    """
    common = {"labelCol": label, "featuresCol": "features", "seed": P.SEED, **({"weightCol": weight} if weight else {})}
    if kind == "forest":
        return RandomForestClassifier(**common, **params)
    if kind == "extra_trees":
        return RandomForestClassifier(**common, **{"bootstrap": False, "featureSubsetStrategy": "sqrt", **params})
    if kind == "tree":
        return DecisionTreeClassifier(**common, **params)
    if kind == "adaboost":
        return AdaptiveBoost(labelCol=label, featuresCol="features", seed=P.SEED, **params)
    if kind == "boosting":
        booster = GBTClassifier(**common, **params)
        if classes <= 2:
            return booster
        return OneVsRest(classifier=booster, labelCol=label, featuresCol="features", **({"weightCol": weight} if weight else {}))
    raise ValueError(f"unknown kind {kind}")


def class_total(df: DataFrame, label: str) -> int:
    return int(df.agg(F.max(label)).first()[0]) + 1


def train(df: DataFrame, kind: str, params: Mapping, label: str = "label", weight: str | None = None):
    """Fitted model on a frame with ``features`` and zero-based integer labels."""
    return estimator(kind, params, class_total(df, label), label, weight).fit(df)


def train_stopping(
    df: DataFrame, params: Mapping, id_col: str, label: str = "label", weight: str | None = None,
    share: float = P.VALIDATION_SHARE, seed: int = P.SEED,
):
    """Gradient boosting that ends as soon as the loss of held-back rows no longer falls.

    A ``share`` of each class is held back. No tree is grown on these rows; the trees up to the round of their
    least loss stay. ``maxIter`` is the most rounds, ``validationTol`` the least gain that counts. Of several
    classes each is learnt against the rest and ends by itself.
    """
    held = stratified_split(df, label, share, id_col, seed, out="_held")
    kept = held.select(label, "features", "_held", *([weight] if weight else []))
    rows = checkpoint_table(kept, scratch_path(df.sparkSession, "held"))
    classes = class_total(rows, label)
    if classes <= 2:
        return estimator("boosting", {**params, "validationIndicatorCol": "_held"}, 2, label, weight).fit(rows)
    booster = estimator("boosting", {**params, "validationIndicatorCol": "_held"}, 2, "_one", weight)
    models = [booster.fit(rows.withColumn("_one", (F.col(label) == c).cast("double"))) for c in range(classes)]
    whole = OneVsRest(classifier=booster, labelCol=label, featuresCol="features")
    return whole._copyValues(OneVsRestModel(models=models))


def rounds_of(model) -> list[int]:
    """Trees of a booster, or of each of its classes."""
    return [one.getNumTrees for one in (model.models if isinstance(model, OneVsRestModel) else [model])]


def predict_with_confidence(model, df: DataFrame, pred: str = "prediction", confidence: str = "confidence") -> DataFrame:
    """Predicted class and the probability given to it."""
    scored = model.transform(df)
    if "probability" not in scored.columns:
        scored = scored.withColumn("probability", array_to_vector(softmax(vector_to_array("rawPrediction"))))
    out = scored.withColumn(confidence, F.array_max(vector_to_array("probability")))
    if pred != "prediction":
        out = out.withColumnRenamed("prediction", pred)
    return out.drop("rawPrediction", "probability")


def importances(model) -> np.ndarray:
    """Importance of each feature; they add up to 1, or are all 0 if no tree splits.

    Boosted stumps count by their votes, classes learnt one against the rest all alike.
    """
    if isinstance(model, AdaptiveBoostModel):
        made = np.array(model.getOrDefault(model.gains))
    elif isinstance(model, OneVsRestModel):
        made = sum(importances(one) for one in model.models)
    else:
        made = model.featureImportances.toArray()
    return made / (made.sum() or 1.0)


def importance_table(model, names: Sequence[str], spark) -> DataFrame:
    """Importance per feature with its rank, the largest first."""
    values = importances(model).tolist()
    order = sorted(range(len(names)), key=lambda i: (-values[i], names[i]))
    return spark.createDataFrame(
        [(names[i], float(values[i]), r + 1) for r, i in enumerate(order)], "feature string, importance double, rank int"
    )


def draw_params(space: Mapping[str, Sequence], draws: int, seed: int) -> list[dict]:
    """Distinct random settings; the whole grid if it is not larger than asked."""
    names = sorted(space)
    size = 1
    for n in names:
        size *= len(space[n])
    picks = random.Random(seed).sample(range(size), min(draws, size))
    out = []
    for pick in picks:
        setting = {}
        for n in names:
            pick, at = divmod(pick, len(space[n]))
            setting[n] = space[n][at]
        out.append(setting)
    return out


def random_search(
    df: DataFrame, kind: str, space: Mapping[str, Sequence], draws: int, id_col: str, label: str = "label",
    folds: int = P.FOLDS, seed: int = P.SEED, parallelism: int = 2, weight: str | None = None,
):
    """Best model over random settings by cross-validated macro F1, refitted on all rows.

    Returns the model, its setting, and a list of (setting, score).
    """
    learner = estimator(kind, {}, class_total(df, label), label, weight)
    tuned = learner.getClassifier() if isinstance(learner, OneVsRest) else learner
    settings = draw_params(space, draws, seed)
    maps = [{tuned.getParam(n): v for n, v in s.items()} for s in settings]
    if isinstance(learner, OneVsRest):
        # The inner learner is itself a parameter, so each setting is a whole booster.
        maps = [{learner.classifier: tuned.copy(m)} for m in maps]
    folded = stratified_folds(df, label, folds, id_col, seed)
    rows = checkpoint_table(folded, scratch_path(df.sparkSession, "folds"))
    cv = CrossValidator(
        estimator=learner, estimatorParamMaps=maps, evaluator=MacroF1(label), numFolds=folds, foldCol="fold", parallelism=parallelism
    )
    fitted = cv.fit(rows)
    scores = [float(m) for m in fitted.avgMetrics]
    best = max(range(len(scores)), key=lambda i: scores[i])
    return fitted.bestModel, settings[best], list(zip(settings, scores))
