"""Properties of what SQL cannot check: models, completion and the grid of experiments."""

import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogue import QUERIES
from catalogue.learning import FEATURES, SMALL, inventory, ready
from linenet import presets as P
from linenet.fixtures import Data
from linenet.functions.values import recode_state
from linenet.operators import evaluate as evl
from linenet.operators import models as md
from linenet.plans import completion as co
from linenet.plans import experiment as ex
from linenet.session import scratch_path
from linenet.sources import artifacts as ar
from linenet.sources.tables import checkpoint_table


@pytest.fixture(scope="module")
def data(spark, folder):
    return Data(spark, folder)


@pytest.mark.parametrize("kind", sorted(SMALL))
def test_train_predicts_with_confidence(spark, folder, kind):
    rows = QUERIES[f"train_{kind}"](spark, folder).collect()
    assert len(rows) == 500
    assert all(0 < r["confidence"] <= 1 and r["pred"] in (0, 1, 2, 3) for r in rows)
    # Better than always naming the largest of the four classes.
    assert sum(r["pred"] == r["label"] for r in rows) / len(rows) > 0.3


def test_boosting_learns_a_plain_rule(spark):
    rows = [(i, int(i % 7 > 3), float(i % 7), float(i % 3)) for i in range(300)]
    df = md.assemble(spark.createDataFrame(rows, "id int, label int, a double, b double"), ["a", "b"])
    for kind in ("boosting", "adaboost", "tree", "forest", "extra_trees"):
        out = md.predict_with_confidence(md.train(df, kind, SMALL[kind]), df)
        assert evl.MacroF1().evaluate(out) > 0.9, kind


def test_importance_and_search(spark, folder, data):
    table = QUERIES["feature_importance"](spark, folder).orderBy("rank").collect()
    assert [r["rank"] for r in table] == list(range(1, 7)) and {r["feature"] for r in table} == set(FEATURES)
    assert sum(r["importance"] for r in table) == pytest.approx(1)
    model, setting, scores = md.random_search(ready(data), "boosting", {"maxIter": [2, 3], "maxDepth": [2]}, 5, "id", folds=2)
    assert len(scores) == 2 and setting in [s for s, _ in scores]
    assert max(f for _, f in scores) == dict((str(s), f) for s, f in scores)[str(setting)]
    assert md.draw_params(P.SEARCH_SPACES["forest"], 30, 1) == md.draw_params(P.SEARCH_SPACES["forest"], 30, 1)
    assert len({str(p) for p in md.draw_params(P.SEARCH_SPACES["forest"], 30, 1)}) == 30


def test_artifacts(spark, folder):
    rows = QUERIES["artifact_round_trip"](spark, folder).collect()
    assert len(rows) == 500 and all(r["prediction"] == r["stored"] for r in rows)


def test_thousand_flat_trees_against_a_plain_walk(spark):
    rnd = random.Random(5)
    flat, votes = md.FlatTrees(depth=2), []
    for _ in range(1_000):
        # A root, a leaf on its left and a further question on its right.
        at = len(flat.feature)
        flat.roots.append(at)
        flat.feature += [rnd.randrange(3), -1, rnd.randrange(3), -1, -1]
        flat.threshold += [rnd.random(), 0.0, rnd.random(), 0.0, 0.0]
        flat.left += [at + 1, 0, at + 3, 0, 0]
        flat.right += [at + 2, 0, at + 4, 0, 0]
        flat.leaf += [rnd.randrange(4) for _ in range(5)]
        votes.append(rnd.random())
    model = md.AdaptiveBoostModel.of(flat, votes, 4, [1.0, 1.0, 2.0], "features", "prediction")
    rows = [(i, *(rnd.random() for _ in range(3))) for i in range(60)] + [(60, *flat.threshold[:1] * 3)]
    df = md.assemble(spark.createDataFrame(rows, "id int, a double, b double, c double"), ["a", "b", "c"])
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    for i, *x in rows:
        score = [0.0] * 4
        for root, vote in zip(flat.roots, votes):
            while flat.feature[root] >= 0:
                root = (flat.left if x[flat.feature[root]] <= flat.threshold[root] else flat.right)[root]
            score[flat.leaf[root]] += vote
        assert got[i] == max(range(4), key=lambda c: score[c])
    assert list(md.importances(model)) == [0.25, 0.25, 0.5]


def test_boosting_past_a_rewrite(spark, data):
    """More rounds than go between two writes of the rows; weights stay the plain rule's."""
    rows = checkpoint_table(ready(data), scratch_path(spark, "rows"))
    model = md.train(rows, "adaboost", {"rounds": md.REWRITE + 2, "maxDepth": 1})
    flat, votes = model.flat(), model.getOrDefault(model.votes)
    assert len(votes) == len(flat.roots) == md.REWRITE + 2
    x = [(r["label"], r["features"].toArray()) for r in rows.collect()]
    w = np.full(len(x), 1.0 / len(x))
    for root, vote in zip(flat.roots, votes):
        leaf = [flat.leaf[(flat.left if f[flat.feature[root]] <= flat.threshold[root] else flat.right)[root]] for _, f in x]
        miss = np.array([c != label for c, (label, _) in zip(leaf, x)], dtype=float)
        error = (w * miss).sum() / w.sum()
        assert vote == pytest.approx(np.log((1 - error) / error) + np.log(3))
        w = w * np.exp(miss * vote) / w.sum()


def test_early_stopping(spark, tmp_path):
    """Noise is not learnt for long, a rule is learnt whole, and a stopped model of several classes can be stored."""
    rnd = random.Random(2)
    rows = [(i, i % 3, rnd.randrange(2), float(i % 3), rnd.random()) for i in range(300)]
    df = md.assemble(spark.createDataFrame(rows, "id int, label int, noise int, a double, b double"), ["a", "b"])
    most = {"maxIter": 20, "maxDepth": 3, "stepSize": 0.5}
    # The loss of a rule learnt whole falls for ever, by less and less of it.
    ruled = md.train_stopping(df, {**most, "validationTol": 0.2}, "id")
    assert len(md.rounds_of(ruled)) == 3 and max(md.rounds_of(ruled)) < 20
    assert evl.MacroF1().evaluate(md.predict_with_confidence(ruled, df)) == 1.0
    noisy = md.train_stopping(df, most, "id", label="noise")
    assert md.rounds_of(noisy)[0] < 10
    assert md.rounds_of(md.train(df, "boosting", most, label="noise")) == [20]
    ar.save_artifacts(spark, str(tmp_path / "s"), {"m": ruled}, {}, {})
    again = ar.load_artifacts(spark, str(tmp_path / "s"), ["m"], [])[0]["m"]
    assert md.rounds_of(again) == md.rounds_of(ruled)


def test_store_is_whole_or_absent(spark, data, tmp_path, monkeypatch):
    rows, ins, path = inventory(data), co.Features(FEATURES, ["kind"], logs=["f1"]), str(tmp_path / "store")
    two = P.STATE_LEVELS[:2]
    first = co.stored_levels(rows, "etat", path, ins, "vec_id", "tree", SMALL["tree"], two)
    assert set(first) == {level.name for level in two}

    def no(*_, **__):
        raise AssertionError("trained again")

    monkeypatch.setattr(co, "train", no)
    again = co.stored_levels(rows, "etat", path, ins, "vec_id", "tree", SMALL["tree"], two)
    assert [f.name for f in again.values()] == ["tree", "tree"]
    # A save that ends before its manifest leaves the former one.
    broken = first[two[0].name].donors.select(F.raise_error(F.lit("lost")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        ar.save_artifacts(spark, f"{path}/{two[0].name}", {}, {"donors": broken}, {})
    assert two[0].name in co.load_levels(spark, path)
    # A part that is gone takes its level away.
    level = f"{path}/{two[1].name}"
    shutil.rmtree(f"{level}/{ar.read_manifest(spark, level)['folder']}/codes_0")
    assert set(co.load_levels(spark, path)) == {two[0].name}
    assert co.load_fitted(spark, f"{path}/none") is None


@pytest.mark.parametrize("kind", ["boosting", "adaboost", "tree"])
def test_importances_of_other_learners(spark, data, kind):
    table = md.importance_table(md.train(ready(data), kind, SMALL[kind]), FEATURES, spark).orderBy("rank").collect()
    assert [r["rank"] for r in table] == list(range(1, len(FEATURES) + 1))
    assert sum(r["importance"] for r in table) == pytest.approx(1) and table[0]["importance"] >= table[-1]["importance"] >= 0


def test_completion_never_changes_originals(spark, folder, data):
    before = {r["vec_id"]: r for r in inventory(data).collect()}
    for name, target, known in (
        ("complete_material", "Materiau", lambda v: v is not None), ("complete_age", "classe_age", lambda v: v in (2, 3, 4, 5)),
    ):
        after = QUERIES[name](spark, folder).collect()
        assert len(after) == len(before)
        for r in after:
            old = before[r["vec_id"]]
            assert all(r[c] == old[c] for c in [*FEATURES, "kind"])
            source, conf = r[f"{target}_source"], r[f"{target}_confiance"]
            if known(old[target]):
                assert (r[target], source, conf) == (old[target], P.SOURCE_ORIGINAL, 1.0)
            elif source == P.SOURCE_EXCLUDED:
                assert r[target] is None and conf is None
            else:
                assert source == P.SOURCE_PREDICTED + "forest" and r[target] is not None and 0 < conf <= 1


def test_levels(spark, folder, data):
    before = {r["vec_id"]: r["etat"] for r in inventory(data).collect()}
    after = QUERIES["complete_state"](spark, folder).collect()
    assert len(after) == len(before)
    for r in after:
        old = before[r["vec_id"]]
        assert r["etat"] == old
        if old is not None:
            assert (r["EDS_n1"], r["EDS_n2"], r["EDS_n3"], r["EDS_n1_confiance"]) == (old, int(old == 4), int(old >= 3), 1.0)
        elif r["EDS_n1_source"] == P.SOURCE_EXCLUDED:
            assert (r["EDS_n1"], r["EDS_n1_confiance"]) == (None, 0.0)
        else:
            assert r["EDS_n1"] in (1, 2, 3, 4) and r["EDS_n2"] in (0, 1) and r["EDS_n3"] in (0, 1)


def test_grid_isolates_failures(spark, data):
    rows, ins = inventory(data), co.Features(FEATURES, ["kind"], logs=["f1"])
    with pytest.raises(ValueError):
        ex.run_grid(rows, {"nothing": True}, [], {}, ins, "vec_id", scratch_path(spark, "r"))
    kinds = {"tree": {"maxDepth": 3}, "forest": {"maxDepth": 99}}
    out = ex.run_grid(rows, {"etat": True}, [P.STATE_LEVELS[2].name], kinds, ins, "vec_id", scratch_path(spark, "r"))
    got = {r["model"]: r for r in out.collect()}
    assert got["tree"]["status"] == "ok" and 0 <= got["tree"]["auc"] <= 1 and got["forest"]["status"].startswith("failed")
    assert [r["model"] for r in ex.best_models(out).collect()] == ["tree"]


def test_grid_query_all_cells_ok(spark, folder):
    assert {r["status"] for r in QUERIES["experiment_grid"](spark, folder).collect()} == {"ok"}


def test_grid_goes_on_after_a_bad_level(spark, data):
    ins = co.Features(FEATURES, ["kind"])
    path = scratch_path(spark, "r")
    for _ in range(2):
        assert ex.run_grid(inventory(data), {"etat": True}, ["no such level"], {"tree": {"maxDepth": 3}}, ins, "vec_id", path).count() == 1
    out = ex.run_grid(inventory(data), {"etat": True}, ["no such level", P.STATE_LEVELS[2].name], {"tree": {"maxDepth": 3}}, ins, "vec_id", path)
    got = {r["level"]: r["status"] for r in out.collect()}
    assert out.count() == 2 and got["no such level"].startswith("failed") and got[P.STATE_LEVELS[2].name] == "ok"


def test_split_before_learning(spark, data):
    ins = co.Features(FEATURES, ["kind"])
    learn, test = ex.prepare(inventory(data), "etat", P.STATE_LEVELS[0].name, ins, "vec_id", balance=True)
    held = {r["id"] for r in test.select("id").collect()}
    bases = {r["id"].split("#")[0] for r in learn.select("id").collect()}
    assert held and not held & bases
    sizes = {r["count"] for r in learn.groupBy("label").count().collect()}
    assert len(sizes) == 1
    with pytest.raises(ValueError):
        recode_state(F.col("etat"), "other")
