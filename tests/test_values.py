"""Hand-worked cases of column functions and rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linenet import presets as P
from linenet.functions import values as val
from linenet.operators import cleaning as cl
from linenet.operators import lookups as lk
from linenet.operators import rules as ru
from linenet.operators import schema as sc


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,want", [
    ("000000001", "1"), ("9.5600", "9.56"), ("300.0", "300"), ("1e3", "1000"), ("DN400", "DN400"), (" 12 ", "12"), ("nan", "nan"),
    ("-0.50", "-0.5"), ("5d", "5d"), ("0.0000001", "0"), (None, None),
])
def test_number_text(spark, text, want):
    assert one(spark, lambda c: val.normalize_number_text(c, P.NULL_TOKENS), text) == want


@pytest.mark.parametrize("text,want", [
    ("2013-09-02T00:00:00", 2013), ("15/10/2000", 2000), ("1969/01/31", 1969), ("1990.0", 1990), ("pose 1985", 1985), ("NC", None),
    ("12", None), ("1750", 1750), ("31/02/1750", None), ("15/10/98", 1998), ("15/10/05", 2005), ("", None), (None, None), ("31-12-2020", 2020),
    ("10/15/2000", 2000), ("1500", None),
])
def test_install_year(spark, text, want):
    assert one(spark, lambda c: val.install_year(c, P.NULL_TOKENS), text) == want


@pytest.mark.parametrize("text,want", [("1e400", None), ("5d", None), (" 7.5 ", 7.5), ("nan", None), ("inf", None), (".5", 0.5), ("1,5", None)])
def test_to_double(spark, text, want):
    assert one(spark, val.to_double, text) == want


def test_cut_edges(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (9.0,), (None,)], "c double")
    left = [r[0] for r in rows.select(val.cut(F.col("c"), [1.0, 2.0], list("abc"), right=False)).collect()]
    right = [r[0] for r in rows.select(val.cut(F.col("c"), [1.0, 2.0], list("abc"), right=True)).collect()]
    assert left == ["a", "b", "c", "c", None]
    assert right == ["a", "a", "b", "c", None]
    with pytest.raises(ValueError):
        val.cut(F.col("c"), [1.0], ["a"], right=True)


def test_slope_rules_in_order(spark):
    rows = [
        ("failed up", 150.0, None, 10.0, 1500.0, None),
        ("failed down", None, 150.0, 10.0, -1500.0, None),
        ("computed", 151.0, 150.0, 10.0, None, 10.0),
        ("sign up", 151.0, 150.0, 50.0, -2.0, 2.0),
        ("counter", 150.0, 151.0, 50.0, 3.0, -3.0),
        ("extreme", 160.0, 150.0, 10.0, None, None),
        ("no length", 151.0, 150.0, None, None, None),
        ("zero level", 151.0, 0.0, 10.0, None, None),
        ("kept", None, None, None, 4.0, 4.0),
    ]
    df = spark.createDataFrame(rows, "id string, a double, b double, n double, s double, want double")
    for r in ru.slope_rules(df, "a", "b", "s", "n").collect():
        assert r["s"] == r["want"], r["id"]


def test_plausibility_and_depth(spark):
    rows = [
        (1, 10.0, 9.0, 12.0, 12.0, 1.0, 3.0), (2, 9.0, 10.0, 12.0, 12.0, 1.0, 3.0), (3, 10.0, 9.0, 12.0, 8.0, None, 3.0),
        (4, 10.0, 9.0, 12.0, 12.0, None, 3.0), (5, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, invert_up double, invert_down double, ground_up double, ground_down double, depth_up double, depth_down double")
    out = {r["id"]: r for r in ru.mean_depth(ru.plausibility(df)).collect()}
    assert (out[1]["mean_depth"], out[1]["method"], out[1]["alert"]) == (2.0, P.METHOD_DEPTHS, "")
    assert (out[2]["mean_depth"], out[2]["method"]) == (None, P.METHOD_DEPTHS + P.METHOD_DOUBT)
    assert out[3]["alert"] == P.FLAG_GROUND_DOWN and out[3]["mean_depth"] is None
    assert (out[4]["mean_depth"], out[4]["method"]) == (2.5, P.METHOD_LEVELS)
    assert (out[5]["mean_depth"], out[5]["method"], out[5]["test_depth"]) == (None, "", True)


def test_depth_class_survives_range(spark):
    df = spark.createDataFrame([(12.0,), (-1.0,), (2.0,)], "m double").withColumns({c: F.lit(None).cast("double") for c in "abcdefg"})
    out = ru.depth_fallback(df, [1.0, 5.0], ["1", "2", "3"], "m", ("a", "b"), ("c", "d"), "e", ("f", "g")).select("depth_final", "depth_class").collect()
    assert [tuple(r) for r in out] == [(None, "3"), (None, "1"), (2.0, "2")]


def test_harmonize_later_attribute_wins(spark):
    df = spark.createDataFrame([("x", 1)], "Src string, n int")
    out = sc.harmonize(df, {"A": "Src", "B": "Src", "C": "gone"}, {"A": "string", "B": "string", "C": "double"})
    assert out.first().asDict() == {"A": None, "B": "x", "C": None}


def test_sink_keeps_null(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 2), None), (None, "a")], "t timestamp, s string")
    out = sc.stringify_complex(df).collect()
    assert [tuple(r) for r in out] == [("2020-01-02 00:00:00", None), (None, "a")]


def test_recode_and_unmapped(spark):
    lookup = spark.createDataFrame([("PVC", "P")], "key string, value string")
    df = spark.createDataFrame([(" PVC",), ("X",), ("NC",), (None,)], "m string")
    assert sorted(str(r[0]) for r in lk.recode(df, "m", lookup).collect()) == ["None", "None", "None", "P"]
    assert [r[0] for r in lk.unmapped(df, "m", lookup, P.NULL_TOKENS).collect()] == ["X"]


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("NC",), ("NC",), ("NC",), (None,)], "c string")
    out = [r[0] for r in lk.fill_token_with_mode(df, "c", "NC").collect()]
    assert sorted(v or "" for v in out) == ["", "a", "a", "a", "a", "a", "b", "b"]


def test_is_filled(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert cl.is_filled(df, ["a"]) and not cl.is_filled(df, ["a", "b"]) and not cl.is_filled(df, ["zz"])


def test_repeated_lookup_keys_double_no_row(spark):
    from linenet.operators import lookups

    df = spark.createDataFrame([(1, " a "), (2, "b"), (3, None)], "id long, c string")
    pairs = spark.createDataFrame([("a", "x"), ("a", "y"), ("z", "w")], "key string, value string")
    assert sorted((r.id, r.c) for r in lookups.recode(df, "c", pairs).collect()) == [(1, "y"), (2, None), (3, None)]
    fresh = spark.createDataFrame([(1, "p"), (1, "q"), (2, None)], "id long, c string")
    assert sorted((r.id, r.c) for r in lookups.merge_back(df, fresh, "id", ["c"]).collect()) == [(1, "q"), (2, "b"), (3, None)]
