"""Hand-worked geometry, ties and edges of the spatial joins."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linenet.functions import geometry as geo
from linenet.functions import projection as pj
from linenet.operators import nearest as nn
from linenet.operators import overlay as ov
from linenet.operators import tiles as ti
from linenet.sources import layers as ly


def geoms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, wkt string")
    return df.withColumn("geom", geo.parse_wkt(F.col("wkt")))


def test_wkt_kinds(spark):
    out = geoms(spark, ["LINESTRING (0 0, 3 4)", "MULTILINESTRING ((0 0, 1 0), (5 5, 5 7))", "POINT (1 2)", "LINESTRING EMPTY", None,
                        "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))"])
    rows = {r["id"]: r for r in out.withColumn("n", geo.line_length(F.col("geom"))).withColumn("ok", geo.is_line(F.col("geom"))).collect()}
    assert rows[0]["n"] == 5.0 and rows[1]["n"] == 3.0 and rows[1]["ok"]
    assert [[(v.x, v.y) for v in part] for part in rows[2]["geom"]] == [[(1.0, 2.0)]]
    assert rows[3]["geom"] == [] and rows[4]["geom"] is None
    assert [rows[i]["ok"] for i in (2, 3, 4)] == [False] * 3
    assert [len(ring) for ring in rows[5]["geom"]] == [4, 4]


def test_centroid_of_degenerate(spark):
    out = geoms(spark, ["LINESTRING (1 1, 1 1)", "LINESTRING (0 0, 4 0, 4 4)"]).select("id", geo.line_centroid(F.col("geom")).alias("c"))
    rows = {r["id"]: (r["c"]["x"], r["c"]["y"]) for r in out.collect()}
    assert rows == {0: (1.0, 1.0), 1: (3.0, 1.0)}


def test_clean_vertices(spark):
    out = geoms(spark, ["MULTILINESTRING ((0 0, 0 0, 1 0, 1 0), (2 2, 2 2))"]).select(geo.clean_vertices(F.col("geom")).alias("g")).first()["g"]
    assert [[(v["x"], v["y"]) for v in part] for part in out] == [[(0.0, 0.0), (1.0, 0.0)]]


def test_wkb_round_trip(spark):
    df = geoms(spark, ["LINESTRING (0 0, 3 4)", "MULTILINESTRING ((0 0, 1 0), (5 5, 5 7))", None])
    back = ly.parse_wkb(ly.to_wkb(df.select("id", "geom")))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.select("id", "geom").collect()), key=str)


def test_lambert_known_point(spark):
    df = spark.createDataFrame([(3.0, 46.5), (2.3522, 48.8566)], "x double, y double")
    p = geo.vertex(F.col("x"), F.col("y"))
    out = df.select(pj.reproject_point(p, 4326, 2154).alias("p")).collect()
    assert (out[0]["p"]["x"], out[0]["p"]["y"]) == pytest.approx((700000, 6600000), abs=1e-6)
    assert (out[1]["p"]["x"], out[1]["p"]["y"]) == pytest.approx((652469.02, 6862035.26), abs=0.05)
    with pytest.raises(ValueError):
        pj.reproject_point(p, 3857, 2154)


def test_nearest_tie_takes_first_present(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, 100.0, 0.0), (3, None, 0.0), (4, 2.0, 0.0)], "id int, x double, y double")
    right = spark.createDataFrame(
        [("b", -1.0, 0.0, 5.0), ("a", 1.0, 0.0, None), ("c", 1.0, 0.0, 7.0), ("z", 0.0, 1.5, 9.0)], "k string, x double, y double, v double"
    )
    out = {r["id"]: (r["distance"], r["near_k"], r["near_v"]) for r in nn.nearest_join(left, right, 2.0, ["k", "v"], "k").collect()}
    assert out == {1: (1.0, "a", 5.0), 2: (None, None, None), 3: (None, None, None), 4: (1.0, "a", 7.0)}


def test_nearest_against_brute_force_with_hot_place(spark):
    rnd = random.Random(3)
    right = [(i, 5.0, 5.0) if i % 3 == 0 else (i, round(rnd.uniform(0, 20), 2), round(rnd.uniform(0, 20), 2)) for i in range(300)]
    left = [(i, 5.5, 5.0) if i % 3 == 0 else (i, rnd.uniform(0, 20), rnd.uniform(0, 20)) for i in range(300)]
    out = nn.nearest_join(
        spark.createDataFrame(left, "id int, x double, y double"), spark.createDataFrame(right, "k int, x double, y double"), 1.0, ["k"], "k"
    )
    got = {r["id"]: (r["distance"], r["near_k"]) for r in out.collect()}
    for i, x, y in left:
        best = min((math.sqrt((a - x) ** 2 + (b - y) ** 2), k) for k, a, b in right)
        assert got[i] == (pytest.approx(best[0]), best[1]) if best[0] <= 1 else got[i] == (None, None)


def test_nearest_in_crowded_bins(spark):
    """Many distinct places in one bin, some left rows far from them but within reach."""
    rnd = random.Random(8)
    right = [(i, rnd.gauss(5, 0.05), rnd.gauss(5, 0.05)) for i in range(400)] + [(900, 7.5, 5.0)]
    left = [(i, rnd.gauss(5, 0.06), rnd.gauss(5, 0.06)) for i in range(200)] + [(500, 6.4, 5.0), (501, 9.0, 9.0), (502, 6.9, 5.0)]
    out = nn.nearest_join(
        spark.createDataFrame(left, "id int, x double, y double"), spark.createDataFrame(right, "k int, x double, y double"), 2.0, ["k"], "k",
        leaf=16,
    )
    got = {r["id"]: (r["distance"], r["near_k"]) for r in out.collect()}
    assert len(got) == len(left)
    for i, x, y in left:
        best = min((math.sqrt((a - x) ** 2 + (b - y) ** 2), k) for k, a, b in right)
        assert got[i] == (pytest.approx(best[0]), best[1]) if best[0] <= 2 else got[i] == (None, None)


def test_nearest_odd_coordinates(spark):
    """Infinite, NaN and missing coordinates are near nothing and hide nothing; equal distances in two leaves tie."""
    nan, inf = float("nan"), float("inf")
    right = [("n", nan, 0.0), ("i", inf, 0.0), ("m", None, 0.0), ("b", 1.0, 0.0), ("a", -1.0, 0.0), ("c", 0.0, 1.0), ("f", 0.9, 1.7)]
    left = [(1, 0.0, 0.0), (2, nan, 0.0), (3, inf, 0.0), (4, None, None)]
    lefts, rights = spark.createDataFrame(left, "id int, x double, y double"), spark.createDataFrame(right, "k string, x double, y double")
    for leaf in (1, 256):
        out = {r["id"]: (r["distance"], r["near_k"]) for r in nn.nearest_join(lefts, rights, 4.0, ["k"], "k", leaf=leaf).collect()}
        assert out == {1: (1.0, "a"), 2: (None, None), 3: (None, None), 4: (None, None)}
        assert nn.nearest_join(lefts, rights.limit(0), 4.0, ["k"], "k", leaf=leaf).filter("distance IS NULL").count() == 4


def test_dense_cluster_is_near_linear(spark):
    """100 000 places on a spot of a thousandth of the distance: each asked place meets few of them."""
    n = 100_000
    u = (F.xxhash64("id", F.lit(1)).cast("double") / 2.0**63) * 1e-3
    v = (F.xxhash64("id", F.lit(2)).cast("double") / 2.0**63) * 1e-3
    right = spark.range(n).select(F.col("id").alias("k"), u.alias("x"), v.alias("y"))
    asked = spark.range(n, n + 4_000).select("id", u.alias("x"), v.alias("y"))
    places = right.select(F.col("x").alias("_rx"), F.col("y").alias("_ry"), F.struct("k").alias("_r_k"))
    levels = nn.bin_tree(places, [], 1.0)
    assert levels[-1][1].filter("_split").isEmpty()
    assert nn._meet(asked, levels, [], "x", "y", 1.0).count() < 4_000 * n / 100
    got = {r["id"]: r["near_k"] for r in nn.nearest_join(asked, right, 1.0, ["k"], "k").filter("id % 40 = 0").collect()}
    r = np.array([[a["k"], a["x"], a["y"]] for a in right.collect()])
    for a in asked.filter("id % 40 = 0").collect():
        d = np.sqrt((r[:, 1] - a["x"]) ** 2 + (r[:, 2] - a["y"]) ** 2)
        assert got[a["id"]] == int(r[d == d.min(), 0].min())


def test_nearest_by_city(spark):
    left = spark.createDataFrame([(1, "A", 0.0, 0.0), (2, "B", 0.0, 0.0)], "id int, city string, x double, y double")
    right = spark.createDataFrame([("m", "A", 0.5, 0.0)], "k string, city string, x double, y double")
    out = {r["id"]: r["near_k"] for r in nn.nearest_join(left, right, 2.0, ["k"], "k", partition=["city"]).collect()}
    assert out == {1: "m", 2: None}


BOX = "MULTILINESTRING (({0} {1}, {2} {1}, {2} {3}, {0} {3}, {0} {1}))"


def test_overlay_rules(spark):
    polys = geoms(spark, [BOX.format(0, 0, 10, 10), BOX.format(5, -5, 30, 15), BOX.format(-20, 0, 0, 10)]).select(
        F.col("id").alias("poly_id"), (F.col("id") % 2 + 1).alias("value"), F.col("geom").alias("rings")
    )
    lines = geoms(spark, [
        "LINESTRING (1 1, 4 1)",     # in 0 only: 1
        "LINESTRING (6 1, 9 1)",     # in 0 and 1: the larger value, 2
        "LINESTRING (-3 5, 3 5)",    # 0 and 2 equally long: the first, 1
        "LINESTRING (100 100, 101 100)",
        "LINESTRING (8 12, 8 20)",   # partly in 1: 2
        None,
    ])
    got = {r["id"]: r["v"] for r in ov.overlay_largest(lines, polys, "id", 7.0, 0, "v").collect()}
    assert got == {0: 1, 1: 2, 2: 1, 3: 0, 4: 2, 5: None}


def blob(rnd, n, x, y, r):
    """A star-shaped ring of whole or broken coordinates."""
    whole = rnd.random() < 0.5
    points = []
    for i in range(n):
        a, d = 2 * math.pi * i / n, r * rnd.uniform(0.4, 1)
        px, py = x + d * math.cos(a), y + d * math.sin(a)
        points.append((float(round(px)), float(round(py))) if whole else (px, py))
    return [*points, points[0]]


def text(kind, parts):
    return f"{kind} (" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in p) + ")" for p in parts) + ")"


@pytest.mark.parametrize("size", [3.0, 10.0, 64.0])
def test_overlay_against_whole_polygons(spark, size):
    """Bins against every line met with every whole polygon: holes, borders on bin borders, lines along edges and through vertices."""
    rnd = random.Random(size)
    rings = [[blob(rnd, rnd.choice([3, 5, 9, 40]), rnd.uniform(-60, 60), rnd.uniform(-60, 60), rnd.uniform(3, 60))] for _ in range(12)]
    rings += [[[(-30.0, -30.0), (60.0, -30.0), (60.0, 30.0), (-30.0, 30.0), (-30.0, -30.0)], [(-10.0, -20.0), (20.0, -20.0), (20.0, 10.0), (-10.0, 10.0), (-10.0, -20.0)]]]
    lines = [[(rnd.uniform(-90, 90), rnd.uniform(-90, 90)) for _ in range(rnd.choice([2, 2, 3, 6]))] for _ in range(60)]
    lines += [[(float(rnd.randrange(-70, 70)), float(rnd.randrange(-70, 70))) for _ in range(3)] for _ in range(60)]
    lines += [[(-30.0, 0.0), (60.0, 0.0)], [(60.0, -30.0), (60.0, 30.0)], [(60.0, 30.0), (60.0, -30.0)], [(-30.0, -30.0), (20.0, 10.0)], [(-40.0, 30.0), (70.0, 30.0)], [(5.0, 5.0), (5.0, 5.0)], [(-30.0, 10.0), (20.0, 10.0)]]
    polys = geoms(spark, [text("POLYGON", r) for r in rings]).select(F.col("id").alias("poly_id"), F.col("id").alias("value"), F.col("geom").alias("rings"))
    shapes = geoms(spark, [text("MULTILINESTRING", [x]) for x in lines])
    every = shapes.select("id", "geom", F.lit(1).alias("k")).join(polys.withColumn("k", F.lit(1)), "k")
    want = {(r["id"], r["poly_id"]): r["n"] for r in every.select("id", "poly_id", geo.clip_length(F.col("geom"), geo.line_pieces(F.col("rings"))).alias("n")).collect()}
    rows = ov.lengths_inside(shapes, polys, "id", size).collect()
    got = {(r["id"], r["poly_id"]): r["clip_length"] for r in rows}
    assert len(got) == len(rows)
    point = len(lines) - 2
    for k, n in want.items():
        if k[0] != point:
            assert got.get(k, 0.0) == pytest.approx(n, abs=1e-6), (k, lines[k[0]], rings[k[1]])
    inside = every.filter(F.col("id") == point).select("poly_id", geo.point_in_polygon(F.lit(5.0), F.lit(5.0), F.col("rings")).alias("n")).collect()
    assert {p for i, p in got if i == point} == {r["poly_id"] for r in inside if r["n"]}
    # Turning a line round changes nothing, also along a border.
    back = geoms(spark, [text("MULTILINESTRING", [x[::-1]]) for x in lines])
    for r in ov.lengths_inside(back, polys, "id", size).collect():
        assert r["clip_length"] == pytest.approx(got[r["id"], r["poly_id"]], abs=1e-6)


def test_overlay_of_a_polygon_with_very_many_vertices(spark):
    n, r = 100_000, 5000.0
    a = F.col("id") * (2 * math.pi / n)
    far = F.lit(r) * (1 + 0.1 * F.sin(a * 7))
    ring = spark.range(n + 1).withColumn("id", F.col("id") % n).select(F.struct((far * F.cos(a)).alias("x"), (far * F.sin(a)).alias("y")).alias("v"), F.monotonically_increasing_id().alias("i"))
    hole = geo.box_ring(F.lit(-50.0), F.lit(-50.0), F.lit(50.0), F.lit(50.0))
    polys = ring.agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("l")).select(F.lit(1).alias("poly_id"), F.lit(3).alias("value"), F.concat(F.array(F.transform("l", lambda x: x["v"])), hole).alias("rings"))
    polys = spark.createDataFrame(polys.collect(), polys.schema)
    lines = geoms(spark, ["LINESTRING (-9000 0, 9000 0)", "LINESTRING (100 100, 900 700)", "LINESTRING (0 -20, 30 20)", "LINESTRING (6000 6000, 7000 7000)"])
    got = {x["id"]: x["clip_length"] for x in ov.lengths_inside(lines, polys, "id", 100.0).collect()}
    assert got == {0: pytest.approx(2 * r - 100, abs=1e-3), 1: pytest.approx(1000.0)}
    plan = ov.lengths_inside(lines, polys, "id", 100.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and plan.count("line_pieces") == 0


def test_clip_respects_holes(spark):
    rings = geoms(spark, ["POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 0.5, 6 0.5, 6 9, 4 9, 4 0.5))"]).first()["wkt"]
    df = geoms(spark, ["LINESTRING (-5 5, 15 5)", "LINESTRING (1 1, 3 3)", "LINESTRING (4.5 5, 5.5 5)", "LINESTRING (-5 5, 5 5, 5 20)"])
    edges = geo.line_pieces(geo.parse_wkt(F.lit(rings)))
    got = {r["id"]: r["n"] for r in df.select("id", geo.clip_length(F.col("geom"), edges).alias("n")).collect()}
    assert got == {0: pytest.approx(8.0), 1: pytest.approx(2 * math.sqrt(2)), 2: 0.0, 3: pytest.approx(4.0 + 1.0)}


def test_point_on_edge_is_outside(spark):
    df = spark.createDataFrame([(0.0, 5.0), (5.0, 10.0), (5.0, 5.0), (10.0, 10.0), (11.0, 5.0)], "x double, y double")
    ring = geo.box_ring(*[F.lit(v) for v in (0.0, 0.0, 10.0, 10.0)])
    assert [r[0] for r in df.select(geo.point_in_polygon(F.col("x"), F.col("y"), ring)).collect()] == [False, False, True, False, False]


def raster(spark):
    tiles = spark.createDataFrame([(0, 0.0, 0.0, 30.0, 30.0, 10.0, 3, 3), (1, 20.0, 0.0, 50.0, 30.0, 10.0, 3, 3)],
                                  "tile_id int, xmin double, ymin double, xmax double, ymax double, cell double, nrows int, ncols int")
    cells = [(t, r, c, float(100 * t + 10 * r + c) if (t, r, c) != (0, 1, 1) else None) for t in (0, 1) for r in range(3) for c in range(3)]
    return tiles, spark.createDataFrame(cells, "tile_id int, row int, col int, value double")


def test_raster_sample_edges_and_overlap(spark):
    tiles, cells = raster(spark)
    points = spark.createDataFrame([(1, 5.0, 25.0), (2, 15.0, 15.0), (3, 0.0, 5.0), (4, 25.0, 25.0), (5, 90.0, 5.0)], "id int, x double, y double")
    got = {r["id"]: r["value"] for r in ti.sample_raster(points, tiles, cells, "id", 13.0).collect()}
    assert got == {1: 0.0, 2: None, 3: None, 4: 100.0, 5: None}


def test_zonal_counts_each_cell_once(spark):
    tiles, cells = raster(spark)
    lines = geoms(spark, ["LINESTRING (5 25, 5 15, 5 25, 6 24)", "LINESTRING (500 500, 510 500)", "LINESTRING (5 25, 5 24)"])
    got = {r["id"]: (r["mean"], r["n_cells"]) for r in ti.zonal_mean(lines, tiles.filter("tile_id = 0"), cells, 1.0, "id", 20.0).collect()}
    assert got == {0: (5.0, 2), 1: (0.0, 0), 2: (0.0, 1)}


def test_zonal_of_a_line_with_thousands_of_vertices(spark):
    tiles, cells = raster(spark)
    zigzag = [(0.5 + 0.005 * i, 25.0 if i % 2 else 15.5) for i in range(5000)]
    lines = geoms(spark, [text("MULTILINESTRING", [zigzag]), "LINESTRING (5 25, 5 24)"])
    got = {r["id"]: (r["mean"], r["n_cells"]) for r in ti.zonal_mean(lines, tiles.filter("tile_id = 0"), cells, 1.0, "id", 20.0).collect()}
    assert got == {0: (pytest.approx((0 + 1 + 2 + 10 + 12) / 5), 5), 1: (0.0, 1)}


def test_zonal_against_brute_force(spark):
    rnd = random.Random(5)
    tiles, cells = raster(spark)
    tiles = tiles.filter("tile_id = 0")
    texts, shapes = [], []
    for _ in range(40):
        pts = [(rnd.uniform(-5, 35), rnd.uniform(-5, 35)) for _ in range(rnd.choice([2, 3, 5]))]
        shapes.append(pts)
        texts.append("LINESTRING (" + ", ".join(f"{x!r} {y!r}" for x, y in pts) + ")")

    def near(pts, box, r):
        # Dense sampling along the line, good to well under the margin left out below.
        best = 1e9
        for (x0, y0), (x1, y1) in zip(pts, pts[1:]):
            for i in range(2001):
                x, y = x0 + (x1 - x0) * i / 2000, y0 + (y1 - y0) * i / 2000
                best = min(best, math.hypot(max(box[0] - x, 0, x - box[2]), max(box[1] - y, 0, y - box[3])))
        return best

    got = {r["id"]: r["n"] for r in ti.touched_cells(geoms(spark, texts), tiles, 2.0, "id", 11.0).groupBy("id").agg(F.count("*").alias("n")).collect()}
    for i, pts in enumerate(shapes):
        d = [near(pts, (10 * c, 20 - 10 * r, 10 * c + 10, 30 - 10 * r), 2.0) for r in range(3) for c in range(3)]
        if all(abs(v - 2.0) > 0.05 for v in d):
            assert got.get(i, 0) == sum(v <= 2.0 for v in d), texts[i]
