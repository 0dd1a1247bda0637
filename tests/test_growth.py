"""What a plan must not do as its input grows: gather a hot key in one task, or run what the JVM won't compile."""

import contextlib
import io
import re
import struct
import warnings

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import catalogue
from linenet.functions import geometry as geo
from linenet.functions import values as val
from linenet.operators import boxes as bx
from linenet.operators import nearest as nn
from linenet.operators import neighbours as nb
from linenet.operators import profiles as pr
from linenet.operators import sampling as sp
from linenet.operators import tiles as ti
from linenet.sources import layers as ly

LONGEST = 8000  # bytes of a method that the JVM still compiles


def longest_method(df) -> int:
    text = io.StringIO()
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(text):
            df.select(*df.columns).explain("codegen")
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue()))


def first_plan(df) -> str:
    """The plan before anything is measured."""
    return df._jdf.queryExecution().sparkPlan().toString()


def grid(spark):
    """Four tiles of 5 x 5 cells of 2 m, out of a table whose size Spark can't know."""
    return spark.range(10_000_000).select((F.col("id") % 4).cast("int").alias("tile_id")).distinct().select(
        "tile_id", ((F.col("tile_id") % 2) * 10.0).alias("xmin"), (F.floor(F.col("tile_id") / 2) * 10.0).alias("ymin"),
        ((F.col("tile_id") % 2) * 10.0 + 10).alias("xmax"), (F.floor(F.col("tile_id") / 2) * 10.0 + 10).alias("ymax"),
        F.lit(2.0).alias("cell"), F.lit(5).alias("nrows"), F.lit(5).alias("ncols"),
    )


def cells(spark):
    """Every cell twice, one of them and those of the last row without a value."""
    at = spark.range(4 * 25 * 2).select(
        (F.col("id") % 4).cast("int").alias("tile_id"), (F.floor(F.col("id") / 4) % 5).cast("int").alias("row"),
        (F.floor(F.col("id") / 20) % 5).cast("int").alias("col"),
    )
    return at.withColumn("value", F.when((F.col("row") < 4) & ~F.expr("row = 1 AND col = 1"), F.col("tile_id") * 100.0 + F.col("row") * 10 + F.col("col")))


def test_zonal_is_compiled(spark):
    lines = spark.range(10).select("id", geo.two_point_line(F.col("id"), F.col("id"), F.col("id") + 5, F.col("id") + 3).alias("geom"))
    assert longest_method(ti.zonal_mean(lines, grid(spark), cells(spark), 1.0, "id", 10.0)) < LONGEST


def test_zonal_of_overlapping_pieces(spark):
    """Lines that run back over themselves, share a key, or have none; cells that come twice count once."""
    texts = [
        (1, "LINESTRING (0.5 0.5, 19.5 1.5, 0.5 2.5, 19.5 0.5)"), (1, "LINESTRING (15 1, 15 19)"), (None, "LINESTRING (3 3, 3 3.5)"),
        (2, "LINESTRING (-9 -9, -8 -8)"), (3, "LINESTRING (5 5, 5 5)"), (4, None), (5, "LINESTRING (2 9, 18 9)"),
    ]
    lines = spark.createDataFrame(texts, "id int, t string").select("id", geo.parse_wkt(F.col("t")).alias("geom"))
    tiles, held, r = grid(spark), cells(spark), 1.0
    got = {x["id"]: (x["mean"], x["n_cells"]) for x in ti.zonal_mean(lines, tiles, held, r, "id", 10.0).collect()}
    boxes = tiles.join(held.dropDuplicates(["tile_id", "row", "col"]).dropna(subset=["value"]), "tile_id").select(
        "tile_id", "row", "col", "value", (F.col("xmin") + F.col("col") * 2).alias("x"), (F.col("ymax") - (F.col("row") + 1) * 2).alias("y")
    )
    pieces = lines.select("id", F.explode(geo.line_pieces(F.col("geom"))).alias("p"))
    near = geo.dist_seg_square(F.col("p"), F.col("x"), F.col("y"), F.col("x") + 2, F.col("y") + 2) <= r
    met = pieces.crossJoin(boxes).filter(near).select("id", "tile_id", "row", "col", "value").distinct()
    want = {x["id"]: (x["m"], x["n"]) for x in met.groupBy("id").agg(F.avg("value").alias("m"), F.count("*").alias("n")).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for key, (mean, n) in got.items():
        m, many = want.get(key, (0.0, 0))
        assert n == many and mean == pytest.approx(m), key


def test_points_meet_few_tiles_without_gathering(spark):
    points = spark.range(1_000_000).select("id", (F.col("id") % 20 + 0.5).alias("x"), (F.col("id") % 19 + 0.5).alias("y"))
    met = ti.points_in_boxes(points, grid(spark), 10.0)
    assert "SortMergeJoin" not in first_plan(met) and "BroadcastHashJoin" in first_plan(met)
    assert met.filter("t_tile_id IS NULL").count() == 0 and met.count() == 1_000_000


@pytest.mark.parametrize("made", [lambda df: sp.stratified_split(df, "y", 0.2, "id", 1), lambda df: sp.stratified_folds(df, "y", 3, "id", 1)])
def test_classes_are_not_gathered(spark, made):
    df = spark.range(3_000_000).select("id", F.when(F.col("id") % 5 > 0, F.lit("hot")).alias("y"))
    assert "SortMergeJoin" not in first_plan(made(df))


def test_years_are_read_once_and_compiled(spark):
    texts = ["15/10/1990", "2001-09-02T00:00:00", "pose 1975", "31/12/99", "NC", None, "1700", "1990.0"]
    df = spark.createDataFrame([(t,) for t in texts for _ in range(3)], "t string")
    dated = df.select(val.install_year(F.col("t"), ["NC"]).alias("y"))
    assert longest_method(dated) < LONGEST
    # The summary itself works on counts alone.
    out = pr.year_summary(dated, "y", 1880, 2025)
    assert "rlike" not in first_plan(out).lower()
    row, years = out.first(), [1990, 2001, 1975, 1999, 1990]
    assert row["n"] == 15 and row["mean_year"] == pytest.approx(sum(years) / 5) and row["median_year"] == 1990
    assert row["mean_age"] == pytest.approx(2025 - sum(years) / 5)
    none = pr.year_summary(dated.filter("y < 0"), "y", 1880, 2025).first()
    assert none["n"] == 0 and none["mean_year"] is None and none["median_year"] is None


def test_zonal_of_lines_without_a_coordinate(spark):
    """A missing coordinate bounds nothing; the cells are those that the column expressions found."""
    n, d = F.lit(None).cast("double"), lambda v: F.lit(v).cast("double")
    ends = [(d(3), d(3), n, d(3.5)), (d(3), d(3), d(9), n), (n, d(3), d(4), d(8)), (n, n, d(4), d(8))]
    rows = F.array(*[F.struct(F.lit(i).alias("id"), geo.two_point_line(*e).alias("geom")) for i, e in enumerate(ends)])
    lines = spark.range(1).select(F.inline(rows))
    got = {r["id"]: (r["mean"], r["n_cells"]) for r in ti.zonal_mean(lines, grid(spark), cells(spark), 1.0, "id", 10.0).collect()}
    assert {k: v[1] for k, v in got.items()} == {0: 10, 1: 5, 2: 19, 3: 9}
    assert [got[i][0] for i in range(4)] == pytest.approx([27.0, 27.2, 329 / 19, 59 / 9])


def test_zonal_moves_a_key_once_for_a_tile(monkeypatch):
    """Pieces of a key that come together leave one row for each tile, with each block once; a key without cells leaves one row."""
    nan = float("nan")
    keys, tiles = ["a", "a", None, "a", "b", None, "c", "a"], [0, 0, 0, 1, None, 0, None, 0]
    ends = [(1, 1, 30, 1), (1, 1, 1, 99), (1, 1, 1, 1), (45, 1, 45, 1), (1, 1, 2, 2), (55, 1, 55, 1), (1, 1, 2, 2), (30, 1, 1, 1)]
    columns = {"k": pa.array(keys), "tile_id": pa.array(tiles, pa.int32())}
    columns |= {f"_p{c}": pa.array([float(e[i]) for e in ends]) for i, c in enumerate(("x0", "y0", "x1", "y1"))}
    columns |= {c: pa.array([nan if t is None else v for t in tiles], from_pandas=True) for c, v in (("t_xmin", 0.0), ("t_ymax", 100.0), ("t_cell", 10.0), ("t_nrows", 10.0), ("t_ncols", 10.0))}
    batch = pa.RecordBatch.from_pydict(columns)

    def cells(rows):
        of = {}
        for r in rows:
            for block, mask in zip(r["_blocks"], r["_masks"], strict=True):
                row, col = (block >> 32) * ti.BLOCK_ROWS, (block & 0xFFFFFFFF) * ti.BLOCK_COLS
                at = {(row + i // ti.BLOCK_COLS, col + i % ti.BLOCK_COLS) for i in range(64) if mask >> i & 1}
                of.setdefault((r["k"], r["tile_id"]), set()).update(at)
        return of

    want = {
        ("a", 0): {(9, c) for c in range(4)} | {(r, 0) for r in range(10)}, ("a", 1): {(9, 4)},
        (None, 0): {(9, 0), (9, 5)}, ("b", None): set(), ("c", None): set(),
    }
    rows = [r for b in ti._blocks(1.0, "k")(iter([batch])) for r in b.to_pylist()]
    assert len(rows) == len(want) and cells(rows) == want
    assert all(len(r["_blocks"]) == len(set(r["_blocks"])) for r in rows)
    for most in (1, 5):
        monkeypatch.setattr(ti, "CELLS_AT_ONCE", most)
        assert cells(r for b in ti._blocks(1.0, "k")(iter([batch])) for r in b.to_pylist()) == want


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_zonal_holds_cells_of_reached_tiles_alone(spark, limit):
    """Keys that repeat or miss, lines of many pieces, without place or cells, by joins of either kind; nothing is sorted by line."""
    rnd = np.random.default_rng(6)
    tiles = spark.createDataFrame(
        [(t, x, y, x + 40.0, y + 40.0, 4.0, 10, 10) for t, (x, y) in enumerate([(0.0, 0.0), (30.0, 0.0), (0.0, 40.0), (900.0, 900.0)])],
        "tile_id int, xmin double, ymin double, xmax double, ymax double, cell double, nrows int, ncols int",
    )
    rows = [(t, r, c, float(rnd.integers(100)) if rnd.random() < 0.8 else None) for t in range(4) for r in range(12) for c in range(10)]
    held = spark.createDataFrame(rows, "tile_id int, row int, col int, value double")
    texts = [(int(k), "LINESTRING (%s)" % ", ".join("%f %f" % tuple(rnd.uniform(-10, 80, 2)) for _ in range(n))) for k, n in zip(rnd.integers(0, 30, 40), rnd.integers(2, 6, 40), strict=True)]
    texts += [(None, "LINESTRING (1 1, 9 9)"), (None, "LINESTRING (60 1, 62 9)"), (None, "LINESTRING (1 1, 9 8)"), (91, None), (91, None), (92, "LINESTRING (500 500, 501 501)"), (93, "LINESTRING EMPTY"), (94, "LINESTRING (3 3)")]
    lines = spark.createDataFrame(texts, "id int, t string").select("id", geo.parse_wkt(F.col("t")).alias("geom")).repartition(3)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        made = ti.zonal_mean(lines, tiles, held, 3.0, "id", 15.0)
        plan = first_plan(made)
        got = {x["id"]: (x["mean"], x["n_cells"]) for x in made.collect()}
        _, met = ti._pairs(lines, tiles, 3.0, "id", 15.0, "geom", "left")
        assert {r[0] for r in ti._cell_blocks(held, met).select("tile_id").distinct().collect()} == {0, 1, 2}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Window" not in plan and "Union" not in plan
    boxes = tiles.join(held.filter("row < 10").dropna(subset=["value"]), "tile_id").select(
        "tile_id", "row", "col", "value", (F.col("xmin") + F.col("col") * 4).alias("x"), (F.col("ymax") - (F.col("row") + 1) * 4).alias("y")
    )
    pieces = lines.select("id", F.explode(geo.line_pieces(F.col("geom"))).alias("p"))
    near = geo.dist_seg_square(F.col("p"), F.col("x"), F.col("y"), F.col("x") + 4, F.col("y") + 4) <= 3.0
    met = pieces.crossJoin(boxes).filter(near).select("id", "tile_id", "row", "col", "value").distinct()
    want = {x["id"]: (x["m"], x["n"]) for x in met.groupBy("id").agg(F.avg("value").alias("m"), F.count("*").alias("n")).collect()}
    assert set(got) == {k for k, _ in texts} and sum(n > 0 for _, n in got.values()) == len(want)
    for key, (mean, n) in got.items():
        m, many = want.get(key, (0.0, 0))
        assert n == many and mean == pytest.approx(m), key


def test_areas_are_coded_together(monkeypatch):
    """Shells, holes, an island in a hole, rings in any order, none and null, in shares of any size."""

    def square(x, y, r):
        return [(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r), (x - r, y - r)]

    def polygon(*rings):
        return struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + struct.pack(f"<{2 * len(r)}d", *sum(r, ())) for r in rings)

    def multi(*polygons):
        return struct.pack("<BII", 1, 6, len(polygons)) + b"".join(polygons)

    shell, hole, island, far, pit = square(0, 0, 10), square(0, 0, 6), square(0, 0, 2), square(50, 0, 5), square(50, 0, 1)
    given = [[shell], [hole, shell], [], None, [pit, island, far, hole, shell]]
    want = [
        polygon(shell), polygon(shell, hole), multi(), None,
        multi(polygon(island), polygon(far, pit), polygon(shell, hole)),
    ]
    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    rows = [g and [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in g] for g in given]
    for most in (1, 7, 131_072):
        monkeypatch.setattr(ly, "AT_ONCE", most)
        assert ly._encode_polygons(pa.array(rows, kind)).to_pylist() == want


def test_areas_are_decoded_together(monkeypatch):
    """Plain areas don't go one by one, whatever lies between them; every value is what it is alone."""

    def ring(*at, order="<", more=0):
        return struct.pack(order + "I", len(at) + more) + struct.pack(f"{order}{2 * len(at)}d", *sum(at, ()))

    def shape(kind, *parts, order="<", n=None):
        return struct.pack(order + "BII", order == "<", kind, len(parts) if n is None else n) + b"".join(parts)

    box, hole, spot = ring((0, 0), (9, 0), (9, 9), (0, 0)), ring((2, 1), (3, 1), (3, 2), (2, 1)), ring()
    line = struct.pack("<BI", 1, 2) + ring((1, 2), (3, 4))
    plain = [
        shape(3, box), shape(3, box, hole), shape(3), shape(3, spot, box), shape(6, shape(3, box, hole), shape(3), shape(3, hole)), line, shape(5, line, line),
        shape(3, *[hole] * ly.FEW_PARTS), shape(3, box) + b"tail",
    ]
    others = [
        shape(6), shape(3, *[hole] * (ly.FEW_PARTS + 1), box), shape(6, shape(3, box), line), shape(3, ring((1, 2), (3, 4), order=">"), order=">"),
        shape(3, ring((1, 2), more=1)), shape(3, box, n=2), shape(3, box)[:-1], shape(6, shape(3, box), n=3), shape(6, shape(3, box), shape(4)), shape(7, line), b"\1", b"", None,
    ]
    every = [v for pair in zip(plain * 2, others * 2, strict=False) for v in pair] + plain + others
    def by_itself(v):
        parts = []
        try:
            ly._read(v or b"", 0, parts)
        except (ValueError, IndexError, struct.error):
            return None
        return [[{"x": x, "y": y} for x, y in part.tolist()] for part in parts]

    alone = {v: by_itself(v) for v in every}
    assert alone[plain[1]] == [[{"x": float(x), "y": float(y)} for x, y in r] for r in ([(0, 0), (9, 0), (9, 9), (0, 0)], [(2, 1), (3, 1), (3, 2), (2, 1)])]
    assert [len(alone[v]) for v in plain] == [1, 2, 0, 2, 3, 1, 2, 64, 1]
    assert [alone[v] and len(alone[v]) for v in others] == [[], 66, 2, 1, *[None] * 9]
    assert ly._decode(pa.array([None, *every], pa.binary())[1:]).to_pylist() == [alone[v] for v in every]
    monkeypatch.setattr(ly, "_read", lambda *_: pytest.fail("one by one"))
    assert ly._decode(pa.array([*plain, None], pa.binary())).to_pylist() == [*[alone[v] for v in plain], None]


def test_points_meet_areas_in_arrays(spark, monkeypatch):
    """One pass for several points; missing, infinite and odd numbers as in column expressions."""
    rnd, odd = np.random.default_rng(4), [None, float("nan"), float("inf"), float("-inf")]

    def number(bad):
        return odd[rnd.integers(4)] if rnd.random() < bad else float(rnd.integers(-3, 4)) + float(rnd.choice([0, 0.5]))

    def ring(bad):
        r = [None if rnd.random() < bad / 3 else (number(bad), number(bad)) for _ in range(rnd.integers(1, 6))]
        return r + r[:1]

    rows = []
    for i in range(3000):
        bad = float(rnd.choice([0, 0, 0.2]))
        rows.append((i, number(bad), number(bad), [ring(bad) for _ in range(rnd.integers(0, 4))]))
    df = spark.createDataFrame([*rows, (-1, 1.0, 1.0, None), (-2, 1.0, 1.0, [None])], f"id int, px double, py double, g {geo.GEOM}")
    each = df.select("id", "px", "py", "g", F.explode_outer(geo.line_pieces(F.col("g"))).alias("e")).select("*", "e.*")
    e = {c: F.col(c) for c in ("x0", "y0", "x1", "y1", "px", "py")}
    cross = ((e["y0"] > e["py"]) != (e["y1"] > e["py"])) & (e["px"] < e["x0"] + (e["py"] - e["y0"]) / (e["y1"] - e["y0"]) * (e["x1"] - e["x0"]))
    level = (e["x1"] - e["x0"]) * (e["py"] - e["y0"]) - (e["y1"] - e["y0"]) * (e["px"] - e["x0"]) == 0
    touch = level & e["px"].between(F.least("x0", "x1"), F.greatest("x0", "x1")) & e["py"].between(F.least("y0", "y1"), F.greatest("y0", "y1"))
    met = each.groupBy("id").agg(F.count(F.when(cross, 1)).alias("n"), F.max(touch).alias("on"), F.count(F.when(F.col("e").isNotNull() & touch.isNull(), 1)).alias("open"))
    want = {}
    for r in met.collect():
        inside = r["n"] % 2 == 1
        want[r["id"]] = False if not inside or r["on"] else None if r["open"] else True
    want[-1] = want[-2] = None
    g = F.col("g")
    for most in (1, 7, 131_072):
        monkeypatch.setattr(geo, "EDGES_AT_ONCE", most)
        t = df.toArrow()
        columns = [t[c].combine_chunks() for c in ("px", "py", "g")]
        assert dict(zip(t["id"].to_pylist(), geo._holds(*columns).to_pylist(), strict=True)) == want
    # Answers of a bit each wait in Python while Spark keeps their rows on disk.
    assert geo._holds(*columns).type == pa.int64()
    both = df.select("id", geo.point_in_polygon(F.col("px"), F.col("py"), g).alias("a"), geo.point_in_polygon(F.col("px") + 0, F.col("py"), g).alias("b"))
    plan = first_plan(both)
    assert plan.count("ArrowEvalPython") == 1 and "lambda" not in plan
    assert {r["id"]: r["a"] for r in both.collect()} == want == {r["id"]: r["b"] for r in both.collect()}


def _points(rng, n, d=5):
    x = rng.integers(-3, 4, (n, d)).astype(float) + rng.choice([0, 1e-9, 0.25], (n, d))
    x[rng.random(x.shape) < 0.2] = np.nan
    return x


def test_few_pairs_are_measured(monkeypatch):
    """Of all pairs in a leaf only those that may count are measured one by one; the answer is that of all."""
    rng, exact, pairs = np.random.default_rng(3), nb._exact, []
    donors, q, k = rng.normal(size=(4000, 7)), rng.normal(size=(200, 7)), 7
    donors[rng.random(donors.shape) < 0.1] = np.nan
    monkeypatch.setattr(nb, "_exact", lambda a, b: pairs.append(len(a)) or exact(a, b))
    rows, at, dist = nb._Pool(donors).closest(q, k, np.full(200, np.nan), None)
    assert sum(pairs) < 0.01 * 200 * 4000
    every = np.stack([exact(np.repeat(one[None], 4000, 0), donors) for one in q])
    order = np.argsort(every, axis=1, kind="stable")[:, :k]
    assert (at.reshape(200, k) == order).all() and (dist.reshape(200, k) == np.take_along_axis(every, order, 1)).all()
    # Within a reach, no more than that.
    reach = every.min(axis=1) ** 2 * (1 + 1e-9)
    rows, at, _ = nb._Pool(donors).closest(q, k, reach, None)
    assert rows.tolist() == list(range(200)) and (at == order[:, 0]).all()


@pytest.mark.parametrize("scale", [1.0, 1e-160, 1e153, 1e160, np.inf])
def test_pairs_of_any_size(scale):
    """Ties, missing features, values whose squares under- or overflow, rows that are barred."""
    rng = np.random.default_rng(8)
    donors, q = _points(rng, 300), _points(rng, 40)
    donors[7], q[7] = np.nan, np.nan
    if np.isinf(scale):
        donors[3, 1], q[4, 2] = np.inf, -np.inf
    else:
        donors, q = donors * scale, q * scale
    barred = rng.random((40, 300)) < 0.05
    rows, at, dist = nb._Pool(donors).closest(q, 6, np.full(40, np.nan), barred)
    for i, one in enumerate(q):
        with np.errstate(over="ignore", invalid="ignore"):
            every = np.where(barred[i], np.inf, nb._exact(np.repeat(one[None], 300, 0), donors))
        best = [j for j in np.argsort(every, kind="stable")[:6] if np.isfinite(every[j])]
        assert at[rows == i].tolist() == best and dist[rows == i].tolist() == every[best].tolist()


def test_least_distance_of_a_box():
    """No point of a box is nearer than it tells, and it is not zero for boxes that are far."""
    rng = np.random.default_rng(9)
    vec = _points(rng, 50)
    for _ in range(20):
        held = _points(rng, 6) + rng.integers(-5, 6, 5)
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            lo, hi = np.nanmin(held, 0), np.nanmax(held, 0)
        low = bx.least(vec, lo[None], hi[None], (~np.isnan(held)).sum(0)[None].astype(float), np.array([6.0]))[:, 0]
        true = np.array([nb._exact(np.repeat(v[None], 6, 0), held).min() for v in vec]) ** 2
        assert (low <= true * (1 + 1e-12)).all() and (np.isinf(low) <= np.isinf(true)).all()
    far = bx.least(np.zeros((1, 5)), np.full((1, 5), 2.0), np.full((1, 5), 3.0), np.full((1, 5), 6.0), np.array([6.0]))
    assert far[0, 0] == pytest.approx(20.0)


def test_lines_meet_their_nodes_without_moving(spark):
    """Few places answer many lines: no line is shuffled or sorted to get the values of its ends."""
    x = (F.col("id") % 50).cast("double")
    lines = spark.range(300_000).select(F.concat(F.lit("s"), "id").alias("k"), geo.two_point_line(x, F.lit(0.0), x + 1, F.lit(0.0)).alias("geom"))
    nodes = spark.range(0, 50, 2).select(F.col("id").alias("n"), F.col("id").cast("double").alias("x"), F.lit(0.1).alias("y"), (F.col("id") * 10.0).alias("v"))
    out = nn.attach_endpoints(lines, nodes, {"v": "v"}, "k", "n", 0.5, numeric=["v"])
    plan = first_plan(out)
    assert "SortMergeJoin" not in plan and "Aggregate" not in plan
    got = out.groupBy("v_up", "v_down").count().collect()
    want = {(i * 10.0 if i % 2 == 0 else None, (i + 1) * 10.0 if i % 2 and i < 49 else None): 6_000 for i in range(49)} | {(None, None): 6_000}
    assert {(r["v_up"], r["v_down"]): r["count"] for r in got} == want
    asked = spark.range(300_000).select("id", x.alias("x"), F.lit(0.0).alias("y"))
    assert "SortMergeJoin" not in first_plan(nn.nearest_join(asked, nodes, 0.5, ["v"], "n"))


def test_lines_that_share_a_key_share_their_levels(spark):
    rows = [("a", 0.0, 4.0), ("a", 4.0, 0.0), ("b", 0.0, 4.0), (None, 0.0, 4.0), (None, 0.0, 4.0), ("c", 90.0, None), ("c", 90.0, 4.0), ("d", None, None)]
    lines = spark.createDataFrame(rows, "k string, x0 double, x1 double").withColumn(
        "geom", geo.two_point_line(F.col("x0"), F.lit(0.0), F.col("x1"), F.lit(0.0))
    )
    nodes = spark.createDataFrame([("n", 0.0, 0.0, 1.0, "p"), ("m", 4.0, 0.0, 2.0, "q"), ("o", 4.0, 0.0, 9.0, "r")], "n string, x double, y double, v double, t string")
    out = nn.attach_endpoints(lines, nodes, {"v": "v", "t": "t"}, "k", "n", 0.5, numeric=["v"])
    assert out.columns == ["k", "x0", "x1", "geom", "v_up", "v_down", "t_up", "t_down"]
    got = sorted(((str(r["k"]), r["v_up"], r["v_down"], r["t_up"], r["t_down"]) for r in out.collect() if r["k"] != "c"), key=str)
    none = (None, None, None, None)
    both = ("a", 2.0, 2.0, "q", "q")
    assert got == [("None", *none), ("None", *none), both, both, ("b", 1.0, 2.0, "p", "q"), ("d", *none)]
    assert [(r["v_up"], r["v_down"]) for r in out.filter("k = 'c'").collect()] == [(None, 2.0)] * 2


def test_straight_lines_are_measured_without_a_walk(spark):
    n, d = F.lit(None).cast("double"), lambda v: F.lit(v).cast("double")
    ends = [(d(0), d(0), d(3), d(4)), (d(1), d(1), d(1), d(1)), (n, d(0), d(1), d(1)), (d(0), d(0), d(1), n), (d(0), d(0), d("NaN"), d(1)), (d(0), d(0), d("inf"), d(1))]
    rows = F.array(*[F.struct(F.lit(i).alias("id"), geo.two_point_line(*e).alias("g")) for i, e in enumerate(ends)])
    lines = spark.range(1).select(F.inline(rows))
    # An empty second part leaves the length as it is, but has to be walked along.
    walked = lines.withColumn("w", F.concat("g", F.array(F.array().cast("array<struct<x:double,y:double>>"))))
    got = walked.select(geo.line_length(F.col("g")).alias("a"), geo.line_length(F.col("w")).alias("b")).collect()
    assert [repr(r["a"]) for r in got] == [repr(r["b"]) for r in got] and got[0]["a"] == 5.0
    assert "CASE WHEN" in first_plan(lines.select(geo.line_length(F.col("g"))))


def test_the_chain_is_compiled(spark, folder):
    assert longest_method(catalogue.QUERIES["preprocess_segments"](spark, folder)) < LONGEST
