"""Line and polygon overlay by edge bins.

Straight pieces of lines and edges of polygons are cut along a square grid and meet by equality of bins, so
neither side ever carries the other's whole shape. A bin that an edge passes knows whether
one point of it, the same place in every bin, is inside: a scan along the bin's row
counts the edges before it. Bins between two edge bins of a row are wholly inside or wholly outside; those
inside are kept as runs, cut at every 32nd bin, that a piece looks up by the number of its stretch of bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..session import scratch_path
from ..sources.tables import checkpoint_table
from .tiles import bins_between

# Where a bin's known point lies, in shares of its side: no edge of real data runs through it.
KNOWN_X, KNOWN_Y = 0.5172839465017, 0.4836150927341
# Where along a piece its inside test is made, for the same reason.
ALONG = 0.4142135623731
# Bins of a row whose runs share a key.
STRETCH = 32


def _rows(df: DataFrame, p: str, size: float) -> DataFrame:
    """A straight piece once for each row of bins it passes, with the share of it that lies there."""
    c = F.col(p)
    told = df.withColumn("_by", F.explode(bins_between(F.least(c["y0"], c["y1"]), F.greatest(c["y0"], c["y1"]), size)))
    enter, leave = geo.slab_span(c["y0"], c["y1"] - c["y0"], F.col("_by") * size, (F.col("_by") + 1) * size)
    told = told.withColumn("_ta", F.greatest(enter, F.lit(0.0))).withColumn("_tb", F.least(leave, F.lit(1.0)))
    return told.filter("_ta <= _tb")


def _at(p: str, t: Column) -> tuple[Column, Column]:
    c = F.col(p)
    return c["x0"] + t * (c["x1"] - c["x0"]), c["y0"] + t * (c["y1"] - c["y0"])


def _side(*values: Column) -> Column:
    """Whether the first of the three values that isn't zero is above it."""
    first, second, third = (F.signum(v) for v in values)
    return first * 4 + second * 2 + third > 0


def binned_pieces(lines: DataFrame, key: str, size: float, geom: str) -> DataFrame:
    """``_piece``, ``_p``, bin and the share ``_ta`` to ``_tb`` of the piece in it; a piece without length is one point."""
    pieces = lines.select(F.col(key).alias("_line"), F.posexplode(geo.line_pieces(F.col(geom))).alias("_piece", "_p"))
    rows = _rows(pieces, "_p", size)
    xa, xb = _at("_p", F.col("_ta"))[0], _at("_p", F.col("_tb"))[0]
    bins = rows.withColumn("_bx", F.explode(bins_between(F.least(xa, xb), F.greatest(xa, xb), size)))
    enter, leave = geo.slab_span(F.col("_p.x0"), F.col("_p.x1") - F.col("_p.x0"), F.col("_bx") * size, (F.col("_bx") + 1) * size)
    bins = bins.withColumn("_ta", F.greatest("_ta", enter)).withColumn("_tb", F.least("_tb", leave))
    point = (F.col("_p.x0") == F.col("_p.x1")) & (F.col("_p.y0") == F.col("_p.y1"))
    return bins.filter((F.col("_ta") < F.col("_tb")) | point)


def binned_edges(polys: DataFrame, size: float) -> DataFrame:
    """Every polygon edge once for each bin it passes, and whether it crosses the height of the row's known points there."""
    edges = polys.select(F.col("poly_id").alias("_poly"), F.explode(geo.line_pieces(F.col("rings"))).alias("_e"))
    rows = _rows(edges, "_e", size)
    height = (F.col("_by") + KNOWN_Y) * size
    e = F.col("_e")
    cross = e["x0"] + (height - e["y0"]) / F.nullif(e["y1"] - e["y0"], F.lit(0.0)) * (e["x1"] - e["x0"])
    rows = rows.withColumn("_cross", F.when((e["y0"] > height) != (e["y1"] > height), cross))
    xa, xb = _at("_e", F.col("_ta"))[0], _at("_e", F.col("_tb"))[0]
    # Taking the crossing in keeps it in one of the edge's own bins whatever is rounded.
    low, high = F.least(xa, xb, F.col("_cross")), F.greatest(xa, xb, F.col("_cross"))
    bins = rows.withColumn("_bx", F.explode(bins_between(low, high, size)))
    return bins.withColumn("_cross", F.when(F.floor(F.col("_cross") / size) == F.col("_bx"), F.col("_cross"))).drop("_ta", "_tb")


def scanned_bins(edges: DataFrame, size: float) -> DataFrame:
    """One row for each bin with edges of a polygon: whether its known point is inside, and the run of inside bins behind it.

    The scan is a running count along one row of bins of one polygon.
    """
    known = (F.col("_bx") + KNOWN_X) * size
    counted = edges.groupBy("_poly", "_by", "_bx").agg(
        F.count("_cross").alias("_n"), F.count(F.when(F.col("_cross") < known, 1)).alias("_left")
    )
    along = Window.partitionBy("_poly", "_by").orderBy("_bx")
    upto = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counted.withColumn("_upto", upto).withColumn("_next", F.lead("_bx").over(along)).select(
        "_poly", "_by", "_bx",
        ((F.col("_upto") - F.col("_n") + F.col("_left")) % 2).alias("_known"),
        F.when((F.col("_upto") % 2 == 1) & (F.col("_next") > F.col("_bx") + 1), F.struct((F.col("_bx") + 1).alias("a"), (F.col("_next") - 1).alias("b"))).alias("_run"),
    )


def _differ() -> Column:
    """Whether an edge's ends lie on different sides of the piece.

    Sides are those of a piece moved up and to the right by less than any distance,
    so touching and shared borders count in one way only, whatever the piece's direction.
    """
    dx, dy, ax, ay = F.col("_dx"), F.col("_dy"), F.col("_e.x0") - F.col("_px"), F.col("_e.y0") - F.col("_py")
    bx, by = F.col("_e.x1") - F.col("_px"), F.col("_e.y1") - F.col("_py")
    return _side(dx * ay - dy * ax, dy, -dx) != _side(dx * by - dy * bx, dy, -dx)


def _cut() -> Column:
    """Where an edge with ends on different sides cuts the piece, as a share of it; null outside its bin."""
    ax, ay = F.col("_e.x0") - F.col("_px"), F.col("_e.y0") - F.col("_py")
    t = (ax * F.col("_ey") - ay * F.col("_ex")) / F.nullif(F.col("_dx") * F.col("_ey") - F.col("_dy") * F.col("_ex"), F.lit(0.0))
    return F.when((t > F.col("_ta")) & (t < F.col("_tb")), t)


def _between() -> Column:
    """Whether an edge lies between the known point ``_rx``, ``_ry`` of the piece's bin and the piece's own point ``_mx``, ``_my``."""
    rx, ry, mx, my, ex, ey = (F.col(c) for c in ("_rx", "_ry", "_mx", "_my", "_ex", "_ey"))
    wx, wy = mx - rx, my - ry
    ax, ay, bx, by = F.col("_e.x0") - rx, F.col("_e.y0") - ry, F.col("_e.x1") - rx, F.col("_e.y1") - ry
    way = _side(wx * ay - wy * ax, ay, -ax) != _side(wx * by - wy * bx, by, -bx)
    edge = _side(ax * ey - ay * ex, -ey, ex) != _side(ex * (my - F.col("_e.y0")) - ey * (mx - F.col("_e.x0")), -ey, ex)
    return way & edge


def _spans_inside(ts: Column, flips: Column) -> Column:
    """The share of a piece that is inside between ``_ta`` and ``_tb``, null if none: each cut changes sides."""
    # Sides of the span that holds the piece's own point, and how many cuts come before that.
    odd = flips - F.size(F.filter(ts, lambda t: t < F.col("_tm")))

    def spans(x: Column) -> Column:
        at, first = x["at"], x["odd"]
        told = F.transform(F.slice(at, F.lit(2), F.size(at) - 1), lambda t, i: F.when(F.pmod(first + i, F.lit(2)) == 1, t - F.get(at, i)))
        return F.aggregate(told, F.lit(None).cast("double"), lambda a, t: F.coalesce(a + t, a, t))

    return geo.once(F.struct(F.array_sort(F.concat(F.array("_ta", "_tb"), ts)).alias("at"), odd.alias("odd")), spans)


def _within_edge_bins(pieces: DataFrame, edges: DataFrame, scanned: DataFrame, size: float) -> DataFrame:
    """Length inside, for pieces in bins that edges of the polygon pass.

    Every edge of the bin says where it cuts the piece, and whether it lies between the bin's known point and a
    point of the piece; a known point that is inside goes along as a row of its own. Only rows that change something
    are counted, so a piece that no edge is near costs one row in what it lies in and none elsewhere.
    """
    p, e = F.col("_p"), F.col("_e")
    mx, my = _at("_p", F.col("_tm"))
    pieces = pieces.withColumns({"_tm": F.col("_ta") + ALONG * (F.col("_tb") - F.col("_ta")), "_dx": p["x1"] - p["x0"], "_dy": p["y1"] - p["y0"]})
    pieces = pieces.select(
        "_line", "_piece", "_bx", "_by", "_ta", "_tb", "_tm", "_dx", "_dy", p["x0"].alias("_px"), p["y0"].alias("_py"), mx.alias("_mx"), my.alias("_my"),
        ((F.col("_bx") + KNOWN_X) * size).alias("_rx"), ((F.col("_by") + KNOWN_Y) * size).alias("_ry"),
    )
    some = edges.select("_poly", "_bx", "_by", "_e", (e["x1"] - e["x0"]).alias("_ex"), (e["y1"] - e["y0"]).alias("_ey"))
    known = [F.lit(None).cast(some.schema[c].dataType).alias(c) for c in ("_e", "_ex", "_ey")]
    inside = scanned.filter("_known = 1").select("_poly", "_bx", "_by", *known)
    met = pieces.join(some.union(inside), ["_bx", "_by"])
    spot = ["_line", "_piece", "_poly", "_bx", "_by"]
    own = ["_ta", "_tb", "_tm", "_dx", "_dy"]
    cut = met.filter(_differ()).withColumn("_t", _cut()).filter(F.col("_t").isNotNull())
    cuts = cut.groupBy(*spot).agg(F.collect_list("_t").alias("_ts"), *[F.min(c).alias(f"{c}c") for c in own])
    flips = met.filter(F.col("_e").isNull() | _between()).groupBy(*spot).agg(F.count(F.lit(1)).alias("_flips"), *[F.min(c).alias(c) for c in own])
    # A piece that only edges cut begins outside.
    told = flips.join(cuts, spot, "full").withColumns({c: F.coalesce(c, f"{c}c") for c in own} | {"_flips": F.coalesce("_flips", F.lit(0))})
    whole = F.when(F.pmod(F.col("_flips"), F.lit(2)) == 1, F.col("_tb") - F.col("_ta"))
    share = F.when(F.col("_ts").isNull(), whole).otherwise(_spans_inside(F.col("_ts"), F.col("_flips")))
    return told.select("_line", "_poly", (share * geo.hypot(F.col("_dx"), F.col("_dy"))).alias("_inside"))


def _within_runs(pieces: DataFrame, scanned: DataFrame) -> DataFrame:
    """Length of the pieces in bins that lie wholly inside a polygon."""
    run, first, last = F.col("_run"), F.col("_stretch") * STRETCH, F.col("_stretch") * STRETCH + STRETCH - 1
    runs = scanned.filter(run.isNotNull()).withColumn("_stretch", F.explode(bins_between(run["a"], run["b"], STRETCH)))
    runs = runs.select("_poly", "_by", "_stretch", F.greatest(run["a"], first).alias("_a"), F.least(run["b"], last).alias("_b"))
    p = F.col("_p")
    length = (F.col("_tb") - F.col("_ta")) * geo.hypot(p["x1"] - p["x0"], p["y1"] - p["y0"])
    asked = pieces.select("_line", "_by", "_bx", F.floor(F.col("_bx") / STRETCH).alias("_stretch"), length.alias("_inside"))
    return asked.join(runs, ["_by", "_stretch"]).filter("_bx between _a and _b").select("_line", "_poly", "_inside")


def lengths_inside(lines: DataFrame, polys: DataFrame, key: str, size: float, geom: str = "geom") -> DataFrame:
    """``(key, poly_id, clip_length)`` of the lines and polygons that share a place.

    ``size`` is the side of the bins, best a few lengths of an edge. Work follows the bins that lines and polygon
    borders pass, not areas. A line without length counts as a point, and has the length zero in what it lies
    in. Ids must be unique on both sides; null or empty shapes meet nothing.
    """
    # Written once, as each is read several times; it also keeps the generated code of each step small.
    spark = lines.sparkSession
    pieces = checkpoint_table(binned_pieces(lines, key, size, geom), scratch_path(spark, "pieces"))
    edges = checkpoint_table(binned_edges(polys, size), scratch_path(spark, "edges"))
    scanned = checkpoint_table(scanned_bins(edges, size), scratch_path(spark, "bins"))
    parts = _within_edge_bins(pieces, edges, scanned, size).unionByName(_within_runs(pieces, scanned))
    told = parts.groupBy(F.col("_line").alias(key), F.col("_poly").alias("poly_id")).agg(F.sum("_inside").alias("clip_length"))
    return told.filter(F.col("clip_length").isNotNull())


def line_polygon_pairs(
    lines: DataFrame, polys: DataFrame, key: str, size: float, geom: str = "geom"
) -> DataFrame:
    """Pairs of a line and a polygon whose boxes overlap, with the length inside, zero or more.

    Boxes meet in square bins by equality; a pair is kept only in the bin that holds the
    corner of its overlap, so no ``distinct`` is needed. Where only overlaps matter,
    ``lengths_inside`` does without the boxes.
    """
    lb = lines.select(key, geo.line_length(F.col(geom)).alias("line_length"), geo.bbox(F.col(geom)).alias("_a"))
    lb = lb.filter(F.col("_a.xmin").isNotNull()).withColumn(
        "_bx", F.explode(bins_between(F.col("_a.xmin"), F.col("_a.xmax"), size))
    ).withColumn("_by", F.explode(bins_between(F.col("_a.ymin"), F.col("_a.ymax"), size)))
    pb = polys.select("poly_id", "value", geo.bbox(F.col("rings")).alias("_b"))
    pb = pb.withColumn("_px", F.explode(bins_between(F.col("_b.xmin"), F.col("_b.xmax"), size))).withColumn(
        "_py", F.explode(bins_between(F.col("_b.ymin"), F.col("_b.ymax"), size))
    )
    cond = (
        (F.col("_bx") == F.col("_px")) & (F.col("_by") == F.col("_py"))
        & geo.bbox_overlap(F.col("_a"), F.col("_b"))
        & (F.floor(F.greatest(F.col("_a.xmin"), F.col("_b.xmin")) / size) == F.col("_bx"))
        & (F.floor(F.greatest(F.col("_a.ymin"), F.col("_b.ymin")) / size) == F.col("_by"))
    )
    near = lb.join(pb, cond).select(key, "poly_id", "value", "line_length")
    inside = lengths_inside(lines, polys, key, size, geom)
    return near.join(inside, [key, "poly_id"], "left").withColumn("clip_length", F.coalesce("clip_length", F.lit(0.0)))


def overlay_largest(
    lines: DataFrame, polys: DataFrame, key: str, size: float, default=None, out: str = "value",
    tolerance: float = 1e-6, geom: str = "geom",
) -> DataFrame:
    """Value of the polygon that contains a line, else of the longest overlap.

    Contained in several: the largest value. Overlaps equal to nine decimals: the polygon with the
    smallest id. Nothing overlapping gives ``default``; a line without geometry gives null.
    """
    inside = lengths_inside(lines, polys, key, size, geom).withColumnRenamed(key, "_line")
    values = polys.select("poly_id", F.col("value").alias("_value"))
    whole = lines.select(F.col(key).alias("_line"), geo.line_length(F.col(geom)).alias("_whole"))
    pairs = inside.join(values, "poly_id").join(whole, "_line")
    best = F.when(
        F.col("clip_length") > 0,
        F.struct((-F.round("clip_length", 9)).alias("l"), F.col("poly_id").alias("p"), F.col("_value").alias("v")),
    )
    found = pairs.groupBy("_line").agg(
        F.max(F.when(F.col("clip_length") >= F.col("_whole") - tolerance, F.col("_value"))).alias("_in"), F.min(best).alias("_best")
    )
    value = F.coalesce(F.col("_in"), F.col("_best.v"), F.lit(default))
    return lines.join(found, F.col(key) == F.col("_line"), "left").withColumn(
        out, F.when(F.coalesce(F.size(geom) > 0, F.lit(False)), value)
    ).drop("_line", "_in", "_best")
