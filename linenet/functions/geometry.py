"""Column functions over lines and polygons held as arrays.

A line is ``array<array<struct<x,y>>>`` (parts, then vertices); a polygon is the same
type, read as rings with the shell first. All but ``point_in_polygon`` stays in JVM expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .arrays import expand, shares
from .values import none_if, once

GEOM = "array<array<struct<x:double,y:double>>>"
EDGES_AT_ONCE = 131_072  # that a task meets with points


def vertex(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def two_point_line(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(F.array(vertex(x0, y0), vertex(x1, y1)))


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return F.array(
        F.array(vertex(xmin, ymin), vertex(xmax, ymin), vertex(xmax, ymax), vertex(xmin, ymax), vertex(xmin, ymin))
    )


def hypot(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def pieces(part: Column) -> Column:
    """Straight pieces of one part, as structs of both end vertices; none below two vertices."""
    n = F.size(part)
    head = F.slice(part, F.lit(1), F.greatest(n - 1, F.lit(0)))
    tail = F.slice(part, F.lit(2), F.greatest(n - 1, F.lit(0)))
    return F.zip_with(
        head,
        tail,
        lambda a, b: F.struct(a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")),
    )


def line_pieces(g: Column) -> Column:
    return F.flatten(F.transform(g, pieces))


def _piece_length(p: Column) -> Column:
    return hypot(p["x1"] - p["x0"], p["y1"] - p["y0"])


def line_length(g: Column) -> Column:
    def part(p: Column) -> Column:
        n = F.greatest(F.size(p) - 1, F.lit(0))
        steps = F.zip_with(
            F.slice(p, F.lit(1), n), F.slice(p, F.lit(2), n), lambda a, b: hypot(b["x"] - a["x"], b["y"] - a["y"])
        )
        return F.aggregate(steps, F.lit(0.0), lambda s, v: s + v)

    # One straight piece, the usual pipe between two manholes, needs no walk; array functions are interpreted.
    first = F.get(g, F.lit(0))
    a, b = F.get(first, F.lit(0)), F.get(first, F.lit(1))
    straight = (F.size(g) == 1) & (F.size(first) == 2)
    walked = F.aggregate(g, F.lit(0.0), lambda s, p: s + part(p))
    return F.when(straight, dist_pp(a["x"], a["y"], b["x"], b["y"])).otherwise(walked)


def longer_than(g: Column, least: float) -> Column:
    """Whether a line is longer than a limit.

    The straight distance between its ends is never more than its length and settles
    nearly every line without walking along it.
    """
    up, down = endpoint(g, "up"), endpoint(g, "down")
    return (dist_pp(up["x"], up["y"], down["x"], down["y"]) > least) | (line_length(g) > least)


def endpoint(g: Column, end: str) -> Column:
    """First vertex (``up``) or last vertex (``down``) of the first part."""
    first = F.get(g, F.lit(0))
    return F.get(first, F.lit(0) if end == "up" else F.size(first) - 1)


def vertex_count(g: Column) -> Column:
    return F.aggregate(g, F.lit(0), lambda s, p: s + F.size(p))


def is_line(g: Column) -> Column:
    """Not null, not empty, and the first part has at least two vertices."""
    return F.coalesce((F.size(g) > 0) & (F.size(F.get(g, F.lit(0))) >= 2), F.lit(False))


def line_centroid(g: Column) -> Column:
    """Length-weighted mean of piece midpoints; vertex mean where the length is zero."""

    def weighed(p: Column) -> Column:
        return F.struct(
            _piece_length(p).alias("w"), ((p["x0"] + p["x1"]) / 2).alias("x"), ((p["y0"] + p["y1"]) / 2).alias("y")
        )

    def total(items: Column, value) -> Column:
        return F.aggregate(items, F.lit(0.0), lambda s, v: s + value(v))

    def vertex_mean(points: Column) -> Column:
        n = none_if(F.size(points), 0)
        return vertex(total(points, lambda v: v["x"]) / n, total(points, lambda v: v["y"]) / n)

    def along(parts: Column) -> Column:
        def of(items: Column) -> Column:
            return once(
                total(items, lambda v: v["w"]),
                lambda w: F.when(
                    w > 0,
                    vertex(total(items, lambda v: v["w"] * v["x"]) / w, total(items, lambda v: v["w"] * v["y"]) / w),
                ).otherwise(vertex_mean(F.flatten(parts))),
            )

        return once(F.transform(line_pieces(parts), weighed), of)

    return F.when(F.coalesce(F.size(F.flatten(g)) > 0, F.lit(False)), once(g, along))


def bbox(g: Column) -> Column:
    def of(points: Column) -> Column:
        xs = F.transform(points, lambda v: v["x"])
        ys = F.transform(points, lambda v: v["y"])
        return F.struct(
            F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
            F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"),
        )

    return once(F.flatten(g), of)


def bbox_overlap(a: Column, b: Column) -> Column:
    return (
        (a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"])
        & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"])
    )


def clean_vertices(g: Column) -> Column:
    """Drop vertices equal to the one before, then parts left with one vertex."""

    def tidy(part: Column) -> Column:
        before = F.concat(
            F.array(F.lit(None).cast("struct<x:double,y:double>")),
            F.slice(part, F.lit(1), F.greatest(F.size(part) - 1, F.lit(0))),
        )
        moved = F.zip_with(part, before, lambda v, w: F.when(~v.eqNullSafe(w), v))
        return F.filter(moved, lambda v: v.isNotNull())

    return F.filter(F.transform(g, tidy), lambda part: F.size(part) >= 2)


def dist_pp(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return hypot(x1 - x0, y1 - y0)


def dist_ps(px: Column, py: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Distance of a point from a straight piece."""
    dx, dy = x1 - x0, y1 - y0
    norm = dx * dx + dy * dy
    t = F.when(norm > 0, ((px - x0) * dx + (py - y0) * dy) / norm).otherwise(F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return hypot(px - (x0 + t * dx), py - (y0 + t * dy))


def slab_span(p0: Column, d: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Parameters between which ``p0 + t*d`` lies in the slab; an empty span if it never does."""
    a, b = (low - p0) / none_if(d, 0.0), (high - p0) / none_if(d, 0.0)
    flat_in = (p0 >= low) & (p0 <= high)
    enter = F.when(d == 0, F.when(flat_in, F.lit(0.0)).otherwise(F.lit(2.0))).otherwise(F.least(a, b))
    leave = F.when(d == 0, F.when(flat_in, F.lit(1.0)).otherwise(F.lit(-1.0))).otherwise(F.greatest(a, b))
    return enter, leave


def box_clip_span(p: Column, xmin, ymin, xmax, ymax) -> tuple[Column, Column]:
    """Parameters between which a piece lies in a box; the piece misses it if enter > leave."""
    ex, lx = slab_span(p["x0"], p["x1"] - p["x0"], xmin, xmax)
    ey, ly = slab_span(p["y0"], p["y1"] - p["y0"], ymin, ymax)
    return F.greatest(ex, ey, F.lit(0.0)), F.least(lx, ly, F.lit(1.0))


def dist_seg_square(p: Column, xmin, ymin, xmax, ymax) -> Column:
    """Distance between a straight piece and a box: zero if they meet, else vertex to side."""
    enter, leave = box_clip_span(p, xmin, ymin, xmax, ymax)

    def to_box(px: Column, py: Column) -> Column:
        zero = F.lit(0.0)
        return hypot(F.greatest(xmin - px, zero, px - xmax), F.greatest(ymin - py, zero, py - ymax))

    ends = F.least(to_box(p["x0"], p["y0"]), to_box(p["x1"], p["y1"]))
    corners = F.least(
        *[dist_ps(cx, cy, p["x0"], p["y0"], p["x1"], p["y1"]) for cx in (xmin, xmax) for cy in (ymin, ymax)]
    )
    return F.when(enter <= leave, F.lit(0.0)).otherwise(F.least(ends, corners))


def _crosses(px: Column, py: Column, e: Column) -> Column:
    """Whether a ray to the right of the point crosses a ring edge."""
    at = e["x0"] + (py - e["y0"]) / (e["y1"] - e["y0"]) * (e["x1"] - e["x0"])
    return ((e["y0"] > py) != (e["y1"] > py)) & (px < at)


def _inside_edges(px: Column, py: Column, edges: Column) -> Column:
    return F.size(F.filter(edges, lambda e: _crosses(px, py, e))) % 2 == 1


def _holds(px: pa.Array, py: pa.Array, rings: pa.Array) -> pa.Array:
    """``point_in_polygon`` over arrays as 0 and 1, with the order of numbers and the nulls of column expressions.

    NaN is the largest number and equal to itself; what a missing value leaves open is null.
    """
    parts = rings.flatten()
    vertices = parts.flatten()
    xy = [vertices.flatten()[vertices.type.get_field_index(c)] for c in ("x", "y")]
    (x, no_x), (y, no_y), (qx, no_qx), (qy, no_qy) = (
        (a.to_numpy(zero_copy_only=False).astype(float), a.is_null().to_numpy(zero_copy_only=False)) for a in (*xy, px, py)
    )
    many = rings.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(int)
    size = parts.value_lengths()
    home, _ = expand(many)
    lost = rings.is_null().to_numpy(zero_copy_only=False).copy()
    lost[home[size.is_null().to_numpy(zero_copy_only=False)]] = True
    size = size.fill_null(0).to_numpy(zero_copy_only=False).astype(int)
    begin, edges = np.cumsum(size) - size, np.maximum(size - 1, 0)
    odd, touched, vague = (np.zeros(len(rings), bool) for _ in range(3))

    def at_least(a, b):
        return (a >= b) | np.isnan(a)

    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for part in shares(edges, EDGES_AT_ONCE):
            ring, k = expand(edges[part])
            ring += part.start
            own, i = home[ring], begin[ring] + k
            x0, y0, x1, y1, p, q = x[i], y[i], x[i + 1], y[i + 1], qx[own], qy[own]
            nx0, ny0, nx1, ny1, np_, nq = no_x[i], no_y[i], no_x[i + 1], no_y[i + 1], no_qx[own], no_qy[own]
            whole = ~(nx0 | ny0 | nx1 | ny1 | np_ | nq)
            # The ray to the right of the point meets the edge.
            cross = np.flatnonzero((at_least(q, y0) != at_least(q, y1)) & whole)
            u0, v0, v, u = x0[cross], y0[cross], q[cross], p[cross]
            right = ~at_least(u, u0 + (v - v0) / (y1[cross] - v0) * (x1[cross] - u0))
            # Rings of a geometry may lie in several shares: only whether their number is odd goes on.
            odd ^= np.bincount(own[cross[right]], minlength=len(rings)) % 2 == 1
            # Least and greatest pass over a missing value.
            x0, x1, y0, y1 = np.where(nx0, x1, x0), np.where(nx1, x0, x1), np.where(ny0, y1, y0), np.where(ny1, y0, y1)
            beside = ~(at_least(p, np.fmin(x0, x1)) & at_least(np.maximum(x0, x1), p)) & ~(np_ | (nx0 & nx1))
            beside |= ~(at_least(q, np.fmin(y0, y1)) & at_least(np.maximum(y0, y1), q)) & ~(nq | (ny0 & ny1))
            near = np.flatnonzero(~beside)
            flat = (x1[near] - x0[near]) * (q[near] - y0[near]) - (y1[near] - y0[near]) * (p[near] - x0[near]) == 0
            touched[own[near[flat & whole[near]]]] = True
            vague[own[near[~whole[near]]]] = True
    inside = odd & ~touched
    return pa.array(inside.astype(np.int64), mask=lost | (inside & vague))


def point_in_polygon(px: Column, py: Column, rings: Column) -> Column:
    """Strict interior, holes out; a point on an edge is not inside.

    Edges are met in arrays: as array functions, which are interpreted, they cost most of what an area costs.
    """
    # Numbers, not single bits: Python sends answers once they fill a buffer, and until then Spark keeps all rows
    # that wait for them, geometries too, on disk.
    return F.arrow_udf(_holds, LongType())(px.cast("double"), py.cast("double"), rings) == 1


def clip_length(g: Column, edges: Column, crossed: Column | None = None) -> Column:
    """Length of a line inside a polygon given by its ring edges (``line_pieces(rings)``).

    ``crossed`` may name the fewer edges the line can meet at all. Each piece is cut where it crosses an edge; the parts whose middle is inside count.
    A piece that crosses nothing, the usual case, needs one inside test.
    """

    def inside_length(p: Column, ring: Column, met: Column) -> Column:
        dx, dy = p["x1"] - p["x0"], p["y1"] - p["y0"]

        def inside(t: Column) -> Column:
            return _inside_edges(p["x0"] + dx * t, p["y0"] + dy * t, ring)

        def crossing(e: Column) -> Column:
            ex, ey = e["x1"] - e["x0"], e["y1"] - e["y0"]
            det = none_if(dx * ey - dy * ex, 0.0)
            u = ((e["x0"] - p["x0"]) * dy - (e["y0"] - p["y0"]) * dx) / det
            t = ((e["x0"] - p["x0"]) * ey - (e["y0"] - p["y0"]) * ex) / det
            return once(t, lambda v: F.when((v > 0) & (v < 1) & (u >= 0) & (u <= 1), v))

        def split(stops: Column) -> Column:
            n = F.size(stops)
            spans = F.zip_with(
                F.slice(stops, F.lit(1), n - 1),
                F.slice(stops, F.lit(2), n - 1),
                lambda a, b: F.when(inside((a + b) / 2), b - a).otherwise(F.lit(0.0)),
            )
            return F.aggregate(spans, F.lit(0.0), lambda s, v: s + v)

        def share(cuts: Column) -> Column:
            whole = F.when(inside(F.lit(0.5)), F.lit(1.0)).otherwise(F.lit(0.0))
            ends = F.array(F.lit(0.0), F.lit(1.0))
            return F.when(F.size(cuts) == 0, whole).otherwise(once(F.array_sort(F.concat(ends, cuts)), split))

        cuts = F.filter(F.transform(met, crossing), lambda t: t.isNotNull())
        return once(cuts, share) * hypot(dx, dy)

    def total(ring: Column, met: Column) -> Column:
        return F.aggregate(line_pieces(g), F.lit(0.0), lambda s, p: s + inside_length(p, ring, met))

    if crossed is None:
        return once(edges, lambda ring: total(ring, ring))
    return once(F.struct(edges.alias("all"), crossed.alias("met")), lambda e: total(e["all"], e["met"]))


def to_wkt(g: Column) -> Column:
    def part(p: Column) -> Column:
        return F.concat(
            F.lit("("),
            F.array_join(
                F.transform(p, lambda v: F.concat(v["x"].cast("string"), F.lit(" "), v["y"].cast("string"))), ", "
            ),
            F.lit(")"),
        )

    def text(parts: Column) -> Column:
        single = F.concat(F.lit("LINESTRING "), part(F.get(parts, F.lit(0))))
        many = F.concat(F.lit("MULTILINESTRING ("), F.array_join(F.transform(parts, part), ", "), F.lit(")"))
        return F.when(F.size(parts) == 0, F.lit("LINESTRING EMPTY")).when(F.size(parts) == 1, single).otherwise(many)

    return F.when(g.isNotNull(), once(g, text))


def parse_wkt(c: Column) -> Column:
    """POINT, LINESTRING, POLYGON, MULTILINESTRING and MULTIPOLYGON text to the array type; null for anything else.

    Z and M are left out; the rings of a multi-polygon follow one another, since a place is inside if
    an odd number of rings is round it.
    """
    kinds = r"^(MULTIPOLYGON|MULTILINESTRING|LINESTRING|POLYGON|POINT)\s*(ZM|Z|M)?\s*"

    def point(v: Column) -> Column:
        return once(
            F.split(F.trim(v), r"\s+"),
            lambda xy: vertex(F.get(xy, F.lit(0)).try_cast("double"), F.get(xy, F.lit(1)).try_cast("double")),
        )

    def read(text: Column) -> Column:
        inner = F.regexp_replace(F.regexp_replace(text, kinds, ""), r"^[\s(]+|[\s)]+$", "")
        parts = F.transform(
            F.split(inner, r"\)[\s)]*,[\s(]*\("), lambda p: F.transform(F.split(p, r"\s*,\s*"), point)
        )
        return F.when(text.rlike(kinds + "EMPTY$"), F.array().cast(GEOM)).when(text.rlike(kinds + r"\("), parts)

    return once(F.upper(F.trim(c)), read)
