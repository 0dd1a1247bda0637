"""Queries for geometry, spatial joins, rasters and the rules that build on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from linenet import presets as P
from linenet.fixtures import Data
from linenet.functions import geometry as geo
from linenet.functions import projection as pj
from linenet.operators import cleaning as cl
from linenet.operators import nearest as nn
from linenet.operators import overlay as ov
from linenet.operators import profiles as pr
from linenet.operators import rules as ru
from linenet.operators import tiles as ti

from .base import d6, query, r6

LENGTH = "sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0))"


def bent(d: Data):
    """Lines of two parts: the segment bent at (x1, y0), with a doubled vertex, and a piece beside it."""
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    return d.segments(spread=True).withColumn(
        "geom",
        F.array(
            F.array(geo.vertex(x0, y0), geo.vertex(x0, y0), geo.vertex(x1, y0), geo.vertex(x1, y1)),
            F.array(geo.vertex(x0, y0 + 30), geo.vertex(x0, y0 + 33)),
        ),
    )


# ---------------------------------------------------------------- geometry

@query("line_length", f"SELECT seg_id, {d6(LENGTH)} AS straight, {d6('abs(x1-x0) + abs(y1-y0) + 3')} AS bent FROM fx_segments")
def _(d):
    lines = bent(d).withColumn("g", geo.two_point_line(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    return lines.select("seg_id", r6(geo.line_length(F.col("g"))).alias("straight"), r6(geo.line_length(F.col("geom"))).alias("bent"))


@query("line_endpoints", "SELECT seg_id, x0 AS up_x, y0 AS up_y, x1 AS down_x, y1 AS down_y FROM fx_segments")
def _(d):
    up, down = geo.endpoint(F.col("geom"), "up"), geo.endpoint(F.col("geom"), "down")
    return bent(d).select("seg_id", up["x"].alias("up_x"), up["y"].alias("up_y"), down["x"].alias("down_x"), down["y"].alias("down_y"))


@query("line_centroid", f"""SELECT seg_id,
  {d6('(abs(x1-x0)*(x0+x1)/2 + abs(y1-y0)*x1 + 3*x0) / (abs(x1-x0)+abs(y1-y0)+3)')} AS x,
  {d6('(abs(x1-x0)*y0 + abs(y1-y0)*(y0+y1)/2 + 3*(y0+31.5)) / (abs(x1-x0)+abs(y1-y0)+3)')} AS y FROM fx_segments""")
def _(d):
    c = geo.line_centroid(F.col("geom"))
    return bent(d).select("seg_id", r6(c["x"]).alias("x"), r6(c["y"]).alias("y"))


@query("line_bbox", """SELECT seg_id, least(x0, x1) AS xmin, greatest(x0, x1) AS xmax, least(y0, y1) AS ymin,
  greatest(y0 + 33, y1) AS ymax FROM fx_segments""")
def _(d):
    return bent(d).select("seg_id", geo.bbox(F.col("geom")).alias("b")).select("seg_id", "b.*")


@query("point_distance", f"""WITH m AS (SELECT seg_id, x0, y0, x1, y1, x1-x0 AS dx, y1-y0 AS dy,
    floor(x0/100)*100.0 AS qx, floor(y0/100)*100.0 AS qy FROM fx_segments),
  t AS (SELECT *, least(greatest(((qx-x0)*dx + (qy-y0)*dy) / (dx*dx+dy*dy), 0.0), 1.0) AS t FROM m)
  SELECT seg_id, {d6('sqrt((qx-x0)*(qx-x0) + (qy-y0)*(qy-y0))')} AS from_start,
  {d6('sqrt((qx-(x0+t*dx))*(qx-(x0+t*dx)) + (qy-(y0+t*dy))*(qy-(y0+t*dy)))')} AS from_line FROM t""")
def _(d):
    seg = d.segments().withColumns({"qx": F.floor(F.col("x0") / 100) * 100.0, "qy": F.floor(F.col("y0") / 100) * 100.0})
    q, p = (F.col("qx"), F.col("qy")), [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    return seg.select("seg_id", r6(geo.dist_pp(*q, *p[:2])).alias("from_start"), r6(geo.dist_ps(*q, *p)).alias("from_line"))


@query("clean_vertices", f"SELECT seg_id, 2 AS parts, 5 AS vertices, {d6('abs(x1-x0) + abs(y1-y0) + 3')} AS length FROM fx_segments")
def _(d):
    tidy = bent(d).withColumn("g", geo.clean_vertices(F.col("geom")))
    return tidy.select("seg_id", F.size("g").alias("parts"), geo.vertex_count(F.col("g")).alias("vertices"), r6(geo.line_length(F.col("g"))).alias("length"))


@query("valid_lines", f"SELECT seg_id FROM fx_segments WHERE material_raw IS NOT NULL AND effluent_raw <> 'NC' AND {LENGTH} > 8")
def _(d):
    """Some lines are made null or single vertices first; those and the short ones go."""
    odd = d.lines().withColumn(
        "geom",
        F.when(F.col("effluent_raw") == "NC", F.array(F.slice(F.col("geom")[0], 1, 1))).when(
            F.col("material_raw").isNotNull(), F.col("geom")
        ),
    )
    return cl.filter_valid_lines(odd, 8.0).select("seg_id")


@query("wkt_round_trip", f"SELECT seg_id, x0, y0, x1, y1, 2 AS parts, {d6('abs(x1-x0) + abs(y1-y0) + 3')} AS length FROM fx_segments")
def _(d):
    back = geo.parse_wkt(geo.to_wkt(F.col("geom")))
    read = bent(d).select("seg_id", back.alias("g"))
    up, down = geo.endpoint(F.col("g"), "up"), geo.endpoint(F.col("g"), "down")
    return read.select(
        "seg_id", up["x"].alias("x0"), up["y"].alias("y0"), down["x"].alias("x1"), down["y"].alias("y1"),
        F.size("g").alias("parts"), r6(geo.line_length(F.col("g"))).alias("length"),
    )


def _lambert_sql() -> str:
    """Lambert conformal conic of EPSG:2154 in plain SQL, with its constants worked out by the SQL."""
    e = "0.0818191910428158"
    m = "cos(radians({p})) / sqrt(1 - pow({e} * sin(radians({p})), 2))"
    t = "tan(pi()/4 - radians({p})/2) / pow((1 - {e}*sin(radians({p}))) / (1 + {e}*sin(radians({p}))), {e}/2)"
    m1, m2 = m.format(p=44.0, e=e), m.format(p=49.0, e=e)
    t1, t2, t0, tp = (t.format(p=p, e=e) for p in (44.0, 49.0, 46.5, "lat"))
    return f"""WITH k AS (SELECT ln(({m1}) / ({m2})) / ln(({t1}) / ({t2})) AS n),
      c AS (SELECT n, 6378137.0 * ({m1}) / (n * pow({t1}, n)) AS f FROM k),
      p AS (SELECT seg_id, x0, y0, 2.0 + x0 / 1000 AS lon, 45.0 + y0 / 1000 AS lat FROM fx_segments),
      r AS (SELECT *, f * pow({t0}, n) AS r0, f * pow({tp}, n) AS r, n * radians(lon - 3.0) AS th FROM p, c)
      SELECT seg_id, {d6('700000 + r * sin(th)', 4)} AS x, {d6('6600000 + r0 - r * cos(th)', 4)} AS y,
      {d6('lon', 8)} AS lon, {d6('lat', 8)} AS lat FROM r"""


@query("reproject_l93", _lambert_sql())
def _(d):
    lonlat = geo.vertex(F.col("x0") / 1000 + 2.0, F.col("y0") / 1000 + 45.0)
    there = d.segments(spread=True).select("seg_id", F.array(F.array(lonlat)).alias("g")).withColumn("p", pj.reproject(F.col("g"), pj.LONLAT, pj.LAMBERT93))
    back = there.withColumn("b", pj.reproject(F.col("p"), pj.LAMBERT93, pj.LONLAT))
    p, b = F.col("p")[0][0], F.col("b")[0][0]
    return back.select("seg_id", r6(p["x"], 4).alias("x"), r6(p["y"], 4).alias("y"), r6(b["x"], 8).alias("lon"), r6(b["y"], 8).alias("lat"))


# ---------------------------------------------------------------- nearest nodes

NEAREST = """WITH ends AS (SELECT seg_id, 'up' AS e, x0 AS x, y0 AS y FROM fx_segments UNION ALL
    SELECT seg_id, 'down', x1, y1 FROM fx_segments),
  near AS (SELECT s.seg_id, s.e, sqrt((m.x-s.x)*(m.x-s.x)+(m.y-s.y)*(m.y-s.y)) AS dist, m.mh_id, m.ground, m.invert, m.depth
    FROM ends s JOIN fx_manholes m ON m.x BETWEEN s.x - 2 AND s.x + 2 AND m.y BETWEEN s.y - 2 AND s.y + 2),
  tied AS (SELECT *, rank() OVER (PARTITION BY seg_id, e ORDER BY dist) AS rk FROM near WHERE dist <= 2),
  best AS (SELECT seg_id, e, min(dist) AS dist, min(mh_id) AS mh_id, arg_min(ground, mh_id) FILTER (WHERE ground IS NOT NULL) AS ground,
    arg_min(invert, mh_id) FILTER (WHERE invert IS NOT NULL) AS invert, arg_min(depth, mh_id) FILTER (WHERE depth IS NOT NULL) AS depth
    FROM tied WHERE rk = 1 GROUP BY 1, 2)"""
ENDS = f"""{NEAREST}, a AS (SELECT s.*, u.mh_id AS id_up, w.mh_id AS id_down, u.ground AS ground_up, w.ground AS ground_down_, u.invert AS invert_up,
    w.invert AS invert_down, u.depth AS mdepth_up, w.depth AS mdepth_down FROM fx_segments s
    LEFT JOIN best u ON u.seg_id = s.seg_id AND u.e = 'up' LEFT JOIN best w ON w.seg_id = s.seg_id AND w.e = 'down')"""
BAD = """coalesce(invert_up < invert_down, false) AS b1, coalesce(ground_up < invert_up, false) AS b2,
  coalesce(ground_down_ < invert_down, false) AS b3"""
DEPTH = f"""{ENDS}, b AS (SELECT *, {BAD}, (mdepth_up + mdepth_down) / 2 AS m1,
    (ground_up - invert_up + ground_down_ - invert_down) / 2 AS m2 FROM a)"""


@query("nearest_manhole", f"""{NEAREST} SELECT s.seg_id, {d6('b.dist')} AS distance, b.mh_id, b.ground, b.invert, b.depth
  FROM fx_segments s LEFT JOIN best b ON b.seg_id = s.seg_id AND b.e = 'up'""")
def _(d):
    starts = d.segments().select("seg_id", F.col("x0").alias("x"), F.col("y0").alias("y"))
    out = nn.nearest_join(starts, d.view("fx_manholes"), P.NODE_DISTANCE, ["mh_id", "ground", "invert", "depth"], "mh_id")
    return out.select("seg_id", r6("distance").alias("distance"), *[F.col(f"near_{c}").alias(c) for c in ("mh_id", "ground", "invert", "depth")])


BY_CITY = """WITH m AS (SELECT *, concat('C', CAST(CAST(substr(mh_id, 2) AS BIGINT) % 25 AS VARCHAR)) AS city FROM fx_manholes),
  near AS (SELECT s.seg_id, sqrt((m.x-s.x0)*(m.x-s.x0)+(m.y-s.y0)*(m.y-s.y0)) AS dist, m.mh_id, m.ground FROM fx_segments s
    JOIN m ON m.city = s.city AND m.x BETWEEN s.x0 - 50 AND s.x0 + 50 AND m.y BETWEEN s.y0 - 50 AND s.y0 + 50),
  tied AS (SELECT *, rank() OVER (PARTITION BY seg_id ORDER BY dist) AS rk FROM near WHERE dist <= 50),
  best AS (SELECT seg_id, min(dist) AS dist, min(mh_id) AS mh_id, arg_min(ground, mh_id) FILTER (WHERE ground IS NOT NULL) AS ground
    FROM tied WHERE rk = 1 GROUP BY 1)"""


@query("nearest_by_city", f"""{BY_CITY} SELECT s.seg_id, s.city, {d6('b.dist')} AS distance, b.mh_id, b.ground
  FROM fx_segments s LEFT JOIN best b ON b.seg_id = s.seg_id""")
def _(d):
    starts = d.segments().select("seg_id", "city", F.col("x0").alias("x"), F.col("y0").alias("y"))
    city = F.concat(F.lit("C"), F.substring("mh_id", 2, 20).cast("bigint") % 25)
    holes = d.view("fx_manholes").withColumn("city", city)
    # Small leaves, so that bins are split.
    out = nn.nearest_join(starts, holes, 50.0, ["mh_id", "ground"], "mh_id", partition=["city"], leaf=4)
    return out.select("seg_id", "city", r6("distance").alias("distance"), F.col("near_mh_id").alias("mh_id"), F.col("near_ground").alias("ground"))


def with_nodes(d: Data):
    fields = {"id": "mh_id", "ground": "ground", "invert": "invert", "mdepth": "depth"}
    lines = d.lines().drop("ground")
    return nn.attach_endpoints(lines, d.view("fx_manholes"), fields, "seg_id", "mh_id", P.NODE_DISTANCE, numeric=["ground", "invert", "mdepth"])


@query("attach_endpoints", f"""{ENDS} SELECT seg_id, id_up, id_down, ground_up, ground_down_ AS ground_down, invert_up, invert_down,
  mdepth_up, mdepth_down FROM a""")
def _(d):
    return with_nodes(d).select("seg_id", "id_up", "id_down", "ground_up", "ground_down", "invert_up", "invert_down", "mdepth_up", "mdepth_down")


@query("plausibility", f"""{DEPTH} SELECT seg_id, NOT b1 AS test_invert, NOT (b2 OR b3) AS test_ground, true AS test_depth,
  CASE WHEN b1 THEN '{P.FLAG_SLOPE}' ELSE '' END || CASE WHEN b2 THEN '{P.FLAG_GROUND_UP}' ELSE '' END
  || CASE WHEN b3 THEN '{P.FLAG_GROUND_DOWN}' ELSE '' END AS alert FROM b""")
def _(d):
    return ru.plausibility(with_nodes(d)).select("seg_id", "test_invert", "test_ground", "test_depth", "alert")


@query("mean_depth", f"""{DEPTH} SELECT seg_id, {d6('CASE WHEN NOT b1 AND NOT b2 AND NOT b3 THEN coalesce(m1, m2) END')} AS mean_depth,
  CASE WHEN m1 IS NOT NULL THEN '{P.METHOD_DEPTHS}' WHEN m2 IS NOT NULL THEN '{P.METHOD_LEVELS}' ELSE '' END
  || CASE WHEN b1 OR b2 OR b3 THEN '{P.METHOD_DOUBT}' ELSE '' END AS method FROM b""")
def _(d):
    out = ru.mean_depth(ru.plausibility(with_nodes(d)), depth="mdepth")
    return out.select("seg_id", r6("mean_depth").alias("mean_depth"), "method")


@query("plausibility_report", f"""{DEPTH} SELECT 'slope' AS test, count(CASE WHEN b1 THEN 1 END) AS n FROM b
  UNION ALL SELECT 'ground', count(CASE WHEN b2 OR b3 THEN 1 END) FROM b
  UNION ALL SELECT 'by depths', count(m1) FROM b
  UNION ALL SELECT 'by levels', count(CASE WHEN m1 IS NULL THEN m2 END) FROM b
  UNION ALL SELECT 'none', count(CASE WHEN b1 OR b2 OR b3 OR coalesce(m1, m2) IS NULL THEN 1 END) FROM b""")
def _(d):
    out = ru.mean_depth(ru.plausibility(with_nodes(d)), depth="mdepth")
    return pr.count_where(out, {
        "slope": ~F.col("test_invert"), "ground": ~F.col("test_ground"),
        "by depths": F.col("method").startswith(P.METHOD_DEPTHS), "by levels": F.col("method").startswith(P.METHOD_LEVELS),
        "none": F.col("mean_depth").isNull(),
    })


@query("extract_nodes", """WITH e AS (SELECT node_up AS id_node, level_up AS level, x0 AS x, 0 AS side, seg_id FROM fx_segments UNION ALL
    SELECT node_down, level_down, x1, 1, seg_id FROM fx_segments),
  f AS (SELECT *, row_number() OVER (PARTITION BY id_node ORDER BY side, seg_id) AS rn FROM e WHERE id_node IS NOT NULL)
  SELECT id_node, level, x, row_number() OVER (ORDER BY id_node) - 1 AS node_index FROM f WHERE rn = 1""")
def _(d):
    return ru.extract_nodes(
        d.segments(), {"id_node": "node_up", "level": "level_up", "x": "x0"},
        {"id_node": "node_down", "level": "level_down", "x": "x1"}, "seg_id",
    )


# ---------------------------------------------------------------- tiles and cells

TILE = 500.0


@query("points_in_tiles", """SELECT s.seg_id, t.tile_id FROM fx_segments s LEFT JOIN fx_tiles t
  ON s.x0 > t.xmin AND s.x0 < t.xmax AND s.y0 > t.ymin AND s.y0 < t.ymax""")
def _(d):
    points = d.segments().select("seg_id", F.col("x0").alias("x"), F.col("y0").alias("y"))
    return ti.points_in_boxes(points, d.view("fx_tiles"), TILE).select("seg_id", F.col("t_tile_id").alias("tile_id"))


SAMPLE = """p AS (SELECT e.*, t.tile_id, CAST(floor((t.ymax - e.y) / 10) AS INT) AS r, CAST(floor((e.x - t.xmin) / 10) AS INT) AS c
    FROM ends e LEFT JOIN fx_tiles t ON e.x > t.xmin AND e.x < t.xmax AND e.y > t.ymin AND e.y < t.ymax),
  v AS (SELECT p.seg_id, p.e, p.tile_id, CASE WHEN k.value <> -9999.0 THEN k.value END AS value FROM p
    LEFT JOIN fx_cells k ON k.tile_id = p.tile_id AND k.row = p.r AND k.col = p.c)"""
END_POINTS = """ends AS (SELECT seg_id, 'up' AS e, x0 AS x, y0 AS y FROM fx_segments UNION ALL SELECT seg_id, 'down', x1, y1 FROM fx_segments)"""


@query("raster_sample", f"WITH {END_POINTS}, {SAMPLE} SELECT seg_id, tile_id, value FROM v WHERE e = 'down'")
def _(d):
    points = d.segments().select("seg_id", F.col("x1").alias("x"), F.col("y1").alias("y"))
    return ti.sample_raster(points, d.view("fx_tiles"), d.cells(), "seg_id", TILE)


@query("ground_levels", f"""WITH {END_POINTS}, {SAMPLE}, w AS (SELECT s.seg_id, coalesce(u.value, s.ground) AS up, w.value AS down FROM fx_segments s
    JOIN v u ON u.seg_id = s.seg_id AND u.e = 'up' JOIN v w ON w.seg_id = s.seg_id AND w.e = 'down')
  SELECT seg_id, {d6('up')} AS ground, {d6('down')} AS ground_down, {d6('(up + down) / 2')} AS ground_mean FROM w""")
def _(d):
    out = ti.ground_levels(d.lines(), d.view("fx_tiles"), d.cells(), "seg_id", TILE, "ground", "ground_down", "ground_mean")
    return out.select("seg_id", *[r6(c).alias(c) for c in ("ground", "ground_down", "ground_mean")])


def _zonal_sql() -> str:
    """All cells of the bounding box, kept by their distance from the segment."""
    def axis(p0, d, lo, hi):
        return f"least(({lo} - {p0}) / {d}, ({hi} - {p0}) / {d})", f"greatest(({lo} - {p0}) / {d}, ({hi} - {p0}) / {d})"

    ex, lx = axis("x0", "dx", "cx", "cx + 10")
    ey, ly = axis("y0", "dy", "cy", "cy + 10")
    box = lambda px, py: f"sqrt(pow(greatest(cx - {px}, 0, {px} - cx - 10), 2) + pow(greatest(cy - {py}, 0, {py} - cy - 10), 2))"

    def corner(px, py):
        t = f"least(greatest((({px} - x0) * dx + ({py} - y0) * dy) / (dx*dx + dy*dy), 0.0), 1.0)"
        return f"sqrt(pow({px} - (x0 + {t} * dx), 2) + pow({py} - (y0 + {t} * dy), 2))"

    corners = ", ".join(corner(px, py) for px in ("cx", "(cx + 10)") for py in ("cy", "(cy + 10)"))
    return f"""WITH s AS (SELECT seg_id, x0, y0, x1, y1, x1 - x0 AS dx, y1 - y0 AS dy,
        CAST(floor((least(x0, x1) - 5) / 10) AS BIGINT) - 1 AS c0, CAST(floor((greatest(x0, x1) + 5) / 10) AS BIGINT) AS c1,
        CAST(floor((995 - greatest(y0, y1)) / 10) AS BIGINT) - 1 AS r0, CAST(floor((1005 - least(y0, y1)) / 10) AS BIGINT) AS r1 FROM fx_segments),
      g AS (SELECT *, unnest(generate_series(c0, c1)) AS gc FROM s), h AS (SELECT *, unnest(generate_series(r0, r1)) AS gr FROM g),
      b AS (SELECT seg_id, x0, y0, x1, y1, dx, dy, gc, gr, gc * 10.0 AS cx, 990.0 - gr * 10.0 AS cy FROM h),
      n AS (SELECT seg_id, gc, gr FROM b WHERE greatest({ex}, {ey}, 0) <= least({lx}, {ly}, 1)
        OR least({box('x0', 'y0')}, {box('x1', 'y1')}, {corners}) <= 5),
      m AS (SELECT n.seg_id, avg(k.value) AS mean, count(k.value) AS n_cells FROM n JOIN fx_cells k
        ON k.grow = n.gr AND k.gcol = n.gc AND k.value <> -9999.0 GROUP BY 1)
      SELECT s.seg_id, {d6('coalesce(m.mean, 0.0)')} AS mean, coalesce(m.n_cells, 0) AS n_cells
      FROM fx_segments s LEFT JOIN m ON m.seg_id = s.seg_id"""


@query("zonal_mean", _zonal_sql())
def _(d):
    out = ti.zonal_mean(d.lines(), d.view("fx_tiles"), d.cells(), P.BUFFER_RADIUS, "seg_id", TILE)
    return out.select("seg_id", r6("mean").alias("mean"), "n_cells")


# ---------------------------------------------------------------- polygons

CLIP = f"""WITH pairs AS (SELECT s.seg_id, p.poly_id, p.level, {LENGTH} AS len,
    greatest(least((p.xmin-x0)/(x1-x0), (p.xmax-x0)/(x1-x0)), least((p.ymin-y0)/(y1-y0), (p.ymax-y0)/(y1-y0)), 0) AS t0,
    least(greatest((p.xmin-x0)/(x1-x0), (p.xmax-x0)/(x1-x0)), greatest((p.ymin-y0)/(y1-y0), (p.ymax-y0)/(y1-y0)), 1) AS t1
    FROM fx_segments s JOIN fx_hazard p ON least(x0, x1) <= p.xmax AND greatest(x0, x1) >= p.xmin
      AND least(y0, y1) <= p.ymax AND greatest(y0, y1) >= p.ymin),
  clip AS (SELECT *, greatest(t1 - t0, 0) * len AS inside FROM pairs),
  pick AS (SELECT seg_id, max(CASE WHEN inside >= len - 1e-6 THEN level END) AS held,
    arg_min(level, poly_id) FILTER (WHERE top) AS longest FROM
    (SELECT *, round(inside, 9) = max(round(inside, 9)) OVER (PARTITION BY seg_id) AND inside > 0 AS top FROM clip) t GROUP BY 1)"""


@query("clip_length", f"{CLIP} SELECT seg_id, poly_id, {d6('inside')} AS clip_length FROM clip")
def _(d):
    pairs = ov.line_polygon_pairs(d.lines(), d.hazard(), "seg_id", 200.0)
    return pairs.select("seg_id", "poly_id", r6("clip_length").alias("clip_length"))


@query("hazard_overlay_null", f"{CLIP} SELECT s.seg_id, coalesce(k.held, k.longest) AS level FROM fx_segments s LEFT JOIN pick k ON k.seg_id = s.seg_id")
def _(d):
    return ov.overlay_largest(d.lines(), d.hazard(), "seg_id", 200.0, None, "level").select("seg_id", "level")


@query("hazard_overlay_zero", f"""{CLIP} SELECT s.seg_id, CASE WHEN s.effluent_raw <> 'NC' THEN coalesce(k.held, k.longest, 0) END AS level
  FROM fx_segments s LEFT JOIN pick k ON k.seg_id = s.seg_id""")
def _(d):
    some = d.lines().withColumn("geom", F.when(F.col("effluent_raw") != "NC", F.col("geom")))
    return ov.overlay_largest(some, d.hazard(), "seg_id", 200.0, 0, "level").select("seg_id", "level")


def _span_sql(dx: str, dy: str) -> str:
    """Length of a segment inside the box of ``fx_hazard``, drawn in by so much on each side."""
    low = f"greatest(least((xmin+{dx}-x0)/(x1-x0), (xmax-{dx}-x0)/(x1-x0)), least((ymin+{dy}-y0)/(y1-y0), (ymax-{dy}-y0)/(y1-y0)), 0)"
    high = f"least(greatest((xmin+{dx}-x0)/(x1-x0), (xmax-{dx}-x0)/(x1-x0)), greatest((ymin+{dy}-y0)/(y1-y0), (ymax-{dy}-y0)/(y1-y0)), 1)"
    return f"greatest({high} - {low}, 0) * {LENGTH}"


@query("holed_lengths", f"""WITH t AS (SELECT seg_id, poly_id, {_span_sql('0', '0')} AS outer_, {_span_sql('(xmax-xmin)/4', '(ymax-ymin)/4')} AS inner_
    FROM fx_segments s JOIN fx_hazard p ON least(x0, x1) <= xmax AND greatest(x0, x1) >= xmin AND least(y0, y1) <= ymax AND greatest(y0, y1) >= ymin)
  SELECT seg_id, poly_id, {d6('outer_ - inner_')} AS clip_length FROM t WHERE outer_ - inner_ > 1e-6""")
def _(d):
    """Boxes with a hole and 4 000 vertices on their border, by bins of 40 m."""
    c = {n: F.col(n) for n in ("xmin", "ymin", "xmax", "ymax")}
    corners = [(c["xmin"], c["ymin"]), (c["xmax"], c["ymin"]), (c["xmax"], c["ymax"]), (c["xmin"], c["ymax"])]
    def side(a, b):
        along = F.sequence(F.lit(0), F.lit(999))
        return F.transform(along, lambda i: geo.vertex(a[0] + (b[0] - a[0]) * i / 1000, a[1] + (b[1] - a[1]) * i / 1000))

    sides = [side(a, b) for a, b in zip(corners, [*corners[1:], corners[0]])]
    shell = F.concat(*sides, F.array(geo.vertex(*corners[0])))
    dx, dy = (c["xmax"] - c["xmin"]) / 4, (c["ymax"] - c["ymin"]) / 4
    hole = geo.box_ring(c["xmin"] + dx, c["ymin"] + dy, c["xmax"] - dx, c["ymax"] - dy)
    holed = d.view("fx_hazard").select("poly_id", F.concat(F.array(shell), hole).alias("rings"))
    inside = ov.lengths_inside(d.lines(), holed, "seg_id", 40.0)
    return inside.filter("clip_length > 1e-6").select("seg_id", "poly_id", r6("clip_length").alias("clip_length"))


@query("point_in_polygon", """WITH b AS (SELECT *, (xmax - xmin) / 4 AS dx, (ymax - ymin) / 4 AS dy FROM fx_hazard)
  SELECT m.mh_id, h.poly_id, x > xmin AND x < xmax AND y > ymin AND y < ymax
    AND NOT (x >= xmin + dx AND x <= xmax - dx AND y >= ymin + dy AND y <= ymax - dy) AS inside
  FROM fx_manholes m JOIN b h ON h.poly_id = CAST(floor(m.x / 200) + floor(m.y / 200) * 5 AS INT)""")
def _(d):
    """Every manhole against the box of its 200 m square, which has a hole in its middle."""
    c = {n: F.col(n) for n in ("xmin", "ymin", "xmax", "ymax")}
    dx, dy = (c["xmax"] - c["xmin"]) / 4, (c["ymax"] - c["ymin"]) / 4
    hole = geo.box_ring(c["xmin"] + dx, c["ymin"] + dy, c["xmax"] - dx, c["ymax"] - dy)
    holed = d.view("fx_hazard").select("poly_id", F.concat(geo.box_ring(*c.values()), hole).alias("rings"))
    square = (F.floor(F.col("x") / 200) + F.floor(F.col("y") / 200) * 5).cast("int")
    met = d.view("fx_manholes").withColumn("poly_id", square).join(holed, "poly_id")
    return met.select("mh_id", "poly_id", geo.point_in_polygon(F.col("x"), F.col("y"), F.col("rings")).alias("inside"))
