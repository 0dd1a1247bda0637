"""Queries for sources and sinks, and the whole pre-processing chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linenet import fixtures as X
from linenet import presets as P
from linenet.fixtures import Data
from linenet.functions import geometry as geo
from linenet.operators import schema as sc
from linenet.plans import preprocess as pp
from linenet.session import scratch_path
from linenet.sources import catalogs as ct
from linenet.sources import grids as gr
from linenet.sources import layers as ly
from linenet.sources import tables as tb

from .base import d6, query, r6
from .cleaning import cut_sql, number, number_text, trimmed, year_of
from .spatial import DEPTH, LENGTH


# ---------------------------------------------------------------- tables

@query("csv_round_trip", f"""SELECT seg_id, 'é' || coalesce(nullif(material_raw, ''), '-') AS material,
  CAST(length_raw AS DOUBLE) AS length FROM fx_segments""")
def _(d):
    """Written in two encodings to one folder and read back at once; each file is told by its bytes."""
    seg = d.segments().select(
        "seg_id", F.concat(F.lit("é"), F.coalesce(F.when(F.col("material_raw") != "", F.col("material_raw")), F.lit("-"))).alias("material"),
        F.col("length_raw").alias("length"), F.array("x0").alias("geom"),
    )
    path = scratch_path(d.spark, "csv")
    short = F.col("length") < 25
    tb.write_table(seg.filter(short), path)
    west = seg.filter(~short).drop("geom").write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1")
    west.option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).mode("append").csv(path)
    kinds = "seg_id string, material string, length double"
    return tb.read_table(d.spark, path, schema=kinds)


@query("sink_coercion", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_totalprice FROM orders")
def _(d):
    return sc.stringify_complex(d.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice"))


@query("results_append", "SELECT target, level, model, run_id, f1 FROM fx_results")
def _(d):
    path = scratch_path(d.spark, "results")
    rows = d.view("fx_results")
    even = F.col("run_id") % 2 == 0
    tb.append_results(rows.filter(even), path, ["target", "level"])
    tb.append_results(rows.filter(~even), path, ["target", "level"])
    return d.spark.read.schema(rows.schema).parquet(path).select("target", "level", "model", "run_id", "f1")


# ---------------------------------------------------------------- layers

def as_layer(d: Data) -> DataFrame:
    """Two-part lines with attributes."""
    second = F.array(geo.vertex(F.col("x0"), F.col("y0") + 30), geo.vertex(F.col("x0"), F.col("y0") + 33))
    return d.lines().withColumn("geom", F.when(F.col("effluent_raw") == "EU", F.concat("geom", F.array(second))).otherwise(F.col("geom")))


@query("layer_read", f"""SELECT seg_id, city, {d6(LENGTH + " + CASE WHEN effluent_raw = 'EU' THEN 3 ELSE 0 END")} AS length FROM fx_segments""")
def _(d):
    path = scratch_path(d.spark, "layer")
    ly.write_layer(as_layer(d).select("seg_id", "city", "geom"), path)
    shapes = ly.read_layer(d.spark, path).select("seg_id", r6(geo.line_length(F.col("geom"))).alias("length"))
    attributes = ly.read_layer(d.spark, path, geometry=False)
    return attributes.join(shapes, "seg_id")


@query("layer_round_trip", "SELECT seg_id, x0, y0, x1, y1, length_raw * 2 AS doubled FROM fx_segments")
def _(d):
    """A layer is replaced by something computed from itself; another layer stays."""
    path = scratch_path(d.spark, "layers")
    ly.write_layer(as_layer(d).select("seg_id", "length_raw", "geom"), path, "pipes")
    ly.write_layer(d.view("fx_manholes"), path, "nodes")
    read = ly.read_layer(d.spark, path, "pipes")
    ly.write_layer(read.select("seg_id", (F.col("length_raw") * 2).alias("doubled"), "geom"), path, "pipes")
    again = ly.read_layer(d.spark, path, "pipes")
    up, down = geo.endpoint(F.col("geom"), "up"), geo.endpoint(F.col("geom"), "down")
    return again.select("seg_id", up["x"].alias("x0"), up["y"].alias("y0"), down["x"].alias("x1"), down["y"].alias("y1"), "doubled")


@query("polygon_layer", """SELECT seg_id, CASE WHEN effluent_raw = 'EU' THEN 6 ELSE 3 END AS kind,
  CASE WHEN effluent_raw = 'EU' THEN 3 ELSE 2 END AS n_rings, x0 - 10 AS xmin, y0 - 10 AS ymin,
  x0 + CASE WHEN effluent_raw = 'EU' THEN 25 ELSE 10 END AS xmax, y0 + 10 AS ymax,
  FALSE AS in_hole, TRUE AS in_shell, effluent_raw IS NOT DISTINCT FROM 'EU' AS in_second FROM fx_segments""")
def _(d):
    """Areas with a hole, some of two parts, stay areas in a layer."""
    x, y = F.col("x0"), F.col("y0")
    rings = F.concat(geo.box_ring(x - 10, y - 10, x + 10, y + 10), geo.box_ring(x - 1, y - 1, x + 1, y + 1))
    second = F.col("effluent_raw").eqNullSafe("EU")
    both = F.when(second, F.concat(rings, geo.box_ring(x + 20, y, x + 25, y + 5))).otherwise(rings)
    path = scratch_path(d.spark, "areas")
    ly.write_layer(d.view("fx_segments").select("seg_id", "x0", "y0", both.alias("geom")), path, polygons=True)
    kind = F.conv(F.hex(F.substring("wkb", 2, 1)), 16, 10).cast("int").alias("kind")
    kinds = d.spark.read.parquet(path).select("seg_id", kind)
    read = ly.read_layer(d.spark, path)
    box, g = geo.bbox(F.col("geom")), F.col("geom")
    # Areas are measured where they are read, so that no geometry is shuffled and each box is made once.
    measured = read.select(
        "seg_id", F.size(g).alias("n_rings"), box.alias("box"),
        geo.point_in_polygon(x, y, g).alias("in_hole"), geo.point_in_polygon(x + 5, y + 5, g).alias("in_shell"),
        geo.point_in_polygon(x + 22, y + 2, g).alias("in_second"),
    )
    sides = (F.col(f"box.{c}") for c in ("xmin", "ymin", "xmax", "ymax"))
    return kinds.join(measured, "seg_id").select("seg_id", "kind", "n_rings", *sides, "in_hole", "in_shell", "in_second")


# ---------------------------------------------------------------- many sources

SCAN_TYPES = {"Materiau": "string", "Longueur": "double", "Pente": "double", "Age": "string"}


@query("catalog_scan", f"""SELECT city, seg_id, material_raw AS Materiau, length_raw AS Longueur, {d6('slope_raw')} AS Pente,
  CASE WHEN substring(city, 2)::INT % 2 = 0 THEN age_raw END AS Age FROM fx_segments""")
def _(d):
    """One folder per city; odd cities use names of their own and have no age. Two rows lead nowhere."""
    base = scratch_path(d.spark, "cities")
    seg = d.segments().select("city", "seg_id", "material_raw", "length_raw", "slope_raw", "age_raw")
    even = F.substring("city", 2, 9).cast("int") % 2 == 0
    seg.filter(even).write.partitionBy("city").parquet(f"{base}/a")
    seg.filter(~even).select("city", "seg_id", F.col("material_raw").alias("MAT"), F.col("length_raw").alias("LONG_M"), F.col("slope_raw").alias("PENTE_P")).write.partitionBy("city").parquet(f"{base}/b")
    plain = {"Materiau": "material_raw", "Longueur": "length_raw", "Pente": "slope_raw", "Age": "age_raw"}
    own = {"Materiau": "MAT", "Longueur": "LONG_M", "Pente": "PENTE_P", "Age": None}
    cities = seg.select("city").distinct()
    odd = ~even
    rows = cities.select(
        F.col("city").alias("name"), F.when(odd, F.lit("b")).otherwise(F.lit("a")).alias("folder"),
        F.concat(F.lit("city="), "city").alias("file"),
        *[F.when(odd, F.lit(own[a])).otherwise(F.lit(plain[a])).alias(a) for a in SCAN_TYPES],
    )
    stray = d.spark.createDataFrame([("", "a", "x"), ("Nowhere", "a", "none")], "name string, folder string, file string")
    df, _ = ct.scan_catalog(d.spark, rows.unionByName(stray, allowMissingColumns=True), base, SCAN_TYPES, extra=["seg_id"])
    return df.withColumn("Pente", r6("Pente"))


@query("dept_union", f"""SELECT CAST(p_partkey % 7 AS VARCHAR) AS department, p_partkey AS poly_id, p_size % 3 AS value, 100.0::DOUBLE AS area_side FROM part""")
def _(d):
    """A polygon around every part's position, one file set per department."""
    base = scratch_path(d.spark, "departments")
    x, y = F.col("p_partkey") * 37 % 1000, F.col("p_partkey") * 11 % 1000
    boxes = d.table("part").select(
        (F.col("p_partkey") % 7).cast("string").alias("dep"), F.col("p_partkey").alias("poly_id"), (F.col("p_size") % 3).alias("value"),
        geo.box_ring(x.cast("double"), y.cast("double"), x + 100.0, y + 100.0).alias("rings"),
    )
    named = boxes.withColumn("Dept", F.concat(F.lit("Dept_"), "dep", F.lit(".zone")))
    named.drop("dep").write.partitionBy("Dept").parquet(base)
    out = ct.scan_parts(d.spark, f"{base}/*")
    b = geo.bbox(F.col("rings"))
    return out.select("department", "poly_id", "value", (b["xmax"] - b["xmin"]).alias("area_side"))


# ---------------------------------------------------------------- grids

def write_grids(d: Data, folder: str) -> None:
    """Every tile of the cells as an ASCII grid; cells not in the table get the no-data mark."""
    tiles = d.view("fx_tiles")
    frame = tiles.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(49)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(49))))
    cells = d.view("fx_cells").select("tile_id", "row", "col", "value")
    full = frame.join(cells, ["tile_id", "row", "col"], "left").withColumn("v", F.coalesce("value", F.lit(-9999.0)).cast("string"))
    lines = full.groupBy("tile_id", "xmin", "ymin", "row").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("col", "v"))), lambda s: s["v"]), " ").alias("line")
    )
    head = F.concat(F.lit("ncols 50\nnrows 50\nxllcorner "), "xmin", F.lit("\nyllcorner "), "ymin", F.lit("\ncellsize 10\nNODATA_value -9999\n"))
    texts = lines.groupBy("tile_id", "xmin", "ymin").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row", "line"))), lambda s: s["line"]), "\n").alias("body")
    ).select("tile_id", F.concat(head, "body").alias("text"))

    def save(batches):
        from pyarrow import fs

        for batch in batches:
            for tile, text in zip(batch["tile_id"], batch["text"]):
                system, root = fs.FileSystem.from_uri(folder)
                where = f"{root}/sheet{tile % 3}"
                system.create_dir(where, recursive=True)
                with system.open_output_stream(f"{where}/Dalle_{tile}.{'ASC' if tile % 2 else 'asc'}") as out:
                    out.write(text.encode())
                yield batch[["tile_id"]].iloc[:0]

    texts.mapInPandas(save, "tile_id int").write.format("noop").mode("overwrite").save()


def grids(d: Data) -> str:
    folder = scratch_path(d.spark, "grids")
    write_grids(d, folder)
    return folder


ALL_CELLS = """f AS (SELECT t.tile_id, CAST(r.r AS INT) AS row, CAST(c.c AS INT) AS col FROM fx_tiles t, generate_series(0, 49) r(r), generate_series(0, 49) c(c))"""


@query("ascii_grid_cells", f"""WITH {ALL_CELLS} SELECT 'dalle_' || f.tile_id AS tile_id, f.row, f.col,
  CASE WHEN k.value <> -9999.0 THEN k.value END AS value FROM f LEFT JOIN fx_cells k ON k.tile_id = f.tile_id AND k.row = f.row AND k.col = f.col""")
def _(d):
    return gr.read_ascii_grid(d.spark, grids(d))


@query("tile_index", """SELECT 'dalle_' || tile_id AS tile_id, xmin, ymin, xmax, ymax, cell, nrows, ncols, -9999.0::DOUBLE AS nodata FROM fx_tiles""")
def _(d):
    return gr.tile_index(d.spark, grids(d))


@query("tile_inventory", """WITH w AS (SELECT 'dalle_' || tile_id AS stem, true AS found FROM fx_tiles
    UNION ALL SELECT 'dalle_x' || tile_id, false FROM fx_tiles) SELECT stem, found FROM w""")
def _(d):
    """Every tile asked for under another spelling, and as many names that do not exist."""
    tiles = gr.list_tiles(d.spark, grids(d))
    t = F.col("tile_id").cast("string")
    names = d.view("fx_tiles").select(
        F.explode(F.array(F.concat(F.lit(" DALLE_"), t, F.lit(".asc ")), F.concat(F.lit("dalle_x"), t))).alias("name")
    )
    return gr.pick_tiles(tiles, names).select("stem", F.col("path").isNotNull().alias("found"))


# ---------------------------------------------------------------- the whole chain

def unified(d: Data) -> DataFrame:
    """The fixture segments under the unified attribute names."""
    c = F.col
    return d.lines().select(
        "seg_id", c("city").alias("Ville"), "geom", c("effluent_raw").alias("Nature_effluent"), c("diameter_raw").alias("Diametre"),
        c("length_raw").alias("Longueur"), c("material_raw").alias("Materiau"), c("age_raw").alias("Age"), c("level_up").alias("File_amont"),
        c("level_down").alias("File_aval"), F.lit(None).cast("double").alias("Cote_TN_am"), F.lit(None).cast("double").alias("Cote_TN_av"),
        c("ground").alias("Cote_TN"), c("slope_raw").alias("Pente"), c("depth_up").alias("Prof_Amont"), c("depth_down").alias("Prof_Aval"),
        c("node_up").alias("id_regard_am"), c("node_down").alias("id_regard_av"), F.lit(None).cast("string").alias("nom_rue"),
        c("seg_id").alias("id_troncon"), c("x0").alias("X_amont"), c("y0").alias("Y_amont"), c("x1").alias("X_aval"), c("y1").alias("Y_aval"),
        (c("length_raw") * 3).alias("taux_arbo"), c("length_raw").alias("taux_imper"),
    )


def lookups(d: Data) -> pp.Lookups:
    return pp.Lookups(
        d.lookup(X.MATERIALS), d.lookup(X.EFFLUENTS), d.lookup(X.DIAMETERS), X.AGE_EDGES, X.AGE_LABELS, X.DEPTH_EDGES, X.DEPTH_LABELS
    )


def _value(table: dict, expr: str) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in table.items()) + " END"


CHAIN = f"""{DEPTH}, d AS (SELECT *, CASE WHEN NOT b1 AND NOT b2 AND NOT b3 THEN coalesce(m1, m2) END AS pm,
    nullif(level_up, 0) AS fu, nullif(level_down, 0) AS fd, nullif(length_raw, 0) AS n, nullif(depth_up, 0) AS du, nullif(depth_down, 0) AS dd,
    nullif(ground, 0) AS g, round({LENGTH}, 3) AS len FROM b WHERE round({LENGTH}, 3) >= 1.0),
  z AS (SELECT *, coalesce(pm, (du + dd) / 2, du, dd, g - (fu + fd) / 2) AS zz, coalesce(fu, invert_up) AS a, coalesce(fd, invert_down) AS bb FROM d),
  y1 AS (SELECT *, CASE WHEN slope_raw IS NOT NULL AND a IS NOT NULL AND (bb IS NULL OR bb = 0) AND n > 0
      AND abs(abs(slope_raw) - abs(a / n * 100)) < 0.01 THEN NULL ELSE slope_raw END AS s1 FROM z),
  y2 AS (SELECT *, CASE WHEN s1 IS NOT NULL AND bb IS NOT NULL AND (a IS NULL OR a = 0) AND n > 0
      AND abs(abs(s1) - abs(bb / n * 100)) < 0.01 THEN NULL ELSE s1 END AS s2 FROM y1),
  y3 AS (SELECT *, CASE WHEN s2 IS NULL AND a IS NOT NULL AND bb IS NOT NULL AND bb <> 0 AND n > 0 THEN (a - bb) / n * 100 ELSE s2 END AS s3 FROM y2),
  y4 AS (SELECT *, CASE WHEN a > bb AND s3 < 0 THEN abs(s3) ELSE s3 END AS s4 FROM y3),
  y5 AS (SELECT *, CASE WHEN a < bb AND s4 > 0 THEN -abs(s4) ELSE s4 END AS s5 FROM y4),
  k AS (SELECT *, {cut_sql('zz', X.DEPTH_EDGES, X.DEPTH_LABELS, True)} AS dk, {year_of('age_raw')} AS yy FROM y5),
  m AS (SELECT *, {cut_sql('yy', X.AGE_EDGES, X.AGE_LABELS, False)} AS ak FROM k)
  SELECT seg_id, city AS "Ville", {_value(X.EFFLUENTS, trimmed('effluent_raw'))} AS "Nature_effluent",
    {_value(X.MATERIALS, trimmed('material_raw'))} AS "Materiau", {d6('len', 3)} AS longueur_calc,
    CASE WHEN {number(_value(X.DIAMETERS, number_text('diameter_raw')))} BETWEEN 100 AND 1500
      THEN {number(_value(X.DIAMETERS, number_text('diameter_raw')))} END AS "Diametre_clean",
    {d6('a')} AS "File_amont", {d6('bb')} AS "File_aval", {d6('CASE WHEN abs(s5) <= 10 THEN s5 END')} AS "Pente",
    {d6('CASE WHEN zz > 0 AND zz <= 10 THEN zz END')} AS "Profondeur_finale", CASE WHEN dk NOT IN ('1', '5') THEN dk END AS classe_profondeur,
    yy AS "Age_extracted", CASE WHEN ak NOT IN ('1', '6') THEN ak END AS classe_age,
    CASE WHEN length_raw * 3 <= 100 THEN length_raw * 3 END AS taux_arbo,
    {d6('(nullif(x0, 0) + nullif(x1, 0)) / 2')} AS "X_fin" FROM m"""


@query("preprocess_segments", CHAIN)
def _(d):
    out = pp.finished(pp.preprocess_segments(unified(d), d.view("fx_manholes"), lookups(d), "seg_id"), "seg_id")
    return out.select(
        "seg_id", "Ville", "Nature_effluent", "Materiau", r6("longueur_calc", 3).alias("longueur_calc"), "Diametre_clean",
        *[r6(c).alias(c) for c in ("File_amont", "File_aval", "Pente", "Profondeur_finale")],
        "classe_profondeur", "Age_extracted", "classe_age", "taux_arbo",
        r6((F.col("X_amont") + F.col("X_aval")) / 2).alias("X_fin"),
    )
