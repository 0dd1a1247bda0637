"""Nearest-point join within a distance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import values as val
from ..session import scratch_path
from ..sources.tables import checkpoint_table

LEAF = 128  # places a bin may hold before it is split
SPLIT = 4  # cells a split bin has along each side
BOX = ("_x0", "_x1", "_y0", "_y1")


def _bin(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(float(size))).cast("bigint")


def _first_present(key: str, c: str) -> Column:
    """Value of a column in the row of the smallest key that has one, with that key."""
    return F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(key).alias("k"), F.col(c).alias("v"))))


def _located(c: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return F.abs(c) < F.lit(float("inf"))


def _boxes(members: DataFrame, key: Sequence[str], leaf: int) -> DataFrame:
    """Bins with the smallest box around their places, and whether they are to be split."""
    return members.groupBy(*key).agg(
        (F.count(F.lit(1)) > leaf).alias("_split"), F.min("_rx").alias("_x0"), F.max("_rx").alias("_x1"),
        F.min("_ry").alias("_y0"), F.max("_ry").alias("_y1"),
    )


def _cell(c: str, low: str, high: str) -> Column:
    """Which of the cells between two bounds a value falls in; the bounds lie in the first and the last."""
    share = (F.col(c) - F.col(low)) / (F.col(high) - F.col(low))
    inner = F.least(F.floor(share * SPLIT), F.lit(SPLIT - 1))
    return F.when(F.col(low) == F.col(high), 0).when(F.col(c) == F.col(high), SPLIT - 1).otherwise(inner).cast("int")


def bin_tree(places: DataFrame, by: Sequence[str], reach: float, leaf: int = LEAF) -> list[tuple[DataFrame, DataFrame]]:
    """Bins and their places, level by level; a bin of more than ``leaf`` places is split on the next level.

    The first level is a grid of side ``reach``. A bin is split along the box around its places, so that a dense
    spot in a wide bin is found in one step. Places differ, and those at the bounds of a box part, so every
    split makes the bins smaller and the last level has none to split. ``_path`` has one digit a level.
    Both frames of a level are written tables.
    """
    spark, key = places.sparkSession, [*by, "_bx", "_by", "_path"]
    members = places.withColumns({"_bx": _bin(F.col("_rx"), reach), "_by": _bin(F.col("_ry"), reach), "_path": F.lit("")})
    levels = []
    while True:
        members = checkpoint_table(members, scratch_path(spark, "places"))
        bins = checkpoint_table(_boxes(members, key, leaf), scratch_path(spark, "bins"))
        levels.append((members, bins))
        full = bins.filter("_split")
        if full.isEmpty():
            return levels
        digit = F.hex(_cell("_rx", "_x0", "_x1") * SPLIT + _cell("_ry", "_y0", "_y1"))
        inside = members.join(full.select(*key, *BOX), key)
        members = inside.withColumn("_path", F.concat("_path", digit)).select(*members.columns)


def _span(x: Column, y: Column, farthest: bool = False) -> Column:
    """Distance from a point to the nearest spot of a box, or to its farthest.

    It is made of the same steps as the distance of two points, each of which keeps order, so no rounding puts
    a place of the box outside these bounds.
    """
    if farthest:
        dx = F.greatest(F.abs(x - F.col("_x0")), F.abs(F.col("_x1") - x))
        dy = F.greatest(F.abs(y - F.col("_y0")), F.abs(F.col("_y1") - y))
    else:
        dx = F.greatest(F.col("_x0") - x, F.lit(0.0), x - F.col("_x1"))
        dy = F.greatest(F.col("_y0") - y, F.lit(0.0), y - F.col("_y1"))
    return geo.hypot(dx, dy)


def _meet(asked: DataFrame, levels: Sequence[tuple[DataFrame, DataFrame]], by: Sequence[str], x: str, y: str, reach: float) -> DataFrame:
    """Pairs of asked and right places at most ``reach`` apart, the nearest of each asked place among them.

    Asked places meet the bins around them by equality of bins, never by a distance condition; the nine bins
    around come from two explodes over bins, not places. If any bin was split, an asked place goes on only to those
    that begin nearer than the nearest bin ends, level by level. At last it meets the places of the bins left to it.
    """
    spark, place = asked.sparkSession, [*[f"_q_{c}" for c in by], "_qx", "_qy"]
    key = [*[f"_p_{c}" for c in by], "_bx", "_by", "_path"]
    offset = F.array(*[F.lit(i).cast("bigint") for i in (-1, 0, 1)])
    around = levels[0][1].withColumn("_i", F.explode(offset)).withColumn("_j", F.explode(offset)).withColumns(
        {"_lx": F.col("_bx") + F.col("_i"), "_ly": F.col("_by") + F.col("_j")}
    ).drop("_i", "_j")
    points = asked.select(
        *[F.col(c).alias(f"_q_{c}") for c in by], F.col(x).alias("_qx"), F.col(y).alias("_qy"),
        _bin(F.col(x), reach).alias("_ax"), _bin(F.col(y), reach).alias("_ay"),
    )
    cond = (F.col("_ax") == F.col("_lx")) & (F.col("_ay") == F.col("_ly"))
    for c in by:
        cond = cond & (F.col(f"_q_{c}") == F.col(f"_p_{c}"))
    pairs = points.join(around, cond).drop("_ax", "_ay", "_lx", "_ly").withColumn("_bound", F.lit(float(reach)))
    near, far = _span(F.col("_qx"), F.col("_qy")), _span(F.col("_qx"), F.col("_qy"), farthest=True)
    found = None
    for level, (members, _) in enumerate(levels):
        if level:
            above = pairs.filter("_split").select(*place, *key[:-1], F.col("_path").alias("_above"), "_bound")
            children = levels[level][1].withColumn("_above", F.substring("_path", 1, level - 1))
            pairs = above.join(children, [*key[:-1], "_above"]).drop("_above")
        if len(levels) > 1:
            best = F.min(far).over(Window.partitionBy(*place))
            pairs = pairs.withColumn("_bound", F.least("_bound", best)).filter(near <= F.col("_bound"))
            pairs = checkpoint_table(pairs, scratch_path(spark, "walk"))
        ends = pairs.filter(~F.col("_split") & (near <= F.col("_bound"))).select(*place, *key)
        dist = geo.dist_pp(F.col("_qx"), F.col("_qy"), F.col("_rx"), F.col("_ry"))
        met = ends.join(members, key).drop(*key).withColumn("_d", dist).filter(F.col("_d") <= reach)
        found = met if found is None else found.unionByName(met)
    return found


def _same_place(by: Sequence[str], x: Column, y: Column, near: str = "_a") -> Column:
    """Whether a row asks for the place of an answer."""
    cond = (x == F.col(f"{near}_x")) & (y == F.col(f"{near}_y"))
    for i, c in enumerate(by):
        cond = cond & (F.col(c) == F.col(f"{near}_{i}"))
    return cond


def answers(
    left: DataFrame, right: DataFrame, max_distance: float, cols: Sequence[str], tie_key: str,
    xy: tuple[str, str] = ("x", "y"), partition: Sequence[str] = (), leaf: int = LEAF,
) -> DataFrame:
    """One row for every asked place that has something near: the place, ``distance`` and ``near_<col>``.

    The place is in ``_a_x``, ``_a_y`` and, for the columns of ``partition``, ``_a_0`` and so on. The rows are a
    written table: Spark knows its size, and left rows that ask for few places don't move to meet it.
    """
    x, y = xy
    by = list(partition)
    reach = float(max_distance)
    places = right.filter(_located(F.col(x)) & _located(F.col(y))).groupBy(*by, x, y).agg(
        *[_first_present(tie_key, c).alias(f"_r_{c}") for c in cols]
    )
    places = places.select(
        *[F.col(c).alias(f"_p_{c}") for c in by], F.col(x).alias("_rx"), F.col(y).alias("_ry"), *[f"_r_{c}" for c in cols]
    )
    asked = left.select(*by, x, y).filter(_located(F.col(x)) & _located(F.col(y))).distinct()
    levels = bin_tree(places, [f"_p_{c}" for c in by], reach, leaf)
    place = [*[f"_q_{c}" for c in by], "_qx", "_qy"]
    met = _meet(asked, levels, by, x, y, reach)
    # Smallest (distance, tie key) that has a value; it counts if it is at the least distance.
    picks = met.groupBy(*place).agg(
        F.min("_d").alias("distance"),
        *[
            F.min(F.when(F.col(f"_r_{c}").isNotNull(), F.struct(F.col("_d").alias("d"), F.col(f"_r_{c}").alias("r"))))
            .alias(f"_m_{c}")
            for c in cols
        ],
    )
    found = picks.select(
        *[F.col(f"_q_{c}").alias(f"_a_{i}") for i, c in enumerate(by)], F.col("_qx").alias("_a_x"), F.col("_qy").alias("_a_y"),
        F.col("distance"),
        *[F.when(F.col(f"_m_{c}.d") == F.col("distance"), F.col(f"_m_{c}.r.v")).alias(f"near_{c}") for c in cols],
    )
    return checkpoint_table(found, scratch_path(left.sparkSession, "answers"))


def nearest_join(
    left: DataFrame, right: DataFrame, max_distance: float, cols: Sequence[str], tie_key: str,
    xy: tuple[str, str] = ("x", "y"), partition: Sequence[str] = (), leaf: int = LEAF,
) -> DataFrame:
    """Attach to every left row the columns of its nearest right row within a distance.

    Rows at equal distance are taken together: each column comes from the one with the
    smallest ``tie_key`` that has a value. Rows with nothing near keep nulls.
    ``partition`` names columns (a city, say) that must be equal on both sides.

    Right rows at one place always tie, and left rows at one place share their answer,
    so both sides are first reduced to one row per place with partial aggregation. A
    place that holds a third of the table therefore costs one row. Places lie in bins that
    are split until none holds more than ``leaf`` of them (``bin_tree``). Coordinates that are
    null, NaN or infinite are near nothing.
    """
    found = answers(left, right, max_distance, cols, tie_key, xy, partition, leaf)
    keys = [c for c in found.columns if c.startswith("_a_")]
    return left.join(found, _same_place(partition, F.col(xy[0]), F.col(xy[1])), "left").drop(*keys)


def line_ends(lines: DataFrame, key: str, geom: str = "geom", keep: Sequence[str] = ()) -> DataFrame:
    """Two rows per line (``end`` is ``up`` or ``down``) with the end vertex."""
    g = F.col(geom)
    ends = F.array(
        *[F.struct(F.lit(e).alias("end"), geo.endpoint(g, e).alias("v")) for e in ("up", "down")]
    )
    return lines.select(key, *keep, F.explode(ends).alias("_e")).select(
        key, *keep, F.col("_e.end").alias("end"), F.col("_e.v.x").alias("x"), F.col("_e.v.y").alias("y")
    )


def _repeated(df: DataFrame, key: str) -> DataFrame | None:
    """Hashes of the keys that more than one row has, or none. Eight bytes a row are moved to find them.

    Two keys of one hash are taken for repeated as well, which costs a little and changes nothing.
    """
    many = df.filter(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("_hash")).count().filter("count > 1")
    many = checkpoint_table(many.select("_hash"), scratch_path(df.sparkSession, "repeated"))
    return None if many.isEmpty() else many


def attach_endpoints(
    lines: DataFrame, nodes: DataFrame, fields: Mapping[str, str], key: str, node_key: str,
    max_distance: float, numeric: Sequence[str] = (), partition: Sequence[str] = (), geom: str = "geom",
) -> DataFrame:
    """Columns ``<field>_up`` and ``<field>_down`` from the nearest node of each line end.

    ``fields`` maps the output name to the node column. Both ends go through one search. Lines that share a key
    all get the largest of their values; a line without a key gets none.

    Lines meet the answers of their two ends where they are: they are neither doubled nor grouped by key, unless
    their key comes more than once.
    """
    ends = line_ends(lines, key, geom, partition)
    found = answers(ends, nodes, max_distance, list(dict.fromkeys(fields.values())), node_key, partition=partition)
    kinds = {f.name: f.dataType.typeName() for f in nodes.schema.fields}
    # The ends are a step of their own, since code made for this and both joins together is too long to be compiled.
    both_ends = val.once(F.col(geom), lambda g: F.struct(*[geo.endpoint(g, e).alias(e) for e in ("up", "down")]))
    near, outs = lines.withColumn("_ends", both_ends), [f"{out}_{e}" for out in fields for e in ("up", "down")]
    for e in ("up", "down"):
        keys = [F.col(c).alias(c.replace("_a_", f"_a_{e}_")) for c in found.columns if c.startswith("_a_")]
        values = []
        for out, src in fields.items():
            value = F.col(f"near_{src}")
            if out in numeric:
                value = val.to_double(value) if kinds[src] == "string" else val.finite(value.cast("double"))
            values.append(value.alias(f"_o_{out}_{e}"))
        place = _same_place(partition, F.col(f"_ends.{e}.x"), F.col(f"_ends.{e}.y"), f"_a_{e}") & F.col(key).isNotNull()
        near = near.join(found.select(*keys, *values), place, "left").drop(*[f"_a_{e}_{i}" for i in ("x", "y", *range(len(partition)))])
    near, many, own = near.drop("_ends"), _repeated(lines, key), [f"_o_{c}" for c in outs]
    if many is None:
        return near.select("*", *[F.col(f"_o_{c}").alias(c) for c in outs]).drop(*own)
    shared = near.select(F.col(key).alias("_line"), F.xxhash64(key).alias("_hash"), *own).filter(F.col("_line").isNotNull())
    largest = shared.join(many, "_hash", "left_semi").groupBy("_line").agg(*[F.max(f"_o_{c}").alias(f"_m_{c}") for c in outs])
    largest = checkpoint_table(largest, scratch_path(lines.sparkSession, "shared"))
    picked = [F.coalesce(f"_m_{c}", f"_o_{c}").alias(c) for c in outs]
    both = near.join(largest, F.col(key) == F.col("_line"), "left")
    return both.select("*", *picked).drop("_line", *own, *[f"_m_{c}" for c in outs])
