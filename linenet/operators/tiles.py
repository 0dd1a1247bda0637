"""Joins of points and lines with raster tiles and their cells.

Tiles are rows ``(tile_id, xmin, ymin, xmax, ymax, cell, nrows, ncols)``; cells are
rows ``(tile_id, row, col, value)`` with null for "no data", row 0 at the top.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.arrays import expand as _expand
from ..functions.arrays import shares as _shares
from ..session import scratch_path
from ..sources.tables import checkpoint_table

ROWS_AT_ONCE, CELLS_AT_ONCE = 65_536, 131_072  # that a task measures
# Cells meet lines in blocks of so many rows and columns, one bit for each; both are powers of two, their product 64 at most.
BLOCK_ROWS, BLOCK_COLS = 4, 8


def bins_between(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size).cast("bigint"), F.floor(high / size).cast("bigint"))


def _tile_bins(tiles: DataFrame, size: float) -> DataFrame:
    named = tiles.select(*[F.col(c).alias(f"t_{c}") for c in ("tile_id", "xmin", "ymin", "xmax", "ymax", "cell", "nrows", "ncols")])
    return named.withColumn("_bx", F.explode(bins_between(F.col("t_xmin"), F.col("t_xmax"), size))).withColumn(
        "_by", F.explode(bins_between(F.col("t_ymin"), F.col("t_ymax"), size))
    )


def _met_bins(tiles: DataFrame, size: float, bins: DataFrame) -> DataFrame:
    """Tiles by bin, of those bins alone that hold something.

    They are written, so a join knows their size: few bins, which may each hold much, are sent to
    every task, and only many are shuffled.
    """
    taken = bins.toDF("_ox", "_oy").distinct()
    met = _tile_bins(tiles, size).join(taken, (F.col("_bx") == F.col("_ox")) & (F.col("_by") == F.col("_oy")), "left_semi")
    return checkpoint_table(met, scratch_path(tiles.sparkSession, "bins"))


def points_in_boxes(points: DataFrame, tiles: DataFrame, size: float) -> DataFrame:
    """Points with every tile whose interior holds them; an edge belongs to no tile.

    ``size`` is the side of the bins both sides meet in, best near the side of a tile.
    """
    placed = points.withColumn("_px", F.floor(F.col("x") / size).cast("bigint")).withColumn(
        "_py", F.floor(F.col("y") / size).cast("bigint")
    )
    inside = (
        (F.col("x") > F.col("t_xmin")) & (F.col("x") < F.col("t_xmax"))
        & (F.col("y") > F.col("t_ymin")) & (F.col("y") < F.col("t_ymax"))
    )
    cond = (F.col("_px") == F.col("_bx")) & (F.col("_py") == F.col("_by")) & inside
    met = _met_bins(tiles, size, placed.select("_px", "_py"))
    return placed.join(met, cond, "left").drop("_px", "_py", "_bx", "_by")


def cell_of(x: Column, y: Column, xmin: Column, ymax: Column, cell: Column) -> tuple[Column, Column]:
    """Row and column of a position, counted from the upper left corner."""
    return F.floor((ymax - y) / cell).cast("int"), F.floor((x - xmin) / cell).cast("int")


def sample_raster(points: DataFrame, tiles: DataFrame, cells: DataFrame, key: str, size: float) -> DataFrame:
    """Value of the raster under each point as ``(key, tile_id, value)``.

    A point in several tiles takes the last one. The tile is settled before the cells
    are joined, so each point meets one cell at most and cells are read once.
    """
    held = points_in_boxes(points, tiles, size)
    row, col = cell_of(F.col("x"), F.col("y"), F.col("t_xmin"), F.col("t_ymax"), F.col("t_cell"))
    spot = F.when(
        F.col("t_tile_id").isNotNull(),
        F.struct(F.col("t_tile_id").alias("tile_id"), row.alias("row"), col.alias("col")),
    )
    last = held.groupBy(key).agg(F.max(spot).alias("_s"))
    values = cells.select(
        F.col("tile_id").alias("_t"), F.col("row").alias("_r"), F.col("col").alias("_c"), "value"
    )
    cond = (F.col("_s.tile_id") == F.col("_t")) & (F.col("_s.row") == F.col("_r")) & (F.col("_s.col") == F.col("_c"))
    return last.join(values, cond, "left").select(key, F.col("_s.tile_id").alias("tile_id"), "value")


def ground_levels(
    lines: DataFrame, tiles: DataFrame, cells: DataFrame, key: str, size: float,
    up: str, down: str, mean: str, geom: str = "geom",
) -> DataFrame:
    """Raster level at both line ends; the old value stays where the raster has none."""
    from .nearest import line_ends

    ends = line_ends(lines, key, geom).withColumn("_end_id", F.struct(key, "end"))
    sampled = sample_raster(ends, tiles, cells, "_end_id", size)
    wide = sampled.groupBy(F.col(f"_end_id.{key}").alias("_line")).agg(
        F.max(F.when(F.col("_end_id.end") == "up", F.col("value"))).alias("_up"),
        F.max(F.when(F.col("_end_id.end") == "down", F.col("value"))).alias("_down"),
    )
    old = {c: F.col(c) if c in lines.columns else F.lit(None).cast("double") for c in (up, down)}
    joined = lines.join(wide, F.col(key) == F.col("_line"), "left")
    filled = joined.withColumns({up: F.coalesce(F.col("_up"), old[up]), down: F.coalesce(F.col("_down"), old[down])})
    return filled.withColumn(mean, (F.col(up) + F.col(down)) / 2).drop("_line", "_up", "_down")


def _near_boxes(x0, y0, x1, y1, left, low, right, high, r: float) -> np.ndarray:
    """``geo.dist_seg_square`` at most ``r``, over arrays; NaN stands for null, which least and greatest pass over."""
    dx, dy = x1 - x0, y1 - y0

    def slab(p, d, a, b):
        flat = (p >= a) & (p <= b)
        u, v = (a - p) / d, (b - p) / d
        return np.where(d == 0, np.where(flat, 0.0, 2.0), np.fmin(u, v)), np.where(d == 0, np.where(flat, 1.0, -1.0), np.fmax(u, v))

    def to_box(px, py):
        h, v = np.fmax(np.fmax(left - px, 0.0), px - right), np.fmax(np.fmax(low - py, 0.0), py - high)
        return np.sqrt(h * h + v * v)

    def to_piece(px, py):
        norm = dx * dx + dy * dy
        t = np.clip(np.where(norm > 0, ((px - x0) * dx + (py - y0) * dy) / norm, 0.0), 0.0, 1.0)
        h, v = px - (x0 + t * dx), py - (y0 + t * dy)
        return np.sqrt(h * h + v * v)

    (ex, lx), (ey, ly) = slab(x0, dx, left, right), slab(y0, dy, low, high)
    near = np.fmax(np.fmax(ex, ey), 0.0) <= np.fmin(np.fmin(lx, ly), 1.0)
    for gap in (to_box(x0, y0), to_box(x1, y1), to_piece(left, low), to_piece(right, low), to_piece(left, high), to_piece(right, high)):
        near |= gap <= r
    return near


def _reached(batch: pa.RecordBatch, r: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Piece, row, first and last column of what each piece of a batch reaches in each row of its tile, in shares."""
    names = ("_px0", "_py0", "_px1", "_py1", "t_xmin", "t_ymax", "t_cell", "t_nrows", "t_ncols")
    x0, y0, x1, y1, xmin, ymax, cell, nrows, ncols = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names)
    top = np.fmax(np.ceil((ymax - (np.fmax(y0, y1) + r)) / cell) - 1, 0)
    end = np.fmin(np.floor((ymax - (np.fmin(y0, y1) - r)) / cell), nrows - 1)
    high = np.fmax(end - top + 1, 0)
    high = np.where(np.isnan(nrows + ncols + cell + ymax), 0, high).astype(int)
    for share in _shares(high, ROWS_AT_ONCE):
        i, down = _expand(high[share])
        i += share.start
        row, dx, dy = top[i] + down, (x1 - x0)[i], (y1 - y0)[i]
        low = ymax[i] - (row + 1) * cell[i]
        # The stretch of the piece near the row bounds the columns.
        ta, tb = (low - r - y0[i]) / dy, (low + cell[i] + r - y0[i]) / dy
        t0 = np.where(dy == 0, 0.0, np.fmin(np.fmax(np.fmin(ta, tb), 0.0), 1.0))
        t1 = np.where(dy == 0, 1.0, np.fmin(np.fmax(np.fmax(ta, tb), 0.0), 1.0))
        xa, xb = x0[i] + t0 * dx, x0[i] + t1 * dx
        a = np.fmax(np.ceil((np.fmin(xa, xb) - r - xmin[i]) / cell[i]) - 1, 0)
        b = np.fmin(np.floor((np.fmax(xa, xb) + r - xmin[i]) / cell[i]), ncols[i] - 1)
        wide = np.fmax(b - a + 1, 0).astype(int)
        for part in _shares(wide, CELLS_AT_ONCE):
            j, along = _expand(wide[part])
            j += part.start
            col, k = a[j] + along, i[j]
            left, size = xmin[k] + col * cell[k], cell[k]
            near = _near_boxes(x0[k], y0[k], x1[k], y1[k], left, low[j], left + size, low[j] + size, r)
            hit = np.flatnonzero(near)
            own, first = np.unique(j[hit], return_index=True)
            last = np.append(first[1:], len(hit)) - 1
            # What lies within a distance of a straight piece is convex: no gaps in a row.
            yield i[own], *(v.astype(np.int64) for v in (row[own], col[hit[first]], col[hit[last]]))


def _spans(radius: float, key: str):
    """First and last column that each piece reaches in each row of its tile, in batches."""
    r = float(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(divide="ignore", invalid="ignore"):
            for batch in batches:
                for i, *cells in _reached(batch, r):
                    who = pa.array(i)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key).take(who), batch.column("tile_id").take(who), *(pa.array(v.astype(np.int32)) for v in cells)],
                        names=[key, "tile_id", "row", "c0", "c1"],
                    )

    return run


def _codes(column: pa.Array) -> np.ndarray:
    """Equal numbers for equal values; nested values are told apart by their place."""
    if pa.types.is_nested(column.type):
        return np.arange(len(column))
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _merged(pair: np.ndarray, block: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each block of a pair once, in order, with all its bits."""
    order = np.lexsort((block, pair))
    pair, block, mask = pair[order], block[order], mask[order]
    first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (block[1:] != block[:-1]))[: len(pair)])
    return pair[first], block[first], np.bitwise_or.reduceat(mask, first) if len(first) else mask


def _blocks(radius: float, key: str):
    """Blocks of cells, with a bit for each cell, that the pieces of a key reach in a tile, in batches.

    What pieces of one batch reach together is told once. A key that reaches nothing gets a block without a bit and
    without a tile, whose number serves to spread such rows alone.
    """
    r, bits = float(radius), np.uint64(1)

    def of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Place of a key and tile, block and mask, in shares."""
        keys = _codes(batch.column(key))
        _, home, pair = np.unique(keys * (len(keys) + 1) + _codes(batch.column("tile_id")), return_index=True, return_inverse=True)
        held, n, some = [], 0, np.zeros(len(keys) + 1, bool)
        for i, row, c0, c1 in _reached(batch, r):
            j, along = _expand(c1 // BLOCK_COLS - c0 // BLOCK_COLS + 1)
            col = c0[j] // BLOCK_COLS + along
            low, high = np.maximum(c0[j] - col * BLOCK_COLS, 0), np.minimum(c1[j] - col * BLOCK_COLS, BLOCK_COLS - 1)
            ones = (bits << (high - low + 1).astype(np.uint64)) - bits
            mask = ones << (low + row[j] % BLOCK_ROWS * BLOCK_COLS).astype(np.uint64)
            some[keys[i]] = True
            held.append(_merged(home[pair[i[j]]], (row[j] // BLOCK_ROWS << 32) + col, mask))
            n += len(held[-1][0])
            if n > CELLS_AT_ONCE:
                yield _merged(*map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield _merged(*map(np.concatenate, zip(*held, strict=True)))
        bare = np.unique(keys[~some[keys]], return_index=True)[1]
        bare = np.flatnonzero(~some[keys])[bare]
        yield -1 - bare, bare, np.zeros(len(bare), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(divide="ignore", invalid="ignore"):
            for batch in batches:
                for place, block, mask in of(batch):
                    first = np.flatnonzero(np.append(True, place[1:] != place[:-1])[: len(place)])
                    ends = pa.array(np.append(first, len(place)).astype(np.int32))
                    at = place[first]
                    tile = pa.array(np.maximum(at, 0), mask=at < 0)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key).take(pa.array(np.where(at < 0, -1 - at, at))), batch.column("tile_id").take(tile)]
                        + [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int64))) for v in (block, mask)],
                        names=[key, "tile_id", "_blocks", "_masks"],
                    )

    return run


def _pairs(
    lines: DataFrame, tiles: DataFrame, radius: float, key: str, size: float, geom: str, how: str
) -> tuple[DataFrame, DataFrame]:
    """Straight pieces of lines with the tiles they reach, and the tiles by bin of all that lines may reach.

    With ``how`` left every line has a row, if need be without a tile.
    """
    r, some = F.lit(float(radius)), F.explode_outer if how == "left" else F.explode
    pieces = lines.select(key, some(geo.line_pieces(F.col(geom))).alias("_p")).select(
        key, "_p",
        (F.least("_p.x0", "_p.x1") - r).alias("_x0"), (F.greatest("_p.x0", "_p.x1") + r).alias("_x1"),
        (F.least("_p.y0", "_p.y1") - r).alias("_y0"), (F.greatest("_p.y0", "_p.y1") + r).alias("_y1"),
    )
    binned = pieces.withColumn("_lx", some(bins_between(F.col("_x0"), F.col("_x1"), size))).withColumn(
        "_ly", some(bins_between(F.col("_y0"), F.col("_y1"), size))
    )
    # A pair meets in several bins but is kept only in the bin of the corner of its overlap.
    cond = (
        (F.col("_lx") == F.col("_bx")) & (F.col("_ly") == F.col("_by"))
        & (F.floor(F.greatest(F.col("_x0"), F.col("t_xmin")) / size) == F.col("_bx"))
        & (F.floor(F.greatest(F.col("_y0"), F.col("t_ymin")) / size) == F.col("_by"))
        & (F.col("_x0") <= F.col("t_xmax")) & (F.col("_x1") >= F.col("t_xmin"))
        & (F.col("_y0") <= F.col("t_ymax")) & (F.col("_y1") >= F.col("t_ymin"))
    )
    met = _met_bins(tiles, size, binned.select("_lx", "_ly"))
    if how == "left":
        # Without a place a piece meets no bin; a number, which is none, keeps such pieces from going to one task.
        placed = F.col("_lx").isNotNull() & F.col("_ly").isNotNull()
        binned = binned.withColumns({"_lx": F.when(placed, F.col("_lx")).otherwise(F.xxhash64(key)), "_ly": F.when(placed, F.col("_ly"))})
    ends = [F.col(f"_p.{c}").alias(f"_p{c}") for c in ("x0", "y0", "x1", "y1")]
    pairs = binned.join(met, cond, how).select(
        key, F.col("t_tile_id").alias("tile_id"), *ends, "t_xmin", "t_ymax", "t_cell", "t_nrows", "t_ncols"
    )
    return pairs, met


def reached_spans(lines: DataFrame, tiles: DataFrame, radius: float, key: str, size: float, geom: str = "geom") -> DataFrame:
    """Cells within a distance of a straight piece of a line, as ``(key, tile_id, row, c0, c1)`` with their first and last column.

    Rows of cells are taken in the height range of a piece, and in each row only the columns the piece
    can reach there are measured, so a long slanting piece does not fill its whole box. Cells are measured in
    arrays: as column expressions they make one method too long for the JVM to compile. Pieces go on their
    own: a line of n pieces costs n rows, none of which knows the others.
    """
    pairs, _ = _pairs(lines, tiles, radius, key, size, geom, "inner")
    kinds = {c: pairs.schema[c].dataType.simpleString() for c in (key, "tile_id")}
    return pairs.mapInArrow(_spans(radius, key), f"`{key}` {kinds[key]}, tile_id {kinds['tile_id']}, row int, c0 int, c1 int")


def touched_cells(lines: DataFrame, tiles: DataFrame, radius: float, key: str, size: float, geom: str = "geom") -> DataFrame:
    """Each cell within a distance of a line once, as ``(key, tile_id, row, col)``."""
    spans = reached_spans(lines, tiles, radius, key, size, geom)
    return spans.select(key, "tile_id", "row", F.explode(F.sequence("c0", "c1")).alias("col")).distinct()


def _cell_blocks(cells: DataFrame, met: DataFrame) -> DataFrame:
    """Cells of the tiles that lines may reach in blocks, ``(tile_id, _block, _values)``; a cell given twice counts with its larger value."""
    row, col = (F.col(c).cast("bigint") for c in ("row", "col"))
    held = cells.filter(F.col("value").isNotNull()).join(met.select(F.col("t_tile_id").alias("tile_id")).distinct(), "tile_id", "left_semi")
    block = (F.floor(row / BLOCK_ROWS) * F.lit(1 << 32) + F.floor(col / BLOCK_COLS)).cast("bigint")
    at = F.pmod(row, F.lit(BLOCK_ROWS)) * BLOCK_COLS + F.pmod(col, F.lit(BLOCK_COLS))
    return held.groupBy("tile_id", block.alias("_block")).agg(
        F.array(*[F.max(F.when(at == i, F.col("value").cast("double"))) for i in range(BLOCK_ROWS * BLOCK_COLS)]).alias("_values")
    )


def zonal_mean(
    lines: DataFrame, tiles: DataFrame, cells: DataFrame, radius: float, key: str, size: float, geom: str = "geom"
) -> DataFrame:
    """Mean of all cells within a distance of each line, as ``(key, mean, n_cells)``.

    A key moves twice: once with the blocks it reaches in a tile, where equal blocks become one, and once with its
    sum and count. Blocks meet those of the cells by equality, where they are if these are few; no single cells are moved.
    Lines without any valid cell get 0.0; they go along with a block that holds nothing.
    """
    pairs, met = _pairs(lines, tiles, radius, key, size, geom, "left")
    kinds = {c: pairs.schema[c].dataType.simpleString() for c in (key, "tile_id")}
    reached = pairs.mapInArrow(
        _blocks(radius, key), f"`{key}` {kinds[key]}, tile_id {kinds['tile_id']}, _blocks array<bigint>, _masks array<bigint>"
    )
    # Dealt out by key and tile alone, so that a row for each tile moves and not one for each block.
    dealt = reached.repartition(key, "tile_id").select(key, "tile_id", "_masks", F.posexplode("_blocks").alias("_i", "_block"))
    every = dealt.groupBy(key, "tile_id", "_block").agg(F.bit_or(F.get("_masks", F.col("_i"))).alias("_mask"))
    # Written, as the bins are: a join then knows their size.
    held = checkpoint_table(_cell_blocks(cells, met), scratch_path(lines.sparkSession, "blocks"))
    hit = F.filter("_values", lambda v, i: v.isNotNull() & (F.getbit(F.col("_mask"), i) == 1))
    found = every.join(held, ["tile_id", "_block"], "left").select(key, hit.alias("_hit")).select(
        key, F.aggregate("_hit", F.lit(0.0), lambda s, v: s + v).alias("_sum"), F.size("_hit").alias("_n")
    )
    total, n = F.sum("_sum"), F.coalesce(F.sum(F.when(F.col("_n") > 0, F.col("_n"))), F.lit(0).cast("bigint"))
    return found.groupBy(key).agg(total.alias("_total"), n.alias("n_cells")).select(
        key, F.when(F.col("n_cells") > 0, F.col("_total") / F.col("n_cells")).otherwise(F.lit(0.0)).alias("mean"), "n_cells"
    )
