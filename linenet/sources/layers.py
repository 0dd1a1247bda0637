"""Spatial layers: Parquet tables with well-known binary geometry."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import expand as _expand
from ..functions.arrays import shares as _shares
from ..functions.geometry import GEOM
from .files import replace_folder

# Geometry type codes of well-known binary, the flags of its extended form, and the
# further coordinates that the thousands of a code stand for.
POINT, LINE, POLYGON, MULTI_LINE, MULTI_POLYGON = 1, 2, 3, 5, 6
HAS_Z, HAS_M, HAS_SRID = 0x80000000, 0x40000000, 0x20000000
MORE = {0: 0, 1: 1, 2: 1, 3: 2}
FEW_PARTS = 64  # lines of more parts and areas of more rings are read one by one
AT_ONCE = 131_072  # vertices or pairs of rings that are worked on together


def _read(data: bytes, at: int, parts: list[np.ndarray]) -> int:
    """Add the parts of the geometry at a place, as rows of x and y; the place behind it.

    Other types and broken values raise ``ValueError`` or ``struct.error``.
    """
    order = "<" if data[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", data, at + 1)
    at += 9 if code & HAS_SRID else 5
    plain = code & ~(HAS_Z | HAS_M | HAS_SRID)
    kind, more = plain % 1000, MORE.get(plain // 1000)
    if more is None or kind not in (POINT, LINE, POLYGON, MULTI_LINE, MULTI_POLYGON):
        raise ValueError(f"geometry type {code}")
    dims = 2 + (more or bool(code & HAS_Z) + bool(code & HAS_M))

    def vertices(n: int) -> None:
        nonlocal at
        parts.append(np.frombuffer(data, order + "f8", n * dims, at).reshape(n, dims)[:, :2])
        at += 8 * dims * n

    def count() -> int:
        nonlocal at
        at += 4
        return struct.unpack_from(order + "I", data, at - 4)[0]

    if kind == POINT:
        vertices(1)
        if np.isnan(parts[-1]).all():  # an empty point
            parts.pop()
    elif kind == LINE:
        vertices(count())
    elif kind == POLYGON:
        for _ in range(count()):
            vertices(count())
    else:
        for _ in range(count()):
            at = _read(data, at, parts)
    return at


def _whole(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Four bytes at each place as a number."""
    return sliding_window_view(raw, 4)[at].view("<u4")[:, 0].astype(np.int64)


def _sixteens(raw: np.ndarray) -> np.ndarray:
    """The sixteen bytes of a vertex from each place on."""
    return sliding_window_view(raw, 16, writeable=raw.flags.writeable).view("V16")[:, 0]


def _plain_parts(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whether each geometry is plain, a line or polygon or a few of them; of its parts or rings their geometry, the place of
    their coordinates and the number of vertices, by geometry."""
    plain, at = np.zeros(len(start), bool), start.copy()
    owners, places, sizes = [], [], []
    kind, left, rings = (np.zeros(len(start), np.int64) for _ in range(3))
    long = np.flatnonzero(end - start >= 9)
    long = long[raw[start[long]] == 1]
    kind[long], left[long] = _whole(raw, start[long] + 1), _whole(raw, start[long] + 5)
    single, multi = (kind == LINE) | (kind == POLYGON), (kind == MULTI_LINE) | (kind == MULTI_POLYGON)
    plain[single | (multi & (left > 0) & (left <= FEW_PARTS))] = True
    left[single] = 1
    at[multi] += 9
    area = (kind == POLYGON) | (kind == MULTI_POLYGON)
    rows = np.flatnonzero(plain)
    for _ in range(FEW_PARTS):
        # Where no ring is left the next line or polygon begins: a line is one "ring" behind its type.
        new = rows[rings[rows] == 0]
        size = np.where(area[new], 9, 5)
        fits = end[new] - at[new] >= size
        fits[fits] = (raw[at[new[fits]]] == 1) & (_whole(raw, at[new[fits]] + 1) == np.where(area[new[fits]], POLYGON, LINE))
        plain[new[~fits]] = False
        new, size = new[fits], size[fits]
        rings[new] = np.where(area[new], _whole(raw, at[new] + 5), 1)
        at[new] += size
        left[new] -= 1
        # One ring of each.
        rows = rows[plain[rows]]
        some = rows[rings[rows] > 0]
        fits = end[some] - at[some] >= 4
        plain[some[~fits]] = False
        some = some[fits]
        n = _whole(raw, at[some])
        fits = end[some] - at[some] - 4 >= 16 * n
        plain[some[~fits]] = False
        some, n = some[fits], n[fits]
        owners.append(some)
        places.append(at[some] + 4)
        sizes.append(n)
        at[some] += 4 + 16 * n
        rings[some] -= 1
        rows = rows[plain[rows] & ((rings[rows] > 0) | (left[rows] > 0))]
        if not len(rows):
            break
    plain[rows] = False
    none = np.zeros(0, np.int64)
    owner, place, size = (np.concatenate([none, *x]) for x in (owners, places, sizes))
    use = plain[owner]
    return plain, owner[use], place[use], size[use]


def _decode(column: pa.Array) -> pa.Array:
    """Lines as parts, polygons as rings, a point as one part of one vertex; null for other types and broken values.

    Plain lines and polygons are read together, all else one by one.
    """
    offsets = np.frombuffer(column.buffers()[1] or bytes(4), np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    start, end = offsets[:-1], np.where(there, offsets[1:], offsets[:-1])
    plain, owner, place, size = _plain_parts(np.append(raw, np.zeros(16, np.uint8)), start, end)
    xy: list[np.ndarray] = []
    others, missing = [], ~there
    for i in np.flatnonzero(there & ~plain):
        parts: list[np.ndarray] = []
        try:
            missing[i] = not _read(raw[start[i] : end[i]].tobytes(), 0, parts)
        except (ValueError, IndexError, struct.error):
            missing[i] = True
        xy += [] if missing[i] else parts
        others += [] if missing[i] else [i] * len(parts)
    if xy:
        # Behind the bytes of the column, as if they had been there.
        more = np.array([len(v) for v in xy], np.int64)
        place = np.append(place, len(raw) + 16 * (np.cumsum(more) - more))
        owner, size = np.append(owner, others), np.append(size, more)
        raw = np.append(raw, np.concatenate(xy).astype("<f8").reshape(-1).view(np.uint8))
    # Parts of a geometry come in their order, wherever they were found.
    order = np.argsort(owner, kind="stable")
    owner, place, size = owner[order], place[order], size[order]
    part, k = _expand(size)
    flat = np.zeros((0, 2)) if not len(part) else _sixteens(raw)[place[part] + 16 * k].view("<f8").reshape(-1, 2)
    inner = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(column)))]).astype(np.int32)
    points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in (0, 1)], ["x", "y"])
    return pa.ListArray.from_arrays(pa.array(ends), pa.ListArray.from_arrays(pa.array(inner), points), mask=pa.array(missing))


def _encode_lines(column: pa.Array) -> pa.Array:
    """One part as a line, any other number as a multi-line."""
    rings = column.flatten()
    points = rings.flatten()
    xy = np.stack([points.field(i).to_numpy(zero_copy_only=False).astype("<f8") for i in (0, 1)], axis=1)
    size = rings.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(int)
    many = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(int)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    owner, _ = _expand(many)
    multi = there & (many != 1)
    length = np.bincount(owner, 9 + 16 * size, len(many)).astype(int) + 9 * multi
    offsets = np.concatenate([[0], np.cumsum(length)])
    out = np.zeros(offsets[-1] + 16, np.uint8)
    # A part begins behind all parts before it and the heads of all multi-lines up to its own.
    begin = np.cumsum(9 + 16 * size) - (9 + 16 * size) + 9 * np.cumsum(multi)[owner]
    for where, kind, n in ((begin, LINE, size), (offsets[:-1][multi], MULTI_LINE, many[multi])):
        head = np.empty((len(where), 9), np.uint8)
        head[:, 0] = 1
        head[:, 1:] = np.stack([np.full(len(where), kind), n], axis=1).astype("<u4").view(np.uint8)
        sliding_window_view(out, 9, writeable=True)[where] = head
    part, k = _expand(size)
    sliding_window_view(out, 16, writeable=True)[begin[part] + 9 + 16 * k] = xy.view(np.uint8)
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(many), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
    return pc.if_else(column.is_valid(), packed, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def _pairs_inside(xy: np.ndarray, cuts: np.ndarray, at: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a ring and another of the same geometry that runs round the ring's point ``at``.

    ``first`` and ``n`` are the first ring and the number of rings of each ring's geometry.
    """
    inner, outer = [], []
    edges = np.maximum(np.diff(cuts) - 1, 0)
    y, height = np.ascontiguousarray(xy[:, 1]), np.ascontiguousarray(at[:, 1])
    for rings in _shares(n, AT_ONCE):
        i, k = _expand(n[rings])
        i += rings.start
        j = first[i] + k
        i, j = i[i != j], j[i != j]
        for pairs in _shares(edges[j], AT_ONCE):
            own, k = _expand(edges[j[pairs]])
            own += pairs.start
            edge, level = cuts[j[own]] + k, height[i[own]]
            # Few edges cross the height of the point, and only these are taken whole.
            cross = np.flatnonzero((y[edge] > level) != (y[edge + 1] > level))
            own, edge = own[cross], edge[cross]
            p, a, b = at[i[own]], xy[edge], xy[edge + 1]
            right = a[:, 0] + (p[:, 1] - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0]) > p[:, 0]
            odd = np.flatnonzero(np.bincount(own[right] - pairs.start, minlength=pairs.stop - pairs.start) % 2) + pairs.start
            inner.append(i[odd])
            outer.append(j[odd])
    none = np.zeros(0, int)
    return np.concatenate([none, *inner]), np.concatenate([none, *outer])


def _encode_polygons(column: pa.Array) -> pa.Array:
    """Rings with an even number of others round them are shells; one shell is a polygon, any other number a multi-polygon."""
    rings = column.flatten()
    points = rings.flatten()
    xy = np.stack([points.field(i).to_numpy(zero_copy_only=False).astype("<f8") for i in (0, 1)], axis=1)
    size = rings.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(int)
    cuts = np.concatenate([[0], np.cumsum(size)])
    many = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(int)
    owner, place = _expand(many)
    second = np.minimum(cuts[:-1] + 1, np.maximum(cuts[1:] - 1, 0))
    at = np.zeros((len(size), 2))
    some = np.flatnonzero(size)
    at[some] = (xy[cuts[:-1][some]] + xy[second[some]]) / 2
    inner, outer = _pairs_inside(xy, cuts, at, np.arange(len(size)) - place, many[owner])
    depth = np.bincount(inner, minlength=len(size))
    shell = depth % 2 == 0
    # A hole goes to the deepest shell round it, the first among equals.
    use = ~shell[inner] & shell[outer]
    holes, round_it = inner[use], outer[use]
    order = np.lexsort((round_it, -depth[round_it], holes))
    found, top = np.unique(holes[order], return_index=True)
    if len(found) < (~shell).sum():
        raise ValueError("a hole without a shell")
    home = np.arange(len(size))
    home[found] = round_it[order][top]
    order = np.lexsort((np.arange(len(size)), ~shell, home))
    size, shell, start, place = size[order], shell[order], cuts[:-1][order], owner[order]
    # Rings now stand in the order of their bytes: each behind its length, the first of a polygon behind
    # a head, the first of a multi-polygon behind one more.
    shells = np.bincount(place[shell], minlength=len(many))
    opens = np.diff(place, prepend=-1) > 0
    before = 4 + 9 * shell + 9 * (opens & (shells[place] != 1))
    length = np.bincount(place, before + 16 * size, len(many)).astype(int) + 9 * (many == 0)
    offsets = np.concatenate([[0], np.cumsum(np.where(column.is_valid().to_numpy(zero_copy_only=False), length, 0))])
    out = np.zeros(offsets[-1] + 16, np.uint8)

    def put(where: np.ndarray, value: np.ndarray) -> None:
        out[where[:, None] + np.arange(4)] = np.asarray(value, "<u4").reshape(-1, 1).view(np.uint8)

    def head(where: np.ndarray, kind: int, n: np.ndarray) -> None:
        out[where] = 1
        put(where + 1, np.full(len(where), kind))
        put(where + 5, n)

    ends = np.cumsum(before + 16 * size)
    # Geometries without rings shift all that come behind them.
    bare = 9 * np.concatenate([[0], np.cumsum((many == 0) & (np.diff(offsets) > 0))])[:-1]
    body = ends - 16 * size + bare[place] if len(size) else ends
    put(body - 4, size)
    polygons = np.flatnonzero(shell)
    head(body[polygons] - 13, POLYGON, np.diff(np.append(polygons, len(size))))
    multi = np.flatnonzero((shells != 1) & (np.diff(offsets) > 0))
    head(offsets[:-1][multi], MULTI_POLYGON, shells[multi])
    raw = np.ascontiguousarray(xy).view("V16")[:, 0]
    for part in _shares(size, AT_ONCE):
        ring, k = _expand(size[part])
        ring += part.start
        _sixteens(out)[body[ring] + 16 * k] = raw[start[ring] + k]
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(many), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
    return pc.if_else(column.is_valid(), packed, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def _swap_column(df: DataFrame, old: str, new: str, kind: str, fn) -> DataFrame:
    """Replace one column batch by batch; the others pass through untouched."""
    keep = [f for f in df.schema.fields if f.name != old]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [f"`{new}` {kind}"])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(old)
            names = [n for n in batch.schema.names if n != old] + [new]
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(batch.columns) if i != at] + [fn(batch.column(at))], names=names)

    return df.mapInArrow(convert, schema)


def parse_wkb(df: DataFrame, c: str = "wkb", out: str = "geom") -> DataFrame:
    """Points, lines and polygons, single or (but for points) multiple, with or without Z and M, which are left out."""
    return _swap_column(df, c, out, GEOM, _decode)


def undecoded(df: DataFrame, c: str = "wkb") -> DataFrame:
    """``start`` (the first five bytes: byte order and type) and ``n`` of the values that ``parse_wkb`` makes null."""
    told = parse_wkb(df.select(F.col(c).alias("wkb"), F.hex(F.substring(F.col(c), 1, 5)).alias("start")))
    return told.where(F.col("start").isNotNull() & F.col("geom").isNull()).groupBy("start").agg(F.count("*").alias("n"))


def to_wkb(df: DataFrame, c: str = "geom", out: str = "wkb", polygons: bool = False) -> DataFrame:
    """Lines, or with ``polygons`` the areas that the rings enclose."""
    return _swap_column(df, c, out, "binary", _encode_polygons if polygons else _encode_lines)


def read_layer(spark: SparkSession, path: str, layer: str | None = None, geometry: bool = True) -> DataFrame:
    """A layer, or with ``geometry=False`` its attributes alone (the scan skips the rest)."""
    df = spark.read.parquet(f"{path}/{layer}" if layer else path)
    return parse_wkb(df) if geometry else df.drop("wkb")


def write_layer(df: DataFrame, path: str, layer: str | None = None, polygons: bool = False) -> None:
    """Write or replace one layer; ``polygons`` says that ``geom`` holds rings.

    The rows are written once, beside the layer, and then take its name. So a layer can be replaced by
    something computed from it, and a write that fails leaves the old one as it was.
    """
    where = (f"{path}/{layer}" if layer else path).rstrip("/")
    coded = to_wkb(df, polygons=polygons) if "geom" in df.columns else df
    folder, name = where.rsplit("/", 1)
    fresh = f"{folder}/.{name}-{uuid.uuid4().hex}"
    coded.write.parquet(fresh)
    replace_folder(df.sparkSession, fresh, where)
