"""Longitude/latitude to Lambert-93 (EPSG:2154) and back, as column maths."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import vertex

# GRS80 ellipsoid and the published constants of EPSG:2154.
AXIS = 6378137.0
FLATTENING = 1 / 298.257222101
PARALLELS = (44.0, 49.0)
ORIGIN = (3.0, 46.5)
OFFSETS = (700000.0, 6600000.0)
LONLAT, LAMBERT93 = 4326, 2154

ECC = math.sqrt(2 * FLATTENING - FLATTENING**2)


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - (ECC * math.sin(phi)) ** 2)


def _t(phi: float) -> float:
    s = ECC * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (ECC / 2)


_P1, _P2 = (math.radians(p) for p in PARALLELS)
CONE = math.log(_m(_P1) / _m(_P2)) / math.log(_t(_P1) / _t(_P2))
SCALE = AXIS * _m(_P1) / (CONE * _t(_P1) ** CONE)
RADIUS0 = SCALE * _t(math.radians(ORIGIN[1])) ** CONE


def _conformal(phi: Column) -> Column:
    s = F.sin(phi) * ECC
    return F.pow((1 - s) / (1 + s), F.lit(ECC / 2))


def _forward(v: Column) -> Column:
    phi = F.radians(v["y"])
    radius = F.pow(F.tan(F.lit(math.pi / 4) - phi / 2) / _conformal(phi), F.lit(CONE)) * SCALE
    theta = (F.radians(v["x"]) - math.radians(ORIGIN[0])) * CONE
    return vertex(radius * F.sin(theta) + OFFSETS[0], F.lit(OFFSETS[1] + RADIUS0) - radius * F.cos(theta))


def _inverse(v: Column) -> Column:
    dx = v["x"] - OFFSETS[0]
    dy = F.lit(RADIUS0 + OFFSETS[1]) - v["y"]
    t = F.pow(F.sqrt(dx * dx + dy * dy) / SCALE, F.lit(1 / CONE))
    start = F.lit(math.pi / 2) - F.atan(t) * 2
    # The latitude is a fixed point; eight rounds reach double precision.
    phi = F.aggregate(
        F.sequence(F.lit(1), F.lit(8)),
        start,
        lambda p, _: F.lit(math.pi / 2) - F.atan(t * _conformal(p)) * 2,
    )
    return vertex(F.degrees(F.atan2(dx, dy) / CONE) + ORIGIN[0], F.degrees(phi))


def reproject_point(v: Column, source: int | None, target: int) -> Column:
    """One vertex; a layer without a reference system is taken to be in Lambert-93."""
    source = source or LAMBERT93
    if source == target:
        return v
    if (source, target) == (LONLAT, LAMBERT93):
        return _forward(v)
    if (source, target) == (LAMBERT93, LONLAT):
        return _inverse(v)
    raise ValueError(f"no conversion from {source} to {target}")


def reproject(g: Column, source: int | None, target: int) -> Column:
    if (source or LAMBERT93) == target:
        return g
    return F.transform(g, lambda part: F.transform(part, lambda v: reproject_point(v, source, target)))
