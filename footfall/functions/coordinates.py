"""Coordinate systems of positions in China, as column expressions.

``wgs84`` is what satellite receivers give, ``gcj02`` the shifted system of maps there, and ``bd09`` a further shift on top of
it.  The formulas go from wgs84 to gcj02 to bd09; the way back solves them by a fixed point, whose steps shrink a
thousandfold each, so ``STEPS`` of them come back to well under a metre (the tests ask for 0.1 m on a grid).  Outside
the box of the shift wgs84 and gcj02 are the same.  A null coordinate gives nulls.
"""

from __future__ import annotations

from collections.abc import Callable
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

SYSTEMS = ("wgs84", "gcj02", "bd09")
#: Rounds of the fixed point.
STEPS = 5

# The ellipsoid, the box and the terms of the published formulas.
AXIS, ECCENTRICITY = 6_378_245.0, 0.006_693_421_622_965_943
WEST, EAST, SOUTH, NORTH = 72.004, 137.8347, 0.8293, 55.8271
BD_LAT, BD_LNG, BD_RADIUS, BD_ANGLE = 0.006, 0.0065, 0.00002, 0.000003
ORIGIN_LNG, ORIGIN_LAT = 105.0, 35.0
#: Constant, and factors of x, y, x^2, y^2, x y and sqrt|x|, of the shift northward and eastward.
NORTHWARD = (-100.0, 2.0, 3.0, 0.0, 0.2, 0.1, 0.2)
EASTWARD = (300.0, 1.0, 2.0, 0.1, 0.0, 0.1, 0.1)
#: Waves of the shift: amplitude and wavelength, over x for both, then over y or x.
COMMON_WAVES = ((20.0, 1 / 6), (20.0, 1 / 2))
NORTHWARD_WAVES = ((20.0, 1.0), (40.0, 3.0), (160.0, 12.0), (320.0, 30.0))
EASTWARD_WAVES = ((20.0, 1.0), (40.0, 3.0), (150.0, 12.0), (300.0, 30.0))


def _place(lat: Column, lng: Column) -> Column:
    return F.struct(lat.cast("double").alias("lat"), lng.cast("double").alias("lng"))


def _waves(over: Column, waves: tuple[tuple[float, float], ...]) -> Column:
    total = F.lit(0.0)
    for amplitude, length in waves:
        total = total + amplitude * F.sin(over * (pi / length))
    return total * (2.0 / 3.0)


def _shift(x: Column, y: Column, terms: tuple[float, ...], over: Column, waves: tuple[tuple[float, float], ...]) -> Column:
    parts = (F.lit(1.0), x, y, x * x, y * y, x * y, F.sqrt(F.abs(x)))
    poly = F.lit(0.0)
    for factor, part in zip(terms, parts, strict=True):
        poly = poly + factor * part
    return poly + _waves(x, COMMON_WAVES) + _waves(over, waves)


def _wgs84_to_gcj02(at: Column) -> Column:
    lat, lng = at["lat"], at["lng"]
    x, y = lng - ORIGIN_LNG, lat - ORIGIN_LAT
    angle = lat * (pi / 180)
    bend = 1 - ECCENTRICITY * F.sin(angle) * F.sin(angle)
    north = _shift(x, y, NORTHWARD, y, NORTHWARD_WAVES) * 180 / (AXIS * (1 - ECCENTRICITY) / (bend * F.sqrt(bend)) * pi)
    east = _shift(x, y, EASTWARD, x, EASTWARD_WAVES) * 180 / (AXIS / F.sqrt(bend) * F.cos(angle) * pi)
    inside = lng.between(WEST, EAST) & lat.between(SOUTH, NORTH)
    return F.when(inside, _place(lat + north, lng + east)).otherwise(at)


def _gcj02_to_bd09(at: Column) -> Column:
    lat, lng = at["lat"], at["lng"]
    radius = F.sqrt(lng * lng + lat * lat) + BD_RADIUS * F.sin(lat * (pi * 3000 / 180))
    angle = F.atan2(lat, lng) + BD_ANGLE * F.cos(lng * (pi * 3000 / 180))
    return _place(radius * F.sin(angle) + BD_LAT, radius * F.cos(angle) + BD_LNG)


def _solved(forward: Callable[[Column], Column], target: Column) -> Column:
    """The place that ``forward`` takes to ``target``: what is missed is added, again and again."""

    def nearer(at: Column, _: Column) -> Column:
        def step(hit: Column) -> Column:
            return _place(at["lat"] + (target["lat"] - hit["lat"]), at["lng"] + (target["lng"] - hit["lng"]))

        return F.get(F.transform(F.array(forward(at)), step), F.lit(0))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), target, nearer)


def _backward(forward: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda target: _solved(forward, target)


def convert(lat: Column, lng: Column, of: str, to: str) -> Column:
    """A struct ``lat``, ``lng``: the position given in system ``of``, in system ``to``."""
    if of not in SYSTEMS or to not in SYSTEMS:
        raise ValueError(f"coordinate systems are {', '.join(SYSTEMS)}")
    forward = (_wgs84_to_gcj02, _gcj02_to_bd09)
    at = _place(lat, lng)
    start, end = SYSTEMS.index(of), SYSTEMS.index(to)
    for k in range(start, end):
        at = _bound(at, forward[k])
    for k in range(start, end, -1):
        at = _bound(at, _backward(forward[k - 1]))
    return at


def _bound(at: Column, then: Callable[[Column], Column]) -> Column:
    """``then(at)`` with ``at`` worked out once."""
    return F.get(F.transform(F.array(at), then), F.lit(0))
