"""Geometry as columns: points are two doubles, a line is an array of (x, y)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE = "array<struct<x:double,y:double>>"
FEET_PER_METRE = 3.280839895
#: The ellipsoid of degrees, its radius at the equator in metres and its eccentricity.
EQUATOR, ECCENTRICITY = 6378137.0, math.sqrt(2 / 298.257223563 - 1 / 298.257223563**2)

#: EPSG:2249, a Lambert conic with two parallels in US survey feet.
_A, _F = 6378137.0, 1 / 298.257222101
_E2 = _F * (2 - _F)
_E = math.sqrt(_E2)
_LAT0, _LON0, _LAT1, _LAT2 = (math.radians(d) for d in (41.0, -71.5, 41 + 43 / 60, 42 + 41 / 60))
_X0, _Y0, _UNIT = 200000.0, 750000.0, 0.3048006096012192


def _t(lat: float) -> float:
    s = _E * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - _E2 * math.sin(lat) ** 2)


_N = (math.log(_m(_LAT1)) - math.log(_m(_LAT2))) / (math.log(_t(_LAT1)) - math.log(_t(_LAT2)))
_AF = _A * _m(_LAT1) / (_N * _t(_LAT1) ** _N)
_R0 = _AF * _t(_LAT0) ** _N


def to_feet(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to EPSG:2249 feet."""
    phi = F.radians(lat)
    s = F.sin(phi) * _E
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(_E / 2))
    r, theta = F.pow(t, F.lit(_N)) * _AF, (F.radians(lon) - _LON0) * _N
    return (r * F.sin(theta) + _X0) / _UNIT, (F.lit(_R0) - r * F.cos(theta) + _Y0) / _UNIT


def latitude(t: Column, eccentricity: float) -> Column:
    """The latitude, in radians, of an isometric one given as t = exp(-psi): six rounds of its fixed point.

    The rounds are a fold, so that each is written once; written out one in
    another they would double with every round.
    """

    def closer(lat: Column, _: Column) -> Column:
        s = F.sin(lat) * eccentricity
        return F.lit(math.pi / 2) - F.atan(t * F.pow((1 - s) / (1 + s), F.lit(eccentricity / 2))) * 2

    return F.aggregate(F.sequence(F.lit(1), F.lit(6)), F.lit(math.pi / 2) - F.atan(t) * 2, closer)


def to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:2249 feet to degrees."""
    dx, dy = x * _UNIT - _X0, F.lit(_R0) - (y * _UNIT - _Y0)
    r, theta = F.sqrt(dx * dx + dy * dy), F.atan2(dx, dy)
    return F.degrees(theta / _N + _LON0), F.degrees(latitude(F.pow(r / _AF, F.lit(1 / _N)), _E))


def to_utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Degrees to metres of a northern UTM zone, by the usual series to the sixth order."""
    k0, e2 = 0.9996, _E2
    ep2 = e2 / (1 - e2)
    phi, dl = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    n = F.lit(_A) / F.sqrt(1 - F.pow(F.sin(phi), 2) * e2)
    t, c, a = F.pow(F.tan(phi), 2), F.pow(F.cos(phi), 2) * ep2, F.cos(phi) * dl
    m = (phi * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) - F.sin(phi * 2) * (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) + F.sin(phi * 4) * (15 * e2**2 / 256 + 45 * e2**3 / 1024) - F.sin(phi * 6) * (35 * e2**3 / 3072)) * _A
    x = n * (a + (1 - t + c) * F.pow(a, 3) / 6 + (5 - t * 18 + t * t + c * 72 - 58 * ep2) * F.pow(a, 5) / 120) * k0 + 500000
    y = (m + n * F.tan(phi) * (a * a / 2 + (5 - t + c * 9 + c * c * 4) * F.pow(a, 4) / 24 + (61 - t * 58 + t * t + c * 600 - 330 * ep2) * F.pow(a, 6) / 720)) * k0
    return x, y


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to EPSG:3395 metres."""
    phi = F.radians(lat)
    s = F.sin(phi) * math.sqrt(0.0066943799901413165)
    e = math.sqrt(0.0066943799901413165)
    return F.radians(lon) * 6378137.0, F.log(F.tan(phi / 2 + math.pi / 4) * F.pow((1 - s) / (1 + s), F.lit(e / 2))) * 6378137.0


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def map_points(line: Column, move) -> Column:
    """``line`` with ``move(x, y)``, a pair of columns, in place of each point."""
    return F.transform(line, lambda p: point(*move(p["x"], p["y"])))


def _steps(line: Column) -> Column:
    return F.arrays_zip(F.slice(line, 1, F.size(line) - 1).alias("a"), F.slice(line, 2, F.size(line) - 1).alias("b"))


def _total(line: Column, length) -> Column:
    steps = F.when(F.size(line) >= 2, _steps(line)).otherwise(F.array().cast("array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>>"))
    return F.aggregate(steps, F.lit(0.0), lambda acc, s: acc + length(s["a"], s["b"]))


def line_length(line: Column) -> Column:
    """The planar length."""
    return _total(line, lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"]))


def geodesic_feet(line: Column) -> Column:
    """The length in feet of a line in degrees, on the ellipsoid, to two decimals.

    A step's length comes from the ellipsoid's two radii of curvature midway,
    which is exact to a millionth for steps of some miles; longer ones are rare
    in street lines.
    """

    def arc(a: Column, b: Column) -> Column:
        middle = F.radians((a["y"] + b["y"]) / 2)
        bend = 1 - ECCENTRICITY**2 * F.pow(F.sin(middle), 2)
        north = F.radians(b["y"] - a["y"]) * EQUATOR * (1 - ECCENTRICITY**2) / F.pow(bend, 1.5)
        east = F.radians(b["x"] - a["x"]) * EQUATOR * F.cos(middle) / F.sqrt(bend)
        return F.hypot(north, east)

    return F.round(_total(line, arc) * FEET_PER_METRE, 2)


def first_point(line: Column) -> Column:
    return F.get(line, F.lit(0))


def last_point(line: Column) -> Column:
    return F.get(line, F.size(line) - 1)


def is_valid_line(line: Column) -> Column:
    """Two points at least, all finite, and some length."""
    finite = F.forall(line, lambda p: p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"]))
    return F.coalesce((F.size(line) >= 2) & finite & (line_length(line) > 0), F.lit(False))


def join_lines(lines: Column) -> Column:
    """Lines end to end in one, each joint once."""
    flat = F.flatten(lines)
    return F.filter(flat, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(flat, i - 1)))


def from_wkt(text: Column) -> Column:
    """The parts of a POINT, LINESTRING or MULTILINESTRING text, an array of lines; other text gives null. A z is dropped."""
    body = F.regexp_replace(F.upper(F.trim(text)), "^SRID=[0-9]+;", "")
    kind = F.regexp_extract(body, "^(POINT|LINESTRING|MULTILINESTRING)( Z)?\\s*\\(", 1)
    inner = F.regexp_replace(F.regexp_replace(body, "^[A-Z]+( Z)?\\s*\\(+\\s*", ""), "\\s*\\)+$", "")
    parts = F.split(inner, "\\)\\s*,\\s*\\(")

    def one(part: Column) -> Column:
        return F.transform(F.split(part, "\\s*,\\s*"), lambda c: point(F.get(F.split(F.trim(c), "\\s+"), F.lit(0)).try_cast("double"), F.get(F.split(F.trim(c), "\\s+"), F.lit(1)).try_cast("double")))

    return F.when(kind != "", F.transform(parts, one))


def from_geojson(text: Column) -> Column:
    """The parts of a Point, LineString or MultiLineString object, an array of lines; other text gives null."""
    kind = F.get_json_object(text, "$.type")
    coordinates = F.get_json_object(text, "$.coordinates")
    line = lambda a: F.transform(a, lambda p: point(F.get(p, F.lit(0)), F.get(p, F.lit(1))))
    one, many, deep = (F.from_json(coordinates, t) for t in ("array<double>", "array<array<double>>", "array<array<array<double>>>"))
    return F.when(kind == "Point", F.array(line(F.array(one)))).when(kind == "LineString", F.array(line(many))).when(kind == "MultiLineString", F.transform(deep, line))


def normalise_geometry(text: Column) -> Column:
    """WKT or GeoJSON text to lines, or null."""
    return F.coalesce(from_geojson(F.when(F.startswith(F.ltrim(text), F.lit("{")), text)), from_wkt(text))


def to_wkt(line: Column) -> Column:
    return F.concat(F.lit("LINESTRING ("), F.array_join(F.transform(line, lambda p: F.concat_ws(" ", p["x"], p["y"])), ", "), F.lit(")"))
