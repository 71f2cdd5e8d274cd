"""Coordinate systems by their EPSG code: degrees to a system's units and back, as columns."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import geometry as G

Move = Callable[[Column, Column], tuple[Column, Column]]
DEGREES = 4326


class System(NamedTuple):
    """``forward`` turns degrees (lon, lat) into the system's (x, y), ``inverse`` the other way."""

    code: int
    forward: Move
    inverse: Move


def _same(x: Column, y: Column) -> tuple[Column, Column]:
    return x, y


def from_utm(x: Column, y: Column, zone: int) -> tuple[Column, Column]:
    """Metres of a northern UTM zone to degrees: the latitude of the meridian's arc, then the usual series to the sixth order."""
    k0, e2 = 0.9996, G._E2
    ep2, e1 = e2 / (1 - e2), (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = y / (k0 * G._A * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    foot = mu + F.sin(mu * 2) * (3 * e1 / 2 - 27 * e1**3 / 32) + F.sin(mu * 4) * (21 * e1**2 / 16 - 55 * e1**4 / 32) + F.sin(mu * 6) * (151 * e1**3 / 96) + F.sin(mu * 8) * (1097 * e1**4 / 512)
    bend = 1 - F.pow(F.sin(foot), 2) * e2
    n, r = F.lit(G._A) / F.sqrt(bend), F.lit(G._A * (1 - e2)) / F.pow(bend, 1.5)
    t, c = F.pow(F.tan(foot), 2), F.pow(F.cos(foot), 2) * ep2
    d = (x - 500000) / (n * k0)
    lat = foot - n * F.tan(foot) / r * (d * d / 2 - (5 + t * 3 + c * 10 - c * c * 4 - 9 * ep2) * F.pow(d, 4) / 24 + (61 + t * 90 + c * 298 + t * t * 45 - 252 * ep2 - c * c * 3) * F.pow(d, 6) / 720)
    lon = (d - (1 + t * 2 + c) * F.pow(d, 3) / 6 + (5 - c * 2 + t * 28 - c * c * 3 + 8 * ep2 + t * t * 24) * F.pow(d, 5) / 120) / F.cos(foot)
    return F.degrees(lon) + (zone * 6 - 183), F.degrees(lat)


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:3395 metres to degrees."""
    return F.degrees(x / G.EQUATOR), F.degrees(G.latitude(F.exp(-y / G.EQUATOR), math.sqrt(0.0066943799901413165)))


def system(code: int | str) -> System:
    """The system of an EPSG code, a number or a name that ends in one ("EPSG:2249", "urn:ogc:def:crs:EPSG::2249"; CRS84 is degrees).

    Known are degrees (4326, and 4269, taken for the same), feet of 2249, the
    northern UTM zones (32601 to 32660, and 26901 to 26923) and 3395. Another
    code is an error.
    """
    text = str(code).strip().upper()
    if text.endswith("CRS84"):
        number = DEGREES
    else:
        found = re.search(r"([0-9]+)$", text)
        number = int(found[1]) if found else -1
    if number in (DEGREES, 4269):
        return System(DEGREES, _same, _same)
    if number == 2249:
        return System(number, G.to_feet, G.to_degrees)
    if number == 3395:
        return System(number, G.to_mercator, from_mercator)
    zone = number - 32600 if 32601 <= number <= 32660 else number - 26900 if 26901 <= number <= 26923 else None
    if zone:
        return System(number, lambda x, y: G.to_utm(x, y, zone), lambda x, y: from_utm(x, y, zone))
    raise ValueError(f"unknown coordinate system: {code}")


def reproject(x: Column, y: Column, source: int | str, target: int | str) -> tuple[Column, Column]:
    """Coordinates of one system in another, by way of degrees; equal systems change nothing."""
    a, b = system(source), system(target)
    return (x, y) if a.code == b.code else b.forward(*a.inverse(x, y))


def reproject_line(line: Column, source: int | str, target: int | str) -> Column:
    """A line, an array of points, of one system in another."""
    if system(source).code == system(target).code:
        return line
    return G.map_points(line, lambda x, y: reproject(x, y, source, target))
