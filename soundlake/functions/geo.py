"""Positions: bearings, projection, cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from soundlake import constants as K


def offset_position(lat: Column, lon: Column, bearing: Column, dist: Column) -> tuple[Column, Column]:
    """Shift a position by ``dist`` metres toward ``bearing`` degrees on a sphere."""
    b = F.radians(bearing)
    new_lat = lat + F.degrees(dist * F.cos(b) / K.EARTH_RADIUS_M)
    new_lon = lon + F.degrees(dist * F.sin(b) / (K.EARTH_RADIUS_M * F.cos(F.radians(lat))))
    return new_lat, new_lon


def towfish_layback(cable: Column, depth: Column) -> Column:
    """Horizontal distance of a towed body; NULL cable means no correction."""
    return F.when(cable.isNull(), F.lit(0.0)).otherwise(
        F.sqrt(F.greatest(cable * cable - depth * depth, F.lit(0.0)))
    )


def heading_gap(a: Column, b: Column) -> Column:
    """Smaller angle between two headings in degrees."""
    d = F.abs(a - b)
    return F.least(d, F.lit(360.0) - d)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    s1 = F.sin(F.radians(lat2 - lat1) / 2)
    s2 = F.sin(F.radians(lon2 - lon1) / 2)
    a = s1 * s1 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s2 * s2
    return 2 * K.EARTH_RADIUS_M * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def flat_spacing(lat0: Column, lon0: Column, lat1: Column, lon1: Column) -> Column:
    """Flat-earth distance between successive fixes (111 320 m per degree)."""
    dy = (lat1 - lat0) * 111320.0
    dx = (lon1 - lon0) * 111320.0 * F.cos(F.radians(lat0))
    return F.sqrt(dx * dx + dy * dy)


# --- transverse Mercator (Krueger series to n^3) ---------------------------------

_N = K.TM_F / (2 - K.TM_F)
_RECT = K.TM_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_E = math.sqrt(K.TM_F * (2 - K.TM_F))
_ALPHA = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
]
_BETA = [
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96,
    _N**2 / 48 + _N**3 / 15,
    17 * _N**3 / 480,
]
_DELTA = [
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3,
    7 * _N**2 / 3 - 8 * _N**3 / 5,
    56 * _N**3 / 15,
]


def series() -> dict[str, object]:
    """The projection's derived numbers, for callers that restate it elsewhere."""
    return {"rect": _RECT, "e": _E, "alpha": _ALPHA, "beta": _BETA, "delta": _DELTA}


def _atanh(x: Column) -> Column:
    return 0.5 * F.log((1 + x) / (1 - x))


def project(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Longitude/latitude degrees to projected metres (x, y)."""
    phi = F.radians(lat)
    lam = F.radians(lon - K.TM_LON0)
    s = F.sin(phi)
    t = F.sinh(_atanh(s) - _E * _atanh(_E * s))
    xi0 = F.atan2(t, F.cos(lam))
    eta0 = _atanh(F.sin(lam) / F.sqrt(1 + t * t))
    xi, eta = xi0, eta0
    for j, a in enumerate(_ALPHA, start=1):
        xi = xi + a * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta + a * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    return K.TM_FE + K.TM_K0 * _RECT * eta, K.TM_K0 * _RECT * xi


def unproject(x: Column, y: Column) -> tuple[Column, Column]:
    """Projected metres to (lon, lat) degrees."""
    xi = y / (K.TM_K0 * _RECT)
    eta = (x - K.TM_FE) / (K.TM_K0 * _RECT)
    xi0, eta0 = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xi0 = xi0 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta0 = eta0 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + d * F.sin(2 * j * chi)
    lam = F.atan2(F.sinh(eta0), F.cos(xi0))
    return K.TM_LON0 + F.degrees(lam), F.degrees(phi)


# --- cells -------------------------------------------------------------------------


def cell_of(x: Column, y: Column, left: float, top: float, res: float) -> tuple[Column, Column]:
    """(row, col) of the cell that contains a point; rows run south. Absurd positions have no cell."""
    row = F.floor((F.lit(top) - y) / res).try_cast("int")
    col = F.floor((x - left) / res).try_cast("int")
    return row, col


def nearest_centre(v: Column, first: float, res: float, n: int) -> Column:
    """Index of the nearest of ``n`` centres ``first + i*res``; the lower one on a tie, clamped."""
    i = F.ceil((v - first) / res - 0.5)
    return F.when(v.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(n - 1), i)).cast("int"))


def centre_x(col: Column, left: float, res: float) -> Column:
    return F.lit(left) + (col + 0.5) * res


def centre_y(row: Column, top: float, res: float) -> Column:
    return F.lit(top) - (row + 0.5) * res


def _hundredths(m: Column) -> Column:
    """``m`` in whole hundredths, rounded by its exact binary value, true halves to even, as C and Python print it.

    Java's formatter rounds the shortest decimal that reads back as ``m``, so 10.245 that lies below the half goes up there. Both parts of ``m`` times 200
    are exact, so the side of the half is.
    """
    low = F.floor(m * 100)
    head = F.floor(m * 1048576) / 1048576.0
    side = (head * 200 - (2 * low + 1)) + (m - head) * 200
    return low + F.when((side > 0) | ((side == 0) & (low % 2 == 1)), 1).otherwise(0)


def degree_minute(v: Column, axis: str) -> Column:
    """Degree/minute text with hemisphere: ``22°08.22′N``."""
    pos, neg = ("N", "S") if axis == "lat" else ("E", "W")
    a = F.abs(v)
    deg = F.floor(a).cast("int")
    hemi = F.when(v >= 0, F.lit(pos)).otherwise(F.lit(neg))
    n = _hundredths((a - deg) * 60)
    return F.format_string("%d°%02d.%02d′%s", deg, F.floor(n / 100), n % 100, hemi)
