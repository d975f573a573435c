"""Projection, distances and grids as Column expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The WGS 84 ellipsoid, and the parameters of the national Lambert conformal conic projection (EPSG:7755).
A, FLATTENING = 6378137.0, 1 / 298.257223563
LAT0, LON0, LAT1, LAT2, FALSE = 24.0, 80.0, 12.472955, 35.1728044444, 4_000_000.0
E = math.sqrt(FLATTENING * (2 - FLATTENING))


def _m(lat: float) -> float:
    s = math.sin(math.radians(lat))
    return math.cos(math.radians(lat)) / math.sqrt(1 - E * E * s * s)


def _t(lat: float) -> float:
    s = math.sin(math.radians(lat))
    return math.tan(math.pi / 4 - math.radians(lat) / 2) / ((1 - E * s) / (1 + E * s)) ** (E / 2)


N = (math.log(_m(LAT1)) - math.log(_m(LAT2))) / (math.log(_t(LAT1)) - math.log(_t(LAT2)))
SCALE = A * _m(LAT1) / (N * _t(LAT1) ** N)
RHO0 = SCALE * _t(LAT0) ** N


def _polar(lon: Column, lat: Column) -> tuple[Column, Column]:
    s = F.sin(F.radians(lat))
    t = F.tan(F.lit(math.pi / 4) - F.radians(lat) / 2) / F.pow((1 - E * s) / (1 + E * s), F.lit(E / 2))
    return SCALE * F.pow(t, F.lit(N)), N * F.radians(lon - LON0)


def project_x(lon: Column, lat: Column) -> Column:
    rho, theta = _polar(lon, lat)
    return FALSE + rho * F.sin(theta)


def project_y(lon: Column, lat: Column) -> Column:
    rho, theta = _polar(lon, lat)
    return FALSE + RHO0 - rho * F.cos(theta)


def project_sql(lon: str, lat: str) -> tuple[str, str]:
    """The same in SQL text."""
    s = f"sin(radians({lat}))"
    t = f"(tan({math.pi / 4!r} - radians({lat}) / 2) / pow((1 - {E!r} * {s}) / (1 + {E!r} * {s}), {E / 2!r}))"
    rho, theta = f"({SCALE!r} * pow({t}, {N!r}))", f"({N!r} * radians({lon} - {LON0!r}))"
    return f"({FALSE!r} + {rho} * sin({theta}))", f"({FALSE!r} + {RHO0!r} - {rho} * cos({theta}))"


def unproject(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lon, lat) of projected points."""
    dx, dy = np.asarray(x, float) - FALSE, RHO0 - (np.asarray(y, float) - FALSE)
    t = (np.hypot(dx, dy) / SCALE) ** (1 / N)
    lat = np.pi / 2 - 2 * np.arctan(t)
    for _ in range(8):
        s = np.sin(lat)
        lat = np.pi / 2 - 2 * np.arctan(t * ((1 - E * s) / (1 + E * s)) ** (E / 2))
    return np.degrees(np.arctan2(dx, dy) / N) + LON0, np.degrees(lat)


def planar_m(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.hypot(x2 - x1, y2 - y1)


def segment_m(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point from a segment."""
    dx, dy = bx - ax, by - ay
    size = dx * dx + dy * dy
    along = F.when(size == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / size)))
    return F.hypot(px - (ax + along * dx), py - (ay + along * dy))


def snap(c: Column, grid: float = 15.0) -> Column:
    """The nearest grid line, halves to the even one."""
    return F.bround(c / grid) * grid


def snap_text(text: str, grid: float = 15.0) -> str:
    return f"(round_even({text} / {grid!r}, 0) * {grid!r})"


def geodesic_m(lon1, lat1, lon2, lat2) -> np.ndarray:
    """Distance on the ellipsoid, by Vincenty's inverse formula; points that it does not settle for use the mean sphere."""
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, float)) for v in (lon1, lat1, lon2, lat2))
    b = A * (1 - FLATTENING)
    u1, u2 = np.arctan((1 - FLATTENING) * np.tan(lat1)), np.arctan((1 - FLATTENING) * np.tan(lat2))
    su1, cu1, su2, cu2, span = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2), lon2 - lon1
    lam = span.copy()
    with np.errstate(all="ignore"):
        for _ in range(60):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cs = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0, cu1 * cu2 * sl / np.where(ss == 0, 1, ss))
            ca = 1 - sa * sa
            cm = np.where(ca == 0, 0, cs - 2 * su1 * su2 / np.where(ca == 0, 1, ca))
            k = FLATTENING / 16 * ca * (4 + FLATTENING * (4 - 3 * ca))
            new = span + (1 - k) * FLATTENING * sa * (sigma + k * ss * (cm + k * cs * (2 * cm * cm - 1)))
            done, lam = np.abs(new - lam) < 1e-12, new
            if done.all():
                break
        q = ca * (A * A - b * b) / (b * b)
        big = 1 + q / 16384 * (4096 + q * (q * (320 - 175 * q) - 768))
        small = q / 1024 * (256 + q * (q * (74 - 47 * q) - 128))
        ds = small * ss * (cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
        found = b * big * (sigma - ds)
        h = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin(span / 2) ** 2
        sphere = 2 * 6371008.8 * np.arcsin(np.sqrt(np.clip(h, 0, 1)))
    return np.where(done & np.isfinite(found), found, sphere)


@F.pandas_udf(DoubleType())
def geodesic_km(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    return pd.Series(geodesic_m(lon1, lat1, lon2, lat2) / 1000)


def valid_lonlat(lon: Column, lat: Column) -> Column:
    return F.coalesce(lon.between(-180, 180) & lat.between(-90, 90) & ~F.isnan(lon) & ~F.isnan(lat), F.lit(False))
