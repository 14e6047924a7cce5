"""Distances and grid references."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM) -> Column:
    """Great-circle distance; pass another radius for metres."""
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


#: Fixed values, as published: both ellipsoids, the grid's origin and scale, and the shift between the datums.
AIRY, WGS84 = (6377563.396, 6356256.909), (6378137.0, 6356752.3141)
GRID_SCALE, GRID_ORIGIN, FALSE_ORIGIN = 0.9996012717, (49.0, -2.0), (400000.0, -100000.0)
SHIFT, TURN_SECONDS, SCALE = (446.448, -125.157, 542.060), (0.1502, 0.2470, 0.8421), -20.4894e-6


def grid_to_degrees(east: np.ndarray, north: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """National Grid metres to WGS84 latitude and longitude: inverse Transverse Mercator, then a Helmert shift."""
    a, b = AIRY
    e2, n = 1 - b**2 / a**2, (a - b) / (a + b)
    phi0, lam0 = np.radians(GRID_ORIGIN)
    y = north - FALSE_ORIGIN[1]

    def meridian(phi):
        series = [1 + n + 5 / 4 * (n**2 + n**3), 3 * n + 3 * n**2 + 21 / 8 * n**3, 15 / 8 * (n**2 + n**3), 35 / 24 * n**3]
        d, s = phi - phi0, phi + phi0
        return b * GRID_SCALE * (series[0] * d + sum((-1) ** k * series[k] * np.sin(k * d) * np.cos(k * s) for k in (1, 2, 3)))

    phi = np.full_like(y, phi0)
    for _ in range(12):
        phi = phi + (y - meridian(phi)) / (a * GRID_SCALE)
    w2 = 1 - e2 * np.sin(phi) ** 2
    nu, rho = a * GRID_SCALE / np.sqrt(w2), a * GRID_SCALE * (1 - e2) / w2**1.5
    t, eta2, q = np.tan(phi), nu / rho - 1, (east - FALSE_ORIGIN[0]) / nu
    lat = phi - t * nu / rho * (q**2 / 2 - q**4 / 24 * (5 + 3 * t**2 + eta2 * (1 - 9 * t**2)) + q**6 / 720 * (61 + 90 * t**2 + 45 * t**4))
    lon = lam0 + (q - q**3 / 6 * (nu / rho + 2 * t**2) + q**5 / 120 * (5 + 28 * t**2 + 24 * t**4) - q**7 / 5040 * (61 + 662 * t**2 + 1320 * t**4 + 720 * t**6)) / np.cos(phi)

    v = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    xyz = np.stack([v * np.cos(lat) * np.cos(lon), v * np.cos(lat) * np.sin(lon), (1 - e2) * v * np.sin(lat)])
    rx, ry, rz = np.radians(np.array(TURN_SECONDS) / 3600)
    turn = np.array([[1 + SCALE, -rz, ry], [rz, 1 + SCALE, -rx], [-ry, rx, 1 + SCALE]])
    x, y, z = turn @ xyz + np.array(SHIFT)[:, None]
    a, b = WGS84
    e2, p = 1 - b**2 / a**2, np.hypot(x, y)
    lat = np.arctan2(z, p * (1 - e2))
    for _ in range(8):
        lat = np.arctan2(z + e2 * a / np.sqrt(1 - e2 * np.sin(lat) ** 2) * np.sin(lat), p)
    return np.degrees(lat), np.degrees(np.arctan2(y, x))


def grid_to_wgs84(east: Column, north: Column) -> Column:
    """struct(lat, lon) of grid metres, in Arrow batches."""

    @F.pandas_udf("lat double, lon double")
    def convert(e: pd.Series, n: pd.Series) -> pd.DataFrame:
        lat, lon = grid_to_degrees(e.to_numpy(float), n.to_numpy(float))
        return pd.DataFrame({"lat": lat, "lon": lon})

    return convert(east.cast("double"), north.cast("double"))
