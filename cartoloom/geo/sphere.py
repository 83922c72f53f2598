"""Distances and areas on the sphere and on the WGS84 spheroid, with numpy."""

from __future__ import annotations

import numpy as np

RADIUS_M = 6371008.8  # mean earth radius
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563


def haversine(lon1, lat1, lon2, lat2):
    """Great-circle distance in metres."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(np.asarray(lon2) - lon1) / 2) ** 2
    return 2 * RADIUS_M * np.arcsin(np.sqrt(np.clip(h, 0, 1)))


def geodesic(lon1, lat1, lon2, lat2, rounds: int = 60):
    """Distance in metres on WGS84 by Vincenty's inverse formula; near-antipodal pairs fall back to the sphere."""
    lon1, lat1, lon2, lat2 = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (lon1, lat1, lon2, lat2)))
    f, a = WGS84_F, WGS84_A
    b = a * (1 - f)
    u1, u2 = np.arctan((1 - f) * np.tan(np.radians(lat1))), np.arctan((1 - f) * np.tan(np.radians(lat2)))
    L = np.radians((lon2 - lon1 + 540) % 360 - 180)
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = L.copy()
    done = np.zeros(L.shape, dtype=bool)
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(rounds):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cs = su1 * su2 + cu1 * cu2 * cl
            sig = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0.0, cu1 * cu2 * sl / np.where(ss == 0, 1, ss))
            c2 = 1 - sa**2
            cm = np.where(c2 < 1e-15, 0.0, cs - 2 * su1 * su2 / np.where(c2 < 1e-15, 1, c2))
            C = f / 16 * c2 * (4 + f * (4 - 3 * c2))
            new = L + (1 - C) * f * sa * (sig + C * ss * (cm + C * cs * (2 * cm**2 - 1)))
            done = np.abs(new - lam) < 1e-13
            lam = new
            if done.all():
                break
        us = c2 * (a * a - b * b) / (b * b)
        A = 1 + us / 16384 * (4096 + us * (-768 + us * (320 - 175 * us)))
        B = us / 1024 * (256 + us * (-128 + us * (74 - 47 * us)))
        ds = B * ss * (cm + B / 4 * (cs * (2 * cm**2 - 1) - B / 6 * cm * (4 * ss**2 - 3) * (4 * cm**2 - 3)))
        d = b * A * (sig - ds)
    near = done | (np.abs(new - lam) < 1e-9)
    out = np.where(ss == 0, 0.0, d)
    return np.where(near & np.isfinite(out), out, haversine(lon1, lat1, lon2, lat2))


def distance(lon1, lat1, lon2, lat2, model: str = "spheroid", axis: str = "lonlat"):
    """Metres between points by the chosen model; ``axis='swapped'`` reads each pair as (lat, lon)."""
    if axis == "swapped":
        lon1, lat1, lon2, lat2 = lat1, lon1, lat2, lon2
    return (haversine if model == "sphere" else geodesic)(lon1, lat1, lon2, lat2)


def degrees_for(distance_m: float) -> float:
    """A latitude difference that surely covers ``distance_m`` on the sphere and on the spheroid."""
    return distance_m / 110574.0 * 1.01


def lon_degrees_for(distance_m: float, lat_abs_max):
    """A longitude difference that surely covers ``distance_m`` up to the given latitude; 360 near the poles."""
    top = np.minimum(np.asarray(lat_abs_max, dtype=float) + degrees_for(distance_m), 90)
    c = np.cos(np.radians(top))
    return np.where(c < 1e-6, 360.0, np.minimum(360.0, degrees_for(distance_m) / np.maximum(c, 1e-6)))
