"""Planar kernels on decoded shapes: centroid, area, length, nearest points, containment, positions along a line."""

from __future__ import annotations

import numpy as np

from cartoloom.geo.sphere import RADIUS_M, WGS84_A, WGS84_F, distance
from cartoloom.geo.wkb import Shape
from cartoloom.operators.nearby import edges_of, strictly_inside

PAIRS = 1_000_000


def segments_of(shape: Shape) -> np.ndarray:
    """(n, 4) segments of all paths as they are stored; a lone point is a segment of no length."""
    out = []
    for p in shape.paths:
        out.append(np.hstack([p[:-1], p[1:]]) if len(p) > 1 else np.hstack([p, p]))
    return np.vstack(out)


def _ring(p: np.ndarray) -> tuple[float, float, float]:
    """Signed area of a ring and its first moments, about the ring's first vertex."""
    o = p[0]
    q = p - o
    x0, y0 = q[:, 0], q[:, 1]
    x1, y1 = np.roll(x0, -1), np.roll(y0, -1)
    c = x0 * y1 - x1 * y0
    a = c.sum() / 2
    return a, ((x0 + x1) * c).sum() / 6 + a * o[0], ((y0 + y1) * c).sum() / 6 + a * o[1]


def planar_area(shape: Shape) -> float:
    """Area in square degrees, holes taken off; 0 for points and lines."""
    if not shape.areal:
        return 0.0
    total, seen = 0.0, set()
    for p, o in zip(shape.paths, shape.owners):
        a = abs(_ring(p)[0])
        total += -a if o in seen else a
        seen.add(o)
    return total


def centroid(shape: Shape) -> tuple[float, float]:
    """Centroid by area, by length or of the points, whichever is the shape's dimension."""
    if shape.areal:
        m = np.zeros(3)
        seen = set()
        for p, o in zip(shape.paths, shape.owners):
            r = np.asarray(_ring(p))
            r = r if r[0] >= 0 else -r
            m += -r if o in seen else r
            seen.add(o)
        if abs(m[0]) > 0:
            return m[1] / m[0], m[2] / m[0]
    if shape.kind not in ("POINT", "MULTIPOINT"):
        s = segments_of(shape)
        w = np.hypot(s[:, 2] - s[:, 0], s[:, 3] - s[:, 1])
        if w.sum() > 0:
            return float(((s[:, 0] + s[:, 2]) / 2 * w).sum() / w.sum()), float(((s[:, 1] + s[:, 3]) / 2 * w).sum() / w.sum())
    a = np.concatenate(shape.paths)
    return float(a[:, 0].mean()), float(a[:, 1].mean())


def sphere_area(shape: Shape) -> float:
    """Area in square metres on the sphere of mean radius; holes taken off."""
    if not shape.areal:
        return 0.0
    total, seen = 0.0, set()
    for p, o in zip(shape.paths, shape.owners):
        lon, lat = np.radians(p[:, 0]), np.radians(p[:, 1])
        d = np.roll(lon, -1) - lon
        a = abs((d * (2 + np.sin(lat) + np.sin(np.roll(lat, -1)))).sum()) * RADIUS_M**2 / 2
        total += -a if o in seen else a
        seen.add(o)
    return total


def _equal_area(p: np.ndarray) -> np.ndarray:
    """Points with their latitudes on the sphere that has the same areas as the WGS84 spheroid."""
    e = np.sqrt(WGS84_F * (2 - WGS84_F))
    x = np.sin(np.radians(np.append(p[:, 1], 90.0)))
    q = (1 - e * e) * (x / (1 - (e * x) ** 2) + np.arctanh(e * x) / e)
    return np.column_stack([p[:, 0], np.degrees(np.arcsin(np.clip(q[:-1] / q[-1], -1, 1)))])


def spheroid_area(shape: Shape) -> float:
    """Area in square metres on the WGS84 spheroid; holes taken off."""
    e = np.sqrt(WGS84_F * (2 - WGS84_F))
    radius2 = WGS84_A**2 / 2 * (1 + (1 - e * e) / e * np.arctanh(e))
    return sphere_area(shape._replace(paths=tuple(_equal_area(p) for p in shape.paths))) * radius2 / RADIUS_M**2


def intersects(a: Shape, b: Shape) -> bool:
    """Whether two shapes share a point: a vertex of one in the other, a vertex on the other's lines, or lines that cross."""
    if a.bbox[0] > b.bbox[2] or b.bbox[0] > a.bbox[2] or a.bbox[1] > b.bbox[3] or b.bbox[1] > a.bbox[3]:
        return False
    for x, y in ((a, b), (b, a)):
        v = np.concatenate(x.paths)
        if y.areal and strictly_inside(v[:, 0], v[:, 1], edges_of(y)).any():
            return True
        if y.kind in ("POINT", "MULTIPOINT"):
            w = np.concatenate(y.paths)
            if x.kind in ("POINT", "MULTIPOINT") and (v[:, None] == w[None]).all(axis=2).any():
                return True
        elif (nearest(segments_of(y), v[:, 0], v[:, 1])[0] <= 1e-12).any():
            return True
    if "POINT" in a.kind or "POINT" in b.kind:
        return False
    return crossing(segments_of(a), segments_of(b)) is not None


def line_length(shape: Shape, model: str = "spheroid", axis: str = "lonlat") -> float:
    """Length in metres of a line, or of the rings of an area."""
    s = segments_of(shape)
    return float(distance(s[:, 0], s[:, 1], s[:, 2], s[:, 3], model, axis).sum())


def nearest(s: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each point the nearest place on segments: planar distance, its x and y, the segment, the position on it."""
    n = len(x)
    out = np.empty((4, n))
    seg = np.empty(n, dtype=int)
    x0, y0, dx, dy = s[:, 0], s[:, 1], s[:, 2] - s[:, 0], s[:, 3] - s[:, 1]
    sq = dx * dx + dy * dy
    safe = np.where(sq > 0, sq, 1)
    step = max(1, PAIRS // max(1, len(s)))
    for i in range(0, n, step):
        px, py = x[i : i + step, None], y[i : i + step, None]
        t = np.clip(((px - x0) * dx + (py - y0) * dy) / safe, 0, 1)
        qx, qy = x0 + t * dx, y0 + t * dy
        d = np.hypot(px - qx, py - qy)
        k = d.argmin(axis=1)
        r = np.arange(len(k))
        out[:, i : i + step] = d[r, k], qx[r, k], qy[r, k], t[r, k]
        seg[i : i + step] = k
    return out[0], out[1], out[2], seg, out[3]


def locate(s: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Fraction of a line's planar length at which each point projects."""
    _, _, _, seg, t = nearest(s, x, y)
    size = np.hypot(s[:, 2] - s[:, 0], s[:, 3] - s[:, 1])
    run = np.concatenate(([0.0], np.cumsum(size)))
    return (run[seg] + t * size[seg]) / run[-1] if run[-1] > 0 else np.zeros(len(x))


def interpolate(s: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Point at a fraction of a line's planar length; the inverse of ``locate``."""
    size = np.hypot(s[:, 2] - s[:, 0], s[:, 3] - s[:, 1])
    run = np.concatenate(([0.0], np.cumsum(size)))
    at = np.clip(f, 0, 1) * run[-1]
    k = np.clip(np.searchsorted(run, at, "right") - 1, 0, len(s) - 1)
    t = np.where(size[k] > 0, (at - run[k]) / np.where(size[k] > 0, size[k], 1), 0)
    return s[k, 0] + t * (s[k, 2] - s[k, 0]), s[k, 1] + t * (s[k, 3] - s[k, 1])


def side_of(s: np.ndarray, x: np.ndarray, y: np.ndarray, reach: float = 1e-4) -> np.ndarray:
    """1 left, -1 right, 0 on the line: side of the chord around each point's projection."""
    f = locate(s, x, y)
    ax, ay = interpolate(s, np.maximum(f - reach, 0))
    bx, by = interpolate(s, np.minimum(f + reach, 1))
    qx, qy = interpolate(s, f)
    return np.sign((bx - ax) * (y - qy) - (by - ay) * (x - qx)).astype(int)


def _turns(a: np.ndarray, b: np.ndarray):
    """Orientation of the ends of every segment of one set against every segment of the other."""

    def turn(ox, oy, px, py, qx, qy):
        return (px - ox) * (qy - oy) - (py - oy) * (qx - ox)

    ax0, ay0, ax1, ay1 = (a[:, i][:, None] for i in range(4))
    bx0, by0, bx1, by1 = (b[:, i][None, :] for i in range(4))
    return (
        turn(ax0, ay0, ax1, ay1, bx0, by0), turn(ax0, ay0, ax1, ay1, bx1, by1), turn(bx0, by0, bx1, by1, ax0, ay0), turn(bx0, by0, bx1, by1, ax1, ay1)
    )


def crossing(a: np.ndarray, b: np.ndarray) -> tuple[float, float] | None:
    """The first place at which a segment of ``a`` properly crosses one of ``b``."""
    step = max(1, PAIRS // max(1, len(b)))
    for i in range(0, len(a), step):
        p, q, r, t = _turns(a[i : i + step], b)
        hit = np.argwhere((p * q < 0) & (r * t < 0))
        if len(hit):
            k, m = hit[0]
            f = r[k, m] / (r[k, m] - t[k, m])
            s = a[i + k]
            return float(s[0] + f * (s[2] - s[0])), float(s[1] + f * (s[3] - s[1]))
    return None


def within(a: Shape, area: Shape) -> bool:
    """Whether ``a`` lies in ``area``: no part outside, and not on the boundary alone."""
    v = np.concatenate(a.paths)
    e = edges_of(area)
    inner = strictly_inside(v[:, 0], v[:, 1], e)
    edge = nearest(e, v[:, 0], v[:, 1])[0] <= 1e-9
    if not (inner | edge).all():
        return False
    if a.kind in ("POINT", "MULTIPOINT"):
        return bool(inner.any())
    s = segments_of(a)
    if crossing(s, e) is not None:
        return False
    mid = strictly_inside((s[:, 0] + s[:, 2]) / 2, (s[:, 1] + s[:, 3]) / 2, e)
    if a.areal and not mid.any() and not inner.any():
        c = centroid(a)
        return bool(strictly_inside(np.array([c[0]]), np.array([c[1]]), e)[0])
    return bool(mid.any() or inner.any())


def closest_point(ref: Shape, other: Shape) -> tuple[float, float]:
    """The point of ``ref`` nearest to ``other`` (planar)."""
    v = np.concatenate(other.paths)
    if ref.areal:
        hit = np.flatnonzero(strictly_inside(v[:, 0], v[:, 1], edges_of(ref)))
        if len(hit):
            return float(v[hit[0], 0]), float(v[hit[0], 1])
    r, o = segments_of(ref), segments_of(other)
    d, qx, qy, _, _ = nearest(r, v[:, 0], v[:, 1])
    k = int(d.argmin())
    best = (float(d[k]), float(qx[k]), float(qy[k]))
    if len(v) > 1 and best[0] > 0 and (x := crossing(r, o)) is not None:
        return x
    if len(v) > 1:  # a vertex of ref may be nearer to the inside of one of the other's segments
        w = np.concatenate(ref.paths)
        d2 = nearest(o, w[:, 0], w[:, 1])[0]
        k = int(d2.argmin())
        if d2[k] < best[0]:
            best = (float(d2[k]), float(w[k, 0]), float(w[k, 1]))
    return best[1], best[2]
