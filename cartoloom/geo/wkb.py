"""Well-known binary, decoded with numpy.

``decode`` parses one geometry of any of the seven simple kinds in either byte order; Z and M ordinates (ISO codes
or the high flag bits) are skipped.  ``points_of`` decodes a whole column of points at once.  Anything that is not
well formed decodes to ``None``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from functools import lru_cache
from typing import NamedTuple

import numpy as np

KINDS = {
    1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 5: "MULTILINESTRING", 6: "MULTIPOLYGON", 7: "GEOMETRYCOLLECTION",
}
POINT_BYTES = 21


class Shape(NamedTuple):
    """A geometry: its kind, its coordinate paths, and the polygon that each path belongs to."""

    kind: str
    paths: tuple[np.ndarray, ...]  # each (n, 2), lon and lat
    owners: tuple[int, ...]  # index of the part of each path; the first path of a part is its outer ring

    @property
    def bbox(self) -> tuple[float, float, float, float]:
        """xmin, ymin, xmax, ymax."""
        a = np.concatenate(self.paths)
        return (*a.min(axis=0), *a.max(axis=0))  # type: ignore[return-value]

    @property
    def areal(self) -> bool:
        return self.kind in ("POLYGON", "MULTIPOLYGON")


def _header(b: bytes, at: int) -> tuple[str, int, int, int]:
    end = "<" if b[at] == 1 else ">"
    (code,) = struct.unpack_from(end + "I", b, at + 1)
    at += 5
    extra = bool(code & 0x80000000) + bool(code & 0x40000000)
    if code & 0x20000000:
        at += 4
    code &= 0x0FFFFFFF
    extra += {0: 0, 1: 1, 2: 1, 3: 2}[code // 1000]
    return end, code % 1000, 2 + extra, at


def _path(b: bytes, at: int, n: int, end: str, dims: int) -> tuple[np.ndarray, int]:
    a = np.frombuffer(b, dtype=end + "f8", count=n * dims, offset=at).reshape(n, dims)[:, :2].astype("f8")
    return a, at + 8 * n * dims


def _read(b: bytes, at: int, paths: list, owners: list, part: list[int]) -> tuple[int, int]:
    end, code, dims, at = _header(b, at)
    if code == 1:
        a, at = _path(b, at, 1, end, dims)
        if not np.isnan(a).any():
            paths.append(a)
            owners.append(part[0])
        part[0] += 1
    elif code == 2:
        (n,) = struct.unpack_from(end + "I", b, at)
        a, at = _path(b, at + 4, n, end, dims)
        if n:
            paths.append(a)
            owners.append(part[0])
        part[0] += 1
    elif code == 3:
        (rings,) = struct.unpack_from(end + "I", b, at)
        at += 4
        for _ in range(rings):
            (n,) = struct.unpack_from(end + "I", b, at)
            a, at = _path(b, at + 4, n, end, dims)
            if n:
                paths.append(a)
                owners.append(part[0])
        part[0] += 1
    elif code in (4, 5, 6, 7):
        (n,) = struct.unpack_from(end + "I", b, at)
        at += 4
        for _ in range(n):
            _, at = _read(b, at, paths, owners, part)
    else:
        raise ValueError(f"geometry code {code}")
    return code, at


def decode(b: bytes | None) -> Shape | None:
    """Parse one geometry; ``None`` for null, empty or malformed input."""
    if not b:
        return None
    paths: list[np.ndarray] = []
    owners: list[int] = []
    try:
        code, _ = _read(b, 0, paths, owners, [0])
    except (struct.error, ValueError, IndexError, KeyError):
        return None
    if not paths or not all(np.isfinite(p).all() for p in paths):
        return None
    return Shape(KINDS[code], tuple(paths), tuple(owners))


@lru_cache(maxsize=4096)
def decode_cached(b: bytes) -> Shape | None:
    """``decode`` for reference geometries that recur in many rows."""
    return decode(b)


def points_of(values: Iterable[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """lon and lat of a column of points; NaN where the value is null or not a point."""
    values = list(values)
    xy = np.full((len(values), 2), np.nan)
    plain = [i for i, b in enumerate(values) if b is not None and len(b) == POINT_BYTES]
    if plain:
        raw = np.frombuffer(b"".join(values[i] for i in plain), dtype="u1").reshape(-1, POINT_BYTES)
        at = np.asarray(plain)
        for order, code in (("<", b"\x01\x01\x00\x00\x00"), (">", b"\x00\x00\x00\x00\x01")):
            hit = (raw[:, :5] == np.frombuffer(code, dtype="u1")).all(axis=1)
            if hit.any():
                xy[at[hit]] = np.ascontiguousarray(raw[hit][:, 5:]).view(order + "f8").reshape(-1, 2)
    rest = [i for i, b in enumerate(values) if b is not None and len(b) != POINT_BYTES]
    for i in rest:
        s = decode(values[i])
        if s is not None and s.kind == "POINT":
            xy[i] = s.paths[0][0]
    xy[~np.isfinite(xy).all(axis=1)] = np.nan
    return xy[:, 0], xy[:, 1]


def encode(kind: str, paths: list[list[list[tuple[float, float]]]]) -> bytes:
    """Little-endian WKB from parts, each a list of paths; the inverse of ``decode`` for the kinds used here."""

    def one(name: str, part: list[list[tuple[float, float]]]) -> bytes:
        code = {v: k for k, v in KINDS.items()}[name]
        out = struct.pack("<BI", 1, code)
        if name == "POINT":
            return out + struct.pack("<2d", *part[0][0])
        if name == "LINESTRING":
            return out + struct.pack("<I", len(part[0])) + b"".join(struct.pack("<2d", *p) for p in part[0])
        return out + struct.pack("<I", len(part)) + b"".join(
            struct.pack("<I", len(r)) + b"".join(struct.pack("<2d", *p) for p in r) for r in part
        )

    if kind.startswith("MULTI"):
        code = {v: k for k, v in KINDS.items()}[kind]
        return struct.pack("<BII", 1, code, len(paths)) + b"".join(one(kind[5:], p) for p in paths)
    return one(kind, paths[0])
