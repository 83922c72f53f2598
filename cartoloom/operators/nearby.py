"""Points near other points, and the regions that contain them.

The plane is cut into latitude strips of about equal weight, whose limits come from approximate quantiles; a strip
that stays too heavy is cut again by longitude, and a tile that even then stays heavy (many points on one spot) is
shared out by a hash of the owner.  Every point goes to its home tile and, as a guest, to the tiles that reach within
the search distance of it.  Inside a tile the rows are sorted by latitude slab and longitude, and a sweep keeps the
longitude-ordered points of the current and the next slab active; candidates are verified by great-circle distance.
A pair belongs to the point with the smaller id and is reported only in the tile where that point is at home, so no
pair is reported twice and nothing has to be deduplicated afterwards.

Regions take part in the same sweep: each region's edges go to the strips they cross, because a horizontal ray at a
point's latitude only ever meets edges that cross that latitude.  A task therefore holds the edges of one strip and
one chunk of points, never a whole group.

Defined results
* null ids, null, empty, malformed and non-point geometries among the points: the row takes no part;
* null ids, null or non-areal geometries among the regions: the row takes no part;
* exact repeats of a row (same id, same place): counted once; an id delivered at several places counts at each of them;
* ties (several ids on one spot): each pair once, at distance 0; a point is never paired with its own id;
* empty tables: an empty result; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoloom.geo.sphere import RADIUS_M, haversine
from cartoloom.geo.wkb import decode, points_of

QUANTILES = 2000  # resolution of the latitude and longitude profiles
ROWS_PER_TILE = 20_000
CANDIDATES = 1_000_000  # pairs verified at once
ON_EDGE_DEG = 1e-9  # a point this close to an edge lies on the boundary
ROW = "cell int, kind int, slab int, lon double, lat double, id string, own boolean, edges binary"
PAIR = "rel string, id_a string, id_b string"


class Tiles:
    """The partition of the plane: limits of the strips, of their tiles, and copies per tile."""

    def __init__(self, lat_cuts: np.ndarray, lon_cuts: dict[int, np.ndarray], copies: dict[tuple[int, int], int], d: float):
        self.lat_cuts, self.lon_cuts, self.d = lat_cuts, lon_cuts, d
        n = len(lat_cuts) + 1
        self.first, self.copies, cell = [], [], 0
        for s in range(n):
            k = len(lon_cuts.get(s, ())) + 1
            c = [copies.get((s, t), 1) for t in range(k)]
            self.first.append(cell + np.concatenate(([0], np.cumsum(c)[:-1])).astype(int))
            self.copies.append(np.asarray(c))
            cell += int(sum(c))
        self.cells = cell
        self.dlat = math.degrees(d / RADIUS_M) * (1 + 1e-9) + 1e-12

    def dlon(self, lat: np.ndarray) -> np.ndarray:
        """Longitude reach of the search distance at a latitude, never too small."""
        top = np.minimum(np.abs(lat) + self.dlat, 90.0)
        s, c = math.sin(min(math.pi / 2, self.d / 2 / RADIUS_M)), np.cos(np.radians(top))
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(c <= s, 360.0, np.degrees(2 * np.arcsin(np.minimum(1, s / np.maximum(c, 1e-300))))) * (1 + 1e-9) + 1e-12

    def of_boxes(self, x0, x1, y0, y1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row index, strip and tile of every tile that each box meets."""
        a, b = np.searchsorted(self.lat_cuts, y0, "right"), np.searchsorted(self.lat_cuts, y1, "right")
        row = np.repeat(np.arange(len(a)), b - a + 1)
        strip = _ranges(a, b - a + 1)
        rows, strips, tiles = [], [], []
        split = np.isin(strip, list(self.lon_cuts))
        rows.append(row[~split])
        strips.append(strip[~split])
        tiles.append(np.zeros((~split).sum(), dtype=int))
        for s in np.unique(strip[split]):
            r = row[strip == s]
            p, q = np.searchsorted(self.lon_cuts[s], x0[r], "right"), np.searchsorted(self.lon_cuts[s], x1[r], "right")
            rows.append(np.repeat(r, q - p + 1))
            strips.append(np.full(int((q - p + 1).sum()), s))
            tiles.append(_ranges(p, q - p + 1))
        return np.concatenate(rows), np.concatenate(strips), np.concatenate(tiles)

    def cells_of(self, strip: np.ndarray, tile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First cell and number of copies of each (strip, tile)."""
        offsets = np.concatenate(([0], np.cumsum([len(c) for c in self.copies])))
        at = offsets[strip] + tile
        return np.concatenate(self.first)[at], np.concatenate(self.copies)[at]


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for each count, in one array."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(count)
    return np.arange(total) - np.repeat(ends - count, count) + np.repeat(start, count)


def _decoded(points: DataFrame, columns: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lon, lat = points_of(b.column("geometry").to_pylist())
            ok = ~np.isnan(lon)
            yield pa.RecordBatch.from_arrays([pa.array(lon[ok]), pa.array(lat[ok])], ["lon", "lat"])

    return points.select("geometry").mapInArrow(run, columns)


def plan_tiles(points: DataFrame, distance_m: float, rows_per_tile: int = ROWS_PER_TILE) -> Tiles:
    """Choose strips, tiles and copies from one profile of the points; the driver sees quantiles only."""
    xy = _decoded(points, "lon double, lat double")
    grid = [i / QUANTILES for i in range(1, QUANTILES)]
    got = xy.agg(F.count("*").alias("n"), F.percentile_approx("lat", grid, 10 * QUANTILES).alias("q")).first()
    n, q = got["n"], np.asarray(got["q"] or [], dtype=float)
    d = float(distance_m)
    height = 4 * math.degrees(d / RADIUS_M)
    per = rows_per_tile * QUANTILES / max(n, 1)  # quantile steps in a tile
    cuts, weights, last = [], [], 0
    for i, v in enumerate(q, 1):
        if i - last >= per and (not cuts or v - cuts[-1] > height):
            cuts.append(v)
            weights.append(i - last)
            last = i
    weights.append(QUANTILES - last)
    if len(cuts) == 0 and n > 0:
        weights = [QUANTILES]
    lat_cuts = np.asarray(cuts)
    heavy = [s for s, w in enumerate(weights) if w > 2 * per and n > 2 * rows_per_tile]
    lon_cuts: dict[int, np.ndarray] = {}
    copies: dict[tuple[int, int], int] = {}
    if heavy:
        strip = F.lit(0)
        for c in cuts:
            strip = strip + (F.col("lat") >= F.lit(float(c))).cast("int")
        if len(cuts) > 200:
            strip = F.expr(f"size(filter(array({','.join(f'{c!r}D' for c in map(float, cuts))}), c -> c <= lat))")
        lon_grid = [i / 256 for i in range(1, 256)]
        rows = (
            xy.withColumn("s", strip).where(F.col("s").isin(heavy)).groupBy("s")
            .agg(F.count("*").alias("n"), F.percentile_approx("lon", lon_grid, 2560).alias("q")).collect()
        )
        for r in rows:
            step = max(1.0, 256 * rows_per_tile / r["n"])
            own, own_w, at = [], [], 0
            for i, v in enumerate(r["q"], 1):
                if i - at >= step and (not own or v > own[-1]):
                    own.append(v)
                    own_w.append(i - at)
                    at = i
            own_w.append(256 - at)
            if own:
                lon_cuts[r["s"]] = np.asarray(own)
            for t, w in enumerate(own_w):
                k = math.ceil(w / 256 * r["n"] / (4 * rows_per_tile))
                if k > 1:
                    copies[(r["s"], t)] = k
    return Tiles(lat_cuts, lon_cuts, copies, d)


def _point_rows(points: DataFrame, tiles: Tiles, guests: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lon, lat = points_of(b.column("geometry").to_pylist())
            ok = np.flatnonzero(~np.isnan(lon))
            lon, lat, h = lon[ok], lat[ok], b.column("h").to_numpy()[ok]
            ids = b.column("id").take(pa.array(ok))
            home_s = np.searchsorted(tiles.lat_cuts, lat, "right")
            home_t = np.zeros(len(lat), dtype=int)
            for s, c in tiles.lon_cuts.items():
                m = home_s == s
                home_t[m] = np.searchsorted(c, lon[m], "right")
            src, x = np.arange(len(lon)), lon
            if guests:
                reach = tiles.dlon(lat)
                east, west = np.flatnonzero(lon - reach < -180), np.flatnonzero(lon + reach > 180)
                src = np.concatenate([src, east, west])
                x = np.concatenate([x, lon[east] + 360, lon[west] - 360])
                r = reach[src]
                row, strip, tile = tiles.of_boxes(x - r, x + r, lat[src] - tiles.dlat, lat[src] + tiles.dlat)
            else:
                row, strip, tile = src, home_s, home_t
            ghost = row >= len(lon)
            at = src[row]
            cell, k = tiles.cells_of(strip, tile)
            home = (strip == home_s[at]) & (tile == home_t[at]) & ~ghost
            rep = np.repeat(np.arange(len(row)), k)
            copy = _ranges(np.zeros(len(k), dtype=int), k)
            own = home[rep] & (h[at[rep]] % k[rep] == copy)
            xs, ys = x[row][rep], lat[at[rep]]
            slab = np.floor(ys / tiles.dlat).astype(np.int32) if guests else np.zeros(len(rep), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array((cell[rep] + copy).astype(np.int32)), pa.array(np.ones(len(rep), dtype=np.int32)), pa.array(slab), pa.array(xs), pa.array(ys), ids.take(pa.array(at[rep])), pa.array(own), pa.nulls(len(rep), pa.binary())],
                ["cell", "kind", "slab", "lon", "lat", "id", "own", "edges"],
            )

    src = points.where(F.col("id").isNotNull() & F.col("geometry").isNotNull())
    return src.select("id", "geometry", F.expr("xxhash64(id) & 9223372036854775807").alias("h")).mapInArrow(run, ROW)


def _area_rows(areas: DataFrame, tiles: Tiles) -> DataFrame:
    limits = np.concatenate(([-np.inf], tiles.lat_cuts, [np.inf]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, str, bytes]] = []
            for key, raw in zip(b.column("id").to_pylist(), b.column("geometry").to_pylist()):
                shape = decode(raw)
                if shape is None or not shape.areal:
                    continue
                e = edges_of(shape)
                if not len(e):
                    continue
                lo, hi = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
                x0, x1 = np.array([e[:, [0, 2]].min()]), np.array([e[:, [0, 2]].max()])
                _, strip, tile = tiles.of_boxes(x0, x1, lo.min(keepdims=True), hi.max(keepdims=True))
                first, k = tiles.cells_of(strip, tile)
                kept: dict[int, bytes] = {}
                for s, c, n in zip(strip, first, k):
                    if s not in kept:
                        hit = (lo <= limits[s + 1] + ON_EDGE_DEG) & (hi >= limits[s] - ON_EDGE_DEG)
                        kept[s] = e[hit].tobytes()
                    out += [(int(c) + i, key, kept[s]) for i in range(int(n))]
            m = len(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array(np.zeros(m, dtype=np.int32)), pa.array(np.zeros(m, dtype=np.int32)), pa.array(np.zeros(m)), pa.array(np.zeros(m)), pa.array([o[1] for o in out], pa.string()), pa.array(np.zeros(m, dtype=bool)), pa.array([o[2] for o in out], pa.binary())],
                ["cell", "kind", "slab", "lon", "lat", "id", "own", "edges"],
            )

    src = areas.where(F.col("id").isNotNull() & F.col("geometry").isNotNull())
    return src.select("id", "geometry").mapInArrow(run, ROW)


def edges_of(shape) -> np.ndarray:
    """(n, 4) array x0, y0, x1, y1 of all rings' segments, closing open rings."""
    out = []
    for p in shape.paths:
        if len(p) and (p[0] != p[-1]).any():
            p = np.vstack([p, p[:1]])
        if len(p) > 1:
            out.append(np.hstack([p[:-1], p[1:]]))
    return np.vstack(out) if out else np.zeros((0, 4))


def strictly_inside(x: np.ndarray, y: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Even-odd test of points against all edges; points on an edge are outside."""
    inside = np.zeros(len(x), dtype=bool)
    if not len(e):
        return inside
    block = max(1, CANDIDATES // len(e))
    x0, y0, x1, y1 = (e[:, i][None, :] for i in range(4))
    dx, dy = x1 - x0, y1 - y0
    size = np.maximum(np.hypot(dx, dy), 1e-300)
    for i in range(0, len(x), block):
        px, py = x[i : i + block, None], y[i : i + block, None]
        cross = dx * (py - y0) - dy * (px - x0)
        spans = (y0 > py) != (y1 > py)
        odd = (spans & ((cross > 0) == (dy > 0))).sum(axis=1) % 2 == 1
        t = ((px - x0) * dx + (py - y0) * dy) / size
        on = ((np.abs(cross) <= ON_EDGE_DEG * size) & (t >= -ON_EDGE_DEG) & (t <= size + ON_EDGE_DEG)).any(axis=1)
        inside[i : i + block] = odd & ~on
    return inside


class _Cell:
    """The sweep over one cell; rows arrive sorted by kind, slab, longitude."""

    def __init__(self, tiles: Tiles, near: bool):
        self.tiles, self.near = tiles, near
        self.areas: list[tuple[str, tuple, np.ndarray]] = []
        self.seen: set[str] = set()
        self.rows: list[tuple] = []
        self.held = 0

    def add(self, kind: np.ndarray, slab, lon, lat, ids: pa.Array, own, edges: pa.Array) -> Iterator[pa.RecordBatch]:
        a = np.flatnonzero(kind == 0)
        for i in a:
            key = ids[i].as_py()
            if key in self.seen:
                continue
            self.seen.add(key)
            e = np.frombuffer(edges[i].as_py(), dtype="f8").reshape(-1, 4)
            if len(e):
                box = (e[:, [0, 2]].min(), e[:, [0, 2]].max(), e[:, [1, 3]].min(), e[:, [1, 3]].max())
                self.areas.append((key, box, e))
        p = np.flatnonzero(kind == 1)
        if len(p):
            if len(p) < len(kind):
                slab, lon, lat, own, ids = slab[p], lon[p], lat[p], own[p], ids.take(pa.array(p))
            self.rows.append((slab, lon, lat, own, ids))
            self.held += len(p)
            if self.held >= 4 * ROWS_PER_TILE:
                yield from self.sweep(False)

    def sweep(self, end: bool) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        slab, lon, lat, own = (np.concatenate([r[i] for r in self.rows]) for i in range(4))
        ids = pa.concat_arrays([r[4] for r in self.rows])
        first = np.ones(len(lon), dtype=bool)
        if len(lon) > 1:
            same = (slab[1:] == slab[:-1]) & (lon[1:] == lon[:-1]) & (lat[1:] == lat[:-1])
            same &= pc.equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)
            first[1:] = ~same
        if not first.all():
            slab, lon, lat, own, ids = slab[first], lon[first], lat[first], own[first], ids.filter(pa.array(first))
        done = slab < slab[-1] - 1 if not end and self.near else np.ones(len(lon), dtype=bool)
        if self.near:
            yield from self._pairs(slab, lon, lat, own, ids, int(done.sum()))
        if self.areas:
            yield from self._inside(lon, lat, own & done, ids)
        keep = np.flatnonzero(~done)
        self.rows = [(slab[keep], lon[keep], lat[keep], own[keep], ids.take(pa.array(keep)))] if len(keep) else []
        self.held = len(keep)

    def _pairs(self, slab, lon, lat, own, ids, n: int) -> Iterator[pa.RecordBatch]:
        wide = 1 << 34
        key = slab.astype(np.int64) * wide + np.round((lon + 400) * 1e7).astype(np.int64)
        reach = np.ceil(self.tiles.dlon(lat) * 1e7).astype(np.int64) + 2
        i = np.arange(n)
        here = np.searchsorted(key, np.minimum(key[:n] + reach[:n], (slab[:n].astype(np.int64) + 1) * wide - 1), "right")
        up = key[:n] + wide
        lo = np.searchsorted(key, up - reach[:n], "left")
        hi = np.searchsorted(key, up + reach[:n], "right")
        lo = np.maximum(lo, here)  # nothing of this slab again
        start = np.concatenate([i + 1, lo])
        count = np.concatenate([here - i - 1, np.maximum(hi - lo, 0)])
        left = np.concatenate([i, i])
        some = np.flatnonzero(count > 0)
        start, count, left = start[some], count[some], left[some]
        ends, at = np.cumsum(count), 0
        while at < len(count):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + CANDIDATES, "right")))
            a = np.repeat(left[at:to], count[at:to])
            b = _ranges(start[at:to], count[at:to])
            at = to
            m = own[a] | own[b]
            a, b = a[m], b[m]
            m = haversine(lon[a], lat[a], lon[b], lat[b]) <= self.tiles.d
            a, b = a[m], b[m]
            if not len(a):
                continue
            ia, ib = ids.take(pa.array(a)), ids.take(pa.array(b))
            less = pc.less(ia, ib).to_numpy(zero_copy_only=False)
            differ = pc.not_equal(ia, ib).to_numpy(zero_copy_only=False)
            small, large = np.where(less, a, b), np.where(less, b, a)
            turn = lon[large] - lon[small]  # of a point and its ghosts a turn away, one lies in this range
            m = own[small] & differ & (turn > -180) & (turn <= 180)
            if m.any():
                yield _pair_batch("near", ids.take(pa.array(small[m])), ids.take(pa.array(large[m])))

    def _inside(self, lon, lat, own, ids) -> Iterator[pa.RecordBatch]:
        mine = np.flatnonzero(own)
        mine = mine[np.argsort(lat[mine], kind="stable")]
        x, y = lon[mine], lat[mine]
        for key, (x0, x1, y0, y1), e in self.areas:
            a, b = np.searchsorted(y, y0, "left"), np.searchsorted(y, y1, "right")
            if a >= b:
                continue
            c = a + np.flatnonzero((x[a:b] >= x0) & (x[a:b] <= x1))
            c = c[strictly_inside(x[c], y[c], e)] if len(c) else c
            if len(c):
                yield _pair_batch("inside", ids.take(pa.array(mine[c])), pa.array([key] * len(c), pa.string()))


def _pair_batch(rel: str, a: pa.Array, b: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([rel] * len(a), pa.string()), a.cast(pa.string()), b.cast(pa.string())], ["rel", "id_a", "id_b"])


def near_and_inside(
    points: DataFrame, distance_m: float | None = 120.0, areas: DataFrame | None = None, rows_per_tile: int = ROWS_PER_TILE
) -> DataFrame:
    """Pairs ``(rel, id_a, id_b)``: ``near`` for two points within the distance, ``inside`` for a point in an area.

    ``points`` and ``areas`` need the columns ``id`` and ``geometry`` (WKB).  ``distance_m=None`` leaves out the
    ``near`` rows, ``areas=None`` the ``inside`` rows.  For ``near``, ``id_a`` is the smaller id by code point.
    See the module's docstring for nulls, repeats and ties.
    """
    near = distance_m is not None
    tiles = plan_tiles(points, distance_m if near else 1.0, rows_per_tile)
    rows = _point_rows(points, tiles, near)
    if areas is not None:
        rows = rows.unionByName(_area_rows(areas, tiles))
    width = max(1, min(tiles.cells, 200_000))
    placed = rows.repartitionById(width, F.col("cell") % width).sortWithinPartitions("cell", "kind", "slab", "lon", "lat", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, at = None, None
        for b in batches:
            if not b.num_rows:
                continue
            cell = b.column("cell").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]))
            for i, j in zip(cuts[:-1], cuts[1:]):
                if state is None or cell[i] != at:
                    if state is not None:
                        yield from state.sweep(True)
                    state, at = _Cell(tiles, near), cell[i]
                part = b.slice(i, j - i)
                yield from state.add(
                    part.column("kind").to_numpy(), part.column("slab").to_numpy(), part.column("lon").to_numpy(), part.column("lat").to_numpy(),
                    part.column("id"), part.column("own").to_numpy(zero_copy_only=False), part.column("edges"),
                )
        if state is not None:
            yield from state.sweep(True)

    return placed.mapInArrow(run, PAIR)
