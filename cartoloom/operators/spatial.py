"""The sixteen named spatial relations.

Every relation asks which features lie in some relation to a few reference shapes, found by name.  The reference rows
are read in blocks of bounded size, and the features are scanned once per block (in practice once): a feature row is
decoded, tested against the boxes of the block's references and then exactly, all inside one Arrow batch function.
There is no shuffle, however many features there are; only the column filters run before it, in the Parquet reader.

Results have the columns ``id, name, geometry`` and bag semantics: a feature that matches several references of one
name is listed for each.  Distances are geodesic on WGS84 (``model="spheroid"``) or great-circle (``"sphere"``);
``axis="swapped"`` reads every coordinate pair as (lat, lon), which reproduces results computed that way.  Rankings
(nearest segment, nearest point of a shape, largest area) are planar in degrees, thresholds in metres.

Defined results: features and references without a decodable geometry take no part; a null name never matches; where
one reference is wanted, ties go by the documented order and then by id; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartoloom.functions.text import fold, fold_term
from cartoloom.geo import kernels as K
from cartoloom.geo.sphere import degrees_for, distance, lon_degrees_for
from cartoloom.geo.wkb import Shape, decode, points_of
from cartoloom.operators.nearby import edges_of, strictly_inside
from cartoloom.sources.views import SEARCH_COLUMNS

FOUND = "id string, name string, geometry binary"
BLOCK_ROWS = 5000
BLOCK_BYTES = 64_000_000
FAR_M = 100_000.0
# Sectors in degrees clockwise from north; north wraps.
SECTORS = {"north": (315, 45), "east": (45, 135), "south": (135, 225), "west": (225, 315)}
LINES = ("river", "stream", "canal")


@dataclass(frozen=True)
class Measure:
    """How distances are measured."""

    model: str = "spheroid"
    axis: str = "lonlat"
    prefilter: bool = True

    def metres(self, lon1, lat1, lon2, lat2) -> np.ndarray:
        return distance(lon1, lat1, lon2, lat2, self.model, self.axis)


def named(df: DataFrame, term: str) -> DataFrame:
    """Rows one of whose searched names equals the term, case and accents folded."""
    t = fold_term(term)
    return df.where(reduce(lambda a, b: a | b, [F.coalesce(fold(c) == t, F.lit(False)) for c in SEARCH_COLUMNS]))


def name_contains(df: DataFrame, term: str) -> DataFrame:
    """Rows one of whose searched names contains the term; ``%`` and ``_`` stand for themselves."""
    t = fold_term(term)
    return df.where(reduce(lambda a, b: a | b, [F.coalesce(fold(c).contains(t), F.lit(False)) for c in SEARCH_COLUMNS]))


def of_class(df: DataFrame, subtype: str, klass: str) -> DataFrame:
    return df.where((F.col("subtype") == subtype) & (F.col("class") == klass))


def of_category(df: DataFrame, category: str) -> DataFrame:
    return df.where(F.array_contains("category_hierarchy", category))


class Batch:
    """The decoded features of one Arrow batch."""

    def __init__(self, raw: list[bytes | None]):
        self.raw = raw
        self.lon, self.lat = points_of(raw)
        self.shapes: dict[int, Shape] = {}
        self.box = np.column_stack([self.lon, self.lat, self.lon, self.lat])
        for i in np.flatnonzero(np.isnan(self.lon)):
            s = decode(raw[i])
            if s is not None:
                self.shapes[int(i)] = s
                self.lon[i], self.lat[i] = K.centroid(s)
                self.box[i] = s.bbox
        self.ok = ~np.isnan(self.lon)

    def shape(self, i: int) -> Shape:
        return self.shapes.get(i) or Shape("POINT", (np.array([[self.lon[i], self.lat[i]]]),), (0,))

    def meeting(self, box: tuple[float, float, float, float], metres: float, m: Measure) -> np.ndarray:
        """Rows whose box meets a box grown by a distance; the growth never falls short of it."""
        if not m.prefilter or m.axis == "swapped":
            return np.flatnonzero(self.ok)
        dy = degrees_for(metres)
        dx = float(lon_degrees_for(metres, max(abs(box[1] - dy), abs(box[3] + dy))))
        b = self.box
        hit = (b[:, 2] >= box[0] - dx) & (b[:, 0] <= box[2] + dx)
        if box[0] - dx < -180:  # the grown box goes on beyond the antimeridian
            hit |= b[:, 2] >= box[0] - dx + 360
        if box[2] + dx > 180:
            hit |= b[:, 0] <= box[2] + dx - 360
        return np.flatnonzero(self.ok & hit & (b[:, 3] >= box[1] - dy) & (b[:, 1] <= box[3] + dy))


def blocks(refs: DataFrame) -> Iterator[list[Shape]]:
    """The shapes of the reference rows, in blocks of bounded size."""
    block: list[Shape] = []
    size = 0
    for row in refs.select("geometry").where("geometry is not null").toLocalIterator():
        s = decode(bytes(row["geometry"]))
        if s is None:
            continue
        block.append(s)
        size += len(row["geometry"])
        if len(block) >= BLOCK_ROWS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def scan(features: DataFrame, refs: DataFrame, test: Callable[[Batch, Shape], np.ndarray]) -> DataFrame:
    """Features joined to the reference shapes by a test that returns the matching rows of a batch."""
    own = features.select("id", "name", "geometry").where("geometry is not null")
    out = None
    for block in blocks(refs):

        def run(batches: Iterator[pa.RecordBatch], block: list[Shape] = block) -> Iterator[pa.RecordBatch]:
            for b in batches:
                batch = Batch(b.column("geometry").to_pylist())
                hits = [h for s in block if len(h := test(batch, s))]
                if hits:
                    yield b.take(pa.array(np.concatenate(hits)))

        part = own.mapInArrow(run, FOUND)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else features.sparkSession.createDataFrame([], FOUND)


def azimuth(x: np.ndarray, y: np.ndarray, lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    """Planar bearing from (x, y) in degrees clockwise from north; NaN for coincident points."""
    dx, dy = lon - x, lat - y
    return np.where((dx == 0) & (dy == 0), np.nan, np.degrees(np.arctan2(dx, dy)) % 360)


def in_sector(bearing: np.ndarray, direction: str) -> np.ndarray:
    """Sector test with both limits included; north, which wraps, excludes 45."""
    low, high = SECTORS[direction]
    with np.errstate(invalid="ignore"):
        return (bearing >= low) | (bearing < high) if direction == "north" else (bearing >= low) & (bearing <= high)


def band(metres: float) -> tuple[float, float]:
    """Distance range asked for by "at so many metres": a fifth either way, between 200 m and 10 km."""
    t = max(200.0, min(0.20 * metres, 10_000.0))
    return metres - t, metres + t


def within_rows(b: Batch, s: Shape) -> np.ndarray:
    """Rows that lie within an area."""
    x0, y0, x1, y1 = s.bbox
    rows = np.flatnonzero(b.ok & (b.box[:, 0] >= x0) & (b.box[:, 2] <= x1) & (b.box[:, 1] >= y0) & (b.box[:, 3] <= y1))
    plain = np.asarray([i for i in rows if int(i) not in b.shapes], dtype=int)
    inside = plain[strictly_inside(b.lon[plain], b.lat[plain], edges_of(s))] if len(plain) else plain
    other = [i for i in rows if int(i) in b.shapes and K.within(b.shapes[int(i)], s)]
    return np.sort(np.concatenate([inside, np.asarray(other, dtype=int)]))


def near_rows(b: Batch, s: Shape, metres: float, m: Measure) -> np.ndarray:
    """Rows whose centroid is within a distance of the shape's point nearest to them."""
    rows = b.meeting(s.bbox, metres, m)
    if not len(rows):
        return rows
    if s.kind == "POINT":
        qx, qy = np.full(len(rows), s.paths[0][0, 0]), np.full(len(rows), s.paths[0][0, 1])
    else:
        q = np.asarray([K.closest_point(s, b.shape(int(i))) for i in rows])
        qx, qy = q[:, 0], q[:, 1]
    return rows[m.metres(b.lon[rows], b.lat[rows], qx, qy) <= metres]


def sector_rows(b: Batch, s: Shape, direction: str, low: float, high: float, m: Measure) -> np.ndarray:
    """Rows in a sector as seen from the shape's centroid, between two distances."""
    rows = b.meeting(s.bbox, high, m)
    x, y = K.centroid(s)
    rows = rows[in_sector(azimuth(x, y, b.lon[rows], b.lat[rows]), direction)]
    d = m.metres(x, y, b.lon[rows], b.lat[rows])
    return rows[(d >= low) & (d <= high)]


def center_rows(b: Batch, s: Shape, m: Measure) -> np.ndarray:
    """Rows in the core of an area."""
    radius = center_radius(K.spheroid_area(s) if m.model == "spheroid" else K.sphere_area(s))
    x, y = K.centroid(s)
    rows = b.meeting((x, y, x, y), radius, m)
    return rows[m.metres(b.lon[rows], b.lat[rows], x, y) <= radius]


def periphery_rows(b: Batch, s: Shape, band_m: float, m: Measure) -> np.ndarray:
    """Rows inside an area and near its border."""
    border = Shape("MULTILINESTRING", s.paths, s.owners)
    x0, y0, x1, y1 = s.bbox
    rows = np.flatnonzero(b.ok & (b.box[:, 0] >= x0) & (b.box[:, 2] <= x1) & (b.box[:, 1] >= y0) & (b.box[:, 3] <= y1))
    rows = np.asarray([i for i in rows if K.within(b.shape(int(i)), s)], dtype=int)
    if not len(rows):
        return rows
    q = np.asarray([K.closest_point(border, b.shape(int(i))) for i in rows])
    return rows[m.metres(b.lon[rows], b.lat[rows], q[:, 0], q[:, 1]) <= band_m]


def border_rows(b: Batch, s: Shape, metres: float, m: Measure) -> np.ndarray:
    """Rows near the border of an area, on either side."""
    rows = b.meeting(s.bbox, metres, m)
    if not len(rows):
        return rows
    _, qx, qy, _, _ = K.nearest(K.segments_of(s), b.lon[rows], b.lat[rows])
    return rows[m.metres(b.lon[rows], b.lat[rows], qx, qy) <= metres]


def line_rows(b: Batch, lines: list[Shape], metres: float, m: Measure, side: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows near some line, the planar distance to the nearest (the first of equals), and whether that one is within reach."""
    segments = [K.segments_of(s) for s in lines]
    size = len(b.lon)
    best, at, which = np.full(size, np.inf), np.full((2, size), np.nan), np.full(size, -1)
    for k, s in enumerate(segments):
        rows = b.meeting(lines[k].bbox, metres, m)
        if not len(rows):
            continue
        d, qx, qy, _, _ = K.nearest(s, b.lon[rows], b.lat[rows])
        closer = d < best[rows]
        rows = rows[closer]
        best[rows], at[0, rows], at[1, rows], which[rows] = d[closer], qx[closer], qy[closer], k
    rows = np.flatnonzero(which >= 0)
    good = m.metres(b.lon[rows], b.lat[rows], at[0, rows], at[1, rows]) <= metres
    if side is not None:
        for j in np.flatnonzero(good):
            i = rows[j]
            good[j] = K.side_of(segments[which[i]], b.lon[i : i + 1], b.lat[i : i + 1])[0] == side
    return rows, best[rows], good


def _within(features: DataFrame, areas: DataFrame) -> DataFrame:
    return scan(features, areas, within_rows)


def _near(features: DataFrame, refs: DataFrame, metres: float, m: Measure) -> DataFrame:
    return scan(features, refs, lambda b, s: near_rows(b, s, metres, m))


def _sector(features: DataFrame, refs: DataFrame, direction: str, low: float, high: float, m: Measure) -> DataFrame:
    return scan(features, refs, lambda b, s: sector_rows(b, s, direction, low, high, m))


def containment(v: dict, place: str, subtype: str, klass: str) -> DataFrame:
    return _within(of_class(v["infrastructures"], subtype, klass), named(v["division_areas"], place))


def proximity(v: dict, place: str, subtype: str, klass: str, distance_m: float = 5000.0, measure: Measure = Measure()) -> DataFrame:
    return _near(of_class(v["infrastructures"], subtype, klass), named(v["divisions"], place), distance_m, measure)


def is_line(column: str) -> Column:
    """Whether a WKB value is a line string, in either byte order, with or without Z, M and SRID."""
    h = F.hex(F.substring(column, 1, 5))
    low = F.concat(F.substring(h, 9, 2), F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2))
    code = F.conv(F.when(F.substring(h, 1, 2) == "01", low).otherwise(F.substring(h, 3, 8)), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(code.bitwiseAND(F.lit(0x0FFFFFFF)), F.lit(1000)) == 2, F.lit(False))


def _lines(v: dict, feature: str) -> DataFrame:
    """Line strings of the watercourses whose name contains the term."""
    lines = name_contains(v["water"].where(F.col("class").isin(*LINES)), feature)
    return lines.where(is_line("geometry")).orderBy("id")


def _by_nearest_line(features: DataFrame, lines: DataFrame, metres: float, m: Measure, side: int | None) -> DataFrame:
    """Features whose nearest line (planar) is within a distance, one row per id; optionally on one side of it.

    With one block of lines the test ends in the scan; with several, the blocks' nearest lines are compared per id.
    Either way the first of equally near lines wins.
    """
    out, n = None, 0
    own = features.select("id", "name", "geometry").where("geometry is not null")
    for block in blocks(lines):

        def run(batches: Iterator[pa.RecordBatch], block: list[Shape] = block, no: int = n) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows, d, good = line_rows(Batch(b.column("geometry").to_pylist()), block, metres, m, side)
                if len(rows):
                    got = b.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([*got.columns, pa.array(d), pa.array(np.full(len(rows), no, np.int32)), pa.array(good)], [*got.schema.names, "d", "no", "good"])

        part = own.mapInArrow(run, FOUND + ", d double, no int, good boolean")
        out = part if out is None else out.unionByName(part)
        n += 1
    if out is None:
        return features.sparkSession.createDataFrame([], FOUND)
    if n > 1:
        out = out.withColumn("rn", F.row_number().over(Window.partitionBy("id").orderBy("d", "no"))).where("rn = 1")
    return out.where("good").select("id", "name", "geometry").dropDuplicates(["id"])


def along(v: dict, feature: str, subtype: str, klass: str, corridor_m: float = 500.0, measure: Measure = Measure()) -> DataFrame:
    return _by_nearest_line(of_class(v["infrastructures"], subtype, klass), _lines(v, feature), corridor_m, measure, None)


def left_right_bank(
    v: dict, feature: str, subtype: str, klass: str, distance_m: float = 3000.0, side_sign: int = 1, measure: Measure = Measure()
) -> DataFrame:
    """Side 1 is the left bank, -1 the right bank, 0 on the line; the geometry is part of the result."""
    return _by_nearest_line(of_class(v["infrastructures"], subtype, klass), _lines(v, feature), distance_m, measure, side_sign)


def center_radius(area_m2: float) -> float:
    return max(300.0, min(5000.0, 0.15 * area_m2**0.5))


def center(v: dict, place: str, subtype: str, klass: str, measure: Measure = Measure()) -> DataFrame:
    return scan(of_class(v["infrastructures"], subtype, klass), named(v["division_areas"], place), lambda b, s: center_rows(b, s, measure))


def periphery(v: dict, place: str, subtype: str, klass: str, band_m: float = 500.0, measure: Measure = Measure()) -> DataFrame:
    return scan(of_class(v["infrastructures"], subtype, klass), named(v["division_areas"], place), lambda b, s: periphery_rows(b, s, band_m, measure))


def direction(v: dict, place: str, subtype: str, klass: str, direction: str, measure: Measure = Measure()) -> DataFrame:
    return _sector(of_class(v["infrastructures"], subtype, klass), named(v["divisions"], place), direction, 0.0, FAR_M, measure)


def direction_distance(v: dict, place: str, subtype: str, klass: str, direction: str, distance_m: float, measure: Measure = Measure()) -> DataFrame:
    return _sector(of_class(v["infrastructures"], subtype, klass), named(v["divisions"], place), direction, *band(distance_m), measure)


def area_distance(v: dict, place: str, subtype: str, klass: str, distance_m: float = 5000.0, measure: Measure = Measure()) -> DataFrame:
    """The reference is the water feature of smallest id whose name contains the term."""
    ref = name_contains(v["water"], place).where("geometry is not null").orderBy("id").limit(1)
    return _near(of_class(v["infrastructures"], subtype, klass), ref, distance_m, measure)


def places_containment(v: dict, place: str, category: str) -> DataFrame:
    return _within(of_category(v["places"], category), named(v["division_areas"], place))


def places_proximity(v: dict, place: str, category: str, distance_m: float = 5000.0, measure: Measure = Measure()) -> DataFrame:
    return _near(of_category(v["places"], category), named(v["divisions"], place), distance_m, measure)


def places_direction(v: dict, place: str, category: str, direction: str, measure: Measure = Measure()) -> DataFrame:
    return _sector(of_category(v["places"], category), named(v["divisions"], place), direction, 0.0, FAR_M, measure)


def bordering(v: dict, place: str, distance_m: float = 20_000.0, measure: Measure = Measure()) -> DataFrame:
    """Localities near the border of an area, on either side; countries and land areas are preferred, then the id."""
    ref = named(v["division_areas"], place).where("geometry is not null")
    ref = ref.orderBy(F.coalesce(F.col("subtype") == "country", F.lit(False)).desc(), F.coalesce("is_land", F.lit(False)).desc(), "id").limit(1)

    return scan(v["divisions"].where("subtype = 'locality'"), ref, lambda b, s: border_rows(b, s, distance_m, measure))


@F.pandas_udf(T.DoubleType())
def planar_area(g: pd.Series) -> pd.Series:
    """Area in square degrees; null where there is no shape."""
    shapes = [decode(x) for x in g]
    return pd.Series([None if s is None else K.planar_area(s) for s in shapes], dtype="float64")


def largest_land_areas(areas: DataFrame) -> DataFrame:
    """The largest land area of each division (ties by id)."""
    own = areas.where("is_land and division_id is not null and geometry is not null").select("division_id", "id", "name", "geometry")
    w = Window.partitionBy("division_id").orderBy(F.desc_nulls_last("a"), "id")
    return own.withColumn("a", planar_area("geometry")).withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("a", "rn")


def _top_division(v: dict, place: str) -> DataFrame:
    return named(v["divisions"], place).orderBy(F.desc_nulls_last("population"), "id").limit(1)


def _cities(v: dict, place: str, direction: str, low: float, high: float, measure: Measure) -> DataFrame:
    city = _sector(v["divisions"].where("subtype = 'locality'"), _top_division(v, place), direction, low, high, measure)
    ids = city.select(F.col("id").alias("division_id")).distinct()
    area = largest_land_areas(v["division_areas"].join(ids, "division_id", "left_semi")).select("division_id", F.col("geometry").alias("area"))
    return city.join(area, city["id"] == area["division_id"], "left").select("id", "name", F.coalesce("area", "geometry").alias("geometry"))


def city_direction(v: dict, place: str, direction: str, measure: Measure = Measure()) -> DataFrame:
    """Localities in a sector of the most populous division of that name, which itself is not listed."""
    return _cities(v, place, direction, 0.0, FAR_M, measure)


def city_direction_distance(v: dict, place: str, direction: str, distance_m: float, measure: Measure = Measure()) -> DataFrame:
    return _cities(v, place, direction, *band(distance_m), measure)


def show_division(v: dict, place: str) -> DataFrame:
    """The most populous division of that name and its largest land area."""
    d = _top_division(v, place)
    ids = d.select(F.col("id").alias("division_id"))
    area = largest_land_areas(v["division_areas"].join(ids, "division_id", "left_semi"))
    return d.select("id", "name", "geometry").unionByName(area.select("id", "name", "geometry"))


OPERATORS = {
    f.__name__: f
    for f in (
        containment, proximity, along, center, periphery, direction, direction_distance, area_distance, left_right_bank, places_containment,
        places_proximity, places_direction, bordering, city_direction, city_direction_distance, show_division,
    )
}
