"""Set-based sampling of question parameters that surely have an answer.

References are drawn per country in the order of a hash, ``quota`` at first.  All features are tested against all drawn
references, inside a scan without a join or a pool, and every template keeps its first ``quota`` references with a hit in
each country.  Countries that fall short get further references, twice as many each round, until the quota is full or no
reference is left; so the result is that of testing everything first and applying the quota afterwards.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartoloom.geo import kernels as K
from cartoloom.geo.sphere import degrees_for, distance, lon_degrees_for
from cartoloom.geo.wkb import decode, decode_cached, points_of
from cartoloom.operators import spatial as S
from cartoloom.operators.nearby import near_and_inside
from cartoloom.plans.dataset import SEED, ranked_per_stratum
from cartoloom.session import checkpointed

GROUP = 2000  # points of an area tested at once
REFS_PER_ROUND = 100_000  # drawn references held by the driver at once
# Template: least and greatest metres from the reference, whether the hit must lie in its country, and in some direction.
NEAR = {"proximity": (0.0, 5000.0, True, False), "direction": (0.0, S.FAR_M, True, True), "direction_distance": (0.0, S.FAR_M, True, True)}
CITIES = {"city_direction": (500.0, S.FAR_M, True, True), "city_direction_distance": (500.0, S.FAR_M, True, True)}
SHOWN = "show_division"
HIT = "template string, ref int, h string, subtype string, class string, distance_m double, bearing double"
SAMPLE = "template string, country string, place string, subtype string, class string, distance_m double, bearing double"


@F.pandas_udf(T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]))
def centre_of(g: pd.Series) -> pd.DataFrame:
    """Centroid of a shape; null where there is none."""
    lon, lat = points_of(g)
    for i in np.flatnonzero(np.isnan(lon)):
        s = decode(g.iloc[i])
        if s is not None:
            lon[i], lat[i] = K.centroid(s)
    return pd.DataFrame({"lon": lon, "lat": lat})


def compass(bearing: Column) -> Column:
    """The one direction of a bearing: sectors are half-open here, unlike in the queries."""
    return F.when((bearing >= 45) & (bearing < 135), "east").when((bearing >= 135) & (bearing < 225), "south").when((bearing >= 225) & (bearing < 315), "west").when(bearing.isNotNull(), "north")


def centred(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows by their centroid, held so that several rounds read the same ones."""
    own = rows.where("id is not null and geometry is not null").select("id", "country", *columns, centre_of("geometry").alias("c"))
    return checkpointed(own.where("c.lon is not null").select("id", "country", *columns, "c.lon", "c.lat"))


def first_hits(rows: DataFrame, refs: list[tuple], wanted: dict[str, tuple], short: dict[str, set[str]]) -> DataFrame:
    """Of each reference and template the hit of smallest hash among all rows; ``refs``: id, country, lon, lat.

    A reference is tested for the templates that are still short in its country.  A task holds one batch of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            order = np.argsort(b.column("lat").to_numpy(), kind="stable")
            b = b.take(pa.array(order))
            lon, lat = b.column("lon").to_numpy(), b.column("lat").to_numpy()
            ids, country = (np.array(b.column(c).to_pylist(), dtype=object) for c in ("id", "country"))
            subtype, klass = b.column("subtype"), b.column("class")
            out = []
            for k, (ref, home, x, y) in enumerate(refs):
                mine = [t for t in wanted if home in short[t]]
                if not mine:
                    continue
                far = max(wanted[t][1] for t in mine)
                dy, dx = degrees_for(far), float(lon_degrees_for(far, abs(y)))
                i, j = np.searchsorted(lat, y - dy, "left"), np.searchsorted(lat, y + dy, "right")
                at = i + np.flatnonzero(np.abs((lon[i:j] - x + 540) % 360 - 180) <= dx)
                at = at[ids[at] != ref]
                if not len(at):
                    continue
                metres, bearing = distance(x, y, lon[at], lat[at]), S.azimuth(x, y, lon[at], lat[at])
                own = country[at] == home
                for t in mine:
                    low, high, inland, turned = wanted[t]
                    good = (metres >= low) & (metres <= high)
                    if inland:
                        good &= own
                    if turned:
                        good &= ~np.isnan(bearing)
                    hits = np.flatnonzero(good)
                    if not len(hits):
                        continue
                    h = [md5(f"{ref}|{z}|{t}|{SEED}".encode()).hexdigest() for z in ids[at[hits]]]
                    least = min(h)
                    for n, z in zip(hits, h):
                        if z == least:
                            a = int(at[n])
                            out.append((t, k, z, subtype[a].as_py(), klass[a].as_py(), float(metres[n]), None if np.isnan(bearing[n]) else float(bearing[n])))
            if out:
                cols = list(zip(*out))
                kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, z) for c, z in zip(cols, kinds)], ["template", "ref", "h", "subtype", "class", "distance_m", "bearing"])

    found = rows.select("id", "country", "subtype", "class", "lon", "lat").mapInArrow(run, HIT)
    return found.groupBy("template", "ref").agg(F.min(F.struct("h", "subtype", "class", "distance_m", "bearing")).alias("k")).select("template", "ref", "k.*")


def sampled(refs: DataFrame, sources: list[tuple[DataFrame, dict[str, tuple]]], quota: int) -> DataFrame:
    """Per template and country the first ``quota`` references with a hit, each with one hit.

    ``refs``: ``id, country, name, lon, lat``; ``sources``: rows and the templates to be tested on them.  The driver holds
    the references of one round and the result, at most ``quota`` rows per template and country.
    """
    asked = {r["country"] for r in refs.where("country is not null").select("country").distinct().collect()}
    short = {t: set(asked) for t in [SHOWN, *(t for _, wanted in sources for t in wanted)]}
    rows, full = [], Counter()
    done, step = 0, quota
    while asked and quota > 0:
        drawn = ranked_per_stratum(refs.where(F.col("country").isin(*asked)), "country", "id", done + step).where(F.col("pick") > done)
        drawn = sorted(drawn.select("country", "pick", "id", "name", "lon", "lat").collect())
        plain = [(r["id"], r["country"], r["lon"], r["lat"]) for r in drawn]
        hits = [(SHOWN, k, None, None, None, None, None) for k in range(len(drawn))]
        for source, wanted in sources:
            if drawn and any(short[t] for t in wanted):
                hits += [tuple(r) for r in first_hits(source, plain, wanted, short).collect()]
        for t, k, _, *hit in sorted(hits, key=lambda r: (r[0], r[1])):
            home = drawn[k]["country"]
            if home in short[t] and full[t, home] < quota:
                full[t, home] += 1
                rows.append((t, home, drawn[k]["name"], *hit))
        size = Counter(r["country"] for r in drawn)
        for t in short:
            short[t] = {c for c in short[t] if full[t, c] < quota and size[c] == step}
        asked = set().union(*short.values())
        done, step = done + step, min(2 * step, max(quota, REFS_PER_ROUND // max(1, len(asked))))
    out = refs.sparkSession.createDataFrame(rows, SAMPLE)
    return out.withColumn("distance_m", F.round("distance_m", 1)).withColumn("direction", compass(F.col("bearing"))).withColumn("bearing", F.round("bearing", 1))


def sample_relations(divisions: DataFrame, features: DataFrame, quota: int) -> DataFrame:
    """Parameters for the relations between a named place and a feature or another place.

    ``divisions``: ``id, name, country, subtype, geometry``; ``features``: ``id, country, subtype, class, geometry``.
    """
    towns = centred(divisions.where("subtype = 'locality' and name is not null"), "name")
    cities = towns.withColumns({c: F.lit(None).cast("string") for c in ("subtype", "class")})
    return sampled(towns, [(centred(features, "subtype", "class"), NEAR), (cities, CITIES)], quota)


FOUND = "id_b string, template string, h string, subtype string, class string, center_radius_m double"


def kinds_in(groups: DataFrame, band_m: float) -> DataFrame:
    """Of each group of points in one area the point of smallest hash per template that holds for it.

    ``groups``: ``id_b, area, hits array<struct<h, subtype, class, lon, lat>>``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k in range(b.num_rows):
                key, raw, hits = (b.column(c)[k].as_py() for c in ("id_b", "area", "hits"))
                s = decode_cached(raw)
                x, y = (np.array([p[c] for p in hits]) for c in ("lon", "lat"))
                radius = S.center_radius(K.sphere_area(s))
                _, qx, qy, _, _ = K.nearest(K.segments_of(s), x, y)
                tests = {"containment": np.full(len(x), True), "center": distance(x, y, *K.centroid(s)) <= radius, "periphery": distance(x, y, qx, qy) <= band_m}
                for template, good in tests.items():
                    some = [hits[i] for i in np.flatnonzero(good)]
                    least = min((p["h"] for p in some), default=None)
                    out += [(key, template, p["h"], p["subtype"], p["class"], radius) for p in some if p["h"] == least]
            if out:
                kinds = [pa.string()] * 5 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, z) for c, z in zip(zip(*out), kinds)], ["id_b", "template", "h", "subtype", "class", "center_radius_m"])

    return groups.select("id_b", "area", "hits").mapInArrow(run, FOUND)


def sample_inside(areas: DataFrame, points: DataFrame, quota: int, band_m: float = 500.0) -> DataFrame:
    """Parameters for containment, centre and periphery: per template and country ``quota`` named land areas for which
    some point holds, with one kind of point found in them.  ``points``: ``id, subtype, class, geometry``.

    Every point in every area is tested.  An area's geometry meets its points once per group of about ``GROUP`` points.
    """
    named = areas.where("is_land and subtype = 'locality' and name is not null and country is not null and geometry is not null").dropDuplicates(["id"])
    own = points.where("id is not null and geometry is not null").dropDuplicates(["id"])
    inside = checkpointed(near_and_inside(own.select("id", "geometry"), None, named.select("id", "geometry")).select("id_a", "id_b"))
    p = own.select(F.col("id").alias("id_a"), "subtype", "class", centre_of("geometry").alias("c"))
    # areas of many points, at most one in GROUP points
    heavy = inside.groupBy("id_b").agg(F.ceil(F.count("*") / GROUP).alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("id_a"), F.coalesce(F.col("parts"), F.lit(1)))
    hit = inside.join(F.broadcast(heavy), "id_b", "left").withColumn("part", part).join(p, "id_a")
    h = F.md5(F.concat_ws("|", "id_a", F.lit(SEED))).alias("h")
    groups = hit.groupBy("id_b", "part").agg(F.collect_list(F.struct(h, "subtype", "class", "c.lon", "c.lat")).alias("hits"))
    found = kinds_in(groups.join(named.select(F.col("id").alias("id_b"), F.col("geometry").alias("area")), "id_b"), band_m)
    one = found.groupBy("template", "id_b").agg(F.min(F.struct("h", "subtype", "class", "center_radius_m")).alias("k"))
    at = one.join(named.select(F.col("id").alias("id_b"), "name", "country"), "id_b").withColumn("stratum", F.concat_ws("|", "template", "country"))
    radius = F.when(F.col("template") == "center", F.round("k.center_radius_m", 1)).alias("center_radius_m")
    return ranked_per_stratum(at, "stratum", "id_b", quota).select("template", "country", F.col("name").alias("place"), "k.subtype", "k.class", radius)
