"""Registered queries of the sixteen spatial relations, and their oracle SQL over decoded geometries.

The searched names are looked up in the data (they differ between data sets): the division that most infrastructure
belongs to, the watercourse with most lines, the country of smallest id.  Geometries are shown as hexadecimal WKB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoloom.operators import spatial as S
from cartoloom.queries.wkb_sql import paths_cte, points_cte
from cartoloom.sources.views import LANGUAGES, SEARCHED, open_views
from cartoloom.session import table

SPHERE = S.Measure(model="sphere")
PARKING = ("transit", "parking")
CATEGORY = "restaurant"


def hot_place(spark: SparkSession, sf_dir: str) -> str:
    """Name of the division that most infrastructure rows belong to."""
    owned = table(spark, sf_dir, "infrastructures").where("division_id is not null").groupBy("division_id").count()
    named = table(spark, sf_dir, "divisions").where("name is not null and geometry is not null").groupBy("id").agg(F.min("name").alias("name"))
    row = owned.join(named, owned["division_id"] == named["id"]).orderBy(F.desc("count"), "id").select("name").first()
    return row["name"] if row else ""


def long_river(spark: SparkSession, sf_dir: str) -> str:
    """Name of most line rows among the watercourses."""
    lines = table(spark, sf_dir, "water").where(F.col("class").isin(*S.LINES) & F.col("name").isNotNull())
    lines = lines.where(F.hex(F.substring("geometry", 1, 5)).isin("0102000000", "0000000002"))
    row = lines.groupBy("name").count().orderBy(F.desc("count"), "name").first()
    return row["name"] if row else ""


def first_country(spark: SparkSession, sf_dir: str) -> str:
    row = table(spark, sf_dir, "division_areas").where("subtype = 'country' and name is not null").orderBy("id").select("name").first()
    return row["name"] if row else ""


def _query(name: str, term, *args, **kwargs):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = S.OPERATORS[name](open_views(spark, sf_dir), term(spark, sf_dir), *args, **kwargs)
        return out.select("id", "name", F.hex("geometry").alias("geometry"))

    run.__name__ = name
    return run


QUERIES = {
    "containment": _query("containment", hot_place, *PARKING),
    "proximity": _query("proximity", hot_place, *PARKING, 5000.0, measure=SPHERE),
    "along": _query("along", long_river, *PARKING, 5000.0, measure=SPHERE),
    "center": _query("center", hot_place, *PARKING, measure=SPHERE),
    "periphery": _query("periphery", hot_place, *PARKING, 1500.0, measure=SPHERE),
    "direction": _query("direction", hot_place, *PARKING, "north", measure=SPHERE),
    "direction_distance": _query("direction_distance", hot_place, *PARKING, "south", 25000.0, measure=SPHERE),
    "area_distance": _query("area_distance", long_river, *PARKING, 20000.0, measure=SPHERE),
    "left_right_bank": _query("left_right_bank", long_river, *PARKING, 20000.0, 1, measure=SPHERE),
    "places_containment": _query("places_containment", hot_place, CATEGORY),
    "places_proximity": _query("places_proximity", hot_place, CATEGORY, 5000.0, measure=SPHERE),
    "places_direction": _query("places_direction", hot_place, CATEGORY, "south", measure=SPHERE),
    "bordering": _query("bordering", first_country, 20_000.0, measure=SPHERE),
    "city_direction": _query("city_direction", hot_place, "west", measure=SPHERE),
    "city_direction_distance": _query("city_direction_distance", hot_place, "south", 12_000.0, measure=SPHERE),
    "show_division": _query("show_division", hot_place),
    "proximity_spheroid": _query("proximity", hot_place, *PARKING, 5000.0),
    "proximity_swapped_axes": _query("proximity", hot_place, *PARKING, 5000.0, measure=S.Measure(axis="swapped")),
}

# Oracle SQL

HOT = """(SELECT d.name FROM (SELECT division_id, count(*) AS c FROM infrastructures WHERE division_id IS NOT NULL GROUP BY 1) i
  JOIN (SELECT id, min(name) AS name FROM divisions WHERE name IS NOT NULL AND geometry IS NOT NULL GROUP BY id) d ON d.id = i.division_id ORDER BY c DESC, d.id LIMIT 1)"""
_IS_LINE = "substr(hex(geometry), 1, 10) IN ('0102000000', '0000000002')"
RIVER = f"""(SELECT name FROM water WHERE class IN ('river', 'stream', 'canal') AND name IS NOT NULL AND {_IS_LINE} GROUP BY name ORDER BY count(*) DESC, name LIMIT 1)"""
COUNTRY = "(SELECT name FROM division_areas WHERE subtype = 'country' AND name IS NOT NULL ORDER BY id LIMIT 1)"
_COLS = ["names.primary", *(f"names.common['{x}']" for x in SEARCHED)]


def _equals(term: str) -> str:
    return "(" + " OR ".join(f"strip_accents(lower({c})) = (SELECT strip_accents(lower(t)) FROM term)" for c in _COLS) + ")"


def _contains(term: str) -> str:
    return "(" + " OR ".join(f"contains(strip_accents(lower({c})), (SELECT strip_accents(lower(t)) FROM term))" for c in _COLS) + ")"


def _metres(x0: str, y0: str, x1: str, y1: str) -> str:
    return (
        f"2 * 6371008.8 * asin(sqrt(least(1, sin(radians({y1} - {y0}) / 2) ** 2 + cos(radians({y0})) * cos(radians({y1})) * sin(radians({x1} - {x0}) / 2) ** 2)))"
    )


def _edges(name: str, vertices: str) -> str:
    return (
        f"{name} AS (SELECT a.id, a.kind, a.part, a.path, a.i, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1 FROM {vertices} a "
        f"JOIN {vertices} b ON a.id = b.id AND a.path = b.path AND b.i = a.i + 1)"
    )


def _rings(name: str, vertices: str, edges: str) -> str:
    """Signed area and moments per ring, the outer ring of a part positive and the others negative."""
    return f"""{name} AS (SELECT id, part, path, abs(a) * w AS a, sign(a) * w * (mx + a * ox) AS mx, sign(a) * w * (my + a * oy) AS my FROM (
  SELECT e.id, e.part, e.path, any_value(o.x) AS ox, any_value(o.y) AS oy, sum(c) / 2 AS a, sum((e.x0 + e.x1 - 2 * o.x) * c) / 6 AS mx, sum((e.y0 + e.y1 - 2 * o.y) * c) / 6 AS my,
    CASE WHEN e.path = any_value(f.p) THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS w
  FROM {edges} e JOIN {vertices} o ON o.id = e.id AND o.path = e.path AND o.i = 0
    JOIN (SELECT id, part, min(path) AS p FROM {vertices} GROUP BY id, part) f ON f.id = e.id AND f.part = e.part,
    LATERAL (SELECT (e.x0 - o.x) * (e.y1 - o.y) - (e.x1 - o.x) * (e.y0 - o.y) AS c) k
  WHERE e.kind IN (3, 6) GROUP BY e.id, e.part, e.path))"""


def _centroids(name: str, vertices: str, edges: str, rings: str) -> str:
    return f"""{name} AS (SELECT id, avg(x) AS x, avg(y) AS y FROM {vertices} WHERE kind IN (1, 4) GROUP BY id
  UNION ALL SELECT id, sum((x0 + x1) / 2 * l) / sum(l), sum((y0 + y1) / 2 * l) / sum(l) FROM (SELECT *, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS l FROM {edges} WHERE kind IN (2, 5)) GROUP BY id
  UNION ALL SELECT id, sum(mx) / sum(a), sum(my) / sum(a) FROM {rings} GROUP BY id)"""


_FEATURES = f"""f AS (SELECT id, any_value(geometry) AS geometry FROM infrastructures WHERE subtype = '{PARKING[0]}' AND class = '{PARKING[1]}' AND geometry IS NOT NULL GROUP BY id),
{paths_cte('fv', 'f')}, {_edges('fe', 'fv')}, {_rings('fr', 'fv', 'fe')}, {_centroids('c', 'fv', 'fe', 'fr')}"""
_PLACES = f"""f AS (SELECT id, any_value(geometry) AS geometry FROM places WHERE geometry IS NOT NULL AND list_contains(taxonomy.hierarchy, '{CATEGORY}') GROUP BY id),
{points_cte('c0', 'f')}, c AS (SELECT id, lon AS x, lat AS y FROM c0), fv AS (SELECT id, 1 AS kind, 0 AS part, 0 AS path, 0 AS i, x, y FROM c),
fe AS (SELECT id, kind, part, path, i, x AS x0, y AS y0, x AS x1, y AS y1 FROM fv WHERE FALSE)"""
_OUT_E = f"""SELECT r.id, r.names.primary AS name, hex(r.geometry) AS geometry FROM infrastructures r JOIN hit ON hit.id = r.id WHERE subtype = '{PARKING[0]}' AND class = '{PARKING[1]}'"""
_OUT_P = f"""SELECT r.id, r.names.primary AS name, hex(r.geometry) AS geometry FROM places r JOIN hit ON hit.id = r.id
WHERE list_contains(taxonomy.hierarchy, '{CATEGORY}') AND len(list_intersect(taxonomy.hierarchy, ['restaurant', 'lodging', 'school', 'hospital', 'shopping_mall', 'grocery_store'])) > 0"""
_REF_POINTS = f"""rd AS (SELECT row_number() OVER () AS id, geometry FROM divisions WHERE {_equals('t')}), {points_cte('rp', 'rd')}"""
_REF_AREAS = f"""ra AS (SELECT row_number() OVER () AS id, geometry FROM division_areas WHERE {_equals('t')} AND geometry IS NOT NULL),
{paths_cte('rv', 'ra')}, {_edges('re', 'rv')}"""
_WITHIN = """fb AS (SELECT id, min(x) AS xa, max(x) AS xb, min(y) AS ya, max(y) AS yb FROM fv GROUP BY id),
rb AS (SELECT id, min(x) AS xa, max(x) AS xb, min(y) AS ya, max(y) AS yb FROM rv GROUP BY id),
cand AS (SELECT fb.id, rb.id AS rid FROM fb JOIN rb ON fb.xa >= rb.xa AND fb.xb <= rb.xb AND fb.ya >= rb.ya AND fb.yb <= rb.yb),
vin AS (SELECT v.id, cand.rid, v.path, v.i,
    sum(CASE WHEN (y0 > v.y) <> (y1 > v.y) AND v.x < (x1 - x0) * (v.y - y0) / (y1 - y0) + x0 THEN 1 ELSE 0 END) % 2 = 1 AS inn,
    min(CASE WHEN v.x BETWEEN least(x0, x1) - 1e-9 AND greatest(x0, x1) + 1e-9 AND v.y BETWEEN least(y0, y1) - 1e-9 AND greatest(y0, y1) + 1e-9
      THEN abs((x1 - x0) * (v.y - y0) - (y1 - y0) * (v.x - x0)) / greatest(sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2), 1e-300) ELSE 1 END) <= 1e-9 AS onn
  FROM cand JOIN fv v ON v.id = cand.id JOIN re ON re.id = cand.rid GROUP BY ALL),
cut AS (SELECT DISTINCT cand.id, cand.rid FROM cand JOIN fe a ON a.id = cand.id JOIN re b ON b.id = cand.rid,
  LATERAL (SELECT (a.x1 - a.x0) * (b.y0 - a.y0) - (a.y1 - a.y0) * (b.x0 - a.x0) AS p, (a.x1 - a.x0) * (b.y1 - a.y0) - (a.y1 - a.y0) * (b.x1 - a.x0) AS q,
    (b.x1 - b.x0) * (a.y0 - b.y0) - (b.y1 - b.y0) * (a.x0 - b.x0) AS r, (b.x1 - b.x0) * (a.y1 - b.y0) - (b.y1 - b.y0) * (a.x1 - b.x0) AS t) k WHERE p * q < 0 AND r * t < 0),
inside AS (SELECT id, rid FROM vin GROUP BY id, rid HAVING bool_and((inn AND NOT onn) OR onn) AND bool_or(inn AND NOT onn)
  EXCEPT SELECT id, rid FROM cut)"""


def _closest(pairs: str) -> str:
    """``q(id, rid, x, y)``: the point of each reference's edges nearest to the feature, over vertices of both."""
    return f"""q1 AS (SELECT p.id, p.rid, e.x0 + t * (e.x1 - e.x0) AS x, e.y0 + t * (e.y1 - e.y0) AS y, sqrt((v.x - e.x0 - t * (e.x1 - e.x0)) ** 2 + (v.y - e.y0 - t * (e.y1 - e.y0)) ** 2) AS d, 0 AS k
  FROM {pairs} p JOIN fv v ON v.id = p.id JOIN re e ON e.id = p.rid,
  LATERAL (SELECT CASE WHEN e.x0 = e.x1 AND e.y0 = e.y1 THEN 0 ELSE greatest(0, least(1, ((v.x - e.x0) * (e.x1 - e.x0) + (v.y - e.y0) * (e.y1 - e.y0)) / ((e.x1 - e.x0) ** 2 + (e.y1 - e.y0) ** 2))) END AS t) l),
q2 AS (SELECT p.id, p.rid, v.x, v.y, sqrt((v.x - e.x0 - t * (e.x1 - e.x0)) ** 2 + (v.y - e.y0 - t * (e.y1 - e.y0)) ** 2) AS d, 1 AS k
  FROM {pairs} p JOIN fe e ON e.id = p.id JOIN rv v ON v.id = p.rid,
  LATERAL (SELECT CASE WHEN e.x0 = e.x1 AND e.y0 = e.y1 THEN 0 ELSE greatest(0, least(1, ((v.x - e.x0) * (e.x1 - e.x0) + (v.y - e.y0) * (e.y1 - e.y0)) / ((e.x1 - e.x0) ** 2 + (e.y1 - e.y0) ** 2))) END AS t) l),
q AS (SELECT id, rid, arg_min(x, (d, k)) AS x, arg_min(y, (d, k)) AS y FROM (SELECT * FROM q1 UNION ALL SELECT * FROM q2) GROUP BY id, rid)"""


def _bearing(x0: str, y0: str, x1: str, y1: str) -> str:
    return f"((degrees(atan2({x1} - {x0}, {y1} - {y0})) + 360) % 360)"


def _sector_sql(x0: str, y0: str, x1: str, y1: str, direction: str) -> str:
    low, high = S.SECTORS[direction]
    b = _bearing(x0, y0, x1, y1)
    test = f"({b} >= {low} OR {b} < {high})" if direction == "north" else f"({b} BETWEEN {low} AND {high})"
    return f"({test} AND NOT ({x0} = {x1} AND {y0} = {y1}))"


def _with(term: str, *parts: str) -> str:
    return "WITH RECURSIVE term AS (SELECT " + term + " AS t),\n" + ",\n".join(parts)


def _point_test(term: str, features: str, out: str, condition: str) -> str:
    return _with(term, features, _REF_POINTS, f"hit AS (SELECT c.id FROM c, rp WHERE {condition})") + "\n" + out


_D = _metres("rp.lon", "rp.lat", "c.x", "c.y")
_LINES = f"""wl AS (SELECT id, any_value(geometry) AS geometry FROM water WHERE class IN ('river', 'stream', 'canal') AND {_IS_LINE} AND {_contains('t')} GROUP BY id),
{paths_cte('lv', 'wl')}, {_edges('le0', 'lv')},
le AS (SELECT *, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS l, coalesce(sum(sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2)) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run,
  sum(sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2)) OVER (PARTITION BY id) AS total FROM le0),
pr AS (SELECT c.id, e.id AS lid, c.x AS cx, c.y AS cy, e.x0 + t * (e.x1 - e.x0) AS qx, e.y0 + t * (e.y1 - e.y0) AS qy, (e.run + t * e.l) / e.total AS f, e.total
  FROM c, le e, LATERAL (SELECT CASE WHEN e.l = 0 THEN 0 ELSE greatest(0, least(1, ((c.x - e.x0) * (e.x1 - e.x0) + (c.y - e.y0) * (e.y1 - e.y0)) / (e.l * e.l))) END AS t) k),
nl AS (SELECT id, arg_min(struct_pack(lid, cx, cy, qx, qy, f, total), (cx - qx) ** 2 + (cy - qy) ** 2) AS s FROM pr GROUP BY id)"""


def _at(name: str, f: str) -> str:
    return f"""{name} AS (SELECT n.id, arg_max(e.x0 + k * (e.x1 - e.x0), e.i) AS x, arg_max(e.y0 + k * (e.y1 - e.y0), e.i) AS y
  FROM nl n JOIN le e ON e.id = n.s.lid AND e.run <= ({f}) * n.s.total, LATERAL (SELECT CASE WHEN e.l = 0 THEN 0 ELSE least(1, (({f}) * n.s.total - e.run) / e.l) END AS k) z GROUP BY n.id)"""


def _city_sql(term: str, direction: str, condition: str) -> str:
    return (
        _with(
            term,
            f"rd AS (SELECT id, geometry FROM divisions WHERE {_equals('t')} ORDER BY population DESC NULLS LAST, id LIMIT 1)",
            points_cte("rp", "rd"),
            "cd AS (SELECT id, any_value(geometry) AS geometry FROM divisions WHERE subtype = 'locality' GROUP BY id)",
            points_cte("c0", "cd"),
            "c AS (SELECT id, lon AS x, lat AS y FROM c0)",
            f"hit AS (SELECT c.id FROM c, rp WHERE {_sector_sql('rp.lon', 'rp.lat', 'c.x', 'c.y', direction)} AND {condition})",
            "da AS (SELECT id, any_value(division_id) AS division_id, any_value(geometry) AS geometry FROM division_areas WHERE is_land AND geometry IS NOT NULL AND division_id IN (SELECT id FROM hit) GROUP BY id)",
            paths_cte("dv", "da"), _edges("de", "dv"), _rings("dr", "dv", "de"),
            "best AS (SELECT division_id, arg_min(geometry, (-a, id)) AS geometry FROM (SELECT da.*, (SELECT sum(a) FROM dr WHERE dr.id = da.id) AS a FROM da) GROUP BY division_id)",
        )
        + "\nSELECT r.id, r.names.primary AS name, hex(coalesce(best.geometry, r.geometry)) AS geometry FROM divisions r JOIN hit ON hit.id = r.id LEFT JOIN best ON best.division_id = r.id WHERE r.subtype = 'locality'"
    )


_SPHERE_AREA = """ar AS (SELECT id, sum(w * a) AS a FROM (SELECT e.id, e.path, CASE WHEN e.path = any_value(f.p) THEN 1 ELSE -1 END AS w,
  abs(sum(radians(x1 - x0) * (2 + sin(radians(y0)) + sin(radians(y1))))) * 6371008.8 ** 2 / 2 AS a
  FROM re e JOIN (SELECT id, part, min(path) AS p FROM rv GROUP BY id, part) f ON f.id = e.id AND f.part = e.part GROUP BY e.id, e.path) GROUP BY id)"""
_D20 = "greatest(200, least(0.2::DOUBLE * {d}, 10000))"

ORACLES = {
    "containment": _with(HOT, _FEATURES, _REF_AREAS, _WITHIN, "hit AS (SELECT id FROM inside)") + "\n" + _OUT_E,
    "proximity": _point_test(HOT, _FEATURES, _OUT_E, f"{_D} <= 5000"),
    "along": _with(RIVER, _FEATURES, _LINES, f"hit AS (SELECT id FROM nl WHERE {_metres('s.cx', 's.cy', 's.qx', 's.qy')} <= 5000)")
    + "\nSELECT f.id, any_value(r.names.primary) AS name, hex(any_value(f.geometry)) AS geometry FROM f JOIN hit ON hit.id = f.id JOIN infrastructures r ON r.id = f.id GROUP BY f.id",
    "center": _with(HOT, _FEATURES, _REF_AREAS, _rings("rr", "rv", "re"), _centroids("rc", "rv", "re", "rr"), _SPHERE_AREA,
                    f"hit AS (SELECT c.id FROM c, rc JOIN ar ON ar.id = rc.id WHERE {_metres('rc.x', 'rc.y', 'c.x', 'c.y')} <= greatest(300, least(5000, 0.15::DOUBLE * sqrt(ar.a))))") + "\n" + _OUT_E,
    "periphery": _with(HOT, _FEATURES, _REF_AREAS, _WITHIN, _closest("inside"), f"hit AS (SELECT q.id FROM q JOIN c ON c.id = q.id WHERE {_metres('q.x', 'q.y', 'c.x', 'c.y')} <= 1500)") + "\n" + _OUT_E,
    "direction": _point_test(HOT, _FEATURES, _OUT_E, f"{_sector_sql('rp.lon', 'rp.lat', 'c.x', 'c.y', 'north')} AND {_D} <= 100000"),
    "direction_distance": _point_test(HOT, _FEATURES, _OUT_E, f"{_sector_sql('rp.lon', 'rp.lat', 'c.x', 'c.y', 'south')} AND {_D} BETWEEN 25000 - {_D20.format(d=25000)} AND 25000 + {_D20.format(d=25000)}"),
    "area_distance": _with(RIVER, _FEATURES, f"ra AS (SELECT id, geometry FROM water WHERE geometry IS NOT NULL AND {_contains('t')} ORDER BY id LIMIT 1)",
                           paths_cte("rv", "ra"), _edges("re", "rv"), "pairs AS (SELECT f.id, ra.id AS rid FROM f, ra)", _closest("pairs"),
                           "vin AS (SELECT v.id, v.path, v.i, any_value(v.x) AS x, any_value(v.y) AS y, sum(CASE WHEN (y0 > v.y) <> (y1 > v.y) AND v.x < (x1 - x0) * (v.y - y0) / (y1 - y0) + x0 THEN 1 ELSE 0 END) % 2 = 1 AS inn FROM fv v, re WHERE re.kind IN (3, 6) GROUP BY ALL)",
                           "own AS (SELECT id, arg_min(x, (path, i)) AS x, arg_min(y, (path, i)) AS y FROM vin WHERE inn GROUP BY id)",
                           f"hit AS (SELECT c.id FROM c JOIN q ON q.id = c.id LEFT JOIN own ON own.id = c.id WHERE {_metres('coalesce(own.x, q.x)', 'coalesce(own.y, q.y)', 'c.x', 'c.y')} <= 20000)") + "\n" + _OUT_E,
    "left_right_bank": _with(RIVER, _FEATURES, _LINES, _at("pa", "greatest(n.s.f - 0.0001::DOUBLE, 0)"), _at("pb", "least(n.s.f + 0.0001::DOUBLE, 1)"), _at("pq", "n.s.f"),
                             f"hit AS (SELECT nl.id FROM nl JOIN pa ON pa.id = nl.id JOIN pb ON pb.id = nl.id JOIN pq ON pq.id = nl.id WHERE {_metres('s.cx', 's.cy', 's.qx', 's.qy')} <= 20000 AND sign((pb.x - pa.x) * (s.cy - pq.y) - (pb.y - pa.y) * (s.cx - pq.x)) = 1)")
    + "\nSELECT f.id, any_value(r.names.primary) AS name, hex(any_value(f.geometry)) AS geometry FROM f JOIN hit ON hit.id = f.id JOIN infrastructures r ON r.id = f.id GROUP BY f.id",
    "places_containment": _with(HOT, _PLACES, _REF_AREAS, _WITHIN, "hit AS (SELECT id FROM inside)") + "\n" + _OUT_P,
    "places_proximity": _point_test(HOT, _PLACES, _OUT_P, f"{_D} <= 5000"),
    "places_direction": _point_test(HOT, _PLACES, _OUT_P, f"{_sector_sql('rp.lon', 'rp.lat', 'c.x', 'c.y', 'south')} AND {_D} <= 100000"),
    "bordering": _with(COUNTRY, f"ra AS (SELECT id, geometry FROM division_areas WHERE {_equals('t')} AND geometry IS NOT NULL ORDER BY (subtype = 'country') DESC, coalesce(is_land, FALSE) DESC, id LIMIT 1)",
                       paths_cte("rv", "ra"), _edges("re", "rv"), "cd AS (SELECT id, any_value(geometry) AS geometry FROM divisions WHERE subtype = 'locality' GROUP BY id)", points_cte("c0", "cd"),
                       "c AS (SELECT id, lon AS x, lat AS y FROM c0)", "fv AS (SELECT id, x, y FROM c)", "fe AS (SELECT id, x AS x0, y AS y0, x AS x1, y AS y1 FROM c WHERE FALSE)", "pairs AS (SELECT c.id, ra.id AS rid FROM c, ra)", _closest("pairs"),
                       f"hit AS (SELECT c.id FROM c JOIN q ON q.id = c.id WHERE {_metres('q.x', 'q.y', 'c.x', 'c.y')} <= 20000)")
    + "\nSELECT r.id, r.names.primary AS name, hex(r.geometry) AS geometry FROM divisions r JOIN hit ON hit.id = r.id WHERE r.subtype = 'locality'",
    "city_direction": _city_sql(HOT, "west", f"{_D} <= 100000"),
    "city_direction_distance": _city_sql(HOT, "south", f"{_D} BETWEEN 12000 - {_D20.format(d=12000)} AND 12000 + {_D20.format(d=12000)}"),
    "show_division": _with(HOT, f"d AS (SELECT id, names.primary AS name, geometry FROM divisions WHERE {_equals('t')} ORDER BY population DESC NULLS LAST, id LIMIT 1)",
                           "da AS (SELECT id, any_value(names.primary) AS name, any_value(geometry) AS geometry FROM division_areas WHERE is_land AND geometry IS NOT NULL AND division_id IN (SELECT id FROM d) GROUP BY id)",
                           paths_cte("dv", "da"), _edges("de", "dv"), _rings("dr", "dv", "de"))
    + "\nSELECT id, name, hex(geometry) AS geometry FROM d UNION ALL (SELECT id, name, hex(geometry) FROM (SELECT da.*, (SELECT sum(a) FROM dr WHERE dr.id = da.id) AS a FROM da) ORDER BY a DESC, id LIMIT 1)",
}
