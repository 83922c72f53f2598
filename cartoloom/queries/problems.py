"""Registered queries of the general data problems: neighbours and regions (p1), heavy keys (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoloom.operators.heavy_keys import heavy_hitters, per_key_summary
from cartoloom.operators.nearby import near_and_inside
from cartoloom.queries.wkb_sql import paths_cte, points_cte
from cartoloom.session import table

NEAR_M = 120.0
HOT_SHARE = 0.08


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, geometry`` of all places and divisions."""
    return table(spark, sf_dir, "places").select("id", "geometry").unionByName(table(spark, sf_dir, "divisions").select("id", "geometry"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = table(spark, sf_dir, "division_areas").where("is_land and subtype <> 'country'").select("id", "geometry")
    return near_and_inside(locations(spark, sf_dir), NEAR_M, areas)


def p1_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every area, land or maritime, of any level, that contains each location."""
    areas = table(spark, sf_dir, "division_areas").select("id", "geometry")
    return near_and_inside(locations(spark, sf_dir), None, areas).select(F.col("id_a").alias("location_id"), F.col("id_b").alias("area_id"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, column in (("infrastructures", "class"), ("divisions", "country")):
        part = heavy_hitters(table(spark, sf_dir, name), column, HOT_SHARE)
        part = part.select(F.lit(f"{name}.{column}").alias("field"), F.col("key").alias("hot_key"))
        out = part if out is None else out.unionByName(part)
    return out


def p5_class_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_key_summary(table(spark, sf_dir, "infrastructures"), "class").withColumnRenamed("key", "class")


def p5_country_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_key_summary(table(spark, sf_dir, "divisions"), "country").withColumnRenamed("key", "country")


QUERIES = {
    "p1_found": p1_found,
    "p1_regions": p1_regions,
    "p5_found": p5_found,
    "p5_class_profile": p5_class_profile,
    "p5_country_profile": p5_country_profile,
}


def _inside_sql(where: str) -> str:
    return f"""loc_src AS (SELECT DISTINCT id, geometry FROM (SELECT id, geometry FROM places UNION ALL SELECT id, geometry FROM divisions)),
{points_cte('loc', 'loc_src')},
area_src AS (SELECT id, any_value(geometry) AS geometry FROM division_areas WHERE {where} GROUP BY id),
{paths_cte('v', 'area_src')},
edge AS (SELECT a.id, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1 FROM v a JOIN v b ON a.id = b.id AND a.path = b.path AND b.i = a.i + 1),
box AS (SELECT id, min(x) AS xa, max(x) AS xb, min(y) AS ya, max(y) AS yb FROM v GROUP BY id),
cand AS (SELECT l.id AS loc, l.lon, l.lat, b.id AS area FROM loc l JOIN box b ON l.lon BETWEEN b.xa AND b.xb AND l.lat BETWEEN b.ya AND b.yb),
inside AS (SELECT loc AS id_a, area AS id_b FROM cand JOIN edge e ON e.id = cand.area GROUP BY loc, area
  HAVING sum(CASE WHEN (y0 > lat) <> (y1 > lat) AND lon < (x1 - x0) * (lat - y0) / (y1 - y0) + x0 THEN 1 ELSE 0 END) % 2 = 1
  AND min(CASE WHEN lon BETWEEN least(x0, x1) - 1e-9 AND greatest(x0, x1) + 1e-9 AND lat BETWEEN least(y0, y1) - 1e-9 AND greatest(y0, y1) + 1e-9
    THEN abs((x1 - x0) * (lat - y0) - (y1 - y0) * (lon - x0)) / greatest(sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2), 1e-300) ELSE 1 END) > 1e-9)"""


_P1 = f"""WITH RECURSIVE {_inside_sql("is_land AND subtype <> 'country'")},
cell AS (SELECT id, lon, lat, CAST(floor(lat / 0.0012) AS BIGINT) AS c FROM loc),
pair AS (SELECT a.id AS ia, b.id AS ib, a.lon AS xa, a.lat AS ya, b.lon AS xb, b.lat AS yb
  FROM (SELECT *, unnest([c - 1, c, c + 1]) AS k FROM cell) a JOIN cell b ON a.k = b.c WHERE a.id < b.id AND abs(a.lon - b.lon) < 0.01)
SELECT DISTINCT 'near' AS rel, ia AS id_a, ib AS id_b FROM pair
WHERE 2 * 6371008.8 * asin(sqrt(least(1, sin(radians(yb - ya) / 2) ** 2 + cos(radians(ya)) * cos(radians(yb)) * sin(radians(xb - xa) / 2) ** 2))) <= {NEAR_M}
UNION ALL SELECT 'inside', id_a, id_b FROM inside"""


def _profile_sql(source: str, key: str) -> str:
    return f"""WITH b AS (SELECT {key} AS key, id, count(*) AS n, min(update_time) AS t0, max(update_time) AS t1 FROM {source} GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY t1 DESC NULLS LAST, id) AS k FROM b)
SELECT key AS "{key}", CAST(sum(n) AS BIGINT) AS n_rows, count(id) AS n_ids, min(t0) AS first_time, max(t1) AS last_time,
  string_agg(CASE WHEN k <= 3 THEN id END, ',' ORDER BY k) AS top_ids FROM r GROUP BY key"""


ORACLES = {
    "p1_found": _P1,
    "p1_regions": f"WITH RECURSIVE {_inside_sql('TRUE')} SELECT id_a AS location_id, id_b AS area_id FROM inside",
    "p5_found": f"""SELECT 'infrastructures.class' AS field, class AS hot_key FROM infrastructures GROUP BY class
HAVING class IS NOT NULL AND count(*) >= {HOT_SHARE} * (SELECT count(*) FROM infrastructures)
UNION ALL SELECT 'divisions.country', country FROM divisions GROUP BY country
HAVING country IS NOT NULL AND count(*) >= {HOT_SHARE} * (SELECT count(*) FROM divisions)""",
    "p5_class_profile": _profile_sql("infrastructures", "class"),
    "p5_country_profile": _profile_sql("divisions", "country"),
}
