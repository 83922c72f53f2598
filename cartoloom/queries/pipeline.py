"""Registered queries of views, text functions, geometry measures and the dataset pipeline, with their oracle SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartoloom.functions import text as X
from cartoloom.geo import kernels as K
from cartoloom.geo.wkb import decode
from cartoloom.operators import spatial as S
from cartoloom.plans import dataset as D
from cartoloom.plans import intent as I
from cartoloom.plans import phrases as P
from cartoloom.plans import sampling as G
from cartoloom.plans import validated as V
from cartoloom.queries import spatial as Q
from cartoloom.queries.wkb_sql import paths_cte, points_cte
from cartoloom.sources import geojson, views
from cartoloom.session import checkpointed, table
from cartoloom.streaming.geofence import windowed_counts

CAP = 200
QUOTA = 5
SYSTEM = "Answer the question with one SQL query over the map views."


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in types.items()])


def _view(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = views.open_views(spark, sf_dir)[name]
        v = v.withColumn("geometry", F.hex("geometry"))
        return v.withColumn("category_hierarchy", F.array_join("category_hierarchy", ",")) if name == "places" else v

    return run


def newest_divisions(spark, sf_dir):
    return views.newest(table(spark, sf_dir, "divisions")).select("id", "version", "name", "country", "population")


def folded_names(spark, sf_dir):
    return table(spark, sf_dir, "divisions").where("name is not null").select("name", X.fold("name").alias("folded")).distinct()


def name_equals(spark, sf_dir):
    return S.named(views.open_views(spark, sf_dir)["divisions"], Q.hot_place(spark, sf_dir)).select("id", "name", "country")


def name_contains(spark, sf_dir):
    return S.name_contains(views.open_views(spark, sf_dir)["water"], Q.long_river(spark, sf_dir)[-8:]).select("id", "name", "class")


def class_profile(spark, sf_dir):
    return table(spark, sf_dir, "infrastructures").groupBy("subtype", "class").agg(F.count("*").alias("n"), F.count(F.col("names.primary")).alias("n_named"))


def category_profile(spark, sf_dir):
    return table(spark, sf_dir, "places").groupBy(F.try_element_at("taxonomy.hierarchy", F.lit(1)).alias("category")).agg(F.count("*").alias("n"))


def countries_semi(spark, sf_dir):
    v = views.open_views(spark, sf_dir)
    return D.countries_with_localities(v["division_areas"], v["divisions"])


@F.pandas_udf(_fields(kind=T.StringType(), **{c: T.DoubleType() for c in "x y area length xmin ymin xmax ymax".split()}))
def measured(g: pd.Series) -> pd.DataFrame:
    out = []
    for raw in g:
        s = decode(raw)
        if s is None:
            out.append((None,) * 9)
        else:
            out.append((s.kind, *K.centroid(s), K.planar_area(s), 0.0 if s.kind == "POINT" else K.line_length(s, "sphere"), *s.bbox))
    return pd.DataFrame(out, columns=["kind", "x", "y", "area", "length", "xmin", "ymin", "xmax", "ymax"])


def shape_measures(spark, sf_dir):
    rows = table(spark, sf_dir, "infrastructures").where("id is not null and geometry is not null").groupBy("id").agg(F.min("geometry").alias("geometry"))
    m = rows.select("id", measured("geometry").alias("m")).where("m.kind is not null")
    return m.select(
        "id", "m.kind", F.round("m.x", 7).alias("x"), F.round("m.y", 7).alias("y"), F.round(F.col("m.area") * 1e6, 3).alias("area"), F.round("m.length", 2).alias("length"),
        "m.xmin", "m.ymin", "m.xmax", "m.ymax",
    )


@F.pandas_udf(_fields(metres=T.DoubleType(), bearing=T.DoubleType(), north=T.BooleanType(), south=T.BooleanType()))
def measured_from(lon: pd.Series, lat: pd.Series, g: pd.Series) -> pd.DataFrame:
    from cartoloom.geo.sphere import haversine
    from cartoloom.geo.wkb import points_of

    x, y = points_of(g)
    b = S.azimuth(lon.to_numpy(), lat.to_numpy(), x, y)
    return pd.DataFrame({"metres": haversine(lon, lat, x, y), "bearing": b, "north": S.in_sector(b, "north"), "south": S.in_sector(b, "south")})


def distance_and_bearing(spark, sf_dir):
    """From the division of most infrastructure to every place."""
    name = Q.hot_place(spark, sf_dir)
    s = next(S.blocks(table(spark, sf_dir, "divisions").where(F.col("name") == name).orderBy("id").limit(1)), [None])[0]
    x, y = K.centroid(s) if s else (0.0, 0.0)
    rows = table(spark, sf_dir, "places").where("id is not null and geometry is not null").select("id", "geometry").distinct()
    m = rows.select("id", measured_from(F.lit(x), F.lit(y), "geometry").alias("m"))
    return m.select("id", F.round("m.metres", 2).alias("metres"), F.round("m.bearing", 4).alias("bearing"), "m.north", "m.south")


def format_distance(spark, sf_dir):
    rows = table(spark, sf_dir, "validated_samples").select(F.col("params.distance_m").alias("metres"), "lang").where("metres is not null").distinct()
    return rows.select("metres", "lang", X.format_distance("metres", "lang").alias("text"))


def normalized_sql(spark, sf_dir):
    return table(spark, sf_dir, "validated_samples").select(X.one_line("sql").alias("sql")).groupBy("sql").agg(F.count("*").alias("n"))


def sample_stratified(spark, sf_dir):
    rows = table(spark, sf_dir, "divisions").where("subtype = 'locality' and name is not null").select("id", "name", "country").distinct()
    return D.ranked_per_stratum(rows, "country", "id", QUOTA)


def sample_relations(spark, sf_dir):
    home = table(spark, sf_dir, "divisions").where("country is not null").groupBy("id").agg(F.min("country").alias("country"))
    raw = table(spark, sf_dir, "infrastructures").where("geometry is not null").dropDuplicates(["id"])
    features = raw.join(home.withColumnRenamed("id", "division_id"), "division_id").select("id", "country", "subtype", "class", "geometry")
    return G.sample_relations(table(spark, sf_dir, "divisions").dropDuplicates(["id"]), features, QUOTA)


def sample_inside(spark, sf_dir):
    v = views.open_views(spark, sf_dir)
    return G.sample_inside(v["division_areas"], v["infrastructures"].select("id", "subtype", "class", "geometry"), QUOTA)


def sample_places_inside(spark, sf_dir):
    """The same for places, whose kind is the main category."""
    v = views.open_views(spark, sf_dir)
    p = v["places"].select("id", F.lit("place").alias("subtype"), F.col("category").alias("class"), "geometry")
    return G.sample_inside(v["division_areas"], p, QUOTA).where("template = 'containment'").select(F.lit("places_containment").alias("template"), "country", "place", F.col("class").alias("category"))


def sample_water(spark, sf_dir):
    return V.sample_water(views.open_views(spark, sf_dir), QUOTA, Q.SPHERE)


def sample_borders(spark, sf_dir):
    return V.sample_borders(views.open_views(spark, sf_dir), QUOTA, Q.SPHERE)


def sample_places_near(spark, sf_dir):
    return V.sample_places_near(views.open_views(spark, sf_dir), QUOTA, Q.SPHERE)


def _all_samples(spark, sf_dir):
    out = None
    for run in (sample_relations, sample_inside, sample_places_inside, sample_water, sample_borders, sample_places_near):
        part = V.conformed(run(spark, sf_dir))
        out = part if out is None else out.unionByName(part)
    return out


def validated_pairs(spark, sf_dir):
    """Statements in French and English from the samples of all relations, each run and found to have an answer."""
    v = views.open_views(spark, sf_dir)
    return V.validated(v, _all_samples(spark, sf_dir), Q.SPHERE).select("entity", "template", "country", "lang", "params.place", "params.feature", "sql")


def eval_executed(spark, sf_dir):
    """The validated statements against those that the intent parser makes of their questions, both run."""
    v = views.open_views(spark, sf_dir)
    own = checkpointed(V.validated(v, _all_samples(spark, sf_dir), Q.SPHERE).withColumn("sample_id", F.col("entity") * 2 + (F.col("lang") == "en").cast("int")))
    asked = V.generated(D.questions(own).select("pos", "sql", "question")).select(F.col("pos").alias("case"), "sql", "gen_sql")
    return V.evaluated_by_running(v, asked, Q.SPHERE).groupBy("bucket").agg(F.count("*").alias("n"))


BOX = (-5.0, 36.0, 15.0, 50.0)


def scan_in_box(spark, sf_dir):
    """Water whose stored box meets a fixed one; the comparisons reach the Parquet reader."""
    return views.in_box(table(spark, sf_dir, "water"), *BOX).select("id", "name", "class")


def grown_boxes(spark, sf_dir):
    """Boxes grown by 5 km: by degrees of latitude, and by degrees of longitude at their own middle."""
    lat = F.lit(5000.0 / 111320.0)
    lon = lat / F.cos(F.radians((F.col("bbox.ymin") + F.col("bbox.ymax")) / 2))
    rows = table(spark, sf_dir, "water").where("bbox is not null")
    return rows.select("id", F.round(F.col("bbox.xmin") - lon, 6).alias("xmin"), F.round(F.col("bbox.xmax") + lon, 6).alias("xmax"), F.round(F.col("bbox.ymin") - lat, 6).alias("ymin"), F.round(F.col("bbox.ymax") + lat, 6).alias("ymax"))


def line_positions(spark, sf_dir):
    """Of every parking against its nearest line of the longest river: planar distance, fraction of the line, side."""
    v = views.open_views(spark, sf_dir)
    lines = [s for b in S.blocks(S._lines(v, Q.long_river(spark, sf_dir)).dropDuplicates(["id"]).orderBy("id")) for s in b]

    @F.pandas_udf(_fields(d=T.DoubleType(), f=T.DoubleType(), side=T.IntegerType()))
    def place(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        import numpy as np

        segs = [K.segments_of(s) for s in lines]
        x, y = x.to_numpy(), y.to_numpy()
        d = np.array([K.nearest(s, x, y)[0] for s in segs]) if segs else np.zeros((0, len(x)))
        out = pd.DataFrame({"d": np.full(len(x), np.nan), "f": np.nan, "side": 0})
        if len(segs):
            k = np.round(d, 9).argmin(axis=0)  # lines that meet are equally near: the first by id
            for j in np.unique(k):
                m = k == j
                out.loc[m, "f"] = K.locate(segs[j], x[m], y[m])
                out.loc[m, "side"] = K.side_of(segs[j], x[m], y[m])
            out["d"] = d.min(axis=0)
        return out

    rows = S.of_class(v["infrastructures"], *Q.PARKING).where("geometry is not null").select("id", "geometry").dropDuplicates(["id"])
    at = rows.select("id", measured("geometry").alias("m")).where("m.kind is not null").select("id", place("m.x", "m.y").alias("p"))
    return at.select("id", F.round("p.d", 8).alias("d"), F.round("p.f", 8).alias("f"), "p.side")


def compound_intersect(spark, sf_dir):
    """Two relations at once: parking near the hot place that also lies inside it."""
    v, place = views.open_views(spark, sf_dir), Q.hot_place(spark, sf_dir)
    near = S.proximity(v, place, *Q.PARKING, 2000.0, measure=Q.SPHERE).select("id")
    return near.intersect(S.containment(v, place, *Q.PARKING).select("id"))


def prepared_query(spark, sf_dir):
    """A parameterised SQL statement over the registered views."""
    views.open_views(spark, sf_dir, register=True)
    return spark.sql("SELECT id, name, class FROM infrastructures WHERE subtype = :subtype AND level IS NOT NULL AND name IS NOT NULL", args={"subtype": "transit"})


def fenced_statements(spark, sf_dir):
    """Statements taken out of fenced answers."""
    rows = table(spark, sf_dir, "validated_samples").select("sample_id", F.when(F.col("sample_id") % 2 == 0, F.concat(F.lit("```sql\n"), X.one_line("sql"), F.lit("\n```"))).otherwise(X.one_line("sql")).alias("answer")).distinct()
    return rows.select("sample_id", X.fenced_sql(F.col("answer")).alias("sql"))


def resolve_names(spark, sf_dir):
    return D.resolve_names(sample_stratified(spark, sf_dir).select("name"), views.open_views(spark, sf_dir)["divisions"])


def pick_name(spark, sf_dir):
    return D.picked_names(resolve_names(spark, sf_dir)).select("name", "lang", "typed")


def _samples(spark, sf_dir):
    own = table(spark, sf_dir, "validated_samples")
    return own.dropDuplicates(["sample_id"])  # records delivered twice are alike


def questions(spark, sf_dir):
    return D.questions(_samples(spark, sf_dir)).select("pos", "template", "lang", "question")


def accentless_variant(spark, sf_dir):
    return D.with_accentless(D.questions(_samples(spark, sf_dir))).select("pos", "lang", "question")


def dedup_pairs(spark, sf_dir):
    return D.deduplicated(D.questions(_samples(spark, sf_dir))).select("pos", "template", "question")


def cap_per_template(spark, sf_dir):
    return D.capped(D.deduplicated(D.questions(_samples(spark, sf_dir))), CAP).select("pos", "template")


def split_components(spark, sf_dir):
    return D.sql_groups(table(spark, sf_dir, "validated_samples"))


def split_stratified(spark, sf_dir):
    return D.train_validation(table(spark, sf_dir, "validated_samples"))


def unknown_bucket(spark, sf_dir):
    own = _samples(spark, sf_dir)
    pairs = own.select("sample_id", "sql")
    return D.with_template(pairs, own.where("lang = 'en'")).select("sample_id", "template")


def chat_messages(spark, sf_dir):
    pairs = D.deduplicated(D.questions(_samples(spark, sf_dir)))
    return D.chat_messages(pairs, SYSTEM).select("pos", F.to_json("messages").alias("messages"))


def _evaluated(spark, sf_dir):
    """Places found by any category of their hierarchy (gold) against those whose main category it is."""
    p = views.open_views(spark, sf_dir)["places"]
    gold = p.select(F.explode("category_hierarchy").alias("case"), "id")
    return D.evaluated(gold, p.select(F.col("category").alias("case"), "id"), gold.select("case", F.lit(None).cast("string").alias("gold_status"), F.lit(None).cast("string").alias("gen_status")).distinct())


def eval_buckets(spark, sf_dir):
    return _evaluated(spark, sf_dir)


def eval_verdict(spark, sf_dir):
    return D.verdict(_evaluated(spark, sf_dir))


def geojson_features(spark, sf_dir):
    p = views.open_views(spark, sf_dir)["water"]
    return geojson.features(p.select("id", "name", "class", "geometry"))


@F.pandas_udf(T.StringType())
def parsed_template(q: pd.Series) -> pd.Series:
    got = {x: I.parse(x) for x in q.unique()}
    return pd.Series([got[x] and got[x].template for x in q], dtype=object)


def intent_templates(spark, sf_dir):
    """How often the parser finds the template a question was made from."""
    asked = D.questions(_samples(spark, sf_dir)).select("template", "question").distinct()
    return asked.select("template", parsed_template("question").alias("parsed")).groupBy("template", "parsed").agg(F.count("*").alias("n"))


def windowed_events(spark, sf_dir):
    return windowed_counts(table(spark, sf_dir, "events")).withColumn("total", F.round("total", 3))


_NAMED = ("divisions", "division_areas", "infrastructures", "water", "places")
QUERIES = {f"view_{n}": _view(n) for n in _NAMED} | {
    f.__name__: f
    for f in (
        newest_divisions, folded_names, name_equals, name_contains, class_profile, category_profile, countries_semi, shape_measures, distance_and_bearing,
        format_distance, normalized_sql, sample_stratified, sample_relations, sample_inside, sample_places_inside, sample_water, sample_borders, sample_places_near, validated_pairs, eval_executed, scan_in_box, grown_boxes, line_positions, compound_intersect,
        prepared_query, fenced_statements, resolve_names, pick_name, questions, accentless_variant, dedup_pairs,
        cap_per_template, split_components, split_stratified, unknown_bucket, chat_messages, eval_buckets, eval_verdict, geojson_features, intent_templates,
        windowed_events,
    )
}

# Oracle SQL

_NAMES = "names.primary AS name, " + ", ".join(f"names.common['{x}'] AS name_{x}" for x in views.LANGUAGES)
_HEX = "hex(geometry) AS geometry"
_ALLOWED = ", ".join(f"('{a}', '{b}')" for a, b in views.ALLOWED)
_CATS = "[" + ", ".join(f"'{c}'" for c in views.CATEGORIES) + "]"


def _lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _case(on: str, pairs: list[tuple[str, str]], otherwise: str) -> str:
    return f"CASE {on} " + " ".join(f"WHEN {_lit(a)} THEN {_lit(b)}" for a, b in pairs) + f" ELSE {otherwise} END"


def _questions_sql() -> str:
    """CTEs up to ``q(pos, template, lang, sql, entity, question)``."""
    labels, cats = [(f"{a} {b}", en, fr) for a, b, en, fr in P.CLASS_LABELS], P.CATEGORY_LABELS
    pair = "(subtype || ' ' || class)"
    plain = f"trim(replace({pair}, '_', ' '))"
    category = " ".join(
        f"WHEN lang {'=' if i == 2 else '<>'} 'fr' THEN CASE WHEN category IS NOT NULL THEN {_case('category', [(r[0], r[i]) for r in cats], chr(39).join(['replace(category, ', '_', ', ', ' ', ')']))} ELSE {_case(pair, [(r[0], r[i]) for r in labels], plain)} END"
        for i in (2, 1)
    )
    vowel = "lower(substr(place, 1, 1)) IN (" + ", ".join(_lit(c) for c in P.VOWELS) + ")"
    # written out here once more, for the countries of the test tables and some neighbours, so that the operator's table is checked
    gender = "CASE WHEN code IN ('AL','AT','BE','BG','CH','CZ','DE','EE','ES','FI','FR','GR','HR','HU','IE','IT','LT','LV','NO','PL','RO','RS','SE','SI','SK','TR','UA') THEN 'la' WHEN code IN ('CA','DK','GB','LI','LU','MA','PT') THEN 'le' WHEN code IN ('NL','US') THEN 'les' ELSE '' END"
    art = f"""CASE WHEN code IS NOT NULL AND NOT coalesce(exonym, FALSE) THEN '' WHEN code IS NOT NULL AND {gender} IN ('la', 'le') AND {vowel} THEN 'l'''
  WHEN code IS NOT NULL THEN {gender} WHEN place LIKE 'Le %' THEN 'le' WHEN place LIKE 'Les %' THEN 'les' ELSE '' END"""
    rest = "CASE WHEN code IS NULL AND place LIKE 'Le %' THEN substr(place, 4) WHEN code IS NULL AND place LIKE 'Les %' THEN substr(place, 5) ELSE place END"

    def prep(p: str, one: str, many: str, elide: str) -> str:
        return f"CASE WHEN art = 'le' THEN '{one} ' || rest WHEN art = 'les' THEN '{many} ' || rest WHEN art = 'l''' THEN '{p} l''' || rest WHEN art = 'la' THEN '{p} la ' || rest {elide} ELSE '{p} ' || place END"

    km = "regexp_replace(format('{:.1f}', m / 1000), '\\.0$', '')"
    distance = f"CASE WHEN m >= 1000 THEN (CASE WHEN lang = 'fr' THEN replace({km}, '.', ',') ELSE {km} END) || 'km' ELSE format('{{:.0f}}', m) || 'm' END"
    fields = {
        "category": f"CASE {category} END",
        "a_place": prep("à", "au", "aux", ""),
        "de_place": prep("de", "du", "des", f"WHEN {vowel} THEN 'd''' || place"),
        "place": "CASE WHEN lang <> 'fr' OR code IS NULL THEN place WHEN art = '' THEN rest WHEN art = 'l''' THEN art || rest ELSE art || ' ' || rest END",
        "feature": "feature",
        "distance": distance,
        "direction": f"CASE WHEN lang = 'fr' THEN {_case('direction', list(P.DIRECTIONS_FR.items()), 'NULL')} ELSE direction END",
        "side": f"CASE WHEN lang = 'fr' THEN {_case('side', list(P.SIDES_FR.items()), 'NULL')} ELSE side END",
        "se_trouve": "CASE WHEN code IS NOT NULL AND art = 'les' THEN 'se trouvent' ELSE 'se trouve' END",
    }
    text = "phrase"
    for k in fields:
        text = f"CASE WHEN contains(phrase, '{{{k}}}') THEN replace({text}, '{{{k}}}', f_{k}) ELSE {text} END"
    values = ", ".join(f"({_lit(t)}, {_lit(x)}, {n}, {_lit(p)})" for t, x, n, p in P.phrases())
    return f"""WITH s0 AS (SELECT DISTINCT ON (sample_id) sample_id, template, lang, sql, entity, coalesce(params.place, params.city) AS place, params.feature AS feature, params.subtype AS subtype,
  params.class AS class, params.category AS category, params.direction AS direction, params.distance_m AS m, params.side AS side, params.place_country_code AS code, params.place_is_exonym AS exonym FROM validated_samples),
s1 AS (SELECT *, {art} AS art, {rest} AS rest FROM s0),
s2 AS (SELECT sample_id, template, lang, sql, entity, {', '.join(f'{v} AS f_{k}' for k, v in fields.items())} FROM s1),
ph(template, lang, phrase_no, phrase) AS (VALUES {values}),
q AS (SELECT sample_id * 100 + phrase_no AS pos, s2.template, s2.lang, sql, entity, {text} AS question FROM s2 JOIN ph ON ph.template = s2.template AND ph.lang = s2.lang WHERE {text} IS NOT NULL),
dd AS (SELECT min(pos) AS pos, arg_min(template, pos) AS template, sql, question FROM q GROUP BY question, sql)"""


_Q = _questions_sql()
_LATIN = lambda c: f"(length({c}) > 0 AND NOT regexp_matches(regexp_replace({c}, '\\p{{Latin}}', '', 'g'), '\\p{{L}}') AND NOT regexp_matches({c}, '[{X.NOT_LATIN}]'))"
_CHANCE = lambda *k: f"(CAST('0x' || substr(md5(concat_ws('|', {', '.join(k)}, '42')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"
_STRATIFIED = f"""SELECT id, name, country, CAST(pick AS INT) AS pick FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY md5(id || '|42'), id) AS pick
FROM (SELECT DISTINCT id, name, country FROM divisions WHERE subtype = 'locality' AND name IS NOT NULL AND country IS NOT NULL)) WHERE pick <= {QUOTA}"""
_RESOLVED = f"""n AS (SELECT names.primary AS name, min(names.common['fr']) AS name_fr, min(names.common['en']) AS name_en FROM divisions
  WHERE names.primary IN (SELECT name FROM ({_STRATIFIED})) GROUP BY 1)"""
_GROUPS = """star AS (SELECT DISTINCT v.entity AS b, m.a FROM validated_samples v JOIN (SELECT sql, min(entity) AS a FROM validated_samples GROUP BY sql HAVING min(entity) < max(entity)) m USING (sql) WHERE v.entity <> m.a),
e AS (SELECT a, b FROM star UNION SELECT b, a FROM star),
r(x, y) AS (SELECT a, b FROM e UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a),
g AS (SELECT v.entity, coalesce((SELECT min(y) FROM r WHERE r.x = v.entity), v.entity) AS group_entity FROM (SELECT DISTINCT entity FROM validated_samples WHERE entity IS NOT NULL) v)"""
_EVAL = f"""p AS (SELECT id, taxonomy.primary AS category, taxonomy.hierarchy AS h FROM places WHERE len(list_intersect(taxonomy.hierarchy, {_CATS})) > 0),
gold AS (SELECT DISTINCT unnest(h) AS "case", id FROM p), gen AS (SELECT DISTINCT category AS "case", id FROM p),
b AS (SELECT c."case", (SELECT count(*) FROM gold WHERE gold."case" = c."case") AS n_gold, (SELECT count(*) FROM gen WHERE gen."case" = c."case") AS n_generated,
  (SELECT count(*) FROM gold JOIN gen USING ("case", id) WHERE "case" = c."case") AS n_both FROM (SELECT DISTINCT "case" FROM gold) c),
ev AS (SELECT "case", n_gold, n_generated, CASE WHEN n_generated = 0 THEN 'empty' WHEN n_both = n_gold AND n_both = n_generated THEN 'ok_match' ELSE 'ok_mismatch' END AS bucket FROM b)"""

ORACLES = {
    "view_divisions": f"SELECT id, {_NAMES}, country, subtype, class, admin_level, population, {_HEX} FROM divisions",
    "view_division_areas": f"SELECT id, division_id, {_NAMES}, country, subtype, class, is_land, is_territorial, {_HEX} FROM division_areas",
    "view_infrastructures": f"SELECT id, {_NAMES}, subtype, class, level, {_HEX} FROM infrastructures WHERE (subtype, class) IN ({_ALLOWED})",
    "view_water": f"SELECT id, {_NAMES}, subtype, class, is_salt, is_intermittent, {_HEX} FROM water",
    "view_places": f"SELECT id, names.primary AS name, taxonomy.primary AS category, array_to_string(taxonomy.hierarchy, ',') AS category_hierarchy, {_HEX} FROM places WHERE len(list_intersect(taxonomy.hierarchy, {_CATS})) > 0",
    "newest_divisions": "SELECT id, version, name, country, population FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC NULLS LAST, update_time DESC NULLS LAST, loaded_at DESC NULLS LAST) AS n FROM divisions) WHERE n = 1",
    "folded_names": "SELECT DISTINCT name, strip_accents(lower(name)) AS folded FROM divisions WHERE name IS NOT NULL",
    "name_equals": f"WITH term AS (SELECT {Q.HOT} AS t) SELECT id, names.primary AS name, country FROM divisions WHERE {Q._equals('t')}",
    "name_contains": f"WITH term AS (SELECT right({Q.RIVER}, 8) AS t) SELECT id, names.primary AS name, class FROM water WHERE {Q._contains('t')}",
    "class_profile": "SELECT subtype, class, count(*) AS n, count(names.primary) AS n_named FROM infrastructures GROUP BY subtype, class",
    "category_profile": "SELECT taxonomy.hierarchy[1] AS category, count(*) AS n FROM places GROUP BY 1",
    "countries_semi": "SELECT country, min(id) AS id FROM division_areas WHERE subtype = 'country' AND country IN (SELECT country FROM divisions WHERE subtype = 'locality' AND names.primary IS NOT NULL) GROUP BY country",
    "shape_measures": f"""WITH RECURSIVE f AS (SELECT id, min(geometry) AS geometry FROM infrastructures WHERE id IS NOT NULL AND geometry IS NOT NULL GROUP BY id),
{paths_cte('fv', 'f')}, {Q._edges('fe', 'fv')}, {Q._rings('fr', 'fv', 'fe')}, {Q._centroids('c', 'fv', 'fe', 'fr')},
b AS (SELECT id, any_value(kind) AS k, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM fv GROUP BY id),
a AS (SELECT id, sum(a) AS a FROM fr GROUP BY id), l AS (SELECT id, sum({Q._metres('x0', 'y0', 'x1', 'y1')}) AS l FROM fe GROUP BY id)
SELECT b.id, CASE k WHEN 1 THEN 'POINT' WHEN 2 THEN 'LINESTRING' WHEN 3 THEN 'POLYGON' WHEN 4 THEN 'MULTIPOINT' WHEN 5 THEN 'MULTILINESTRING' WHEN 6 THEN 'MULTIPOLYGON' END AS kind,
  round(c.x, 7) AS x, round(c.y, 7) AS y, round(coalesce(a.a, 0) * 1e6, 3) AS area, round(coalesce(l.l, 0), 2) AS length, xmin, ymin, xmax, ymax
FROM b JOIN c USING (id) LEFT JOIN a USING (id) LEFT JOIN l USING (id)""",
    "distance_and_bearing": f"""WITH h AS (SELECT id, geometry FROM divisions WHERE name = {Q.HOT} AND geometry IS NOT NULL ORDER BY id LIMIT 1), {points_cte('rp', 'h')},
pl AS (SELECT DISTINCT id, geometry FROM places WHERE id IS NOT NULL), {points_cte('c', 'pl')}
SELECT c.id, round({Q._metres('rp.lon', 'rp.lat', 'c.lon', 'c.lat')}, 2) AS metres, round({Q._bearing('rp.lon', 'rp.lat', 'c.lon', 'c.lat')}, 4) AS bearing,
  {Q._sector_sql('rp.lon', 'rp.lat', 'c.lon', 'c.lat', 'north')} AS north, {Q._sector_sql('rp.lon', 'rp.lat', 'c.lon', 'c.lat', 'south')} AS south FROM c, rp""",
    "format_distance": r"""SELECT DISTINCT m AS metres, lang, CASE WHEN m >= 1000 THEN (CASE WHEN lang = 'fr' THEN replace(k, '.', ',') ELSE k END) || 'km' ELSE format('{:.0f}', m) || 'm' END AS text
FROM (SELECT params.distance_m AS m, lang, regexp_replace(format('{:.1f}', params.distance_m / 1000), '\.0$', '') AS k FROM validated_samples WHERE params.distance_m IS NOT NULL)""",
    "normalized_sql": r"SELECT trim(regexp_replace(sql, '\s+', ' ', 'g')) AS sql, count(*) AS n FROM validated_samples GROUP BY 1",
    "sample_stratified": _STRATIFIED,
    "scan_in_box": f"SELECT id, name, class FROM water WHERE bbox.xmax >= {BOX[0]} AND bbox.xmin <= {BOX[2]} AND bbox.ymax >= {BOX[1]} AND bbox.ymin <= {BOX[3]}",
    "grown_boxes": """SELECT id, round(bbox.xmin - g, 6) AS xmin, round(bbox.xmax + g, 6) AS xmax, round(bbox.ymin - d, 6) AS ymin, round(bbox.ymax + d, 6) AS ymax
FROM water, LATERAL (SELECT 5000.0::DOUBLE / 111320.0::DOUBLE AS d, 5000.0::DOUBLE / 111320.0::DOUBLE / cos(radians((bbox.ymin + bbox.ymax) / 2)) AS g) k WHERE bbox IS NOT NULL""",
    "line_positions": Q._with(Q.RIVER, Q._FEATURES, Q._LINES.replace("arg_min(struct_pack(lid, cx, cy, qx, qy, f, total), (cx - qx) ** 2 + (cy - qy) ** 2)", "first(struct_pack(lid, cx, cy, qx, qy, f, total) ORDER BY round(sqrt((cx - qx) ** 2 + (cy - qy) ** 2), 9), lid)"), Q._at("pa", "greatest(n.s.f - 0.0001::DOUBLE, 0)"), Q._at("pb", "least(n.s.f + 0.0001::DOUBLE, 1)"), Q._at("pq", "n.s.f"))
    + """
SELECT nl.id, round(sqrt((s.cx - s.qx) ** 2 + (s.cy - s.qy) ** 2), 8) AS d, round(s.f, 8) AS f, CAST(sign((pb.x - pa.x) * (s.cy - pq.y) - (pb.y - pa.y) * (s.cx - pq.x)) AS INT) AS side
FROM nl JOIN pa ON pa.id = nl.id JOIN pb ON pb.id = nl.id JOIN pq ON pq.id = nl.id""",
    "compound_intersect": Q._with(Q.HOT, Q._FEATURES, Q._REF_AREAS, Q._WITHIN, Q._REF_POINTS, f"near AS (SELECT c.id FROM c, rp WHERE {Q._D} <= 2000)") + "\nSELECT id FROM near INTERSECT SELECT id FROM inside",
    "prepared_query": f"SELECT id, names.primary AS name, class FROM infrastructures WHERE (subtype, class) IN ({_ALLOWED}) AND subtype = 'transit' AND level IS NOT NULL AND names.primary IS NOT NULL",
    "fenced_statements": r"SELECT DISTINCT sample_id, trim(regexp_replace(sql, '\s+', ' ', 'g')) AS sql FROM validated_samples",
    "resolve_names": f"WITH {_RESOLVED} SELECT name, name_fr, name_en FROM n",
    "pick_name": f"""WITH {_RESOLVED}, l AS (SELECT name, 'fr' AS lang, name_fr AS exonym FROM n UNION ALL SELECT name, 'en', name_en FROM n),
k AS (SELECT name, lang, CASE WHEN {_LATIN('name')} THEN name END AS a, CASE WHEN {_LATIN('exonym')} THEN exonym END AS b, {_CHANCE('name', 'lang')} < 0.1 AS own FROM l)
SELECT name, lang, CASE WHEN own THEN coalesce(a, b) ELSE coalesce(b, a) END AS typed FROM k""",
    "questions": _Q + " SELECT pos, template, lang, question FROM q",
    "dedup_pairs": _Q + " SELECT pos, template, question FROM dd",
    "accentless_variant": _Q + f""" SELECT pos * 2 AS pos, lang, question FROM q
UNION ALL SELECT pos * 2 + 1, lang, strip_accents(question) FROM q WHERE {_CHANCE('CAST(pos AS VARCHAR)', 'question')} < 0.3 AND strip_accents(question) <> question""",
    "cap_per_template": _Q + f" SELECT pos, template FROM (SELECT *, row_number() OVER (PARTITION BY template ORDER BY pos) AS n FROM dd) WHERE n <= {CAP}",
    "split_components": f"WITH RECURSIVE {_GROUPS} SELECT entity, group_entity FROM g",
    "split_stratified": f"""WITH RECURSIVE {_GROUPS}, gt AS (SELECT group_entity, min(template) AS template FROM g JOIN validated_samples v USING (entity) GROUP BY group_entity),
k AS (SELECT *, row_number() OVER (PARTITION BY template ORDER BY md5(CAST(group_entity AS VARCHAR) || '|42'), group_entity) AS r, count(*) OVER (PARTITION BY template) AS n FROM gt)
SELECT template, group_entity, CASE WHEN n > 1 AND r <= greatest(1, round_even(n * 0.1::DOUBLE, 0)) THEN 'validation' ELSE 'train' END AS split FROM k""",
    "unknown_bucket": """WITH s AS (SELECT DISTINCT ON (sample_id) sample_id, sql, template, lang FROM validated_samples), k AS (SELECT sql, min(template) AS t FROM s WHERE lang = 'en' GROUP BY sql)
SELECT s.sample_id, coalesce(k.t, '_unknown') AS template FROM s LEFT JOIN k ON k.sql = s.sql""",
    "chat_messages": _Q + f""" SELECT pos, CAST(to_json([{{'role': 'system', 'content': {_lit(SYSTEM)}}}, {{'role': 'user', 'content': question}}, {{'role': 'assistant', 'content': sql}}]) AS VARCHAR) AS messages FROM dd""",
    "eval_buckets": f'WITH {_EVAL} SELECT "case", n_gold, n_generated, bucket FROM ev',
    "eval_verdict": f"""WITH {_EVAL}, n AS (SELECT count(*) AS n_cases, count(*) FILTER (bucket = 'ok_match') AS n_match FROM ev)
SELECT n_cases, n_match, round(100.0::DOUBLE * n_match / n_cases, 1) AS percent, CASE WHEN 100.0 * n_match / n_cases >= 80 THEN 'ok' WHEN 100.0 * n_match / n_cases >= 50 THEN 'warn' ELSE 'fail' END AS verdict FROM n""",
    "windowed_events": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY 1, 2",
}
