"""From sampled parameters to validated statements in French and English, and evaluation by running statements.

Every sample is filled in once per language, with the name a user of that language would type, and kept if its statement
finds something.  All statements are answered together (``statements.answers``), not one by one.

Samples are bounded by their quota per template and country, so the driver holds statements and references only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import md5

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cartoloom.functions import text as X
from cartoloom.geo import kernels as K
from cartoloom.geo.wkb import decode
from cartoloom.operators import spatial as S
from cartoloom.plans import dataset as D
from cartoloom.plans import statements as T
from cartoloom.plans.intent import Intent
from cartoloom.plans.intent import parse as parsed
from cartoloom.session import checkpointed
from cartoloom.sources.views import CATEGORIES

PARAMS = {
    "place": "string", "feature": "string", "subtype": "string", "class": "string", "category": "string", "city": "string", "direction": "string", "distance_m": "double",
    "corridor_m": "double", "band_m": "double", "side_sign": "int", "side": "string", "place_country_code": "string",
}
SAMPLE = "template string, country string, " + ", ".join(f"{k} {t}" for k, t in PARAMS.items())
LONGEST_M = 50_000.0  # longer lines are not drawn
DIRECTIONS = ("north", "east", "south", "west")


def view_of(template: Column) -> Column:
    """The view in which a template's reference is named."""
    return F.when(template.isin(*T.AREAS, "bordering"), "division_areas").when(template.isin(*T.LINES, "area_distance"), "water").otherwise("divisions")


def conformed(samples: DataFrame) -> DataFrame:
    """A table of samples with all parameter columns; those it lacks are null, fixed distances are filled in."""
    fixed = {"distance_m": F.when(F.col("template").isin("proximity", "places_proximity", "area_distance"), 5000.0)}
    cols = [F.coalesce(F.col(k), fixed[k]) if k in samples.columns and k in fixed else F.col(k) if k in samples.columns else fixed.get(k, F.lit(None)) for k in PARAMS]
    own = samples.select("template", "country", *[c.cast(t).alias(k) for c, (k, t) in zip(cols, PARAMS.items())])
    by_distance = F.col("template").isin("proximity", "places_proximity", "area_distance")
    return own.withColumn("distance_m", F.when(by_distance, F.lit(5000.0)).when(~F.col("template").isin("direction", "places_direction", "city_direction", "show_division"), F.col("distance_m")))


def countries_crossed(water: DataFrame, areas: DataFrame) -> DataFrame:
    """``(id, name, country, is_line)`` of named water and the countries whose land it meets, exactly.

    The countries' shapes are held by every task; there are a few hundred of them, and their size is checked.
    """
    own = areas.where("subtype = 'country' and is_land and country is not null and geometry is not null").select("country", "geometry")
    shapes, size = [], 0
    for r in own.toLocalIterator():
        size += len(r["geometry"])
        if size > T.MAX_BYTES:
            raise ValueError(f"country shapes of more than {T.MAX_BYTES} bytes")
        if (s := decode(bytes(r["geometry"]))) is not None:
            shapes.append((r["country"], s))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, name, raw in zip(*(b.column(k).to_pylist() for k in range(3))):
                s = decode(raw)
                if s is None:
                    continue
                line = s.kind == "LINESTRING"
                if line and K.line_length(s) >= LONGEST_M:
                    continue
                out += [(i, name, c, line) for c in sorted({c for c, a in shapes if K.intersects(s, a)})]
            cols = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.bool_()))], ["id", "name", "country", "is_line"])

    rows = water.where("id is not null and name is not null and geometry is not null").select("id", "name", "geometry")
    return rows.mapInArrow(run, "id string, name string, country string, is_line boolean")


def sampled_by_answers(v: dict, refs: DataFrame, wanted: dict[str, tuple[str, object]], quota: int, measure: S.Measure) -> DataFrame:
    """Of every country and key of ``wanted`` the first ``quota`` references, in the order of a hash, whose statement finds something.

    ``refs``: ``id, country, name``; ``wanted``: key to a template and a function from a reference to its parameters.  A
    statement without class or category finds features of all kinds; the found feature of smallest hash gives the kind.
    Countries that fall short get further references, twice as many each round, until none is left.
    """
    spark = refs.sparkSession
    refs = checkpointed(refs.dropDuplicates(["country", "id"]))
    asked = {r["country"] for r in refs.where("country is not null").select("country").distinct().collect()}
    short = {k: set(asked) for k in wanted}
    full, rows = Counter(), []
    done, step = 0, quota
    while asked and quota > 0:
        drawn = D.ranked_per_stratum(refs.where(F.col("country").isin(*asked)), "country", "id", done + step).where(F.col("pick") > done)
        drawn = sorted(drawn.select("country", "pick", "id", "name").collect())
        cases = []
        for key, (template, params) in wanted.items():
            for r in drawn:
                if r["country"] in short[key]:
                    intent = Intent(template, params(r))
                    cases.append((key, r["country"], r["pick"], intent, T.written(intent)))
        if cases:
            got, _ = T.answers(v, spark.createDataFrame([(c[4],) for c in cases], "sql string"), measure)
            one = got.groupBy("sql").agg(F.min(F.struct(F.md5(F.concat_ws("|", "id", "sql", F.lit(D.SEED))).alias("h"), "id")).alias("k")).select("sql", "k.id")
            kind = v["infrastructures"].groupBy("id").agg(F.min(F.struct("subtype", "class")).alias("k"))
            city = v["divisions"].groupBy("id").agg(F.min("name").alias("city"))
            known = one.join(kind, "id", "left").join(city, "id", "left").select("sql", "k.subtype", "k.class", "city")
            hit = {r["sql"]: r for r in known.collect()}  # at most one row per statement
            for key, home, _, intent, sql in sorted(cases, key=lambda c: c[:3]):
                if sql in hit and full[key, home] < quota:
                    full[key, home] += 1
                    p = dict(intent.params)
                    if intent.template in ("along", "left_right_bank", "area_distance"):
                        p |= {"subtype": hit[sql]["subtype"], "class": hit[sql]["class"]}
                    if intent.template == "bordering":
                        p |= {"city": hit[sql]["city"], "place_country_code": home}
                    if "side_sign" in p:
                        p["side"] = "left" if p["side_sign"] == 1 else "right"
                    rows.append((intent.template, home, *[p.get(k) for k in PARAMS]))
        size = Counter(r["country"] for r in drawn)
        for k in short:
            short[k] = {c for c in short[k] if full[k, c] < quota and size[c] == step}
        asked = set().union(*short.values())
        done, step = done + step, 2 * step
    return spark.createDataFrame(rows, SAMPLE)


def _choice(options: tuple, *keys: str) -> str:
    return options[int(md5("|".join((*keys, D.SEED)).encode()).hexdigest()[:8], 16) % len(options)]


def sample_water(v: dict, quota: int, measure: S.Measure = S.Measure()) -> DataFrame:
    """Parameters of the relations to rivers, streams and canals, and to lakes and reservoirs."""
    flowing = countries_crossed(v["water"].where(F.col("class").isin(*S.LINES)), v["division_areas"]).where("is_line").drop("is_line")
    still = countries_crossed(v["water"].where("class in ('lake', 'reservoir')"), v["division_areas"]).drop("is_line")
    lines = {
        "along": ("along", lambda r: {"feature": r["name"], "corridor_m": 500.0}),
        "left": ("left_right_bank", lambda r: {"feature": r["name"], "distance_m": 3000.0, "side_sign": 1}),
        "right": ("left_right_bank", lambda r: {"feature": r["name"], "distance_m": 3000.0, "side_sign": -1}),
    }
    around = {"area_distance": ("area_distance", lambda r: {"place": r["name"], "distance_m": 5000.0})}
    return sampled_by_answers(v, flowing, lines, quota, measure).unionByName(sampled_by_answers(v, still, around, quota, measure))


def sample_borders(v: dict, quota: int, measure: S.Measure = S.Measure()) -> DataFrame:
    """Parameters of bordering: countries with a town near their border, and that town."""
    refs = v["division_areas"].where("subtype = 'country' and country is not null and name is not null").select("id", "country", "name")
    return sampled_by_answers(v, refs, {"bordering": ("bordering", lambda r: {"place": r["name"], "distance_m": 20_000.0})}, quota, measure)


def sample_places_near(v: dict, quota: int, measure: S.Measure = S.Measure()) -> DataFrame:
    """Parameters of places near a town or in a direction of it; category and direction are drawn with the town."""
    refs = v["divisions"].where("subtype in ('locality', 'neighborhood') and country is not null and name is not null and geometry is not null").select("id", "country", "name")
    wanted = {
        "places_proximity": ("places_proximity", lambda r: {"place": r["name"], "category": _choice(tuple(CATEGORIES), r["id"], "near"), "distance_m": 5000.0}),
        "places_direction": ("places_direction", lambda r: {"place": r["name"], "category": _choice(tuple(CATEGORIES), r["id"], "far"), "direction": _choice(DIRECTIONS, r["id"])}),
    }
    return sampled_by_answers(v, refs, wanted, quota, measure)


def filled(v: dict, samples: DataFrame, local_ratio: float = 0.1) -> DataFrame:
    """Samples (``conformed``) in French and English: ``entity, template, country, lang, params, sql``.

    ``entity`` numbers the distinct samples; a language without a usable name has no row.
    """
    own = samples.distinct().withColumn("name", F.coalesce("feature", "place")).withColumn("view", view_of(F.col("template"))).where("name is not null")
    # bounded by the quotas: one task may number the samples
    own = own.withColumn("entity", F.row_number().over(Window.orderBy("template", "country", *[F.col(k).cast("string") for k in PARAMS])).cast("bigint"))
    names = None
    for view in ("divisions", "division_areas", "water"):
        part = D.resolve_names(own.where(F.col("view") == view), v[view]).withColumn("view", F.lit(view))
        names = part if names is None else names.unionByName(part)
    lang = F.explode(F.array(*[F.struct(F.lit(x).alias("lang"), F.col(f"name_{x}").alias("exonym")) for x in ("fr", "en")]))
    rows = own.join(names, ["view", "name"]).withColumn("l", lang).select("*", "l.lang", "l.exonym")
    rows = rows.withColumn("typed", X.pick_name(F.col("name"), F.col("exonym"), D.chance("entity", "lang") < local_ratio)).where("typed is not null")
    rows = rows.withColumn("place", F.when(F.col("place").isNotNull(), F.col("typed"))).withColumn("feature", F.when(F.col("feature").isNotNull(), F.col("typed")))
    exonym = F.when(F.col("place_country_code").isNotNull(), F.coalesce(F.col("typed") == F.col("exonym"), F.lit(False))).alias("place_is_exonym")
    sql = T.statement(F.col("template"), {k: F.col("class" if k == "klass" else k) for names in T.SIGNATURES.values() for k in names})
    return rows.select("entity", "template", "country", "lang", F.struct(*PARAMS, exonym).alias("params"), sql.alias("sql"))


def validated(v: dict, samples: DataFrame, measure: S.Measure = S.Measure(), local_ratio: float = 0.1) -> DataFrame:
    """The filled samples whose statement finds at least one row."""
    rows = checkpointed(filled(v, samples, local_ratio))
    found, _ = T.answers(v, rows.select("sql"), measure)
    return rows.join(found.select("sql").distinct(), "sql", "left_semi").select("entity", "template", "country", "lang", "params", "sql")


def generated(asked: DataFrame) -> DataFrame:
    """``asked`` (``question``) with the statement ``gen_sql`` that the intent parser gives; null where no phrase fits."""

    @F.pandas_udf(StringType())
    def answer(question: pd.Series) -> pd.Series:
        intents = {q: parsed(q) if q else None for q in question.unique()}
        return pd.Series([None if intents[q] is None else T.written(intents[q]) for q in question], dtype=object)

    return asked.withColumn("gen_sql", answer("question"))


def evaluated_by_running(v: dict, pairs: DataFrame, measure: S.Measure = S.Measure()) -> DataFrame:
    """``(case, n_gold, n_generated, bucket)`` of pairs ``(case, sql, gen_sql)``, both statements run.

    A missing or unreadable generated statement is a ``syntax_error``; a case whose own statement fails or finds
    nothing is skipped.
    """
    pairs = checkpointed(pairs.select(F.col("case").cast("string").alias("case"), "sql", "gen_sql"))
    got, status = T.answers(v, pairs.select("sql").unionByName(pairs.select(F.col("gen_sql").alias("sql"))), measure)
    got = checkpointed(got)
    gold = pairs.join(got, "sql").select("case", "id")
    made = pairs.join(got.withColumnRenamed("sql", "gen_sql"), "gen_sql").select("case", "id")
    cases = pairs.join(status.withColumnRenamed("status", "gold_status"), "sql", "left")
    cases = cases.join(status.select(F.col("sql").alias("gen_sql"), F.col("status").alias("gen_status")), "gen_sql", "left")
    return D.evaluated(gold, made, cases.select("case", "gold_status", F.when(F.col("gen_sql").isNull(), "syntax_error").otherwise(F.col("gen_status")).alias("gen_status")))


def advice(results: DataFrame) -> DataFrame:
    """The most frequent kind of failure, its number, and what it mostly comes from; no row if nothing failed."""
    of = F.create_map(*[F.lit(x) for kv in {
        "syntax_error": "no phrase or statement could be read", "empty": "a name or category was altered", "ok_mismatch": "another relation or category was meant",
        "timeout": "too much was searched",
    }.items() for x in kv])
    n = results.where("bucket not in ('ok_match', 'skipped')").groupBy("bucket").agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), "bucket").limit(1).select("bucket", "n", of[F.col("bucket")].alias("advice"))


def seeded_sample(rows: DataFrame, key: str, n: int, seed: str = D.SEED) -> DataFrame:
    """``n`` rows without replacement, the same for the same seed, whatever the partitioning."""
    return rows.orderBy(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(seed))), key).limit(n)
