"""Statements of the sixteen relations: written from parameters, read back and checked, and answered many at a time.

A statement is ``SELECT id, name, geometry FROM <relation>(name => value, ...)``.  ``answers`` runs a whole set of them
with one scan of the features per relation: the references of all statements are looked up together, and every batch of
features is tested against all of them.  What the driver holds are the statements and their reference shapes, both of
checked size (``MAX_STATEMENTS``, ``MAX_BYTES``); features never pass through it.

Defined results: a text that is no SELECT is refused (``UnsafeQuery``), one that names no known relation or a wrong
parameter fails (``FailedQuery``); in ``answers`` both have the status ``syntax_error``; a statement whose reference
does not exist has no rows; null statements are failed ones.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartoloom.functions.text import fold, fold_term
from cartoloom.geo.wkb import Shape, decode
from cartoloom.operators import spatial as S
from cartoloom.plans.intent import Intent
from cartoloom.sources.views import SEARCH_COLUMNS

MAX_STATEMENTS = 50_000
MAX_BYTES = 256_000_000
#: Parameters of each relation in the order in which they are written.
SIGNATURES = {
    "containment": ("place", "subtype", "klass"), "proximity": ("place", "subtype", "klass", "distance_m"), "along": ("feature", "subtype", "klass", "corridor_m"),
    "center": ("place", "subtype", "klass"), "periphery": ("place", "subtype", "klass", "band_m"), "direction": ("place", "subtype", "klass", "direction"),
    "direction_distance": ("place", "subtype", "klass", "direction", "distance_m"), "area_distance": ("place", "subtype", "klass", "distance_m"),
    "left_right_bank": ("feature", "subtype", "klass", "distance_m", "side_sign"), "places_containment": ("place", "category"),
    "places_proximity": ("place", "category", "distance_m"), "places_direction": ("place", "category", "direction"), "bordering": ("place", "distance_m"),
    "city_direction": ("place", "direction"), "city_direction_distance": ("place", "direction", "distance_m"), "show_division": ("place",),
}
NUMBERS = {"distance_m": float, "corridor_m": float, "band_m": float, "side_sign": int}
AREAS = ("containment", "center", "periphery", "places_containment")
POINTS = ("proximity", "direction", "direction_distance", "places_proximity", "places_direction")
LINES = ("along", "left_right_bank")
CITIES = ("city_direction", "city_direction_distance")
_CALL = re.compile(r"\s*select\s+id\s*,\s*name\s*,\s*geometry\s+from\s+(\w+)\s*\((.*)\)\s*;?\s*", re.IGNORECASE | re.DOTALL)
_ARGUMENT = re.compile(r"\s*(\w+)\s*=>\s*(?:'((?:[^']|'')*)'|(-?\d+(?:\.\d+)?(?:[eE]-?\d+)?))\s*(,|$)")


class UnsafeQuery(ValueError):
    """The text is no statement that only reads."""


class FailedQuery(ValueError):
    """The statement cannot be understood or run."""


def written(intent: Intent) -> str:
    """The statement of an intent."""
    args = []
    for p in SIGNATURES[intent.template]:
        if intent.params.get(p) is not None:
            x = intent.params[p]
            args.append(f"{p} => {x}" if p in NUMBERS else f"{p} => '" + str(x).replace("'", "''") + "'")
    return f"SELECT id, name, geometry FROM {intent.template}({', '.join(args)})"


def statement(template: Column, params: dict[str, Column]) -> Column:
    """The statements of many rows, by template; parameters that are null are left out."""
    quote = F.lit("'")

    def argument(p: str) -> Column:
        c = params[p]
        text = c.cast("string") if p in NUMBERS else F.concat(quote, F.replace(c, quote, F.lit("''")), quote)
        return F.concat(F.lit(f"{p} => "), text)

    out = F.lit(None).cast("string")
    for t, names in SIGNATURES.items():
        call = F.concat(F.lit(f"SELECT id, name, geometry FROM {t}("), F.concat_ws(", ", *[argument(p) for p in names if p in params]), F.lit(")"))
        out = F.when(template == t, call).otherwise(out)
    return out


def read(sql: str | None) -> Intent:
    """The intent of a statement."""
    if not sql or sql.split(None, 1)[0].lower() not in ("select", "with"):
        raise UnsafeQuery("only SELECT statements are run")
    m = _CALL.fullmatch(sql)
    if not m or m.group(1).lower() not in SIGNATURES:
        raise FailedQuery(f"no known relation: {sql[:200]}")
    template, rest, at, params = m.group(1).lower(), m.group(2).rstrip(), 0, {}
    while at < len(rest):
        a = _ARGUMENT.match(rest, at)
        if not a or a.group(1) not in SIGNATURES[template] or a.group(1) in params or (a.group(3) is None) == (a.group(1) in NUMBERS):
            raise FailedQuery(f"wrong parameter: {rest[at : at + 100]}")
        params[a.group(1)] = NUMBERS[a.group(1)](float(a.group(3))) if a.group(1) in NUMBERS else a.group(2).replace("''", "'")
        at = a.end()
    needed = [p for p in SIGNATURES[template] if p not in ("subtype", "klass", "category", "distance_m", "corridor_m", "band_m", "side_sign")]
    if template in ("direction_distance", "city_direction_distance"):
        needed.append("distance_m")
    if any(p not in params for p in needed):
        raise FailedQuery(f"{template} needs {', '.join(needed)}")
    return Intent(template, params)


def only_reads(spark, sql: str) -> None:
    """Raise unless a text of the SQL dialect is a query: its parsed plan may hold no command and no write."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:  # the parser's own error classes live in the JVM
        raise FailedQuery(str(e).split("\n")[0]) from e
    names, todo = [], [plan]
    while todo:
        p = todo.pop()
        names.append(p.getClass().getName().rsplit(".", 1)[-1])
        todo += [p.children().apply(i) for i in range(p.children().size())]
    if any(re.search(r"Command|Insert|Create|Drop|Alter|Set|Delete|Update|Merge|Cache|Truncate|Load|Refresh|Analyze|Replace", n) and n != "SetOperation" for n in names):
        raise UnsafeQuery("only statements that read are run")


def run_query(views: dict[str, DataFrame], sql: str, measure: S.Measure = S.Measure()) -> DataFrame:
    """The rows of a statement: a relation, or any other query over the registered views."""
    m = _CALL.fullmatch(sql or "")
    if m and m.group(1).lower() in SIGNATURES:
        intent = read(sql)
        extra = {} if intent.template in (*AREAS[:1], "places_containment", "show_division") else {"measure": measure}
        try:
            return S.OPERATORS[intent.template](views, **intent.params, **extra)
        except TypeError as e:
            raise FailedQuery(str(e)) from e
    spark = views["divisions"].sparkSession
    only_reads(spark, sql or "")
    try:
        return spark.sql(sql)
    except Exception as e:
        raise FailedQuery(str(e).split("\n")[0]) from e


def exists(rows: DataFrame) -> bool:
    """Whether there is any row; stops at the first."""
    return not rows.isEmpty()


def _references(v: dict, template: str, terms: list[str]) -> dict[str, list[tuple[str, Shape]]]:
    """Reference shapes (with ids) of the folded names, by the rule of the relation; by id where several count."""
    spark = v["divisions"].sparkSession
    if template in (*LINES, "area_distance"):
        own = v["water"].where(F.col("class").isin(*S.LINES) & S.is_line("geometry")) if template in LINES else v["water"].where("geometry is not null")
        whole = F.concat_ws("\n", *[fold(c) for c in SEARCH_COLUMNS])
        found = own.select("id", "geometry", whole.alias("whole")).withColumn("term", F.explode(F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.col("whole").contains(t))))
        order = ["id"]
    else:
        own = v["division_areas" if template in (*AREAS, "bordering") else "divisions"].where("geometry is not null")
        asked = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term string"))  # at most MAX_STATEMENTS
        found = own.withColumn("term", F.explode(F.array_distinct(F.array(*[fold(c) for c in SEARCH_COLUMNS])))).join(asked, "term")
        order = ["id"]
        if template == "bordering":
            order = [F.coalesce(F.col("subtype") == "country", F.lit(False)).desc(), F.coalesce("is_land", F.lit(False)).desc(), "id"]
        if template in (*CITIES, "show_division"):
            order = [F.desc_nulls_last("population"), "id"]
    if template in ("bordering", "area_distance", "show_division", *CITIES):
        found = found.withColumn("rn", F.row_number().over(Window.partitionBy("term").orderBy(*order))).where("rn = 1")
    out: dict[str, list] = defaultdict(list)
    size = 0
    for r in found.select("term", "id", "geometry").toLocalIterator():
        size += len(r["geometry"])
        if size > MAX_BYTES:
            raise FailedQuery(f"reference shapes of more than {MAX_BYTES} bytes; ask fewer statements at once")
        s = decode(bytes(r["geometry"]))
        if s is not None:
            out[r["term"]].append((r["id"], s))
    return {t: sorted(x, key=lambda y: y[0]) for t, x in out.items()}


def _features(v: dict, template: str, params: list[dict]) -> DataFrame:
    """``id, geometry, kinds`` of the features that any of the parameters asks for."""
    if template.startswith("places_"):
        kinds = sorted({p["category"] for p in params if "category" in p})
        own = v["places"].where(F.arrays_overlap("category_hierarchy", F.array(*[F.lit(k) for k in kinds]))) if all("category" in p for p in params) else v["places"]
        return own.select("id", "geometry", F.coalesce("category_hierarchy", F.array().cast("array<string>")).alias("kinds"))
    if template == "bordering" or template in CITIES:
        return v["divisions"].where("subtype = 'locality'").select("id", "geometry", F.array().cast("array<string>").alias("kinds"))
    kind = F.concat_ws(" ", "subtype", "class")
    own = v["infrastructures"]
    if all("klass" in p for p in params):
        own = own.where(F.col("class").isin(*{p["klass"] for p in params}))
    return own.select("id", "geometry", F.array(kind).alias("kinds"))


def _hits(b: S.Batch, template: str, shapes: list[Shape], p: dict, m: S.Measure) -> np.ndarray:
    if template in LINES:
        rows, _, good = S.line_rows(b, shapes, p.get("corridor_m", 500.0) if template == "along" else p.get("distance_m", 3000.0), m, p.get("side_sign", 1) if template == "left_right_bank" else None)
        return rows[good]
    one = {
        "containment": S.within_rows, "places_containment": S.within_rows,
        "center": lambda b, s: S.center_rows(b, s, m), "periphery": lambda b, s: S.periphery_rows(b, s, p.get("band_m", 500.0), m),
        "bordering": lambda b, s: S.border_rows(b, s, p.get("distance_m", 20_000.0), m),
    }.get(template)
    if one is None and template in ("proximity", "places_proximity", "area_distance"):
        one = lambda b, s: S.near_rows(b, s, p.get("distance_m", 5000.0), m)
    if one is None:
        low, high = S.band(p["distance_m"]) if template.endswith("_distance") else (0.0, S.FAR_M)
        one = lambda b, s: S.sector_rows(b, s, p["direction"], low, high, m)
    return np.unique(np.concatenate([one(b, s) for s in shapes] or [np.zeros(0, dtype=int)]).astype(int))


def answers(v: dict[str, DataFrame], statements: DataFrame, measure: S.Measure = S.Measure()) -> tuple[DataFrame, DataFrame]:
    """``(sql, id)`` of the rows that each distinct statement (column ``sql``) finds, and ``(sql, status)``: null or ``syntax_error``."""
    spark = v["divisions"].sparkSession
    texts = sorted(r["sql"] for r in statements.where("sql is not null").select("sql").distinct().limit(MAX_STATEMENTS + 1).collect())
    if len(texts) > MAX_STATEMENTS:
        raise FailedQuery(f"more than {MAX_STATEMENTS} statements at once")
    by: dict[str, list[tuple[int, dict]]] = defaultdict(list)
    status = []
    for no, sql in enumerate(texts):
        try:
            intent = read(sql)
            by[intent.template].append((no, intent.params))
            status.append((sql, None))
        except (UnsafeQuery, FailedQuery):
            status.append((sql, "syntax_error"))
    out = spark.createDataFrame([], "no int, id string")
    for template, cases in sorted(by.items()):
        term = lambda p: fold_term(p.get("feature") or p.get("place"))
        refs = _references(v, template, sorted({term(p) for _, p in cases}))
        if template == "show_division":
            shown = spark.createDataFrame([(no, refs[term(p)][0][0]) for no, p in cases if term(p) in refs], "no int, id string")
            area = S.largest_land_areas(v["division_areas"].join(shown.select(F.col("id").alias("division_id")), "division_id", "left_semi"))
            out = out.unionByName(shown).unionByName(shown.join(area.select(F.col("division_id").alias("id"), F.col("id").alias("area")), "id").select("no", F.col("area").alias("id")))
            continue
        live = [(no, p, [s for _, s in refs[term(p)]]) for no, p in cases if term(p) in refs]
        if not live:
            continue

        def run(batches: Iterator[pa.RecordBatch], template: str = template, live: list = live) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids, kinds = b.column(0), b.column(2).to_pylist()
                batch = S.Batch(b.column(1).to_pylist())
                of: dict[str, np.ndarray] = {}
                nos, rows = [], []
                for no, p, shapes in live:
                    hit = _hits(batch, template, shapes, p, measure)
                    want = p.get("category") or (f"{p.get('subtype')} {p['klass']}" if "klass" in p else None)
                    if want is not None and len(hit):
                        if want not in of:
                            of[want] = np.asarray([want in k for k in kinds], dtype=bool)
                        hit = hit[of[want][hit]]
                    nos.append(np.full(len(hit), no, np.int32))
                    rows.append(hit)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nos)), ids.take(pa.array(np.concatenate(rows).astype(np.int64)))], ["no", "id"])

        own = _features(v, template, [p for _, p, _ in live]).where("geometry is not null")
        out = out.unionByName(own.mapInArrow(run, "no int, id string"))
    names = F.broadcast(spark.createDataFrame(list(enumerate(texts)), "no int, sql string"))  # at most MAX_STATEMENTS
    return out.distinct().join(names, "no").select("sql", "id"), spark.createDataFrame(status, "sql string, status string")
