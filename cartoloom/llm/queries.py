"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartoloom.llm import group_split, mixing, packing, pii, quota_sample, script_forms
from cartoloom.session import checkpointed, table

NAMED_TABLES = ("divisions", "division_areas", "water")
SAMPLE_FIELDS = ("template", "country")
#: Sources of which a container takes one text at most: scanned pages of one file should not fill a container alone.
ONE_PER_SOURCE = ("archive_scans",)


def named_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, name`` of the three tables with names."""
    out = None
    for name in NAMED_TABLES:
        part = table(spark, sf_dir, name).select("id", "name")
        out = part if out is None else out.unionByName(part)
    return out


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return script_forms.same_looking_pairs(named_records(spark, sf_dir))


def p2_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's name and its consistent form."""
    return script_forms.consistent_names(named_records(spark, sf_dir).distinct()).select("id", "name", "form", "how")


def _per_field(spark: SparkSession, sf_dir: str, run) -> DataFrame:
    records, targets = table(spark, sf_dir, "validated_samples"), table(spark, sf_dir, "sample_targets")
    out = None
    for field in SAMPLE_FIELDS:
        part = run(records, targets, field)
        out = part if out is None else out.unionByName(part)
    return out


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_field(spark, sf_dir, quota_sample.quota_report).where("not met").select("field", "category")


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_field(spark, sf_dir, quota_sample.quota_report)


def p3_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(records: DataFrame, targets: DataFrame, field: str) -> DataFrame:
        return quota_sample.quota_sample(records, targets, field).withColumn("field", F.lit(field))

    return _per_field(spark, sf_dir, run)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = group_split.entity_groups(table(spark, sf_dir, "validated_samples"))
    return groups.where("entity <> group_entity").select("group_entity", "entity")


def p4_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_split.split_records(table(spark, sf_dir, "validated_samples"), table(spark, sf_dir, "split_targets"))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "containers"), ONE_PER_SOURCE)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.oversized(_packed(spark, sf_dir))


def p6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir)


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(_packed(spark, sf_dir), table(spark, sf_dir, "containers"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
    return plan.where("below_target").select("source")


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def p8_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.redact(docs, keep_text=False).select("doc_id", F.size("items").alias("n_items"), "redacted")


def _none(**counts: DataFrame) -> DataFrame:
    """One row with the number of rows of each of these tables of faults."""
    out = None
    for name, rows in counts.items():
        one = rows.agg(F.count("*").alias(name))
        out = one if out is None else out.join(one)  # one row each
    return out


def p4_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups in several splits, records without a split, and splits that a template with three groups or more lacks."""
    records = table(spark, sf_dir, "validated_samples").where("sample_id is not null").select("sample_id").distinct()
    got = checkpointed(p4_split(spark, sf_dir))
    torn = got.where("group_entity is not null").groupBy("group_entity").agg(F.count_distinct("split_name").alias("n")).where("n > 1")
    per = got.groupBy("template").agg(F.count_distinct("group_entity").alias("groups"), F.count_distinct("split_name").alias("splits"))
    return _none(torn_groups=torn, lost_records=records.join(got, "sample_id", "left_anti"), bare_templates=per.where("groups >= 3 and splits < 3"))


def p6_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overfull containers, items that are not where the ones before them end, and documents not packed whole."""
    packed = checkpointed(_packed(spark, sf_dir))
    sizes = table(spark, sf_dir, "containers")
    used = packed.groupBy("container", "container_no").agg(F.sum("tokens").alias("t")).join(F.broadcast(sizes), "container")
    before = F.coalesce(F.sum("tokens").over(Window.partitionBy("container", "container_no").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = packed.groupBy("container", "doc_id", "n_pieces").agg(F.count_distinct("piece").alias("k"), F.max(F.col("token_start") + F.col("tokens")).alias("end"), F.sum("tokens").alias("t"))
    return _none(overfull=used.where("t > capacity_tokens"), misplaced=packed.withColumn("at", before).where("at <> offset"), torn=whole.where("k <> n_pieces or end <> t"))


def p7_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated too often, and sources whose drawn tokens miss the allotted ones by more than their longest text."""
    docs, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")
    drawn = checkpointed(mixing.mix(docs, targets))
    often = drawn.join(F.broadcast(targets), "source").where("repeats > max_repeats")
    longest = drawn.groupBy("source").agg(F.max("tokens").alias("longest"), F.sum(F.col("tokens") * F.col("repeats")).alias("drawn"))
    missed = mixing.mix_plan(docs, targets).join(longest, "source").where("abs(drawn - allotted_tokens) > longest")
    return _none(too_often=often, missed=missed)


def p8_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose items are not where they are said to be, or whose other characters changed."""
    rows = pii.redact(table(spark, sf_dir, "documents").select("doc_id", "text")).where("text is not null")
    moved = F.exists("items", lambda i: F.substring(F.col("text"), i["start"] + 1, i["end"] - i["start"]) != i["found_text"])
    grown = F.aggregate("items", F.lit(0), lambda a, i: a + F.length(i["kind"]) + 2 - (i["end"] - i["start"]))
    return rows.select(F.count_if(moved).alias("moved"), F.count_if(F.length("redacted") != F.length("text") + grown).alias("changed"))


QUERIES = {
    f.__name__: f
    for f in (
        p2_found, p2_forms, p3_found, p3_report, p3_sample, p4_found, p4_split, p6_found, p6_pack, p6_fill, p7_found, p7_mix, p7_report,
        p8_found, p8_redacted, p4_faults, p6_faults, p7_faults, p8_faults,
    )
}


def queries() -> dict:
    return dict(QUERIES)


def _looks_sql(column: str) -> str:
    """SQL for the looks of a name: every letter as the Latin letter of its look, where there is one."""
    one, many = {}, {}
    for o in [*range(0xA0, 0x590), *range(0x2000, 0x2070), 0x205F, 0x212A, 0x212B, 0x3000, *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        c = chr(o)
        if script_forms._IGNORED.match(c) or unicodedata.category(c) == "Cn" or unicodedata.combining(c):
            continue
        d = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", c.translate(script_forms._BEFORE)))
        d = "".join(" " if unicodedata.category(x) == "Zs" else script_forms.SAME_LOOK.get(x, x) for x in d)
        d = unicodedata.normalize("NFC", "".join(script_forms._CLASS[x]["LATIN"] if x in script_forms._CLASS else x for x in d))
        if d != c:
            (one if len(d) == 1 else many)[c] = d
    kept = {c: d for c, d in many.items() if 0xFB00 <= ord(c)}
    ignored = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in script_forms.INVISIBLE)
    out = f"regexp_replace({column}, '[{ignored}]', '', 'g')"
    for c, d in kept.items():
        out = f"replace({out}, '{c}', '{d}')"
    quoted = lambda x: x.replace("'", "''")
    return f"trim(nfc_normalize(translate({out}, '{quoted(''.join(one))}', '{quoted(''.join(one.values()))}')))"


_REQUIRED = """WITH d AS (SELECT sample_id, min(template) AS template, min(country) AS country FROM validated_samples WHERE sample_id IS NOT NULL GROUP BY sample_id),
n AS (SELECT 'template' AS field, template AS category, count(*) AS available FROM d GROUP BY template
  UNION ALL SELECT 'country', country, count(*) FROM d GROUP BY country),
t AS (SELECT s.field, s.category, s.target_share, s.min_rows, coalesce(n.available, 0) AS available,
  greatest(CAST(s.min_rows AS DOUBLE), s.target_share * 0.25::DOUBLE * (SELECT count(*) FROM d)) AS required
  FROM sample_targets s LEFT JOIN n ON n.field = s.field AND n.category = s.category)"""

ORACLES = {
    "p2_found": f"""WITH r AS (SELECT DISTINCT id, name, {_looks_sql('name')} AS look
  FROM (SELECT id, name FROM divisions UNION ALL SELECT id, name FROM division_areas UNION ALL SELECT id, name FROM water) WHERE id IS NOT NULL AND name IS NOT NULL)
SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM r a JOIN r b ON a.look = b.look AND a.name <> b.name AND a.id < b.id""",
    "p3_found": _REQUIRED + " SELECT field, category FROM t WHERE available < required",
    "p3_report": _REQUIRED + """,
r AS (SELECT field, category, target_share, min_rows, unnest(range(1, available + 1)) AS r FROM t),
p AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY CASE WHEN r <= min_rows THEN 0 ELSE (r - 0.5::DOUBLE) / target_share END, category, r) AS n FROM r),
s AS (SELECT field, category, count(*) AS seats FROM p WHERE n <= floor(0.25::DOUBLE * (SELECT count(*) FROM d)) GROUP BY field, category),
w AS (SELECT field, sum(seats) AS w FROM s GROUP BY field)
SELECT t.field, t.category, t.target_share, t.min_rows, t.available, CAST(coalesce(seats, 0) AS BIGINT) AS seats, coalesce(seats, 0)::DOUBLE / w.w::DOUBLE AS reached_share, required,
  NOT (coalesce(seats, 0) < required AND available < required) AS met
FROM t LEFT JOIN s ON s.field = t.field AND s.category = t.category JOIN w ON w.field = t.field""",
    "p4_faults": "SELECT 0::BIGINT AS torn_groups, 0::BIGINT AS lost_records, 0::BIGINT AS bare_templates",
    "p6_faults": "SELECT 0::BIGINT AS overfull, 0::BIGINT AS misplaced, 0::BIGINT AS torn",
    "p7_faults": "SELECT 0::BIGINT AS too_often, 0::BIGINT AS missed",
    "p8_faults": "SELECT 0::BIGINT AS moved, 0::BIGINT AS changed",
    "p4_found": r"""WITH RECURSIVE d AS (SELECT DISTINCT entity, trim(regexp_replace(sql, '\s+', ' ', 'g')) AS k FROM validated_samples),
m AS (SELECT k, min(entity) AS a FROM d GROUP BY k HAVING count(*) > 1),
star AS (SELECT d.entity AS b, m.a FROM d JOIN m USING (k) WHERE d.entity <> m.a),
e AS (SELECT a, b FROM star UNION SELECT b, a FROM star),
r(x, y) AS (SELECT a, b FROM e UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a)
SELECT min(y) AS group_entity, x AS entity FROM r GROUP BY x HAVING min(y) < x""",
}


def oracles() -> dict[str, str]:
    return dict(ORACLES)
