import unicodedata

import pytest
from pyspark.sql import functions as F

from cartoloom.functions import text as X
from cartoloom.plans import dataset as D
from cartoloom.plans import phrases as P
from cartoloom.sources import jsonl
from cartoloom.streaming.geofence import windowed_counts

WORDS = ["Séville", "Œuvre", "Straße", "Łódź", "Ångström", "é", "Київ", "ﬂor", "", None, "Άνω"]


def column(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string").orderBy("i").select(f(F.col("s"))).collect()]


def test_folding(spark):
    def off(form, s):
        return None if s is None else "".join(c for c in unicodedata.normalize(form, s) if not unicodedata.combining(c))

    assert column(spark, WORDS, X.strip_accents) == [off("NFD", w) for w in WORDS]
    assert column(spark, WORDS, X.without_accents) == [off("NFKD", w) for w in WORDS]
    assert [X.fold_term(w) for w in WORDS if w] == [w for w in column(spark, WORDS, X.fold) if w]


def test_latin_and_picked_names(spark):
    assert column(spark, ["Łódź", "Київ", "Parіs", "", None, "12", "ａ"], X.is_latin) == [True, False, False, False, False, True, False]
    rows = spark.createDataFrame([("a", "b", True), ("a", "b", False), ("Київ", "Kyiv", True), ("Київ", None, False), ("a", None, False)], "l string, e string, u boolean")
    assert [r[0] for r in rows.select(X.pick_name(F.col("l"), F.col("e"), F.col("u"))).collect()] == ["a", "b", "Kyiv", None, "a"]


def test_distance_text():
    assert [X.distance_text(m, "en") for m in (250.0, 999.6, 1500.0, 2450.0, 2000.0, 0.5, None)] == ["250m", "1000m", "1.5km", "2.5km", "2km", "0m", None]
    assert X.distance_text(12345.6, "fr") == "12,3km"


def test_french_prepositions(spark):
    rows = spark.createDataFrame(
        [("Maroc", "MA", True), ("France", "FR", True), ("Espagne", "ES", True), ("Pays-Bas", "NL", True), ("Orléans", None, None), ("Le Havre", None, None), ("Lyon", None, None), ("Malte", "MT", True), ("España", "ES", False)],
        "p string, c string, x boolean",
    )
    got = rows.select(D.in_french("de", F.col("p"), F.col("c"), F.col("x")), D.in_french("à", F.col("p"), F.col("c"), F.col("x"))).collect()
    assert [r[0] for r in got] == ["du Maroc", "de la France", "de l'Espagne", "des Pays-Bas", "d'Orléans", "du Havre", "de Lyon", "de Malte", "d'España"]
    assert [r[1] for r in got] == ["au Maroc", "à la France", "à l'Espagne", "aux Pays-Bas", "à Orléans", "au Havre", "à Lyon", "à Malte", "à España"]


def asked(spark):
    rows = [(1, "containment", "en", "S1", 1, "q"), (2, "containment", "en", "S1", 2, "q"), (3, "along", "en", "S2", 3, "q"), (4, "containment", "fr", "S3", 4, "à l'été")]
    return spark.createDataFrame(rows, "pos bigint, template string, lang string, sql string, entity bigint, question string")


def test_pairs(spark):
    got = D.deduplicated(asked(spark))
    assert sorted(r["pos"] for r in got.collect()) == [1, 3, 4]
    assert sorted(r["pos"] for r in D.capped(got, 1).collect()) == [1, 3]
    every = D.with_accentless(asked(spark), 1.0).collect()
    assert sorted(r["question"] for r in every) == ["a l'ete", "q", "q", "q", "à l'été"]
    m = D.chat_messages(got, "sys").where("pos = 3").first()["messages"]
    assert [(t["role"], t["content"]) for t in m] == [("system", "sys"), ("user", "q"), ("assistant", "S2")]
    known = D.with_template(got.select("pos", "sql"), asked(spark).where("pos < 3"))
    assert {r["pos"]: r["template"] for r in known.collect()} == {1: "containment", 3: "_unknown", 4: "_unknown"}


def test_split_keeps_groups(spark):
    rows = [(f"t{e % 3}", f"S{e if e % 4 else 0}", e) for e in range(40)] + [("t9", "only", 99), ("t0", None, 100), ("t0", "x", None)]
    v = spark.createDataFrame(rows, "template string, sql string, entity bigint")
    g = {r["entity"]: r["group_entity"] for r in D.sql_groups(v).collect()}
    assert all(g[e] == (0 if e % 4 == 0 else e) for e in range(40))
    got = D.train_validation(v).collect()
    assert len({r["group_entity"] for r in got}) == len(got)
    per = {}
    for r in got:
        per.setdefault(r["template"], []).append(r["split"])
    assert all(p.count("validation") == (max(1, round(len(p) * 0.1)) if len(p) > 1 else 0) for p in per.values())


def test_evaluation(spark):
    ids = lambda rows: spark.createDataFrame(rows, "case string, id string")
    cases = spark.createDataFrame([(c, None, "timeout" if c == "t" else None) for c in "abcdt"], "case string, gold_status string, gen_status string")
    out = D.evaluated(ids([("a", "1"), ("a", "1"), ("b", "1"), ("c", "1"), ("t", "1")]), ids([("a", "1"), ("b", "2"), ("d", "3")]), cases)
    assert {r["case"]: r["bucket"] for r in out.collect()} == {"a": "ok_match", "b": "ok_mismatch", "c": "empty", "d": "skipped", "t": "timeout"}
    v = D.verdict(out).first()
    assert (v["n_cases"], v["n_match"], v["percent"], v["verdict"]) == (4, 1, 25.0, "fail")


def test_phrase_table():
    assert len({(t, lang) for t, lang, _, _ in P.phrases()}) == 32 and len(P.CLASS_LABELS) == 33


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_parts(spark, tmp_path, mode):
    path = str(tmp_path / "parts")
    jsonl.write_parts(asked(spark), path)
    jsonl.write_parts(asked(spark).where("template = 'along'"), path, mode=mode)
    assert jsonl.merged(spark, path).count() == (4 if mode == "overwrite" else 5)
    jsonl.write(asked(spark), str(tmp_path / "j"))
    assert jsonl.read(spark, str(tmp_path / "j"), "pos bigint, question string").where("question like '%été'").count() == 1


def test_stream_equals_table(spark, tmp_path):
    rows = spark.range(200).selectExpr("timestamp_seconds(id * 60) as ts", "concat('e', id % 3) as event_type", "cast(id as double) as value")
    rows.write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("windows").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, windowed_counts(rows).collect()))


def test_groups_of_a_long_chain(spark):
    """Labels travel along a chain of any length; a hub with many statements is one group as well."""
    chain = [(i, f"S{k}") for i in range(200) for k in (i, i + 1)]
    hub = [(1000, f"H{i}") for i in range(50)] + [(1001 + i, f"H{i}") for i in range(50)]
    rows = spark.createDataFrame(chain + hub + [(5000, "alone"), (5001, None), (None, "S1")], "entity bigint, sql string")
    got = {r["entity"]: r["group_entity"] for r in D.sql_groups(rows).collect()}
    assert got == {**dict.fromkeys(range(200), 0), **dict.fromkeys(range(1000, 1051), 1000), 5000: 5000}
