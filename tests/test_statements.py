import pytest

from cartoloom.operators import spatial as S
from cartoloom.plans import service
from cartoloom.plans import statements as T
from cartoloom.plans import validated as V
from cartoloom.plans.intent import Intent
from cartoloom.queries import spatial as Q
from cartoloom.sources import jsonl
from cartoloom.sources import views as sources
from cartoloom.sources.views import open_views

DATA = "/root/testdata/sf0.001"
PARKING = {"subtype": "transit", "klass": "parking"}


@pytest.fixture(scope="module")
def views(spark):
    return open_views(spark, DATA, register=True)


def intents(spark):
    place, river, country = Q.hot_place(spark, DATA), Q.long_river(spark, DATA), Q.first_country(spark, DATA)
    return [
        Intent("containment", {"place": place, **PARKING}), Intent("proximity", {"place": place, **PARKING, "distance_m": 5000.0}), Intent("along", {"feature": river, **PARKING, "corridor_m": 500.0}),
        Intent("left_right_bank", {"feature": river, **PARKING, "distance_m": 3000.0, "side_sign": -1}), Intent("direction", {"place": place, **PARKING, "direction": "north"}),
        Intent("places_direction", {"place": place, "category": "restaurant", "direction": "south"}), Intent("bordering", {"place": country, "distance_m": 20000.0}),
        Intent("city_direction", {"place": place, "direction": "north"}), Intent("show_division", {"place": place}), Intent("center", {"place": "Nowhere at all", **PARKING}),
    ]


def test_written_and_read_back():
    for i in (Intent("show_division", {"place": "L'Île d'O''B, x => 'y')"}), Intent("left_right_bank", {"feature": "Po", **PARKING, "distance_m": 2.5, "side_sign": -1})):
        assert T.read(T.written(i)) == i
    for bad in ("DROP TABLE x", "", None, "  insert into t values (1)"):
        with pytest.raises(T.UnsafeQuery):
            T.read(bad)
    for bad in ("SELECT 1", "SELECT id, name, geometry FROM nothing(place => 'x')", "SELECT id, name, geometry FROM along(place => 'x')", "SELECT id, name, geometry FROM show_division(place => 3)",
                "SELECT id, name, geometry FROM show_division()", "SELECT id, name, geometry FROM direction(place => 'a', direction => 'north'"):
        with pytest.raises(T.FailedQuery):
            T.read(bad)


def test_answers_equal_single_runs(spark, views):
    own = [T.written(i) for i in intents(spark)]
    got, status = T.answers(views, spark.createDataFrame([(x,) for x in [*own, own[0], "DROP TABLE x", None]], "sql string"), Q.SPHERE)
    found = {}
    for r in got.collect():
        found.setdefault(r["sql"], []).append(r["id"])
    for sql in own:
        assert sorted(found.get(sql, [])) == sorted({r["id"] for r in T.run_query(views, sql, Q.SPHERE).collect()}), sql
    assert {r["sql"]: r["status"] for r in status.collect()} == {**dict.fromkeys(own), "DROP TABLE x": "syntax_error"}
    assert T.exists(T.run_query(views, own[-2])) and not T.exists(T.run_query(views, own[-1]))


def test_only_queries_run(views):
    assert T.run_query(views, "WITH a AS (SELECT id FROM divisions) SELECT * FROM a LIMIT 1").count() == 1
    for bad in ("INSERT INTO divisions SELECT 1", "DROP TABLE divisions", "CREATE TABLE t AS SELECT 1 AS x", "SET x = 1", "CACHE TABLE divisions"):
        with pytest.raises(T.UnsafeQuery):
            T.run_query(views, bad)
    for bad in ("SELEC 1", "SELECT nothing_here FROM divisions"):
        with pytest.raises(T.FailedQuery):
            T.run_query(views, bad)


def test_validated_and_evaluated(spark, views):
    place = Q.hot_place(spark, DATA)
    samples = V.conformed(spark.createDataFrame(
        [("containment", "FR", place, "transit", "parking"), ("containment", "FR", place, "transit", "parking"), ("containment", "FR", "Nowhere at all", "transit", "parking"), ("center", "FR", None, "a", "b")],
        "template string, country string, place string, subtype string, class string",
    ))
    rows = V.validated(views, samples, Q.SPHERE, 0.0).collect()
    assert {r["lang"] for r in rows} <= {"fr", "en"} and rows and len({r["entity"] for r in rows}) == 1
    assert all(T.exists(T.run_query(views, r["sql"])) for r in rows)
    good = rows[0]["sql"]
    nowhere = T.written(Intent("containment", {"place": "Nowhere at all", **PARKING}))
    other = T.written(Intent("show_division", {"place": place}))
    pairs = spark.createDataFrame([("same", good, good), ("none", good, None), ("broken", good, "SELECT x"), ("empty", good, nowhere), ("other", good, other), ("skip", nowhere, good), ("bad gold", "x", good)], "case string, sql string, gen_sql string")
    out = V.evaluated_by_running(views, pairs, Q.SPHERE)
    want = {"same": "ok_match", "none": "syntax_error", "broken": "syntax_error", "empty": "empty", "other": "ok_mismatch", "skip": "skipped", "bad gold": "skipped"}
    assert {r["case"]: r["bucket"] for r in out.collect()} == want
    worst = V.advice(out).first()
    assert (worst["bucket"], worst["n"]) == ("syntax_error", 2) and V.advice(out.where("bucket = 'ok_match'")).count() == 0


def test_service(spark, views):
    place = Q.hot_place(spark, DATA)
    r = service.respond(views, f"parking areas in {place}", measure=Q.SPHERE)
    assert r.feature_count == len(r.geojson["features"]) == T.run_query(views, r.sql).count() > 0 and set(r.as_dict()) == {"question", "sql", "geojson", "feature_count"}
    assert all("geometry" not in f["properties"] and "id" in f["properties"] for f in r.geojson["features"])

    def broken(question):
        raise OSError("no model")

    for ask, write, status in ((" ", None, 422), ("what is love", None, 422), ("x", lambda q: "DROP TABLE t", 422), ("x", lambda q: "SELECT 1 AS x", 422), ("x", broken, 502)):
        with pytest.raises(service.ServiceError) as e:
            service.respond(views, ask, write)
        assert e.value.status == status
    with pytest.raises(service.ServiceError):
        service.QueryRequest("")
    assert service.health() == {"status": "ok"}


def test_parts_merged_in_order(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "template string, n int")
    jsonl.write_parts(rows, str(tmp_path / "parts"))
    merge = lambda mode: jsonl.merge_parts(spark, str(tmp_path / "parts"), str(tmp_path / "all"), ["c", "a", "none"], mode)
    with pytest.warns(UserWarning, match="none"):
        assert merge("overwrite") == ["none"]
    read = lambda: sorted(r["n"] for r in jsonl.read(spark, str(tmp_path / "all"), "n int").collect())
    assert read() == [2, 3] and merge("cancel") == [] and read() == [2, 3]
    with pytest.warns(UserWarning):
        merge("merge")
    assert read() == [2, 2, 3, 3]
    with pytest.raises(ValueError):
        merge("ask")


def test_ingest_and_partitions(spark, tmp_path):
    raw = spark.read.parquet(f"{DATA}/places.parquet")
    box = (0.0, 40.0, 20.0, 50.0)
    sources.ingest(raw, str(tmp_path / "theme=places" / "type=place"), box)
    got = sources.open_partitioned(spark, str(tmp_path), "place")
    boxed = raw.where("geometry is not null").withColumn("bbox", sources.box_of("geometry"))
    assert got.count() == sources.in_box(boxed, *box).count() > 0 and {"theme", "type", "bbox"} <= set(got.columns)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        sources.open_partitioned(spark, str(tmp_path), "other")


def test_seeded_sample(spark):
    rows = spark.range(500)
    a, b = (sorted(r["id"] for r in V.seeded_sample(x, "id", 50).collect()) for x in (rows, rows.repartition(7)))
    assert a == b and len(set(a)) == 50 and V.seeded_sample(rows, "id", 900).count() == 500 and V.seeded_sample(rows.limit(0), "id", 5).count() == 0
