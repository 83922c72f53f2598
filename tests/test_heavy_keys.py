import datetime as dt

from cartoloom.operators import heavy_keys as H

SCHEMA = "k string, id string, update_time timestamp, version int, code string, parts int, n int"
T0 = dt.datetime(2025, 1, 1)


def table(spark, rows):
    return spark.createDataFrame([(k, i, None if t is None else T0 + dt.timedelta(hours=t), v, "c", 7, 9) for k, i, t, v in rows], SCHEMA)


def data():
    rows = [("big", f"b{i % 500}", i % 97, i % 3) for i in range(900)]
    rows += [(None, f"n{i}", i, 1) for i in range(300)]
    rows += [(f"s{i % 40}", f"x{i}", i, 1) for i in range(200)]
    return rows + [("", "e1", 5, 1), ("n", "e2", None, 1), ("n", None, 4, 1), ("n", "e2", 9, None)]


def expected(rows, top=3):
    out = {}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        last = {}
        for _, i, t, _ in own:
            if i is not None:
                last[i] = max(last.get(i, -1), -1 if t is None else t)
        times = [r[2] for r in own if r[2] is not None]
        best = sorted(last, key=lambda i: (-last[i], i))[:top]
        out[key] = (len(own), len(last), min(times), max(times), ",".join(best))
    return out


def test_summary_matches_brute_force(spark):
    rows = data()
    got = {}
    for r in H.per_key_summary(table(spark, rows).repartition(5), "k").collect():
        hours = [int((x - T0).total_seconds() // 3600) for x in (r["first_time"], r["last_time"])]
        assert r["key"] not in got
        got[r["key"]] = (r["n_rows"], r["n_ids"], *hours, r["top_ids"])
    assert got == expected(rows)


def test_heavy_hitters(spark):
    t = table(spark, data()).repartition(6)
    assert {(r["key"], r["n"]) for r in H.heavy_hitters(t, "k", 0.08).collect()} == {("big", 900)}
    low = {r["key"] for r in H.heavy_hitters(t, "k", 0.003).collect()}
    assert low == {"big"} | {f"s{i}" for i in range(40)} - {f"s{i}" for i in range(40) if 5 < 0.003 * 1404}
    tie = table(spark, [("a", "1", 1, 1), ("b", "2", 1, 1)])
    assert {r["key"] for r in H.heavy_hitters(tie, "k", 0.5).collect()} == {"a", "b"}


def test_empty(spark):
    assert H.heavy_hitters(table(spark, []), "k").count() == 0
    assert H.per_key_summary(table(spark, []), "k").count() == 0


def test_sketch_never_loses_a_heavy_key():
    counts = {}
    for _ in range(50):
        counts = H._merge(counts, {"hot": 10, **{f"r{i}": 1 for i in range(60)}}, 20)
    assert len(counts) <= 20 and counts["hot"] >= 50 * 10 - 50 * 70 / 20
