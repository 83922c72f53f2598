import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoloom.llm import group_split as G

SCHEMA = "sample_id bigint, template string, sql string, entity bigint, _code string, n int"
SPLITS = "split_name string, share double"


def brute(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("leaf,task", [(1_000_000, 1_000_000), (40, 1_000_000), (25, 30)])
def test_components(spark, leaf, task):
    r = np.random.default_rng(4)
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    loose = [tuple(map(int, x)) for x in r.integers(2000, 2300, (150, 2))]
    links = path + star + loose + loose[:20] + [(7, 7)]
    order = [links[i] for i in r.permutation(len(links))]
    got = G.components(spark.createDataFrame(order, "a bigint, b bigint"), leaf, task)
    want = {k: v for k, v in brute([x for x in links if x[0] != x[1]]).items()}
    assert {x["node"]: x["root"] for x in got.collect()} == want


def data(spark, groups=400):
    r = np.random.default_rng(9)
    rows, k = [], 0
    for g in range(groups):
        size = 120 if g == 0 else int(r.choice([1, 1, 2, 5, 12]))
        for e in range(size):
            for lang in range(2):
                rows.append((k, f"t{int(r.integers(0, 3))}", f"S {g}" if e % 2 == lang else f"  S \t\n{g} ", g * 1000 + e, "x", 1))
                k += 1
    rows += rows[:30]
    rows += [(None, "t0", "S 1", 1000, "x", 1), (90_000, None, None, 777_777, "x", 1), (90_001, "t0", "", 777_778, "x", 1), (90_002, "t0", " \n", 777_779, "x", 1), (90_003, "t1", "S 5", None, "x", 1)]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_groups_and_splits(spark, monkeypatch):
    monkeypatch.setattr(G, "GROUPS_PER_BUCKET", 100)
    records, rows = data(spark)
    groups = {r["entity"]: r["group_entity"] for r in G.entity_groups(records).collect()}
    assert all(groups[e] == e // 1000 * 1000 for e in groups) and len(groups) > 400 and 777_777 not in groups
    targets = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], SPLITS)
    got = G.split_records(records, targets).collect()
    keys = {r[0] for r in rows if r[0] is not None}
    assert sorted(r["sample_id"] for r in got) == sorted(keys)
    per = {}
    for r in got:
        per.setdefault(("r", r["sample_id"]) if r["entity"] is None else r["entity"] // 1000 if r["entity"] < 700_000 else r["entity"], set()).add(r["split_name"])
    assert all(len(s) == 1 for s in per.values())
    n = len(got)
    for name, share in (("train", 0.8), ("validation", 0.1), ("test", 0.1)):
        assert abs(sum(r["split_name"] == name for r in got) / n - share) < 0.03
        for t in ("t0", "t1", "t2"):
            own = [r for r in got if r["template"] == t]
            assert abs(sum(r["split_name"] == name for r in own) / len(own) - share) < 0.06
    again = {r["sample_id"]: r["split_name"] for r in G.split_records(records.repartition(5), targets).collect()}
    assert again == {r["sample_id"]: r["split_name"] for r in got}


def test_hub_is_spread(spark):
    """No task gets much more than its share of a star, and the star is one component."""
    n, limit = 200_000, 20_000
    links = spark.range(1, n + 1).select(F.lit(0).cast("bigint").alias("a"), F.col("id").alias("b"))
    tasks = n // limit
    rows = G.placed(links, tasks, limit).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in rows) == 2 * n and max(r["count"] for r in rows) <= 2 * 2 * limit + 3 * limit
    got = G.components(links, limit, limit).agg(F.count("*").alias("n"), F.max("root").alias("top")).first()
    assert (got["n"], got["top"]) == (n + 1, 0)


def greedy(groups, share):
    """One group after the other to the split furthest below its target."""
    totals, have, out = {}, {}, []
    for c in groups:
        for s, k in c.items():
            totals[s] = totals.get(s, 0) + k
    for c in groups:
        lack = [sum(k * (share[j] - have.get((s, j), 0) / totals[s]) for s, k in c.items()) for j in range(len(share))]
        j = max(range(len(share)), key=lambda i: (round(lack[i], 9), -i))
        out.append(j)
        for s, k in c.items():
            have[s, j] = have.get((s, j), 0) + k
    return have


def test_compositions_are_dealt_like_single_groups():
    share = np.array([0.8, 0.1, 0.1])
    table = [({"a": 9, "b": 2}, 3), ({"a": 7}, 5), ({"b": 3}, 40), ({"a": 2}, 400), ({"a": 1}, 1001), ({"b": 1}, 7)]
    parts = G.assigned(table, share)
    assert [int(p.sum()) for p in parts] == [n for _, n in table]
    have = greedy([c for c, n in table for _ in range(n)], share)
    for s in "ab":
        for j in range(3):
            assert abs(sum(p[j] * c.get(s, 0) for (c, _), p in zip(table, parts)) - have[s, j]) <= 3
    few = G.assigned([({"a": 5}, 1), ({"a": 4}, 1), ({"a": 1}, 1)], share)
    assert sorted(int(np.argmax(p)) for p in few) == [0, 1, 2]


def test_empty(spark):
    records, _ = data(spark, 2)
    targets = spark.createDataFrame([("train", 1.0)], SPLITS)
    assert G.entity_groups(records.limit(0)).count() == 0 and G.split_records(records.limit(0), targets).count() == 0
