import random

import pytest

from cartoloom.llm import quota_sample as Q

SCHEMA = "sample_id bigint, template string, rank int, _key string"
TARGETS = "field string, category string, target_share double, min_rows int"


def brute(sizes, targets, seats):
    """The seats with the smallest priorities, one by one."""
    got = {c: min(sizes.get(c, 0), f) for c, (_, f) in targets.items()}
    assert sum(got.values()) <= seats
    while sum(got.values()) < seats:
        open_ = [c for c in targets if got[c] < sizes.get(c, 0) and targets[c][0] > 0]
        if not open_:
            break
        c = min(open_, key=lambda c: ((got[c] + 0.5) / targets[c][0], c))
        got[c] += 1
    return got


def test_seats_are_the_smallest_priorities():
    r = random.Random(1)
    for _ in range(200):
        k = r.randint(1, 7)
        raw = [r.choice([0.0, 1.0, 2.0, r.random()]) for _ in range(k)]
        shares = [x / max(sum(raw), 1e-9) for x in raw]
        sizes = {f"c{i}": r.choice([0, 3, 40, 500]) for i in range(k)}
        targets = {f"c{i}": (shares[i], r.choice([0, 2, 5])) for i in range(k)}
        seats = max(sum(sizes.values()) // 4, sum(min(sizes[c], f) for c, (_, f) in targets.items()))
        assert Q.seats_by_priority(sizes, targets, seats) == brute(sizes, targets, seats)


def test_floors_above_the_sample():
    assert sum(Q.seats_by_priority({"a": 10, "b": 10}, {"a": (0.5, 6), "b": (0.5, 6)}, 5).values()) == 5


def data(spark):
    rows = [(i, "hot" if i % 3 else "cold", 1, "k") for i in range(3000)] + [(5000 + i, "few", 1, "k") for i in range(6)]
    rows += rows[:50] + [(None, "hot", 1, "k"), (9000, None, 1, "k"), (9001, "other", 1, "k")]
    targets = [("template", "hot", 0.3, 4), ("template", "cold", 0.6, 4), ("template", "few", 0.09, 4), ("template", "gone", 0.01, 2), ("country", "hot", 1.0, 1)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(targets, TARGETS)


@pytest.mark.parametrize("per_bucket", [50_000, 20])
def test_sample(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(Q, "ROWS_PER_BUCKET", per_bucket)
    records, targets = data(spark)
    report = {r["category"]: r for r in Q.quota_report(records, targets, "template").collect()}
    total = 3008
    assert {c: r["available"] for c, r in report.items()} == {"hot": 2000, "cold": 1000, "few": 6, "gone": 0}
    assert {c for c, r in report.items() if not r["met"]} == {"few", "gone"}
    assert sum(r["seats"] for r in report.values()) == total // 4
    got = Q.quota_sample(records, targets, "template").collect()
    assert len({r["sample_id"] for r in got}) == len(got) == total // 4
    for c, r in report.items():
        own = sorted(x["rank"] for x in got if x["category"] == c)
        assert own == list(range(1, r["seats"] + 1))
        assert r["seats"] == 0 or abs(r["reached_share"] - len(own) / len(got)) < 1e-12
    again = Q.quota_sample(records.repartition(7), targets, "template").collect()
    assert {r["sample_id"] for r in again} == {r["sample_id"] for r in got}
    other = Q.quota_sample(records, targets, "template", seed=8).collect()
    assert {r["sample_id"] for r in other} != {r["sample_id"] for r in got}


def test_empty(spark):
    records, targets = data(spark)
    assert Q.quota_sample(records.limit(0), targets, "template").count() == 0
    assert [r["available"] for r in Q.quota_report(records.limit(0), targets, "template").collect()] == [0] * 4
    assert Q.quota_sample(records, targets.limit(0), "template").count() == 0
