import random

from cartoloom.llm import mixing as M
from cartoloom.llm.tokens import encoding

SCHEMA = "doc_id bigint, text string, source string, repeats int, _u string"
TARGETS = "source string, target_share double, max_repeats int"


def test_water_fill_properties():
    r = random.Random(3)
    for _ in range(300):
        k = r.randint(1, 6)
        w = [r.random() for _ in range(k)]
        spec = {f"s{i}": (w[i] / sum(w), r.randint(0, 4)) for i in range(k)}
        sizes = {f"s{i}": r.choice([0, 10, 1000]) for i in range(k)}
        total = r.choice([0, 50, 900])
        got = M.water_fill(sizes, spec, total)
        cap = {s: sizes[s] * spec[s][1] for s in spec}
        assert all(got[s] <= cap[s] + 1e-6 for s in spec)
        assert abs(sum(got.values()) - min(total, sum(cap.values()))) < 1e-6
        level = [got[s] / spec[s][0] for s in spec if got[s] < cap[s] - 1e-6]
        assert not level or max(level) - min(level) < 1e-6  # open sources share one water level
        assert all(got[s] / spec[s][0] <= level[0] + 1e-6 for s in spec if level)


def docs(spark):
    word = "bridge over the quiet river "
    rows = [(i, word * (1 + i % 5), "big", 1, "x") for i in range(1200)] + [(5000 + i, word * (1 + i % 3), "mid", 1, "x") for i in range(300)]
    rows += [(8000 + i, word, "tiny", 1, "x") for i in range(5)] + rows[:40]
    rows += [(9000, None, "mid", 1, "x"), (9001, "", "mid", 1, "x"), (None, word, "mid", 1, "x"), (9002, word, None, 1, "x"), (9003, word * 50, "other", 1, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def targets(spark):
    return spark.createDataFrame([("big", 0.65, 3), ("mid", 0.15, 3), ("tiny", 0.1, 2), ("none", 0.1, 2)], TARGETS)


def test_mix(spark):
    report = {r["source"]: r for r in M.mix_report(docs(spark), targets(spark)).collect()}
    assert {s for s, r in report.items() if r["below_target"]} == {"tiny", "none"}
    got = M.mix(docs(spark), targets(spark)).collect()
    assert len({r["doc_id"] for r in got}) == len(got)
    size = {r["doc_id"]: r["tokens"] for r in got}
    assert size[0] == len(encoding().encode_ordinary("bridge over the quiet river "))
    for s, r in report.items():
        own = [x for x in got if x["source"] == s]
        drawn = sum(x["tokens"] * x["repeats"] for x in own)
        assert drawn == r["drawn_tokens"] and abs(drawn - r["allotted_tokens"]) <= 60
        assert all(x["repeats"] <= r["max_repeats"] for x in own)
        reps = {x["repeats"] for x in own}
        assert not reps or max(reps) - min(reps) <= 1
    assert sum(x["repeats"] for x in got if x["source"] == "tiny") == 10
    again = {(r["doc_id"], r["repeats"]) for r in M.mix(docs(spark).repartition(7), targets(spark)).collect()}
    assert again == {(r["doc_id"], r["repeats"]) for r in got}
    assert {(r["doc_id"], r["repeats"]) for r in M.mix(docs(spark), targets(spark), seed=5).collect()} != again


def test_empty(spark):
    assert M.mix(docs(spark).limit(0), targets(spark)).count() == 0 and M.mix(docs(spark), targets(spark).limit(0)).count() == 0
    assert {r["drawn_tokens"] for r in M.mix_report(docs(spark).limit(0), targets(spark)).collect()} == {0}
