import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from cartoloom.llm import packing as P
from cartoloom.llm.tokens import encoding, with_tokens

SCHEMA = "doc_id bigint, text string, source string, tokens int, shard string"


def items(rows):
    return pd.DataFrame([(i, s, c, 1, 1, 0, t) for i, (t, c, s) in enumerate(rows)], columns=["doc_id", "source", "cluster", "piece", "n_pieces", "token_start", "tokens"])


def plain_best_fit(rows, capacity, alone):
    """The same rule, searching all containers."""
    many = {c for _, c, _ in rows if sum(c == d for _, d, _ in rows) > 1}
    order = sorted(range(len(rows)), key=lambda i: (not (rows[i][1] in many or rows[i][2] in alone), -rows[i][0], i))
    bins = []
    for i in order:
        t, c, s = rows[i]
        fits = [b for b in bins if b["left"] >= t and not (c in many and c in b["c"]) and not (s in alone and s in b["s"])]
        b = min(fits, key=lambda b: b["left"], default=None)
        if b is None:
            b = {"left": capacity, "c": set(), "s": set(), "i": []}
            bins.append(b)
        b["left"] -= t
        b["c"].add(c)
        b["s"].add(s)
        b["i"].append(i)
    return bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.integers(0, 6), st.sampled_from("ab")), max_size=40))
def test_best_fit_with_conflicts(rows):
    got = P.pack_shard(items(rows), 20, ("a",))
    want = plain_best_fit(rows, 20, {"a"})
    assert sorted(sum(r.tokens for r in b) for b in got) == sorted(20 - b["left"] for b in want)
    for b in got:
        assert sum(r.tokens for r in b) <= 20
        clusters = [r.cluster for r in b]
        assert len(set(clusters)) == len(clusters) and sum(r.source == "a" for r in b) <= 1
    assert sorted(r.doc_id for b in got for r in b) == list(range(len(rows)))


def docs(spark):
    word = "bridge over the quiet river "
    rows = [(i, word * (1 + i % 9), ("s", "t", None)[i % 3], 1, "x") for i in range(300)]
    rows += [(1000 + i, "the same text", "s", 1, "x") for i in range(120)]  # a hot cluster
    rows += [(2000, word * 4000, "s", 1, "x"), (2001, None, "s", 1, "x"), (2002, "", "s", 1, "x"), (None, "lost", "s", 1, "x"), (2003, "x", "t", 1, "x"), (2003, "x", "t", 1, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def test_pack(spark):
    boxes = spark.createDataFrame([("small", 64), ("large", 512), ("broken", 0)], "container string, capacity_tokens int")
    for per_shard in (20_000, 100):
        got = P.pack(docs(spark), boxes, ("t",), items_per_shard=per_shard).toPandas()
        assert set(got["container"]) == {"small", "large"}
        for (kind, _), b in got.sort_values("position").groupby(["container", "container_no"]):
            cap = {"small": 64, "large": 512}[kind]
            assert b["tokens"].sum() <= cap and (b["source"] == "t").sum() <= 1
            assert b["position"].tolist() == list(range(1, len(b) + 1))
            assert b["offset"].tolist() == [0, *b["tokens"].cumsum().tolist()[:-1]]
            assert (b["doc_id"].between(1000, 1119)).sum() <= 1  # copies apart
        n = len(encoding().encode_ordinary("bridge over the quiet river " * 4000))
        for kind, cap in (("small", 64), ("large", 512)):
            long = got[(got["doc_id"] == 2000) & (got["container"] == kind)].sort_values("piece")
            assert long["tokens"].sum() == n and long["token_start"].tolist() == [cap * i for i in range(len(long))] and (long["n_pieces"] == len(long)).all()
            assert sorted(got[(got["container"] == kind) & (got["n_pieces"] == 1)]["doc_id"]) == sorted([*range(300), *range(1000, 1120), 2003, 2003])
    assert {tuple(r) for r in P.oversized(P.pack(docs(spark), boxes)).collect()} == {("small", 2000), ("large", 2000)} | {
        ("small", d) for d in range(300) if len(encoding().encode_ordinary("bridge over the quiet river " * (1 + d % 9))) > 64
    }
    fill = {r["container"]: r["fill_share"] for r in P.fill_report(P.pack(docs(spark), boxes), boxes).collect()}
    assert 0 < fill["small"] <= 1 and 0 < fill["large"] <= 1


def test_tokens_and_empty(spark):
    got = {r["doc_id"]: r["tokens"] for r in with_tokens(docs(spark).select("doc_id", "text").where("doc_id >= 2000"), "text").collect()}
    assert got[2001] == 0 and got[2002] == 0 and got[2003] == 1 and got[2000] > 10_000
    boxes = spark.createDataFrame([("small", 64)], "container string, capacity_tokens int")
    assert P.pack(docs(spark).limit(0), boxes).count() == 0 and P.pack(docs(spark), boxes.limit(0)).count() == 0
