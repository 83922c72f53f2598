import numpy as np

from cartoloom.llm import copies as C


def brute(rows):
    sets = {i: set(C.shingles(t, C._Codes()).tolist()) for i, t in rows if t}
    sets = {i: s for i, s in sets.items() if s}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_clusters_against_brute_force(spark):
    r = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(60)])
    rows = []
    for g in range(25):
        base = list(r.choice(words, int(r.integers(6, 90))))
        for _ in range(int(r.integers(1, 6))):
            own = base.copy()
            for _ in range(int(r.integers(0, 4))):
                own[int(r.integers(0, len(own)))] = str(r.choice(words))
            rows.append((len(rows), "  ".join(own)))
    rows += [(500 + i, "One and the same TEXT for all of them") for i in range(40)] + [(600, "one and the same text for all of them!")]
    rows += [(700, "short"), (701, "Short"), (702, ""), (703, " \n"), (704, "..."), (705, "w1 " * 5000), (706, "w1 " * 6000)]
    got = C.duplicate_clusters(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert len(got) == len({x["doc_id"] for x in got})
    assert {x["doc_id"]: x["cluster"] for x in got} == brute(rows)


def test_empty(spark):
    assert C.duplicate_clusters(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def near_copies(r, words, n, edits):
    base, other = list(r.choice(words, 120)), list(r.choice(words, 120))
    rows = []
    for i in range(n):
        own = (base if i % 8 else other).copy()
        for _ in range(int(r.integers(0, edits + 1))):
            own[int(r.integers(0, len(own)))] = str(r.choice(words))
        rows.append((i, " ".join(own)))
    return base, rows + [(2000 + i, " ".join(r.choice(words, 80))) for i in range(100)]


def test_many_near_copies(spark, monkeypatch):
    """Pairs that are compared stay linear in the rows when a text has many near copies, and no link is lost."""
    r = np.random.default_rng(5)
    _, rows = near_copies(r, np.array([f"v{i}" for i in range(4000)]), 400, 2)
    compared = []
    inner = C._compared
    monkeypatch.setattr(C, "_compared", lambda pairs, sets: compared.append(pairs.count()) or inner(pairs, sets))
    got = C.duplicate_clusters(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert {x["doc_id"]: x["cluster"] for x in got} == brute(rows)
    assert sum(compared) < 4 * len(rows), compared


def test_near_copies_beside_texts_that_share_half(spark):
    """Texts that share half of a copied text are told from it, and copies at the very limit are linked."""
    r = np.random.default_rng(6)
    words = np.array([f"v{i}" for i in range(4000)])
    base, rows = near_copies(r, words, 200, 5)
    rows += [(1000 + i, " ".join(base[:60] + list(r.choice(words, 60)))) for i in range(40)]
    got = C.duplicate_clusters(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert {x["doc_id"]: x["cluster"] for x in got} == brute(rows)
