import itertools

import numpy as np
import pytest

from cartoloom.llm import pii, pii_forms, pii_labels, pii_train
from cartoloom.llm.pii_model import TAGS, Tagger, Vocabulary, tag_rules

ITEMS = {
    "email": ["nora.fenley@example.org", "c.voguleau (at) example.net", "GRAHAM+CARTE@POST.EXAMPLE.COM", "jgimano(at)mail [dot] rimales [dot] invalid"],
    "phone": ["+44 (0)20 7946 0760", "05.36.49.09.14", "(040) 66969-190", "+1-962-555-0130"],
    "id_number": ["QQ 40 80 56 D", "2 94 13 79 412 905 86", "99.995.654-A", "SBSLCP86B20W349I"],
    "address": ["88B Denley Rd", "16 bis, rue de l'Écluse", "Schäferstraße 128a", "Avenida de los Chopos, nº 48"],
    "person": ["Martin Grolworth", "É. Tifanac", "BARDHORN Anneliese", "Trimez, Pilar"],
}
PLAIN = "We followed Mill Lane for 3.5 km and turned north at the weir. Tile 7392/6 was exported twice, see ticket GEO-2023-7392 for the difference. "


def carried(kind, item):
    lead = {"email": "Corrections go to <{}> before Friday. ", "phone": "My number is {}, ask for the map room. ", "id_number": "The applicant's identity number is {}. ",
            "address": "She lives at {} and sees the gauge from her window. ", "person": "I spoke with {} at the town hall. "}
    return lead[kind].format(item)


@pytest.mark.parametrize("kind", ITEMS)
def test_items_are_found_anywhere(kind):
    for item in ITEMS[kind]:
        for before in (0, 1, 2, 5, 40):  # also across the borders of windows
            for shift in (0, 13, 29):
                text = PLAIN[shift:] + PLAIN * before + carried(kind, item) + PLAIN
                got = [(k, text[a:b]) for a, b, k in pii.find_items([text])[0]]
                assert got == [(kind, item)], (item, before, shift, got)


def test_plain_text_has_none():
    decoys = "Handle @carto_nord reported it. Package geo-tools@31.4.1 wrote sheet 07-9230-4. The point sits at 41.3907, 13.6048. Gauge readings: 58 56 70 21. Object 382b504a-6b45. "
    assert pii.find_items([PLAIN * 20 + decoys + PLAIN]) == [[]]


def test_redaction(spark):
    text = "Reported by Martin Grolworth. " + carried("phone", "05.36.49.09.14") + carried("phone", "05.36.49.09.14")
    long = PLAIN * 3000 + carried("email", "nora.fenley@example.org")
    rows = [(1, text, 5, None), (2, None, 5, None), (3, "", 5, None), (4, long, None, None), (1, text, 5, None), (None, text, 5, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, items int, redacted string")
    got = pii.redact(df)
    assert got.columns == ["doc_id", "text", "items", "redacted"]
    by = {r["doc_id"]: r for r in got.collect()}
    want = "Reported by [PERSON]. My number is [PHONE], ask for the map room. My number is [PHONE], ask for the map room. "
    assert by[1]["redacted"] == want and by[None]["redacted"] == want
    assert by[2]["redacted"] is None and by[2]["items"] is None and by[3]["redacted"] == "" and by[3]["items"] == []
    assert by[4]["redacted"] == long.replace("nora.fenley@example.org", "[EMAIL]")
    for r in by.values():
        for i in r["items"] or []:
            assert r["text"][i["start"] : i["end"]] == i["found_text"]
    found = sorted(map(tuple, pii.found(df).where("doc_id = 1").collect()))
    assert found == sorted([(1, "person", "Martin Grolworth"), (1, "phone", "05.36.49.09.14")] * 2)  # each delivered row by itself
    assert pii.found(df.limit(0)).count() == 0


def test_documents_not_trained_on(spark):
    """On other documents of the fixture, the items that have a clear shape are found and nothing else of those kinds."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null").select("text").collect()
    texts = [r["text"] for r in docs]
    hit = wrong = missed = 0
    for t, items in zip(texts, pii.find_items(texts)):
        want, have = set(pii_labels.shaped(t)), {i for i in items if i[2] != "person"}
        hit, wrong, missed = hit + len(want & have), wrong + len(have - want), missed + len(want - have)
    assert hit / (hit + wrong) > 0.98 and hit / (hit + missed) > 0.98


def test_training_text_is_labelled_where_its_items_stand():
    make = pii_forms.Makers(1, ["the", "weir", "and", "opens"], ["Meadow", "Winter", "Council"])
    places = {"Lyon": ["Lyon"], "Bad": ["Bad Ems"], "Ems": ["Bad Ems"]}
    own = "Reported by M. Example. The boundary of Bad Ems moved. Call 05.36.49.09.14 now!\n"
    spans = pii_labels.shaped(own)
    pieces = pii_train.pieces(own, spans)
    assert "".join(t for t, _ in pieces) == own and [t for t, s in pieces if s] == ["Call 05.36.49.09.14 now!"]
    assert [pii_train.doubtful(t, s, places) for t, s in pieces] == [True, False, False, False]
    for _ in range(200):
        text, at = pii_train.composed(pieces, make, places)
        assert all(text[a:b].strip() == text[a:b] != "" for a, b, _ in at) and all(x[1] <= y[0] for x, y in zip(sorted(at), sorted(at)[1:]))


def test_gradients():
    r = np.random.default_rng(0)
    m = Tagger(Vocabulary(["\0pad", "\0other", *"abcdef"]), 5)
    ids = r.integers(1, 8, (9, 3)).astype(np.int16)
    tags = np.array([[0, 1, 3], [0, 2, 4], [1, 2, 0], [2, 0, 0], [0, 0, 5], [3, 9, 6], [4, 10, 0], [4, 10, 7], [0, 0, 8]], np.int8)
    _, g = m.loss_and_grads(ids, tags)
    for k, w in m.w.items():
        i = np.unravel_index(np.abs(g[k]).argmax(), w.shape)
        old = w[i]
        w[i] = old + 1e-2
        up = m.loss_and_grads(ids, tags)[0]
        w[i] = old - 1e-2
        down = m.loss_and_grads(ids, tags)[0]
        w[i] = old
        assert abs(g[k][i] - (up - down) / 2e-2) < 0.02 * max(1, abs(g[k][i])), k


def test_viterbi_and_loss_against_enumeration():
    r = np.random.default_rng(1)
    m = Tagger(Vocabulary(["\0pad", "\0other", *"abc"]), 4)
    m.w["T"] = r.normal(0, 1, m.w["T"].shape).astype(np.float32)
    e = r.normal(0, 2, (4, 2, len(TAGS))).astype(np.float32)
    rule_t, rule_s = tag_rules()
    best = m.best_paths(e)
    for b in range(2):
        score = lambda p: m.w["S"][p[0]] + rule_s[p[0]] + e[0, b, p[0]] + sum(m.w["T"][p[i - 1], p[i]] + rule_t[p[i - 1], p[i]] + e[i, b, p[i]] for i in range(1, 4))  # noqa: B023, E731
        top = max(itertools.product(range(len(TAGS)), repeat=4), key=score)
        assert tuple(best[:, b]) == top
    back = Tagger.from_bytes(m.to_bytes())
    assert back.vocabulary.entries == m.vocabulary.entries and all(np.allclose(back.w[k], m.w[k], atol=2e-2) for k in m.w)
