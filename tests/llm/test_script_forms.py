import itertools
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from cartoloom.llm import script_forms as S

SCHEMA = "id string, name string, form string, how int"
FULL = {c: chr(ord(c) + 0xFEE0) for c in map(chr, range(0x21, 0x7F))}
LOOKS = {row["LATIN"]: [c for s, c in row.items() if s != "LATIN"] for row in S._CLASS.values()}


def disguised(name, k):
    """The name in other characters of the same look."""
    kind = k % 5
    if kind == 0:
        return "".join(FULL.get(c, c) for c in name).replace(" ", chr(0x3000))
    if kind == 1:
        return unicodedata.normalize("NFD", name)
    if kind == 2:
        return name[:2] + chr(0x200B) + name[2:] + chr(0x2060)
    if kind == 3:
        return name.replace(" ", chr(0xA0))
    return "".join(LOOKS[c][k % len(LOOKS[c])] if c in LOOKS else c for c in name)


NAMES = ["Vága Sopé", "Œuf de Mara", "Straße", "Łąg Peso", "Coco", "Пуша Рося", "Κεζωνάσιδας", "L'Arbre-Sec"]


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(NAMES[:4] + NAMES[7:]), st.integers(0, 1000), st.integers(0, 1000))
def test_disguises_come_back(name, a, b):
    assert S.resolve(disguised(disguised(name, a), b))[0] == name


def test_visible_differences_stay():
    apart = ["Pena", "Peña", "PENA", "Pe na", "Pe-na", "Penna", "Strasse", "Straße", "Oeuf", "Œuf", "сосо жук", "coco", "Vaga", "Vága"]
    forms = [S.resolve(n)[0] for n in apart]
    assert len(set(forms)) == len(apart)


def test_scripts():
    assert S.resolve("Pаris") == ("Paris", "mixed")
    assert S.resolve("Мocква") == ("Москва", "mixed")
    assert S.resolve("сосо") == ("coco", "whole")
    assert S.resolve("сосо жук") == ("сосо жук", "single")  # the other token decides
    assert S.resolve("coco жук") == ("сосо жук", "whole")
    assert S.resolve("жr")[1] == "none"
    for n in NAMES:
        assert S.resolve(n)[0] == n


def test_form_is_stable():
    for n in NAMES:
        for k in range(12):
            f = S.resolve(disguised(n, k))[0]
            assert S.resolve(f)[0] == f


def brute(rows):
    own = {(i, n) for i, n in rows if i is not None and n is not None}
    return {tuple(sorted((a[0], b[0]))) for a, b in itertools.combinations(own, 2) if a[0] != b[0] and a[1] != b[1] and S.resolve(a[1])[0] == S.resolve(b[1])[0]}


def test_pairs_against_brute_force(spark):
    rows = [(f"i{k}", disguised(n, k)) for k, n in enumerate(NAMES * 6)] + [(f"h{k}", "Coco") for k in range(60)]
    rows += [("i0", disguised(NAMES[0], 0)), ("x", None), (None, "Coco"), ("y", ""), ("z", chr(0x200B)), ("long", "Vága Sopé" * 3000), ("long2", disguised("Vága Sopé" * 3000, 1))]
    df = spark.createDataFrame([(i, n, "f", 1) for i, n in rows], SCHEMA)
    got = [tuple(r) for r in S.same_looking_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert ("y", "z") in set(got) and ("long", "long2") in set(got)
    forms = S.consistent_names(df).collect()
    assert len(forms) == len(rows) and all((r["form"] is None) == (r["name"] is None) for r in forms)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert S.same_looking_pairs(none).count() == 0 and S.consistent_names(none).count() == 0
