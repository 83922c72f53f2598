"""One consistent form for text that looks the same but is stored in different characters.

A name is cleaned of invisible characters and brought to compatibility form.  Each of its tokens is then resolved
against the scripts: every letter has the set of scripts in which a letter of that look exists, and the intersection
over the token's letters gives the scripts in which the whole token can be spelled.

* one script left: the token is spelled in it, which turns a mixed token ("Pаris" with a Cyrillic letter) into its
  single-script spelling;
* several left (a whole-script confusable such as "сосо"): the script of the name's other tokens decides, then the
  fixed order of ``SCRIPT_ORDER``;
* none left (the token visibly mixes scripts): every letter takes the first script of that order that has its look.

The result depends on the looks only, so names that look the same get the same form, and since no accent, case,
hyphen, space or letter shape is changed, names that look different keep different forms.

Defined results: null stays null; a text of invisible characters only becomes the empty string; leading and trailing
spaces, which cannot be seen, are removed; repeated and very long texts are treated like any other.  The operators
read the named columns only, so extra or clashing columns do no harm; empty tables give empty results.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCRIPT_ORDER = ("LATIN", "CYRILLIC", "GREEK", "ARMENIAN")

# Letters of the same look, Latin first; a hyphen stands where a script has none.
# Latin, Cyrillic, Greek, Armenian
LOOKALIKES = """
A А Α -
B В Β -
C С Ϲ -
E Е Ε -
H Н Η -
I І Ι -
J Ј Ϳ -
K К Κ -
M М Μ -
N - Ν -
O О Ο Օ
P Р Ρ -
S Ѕ - Տ
T Т Τ -
X Х Χ -
Y Ү Υ -
Z - Ζ -
G Ԍ - -
Q Ԛ - -
W Ԝ - -
a а - -
c с ϲ -
d ԁ - -
e е - -
g - - ց
h һ - հ
i і - -
j ј ϳ -
l ӏ - -
n - - ո
o о ο օ
p р - -
q ԛ - զ
s ѕ - -
u - - ս
v ѵ ν -
w ԝ - -
x х - -
y у - -
"""
# Other characters of the look of an ordinary one.
SAME_LOOK = {"ɡ": "g", "‐": "-", "‑": "-", "’": "'", "ʼ": "'", "＇": "'"}

_CLASS: dict[str, dict[str, str]] = {}
for _line in LOOKALIKES.split("\n"):
    if _line:
        _row = {s: c for s, c in zip(SCRIPT_ORDER, _line.split(" ")) if c != "-"}
        for _c in _row.values():
            _CLASS[_c] = _row

#: Look-alikes that the compatibility form would turn into letters of another look go to their Latin twin before it.
_BEFORE = {ord(c): row["LATIN"] for c, row in _CLASS.items() if unicodedata.normalize("NFKC", c) != c}

#: Ranges of characters that leave no mark: soft hyphen, joiners, direction and variation marks, fillers, tags.
INVISIBLE = (
    (0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E),
    (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xE0000, 0xE0FFF),
)
_IGNORED = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in INVISIBLE) + "]")
_TOKEN = re.compile(rf"[^\W\d_](?:[^\W\d_]|[{chr(0x300)}-{chr(0x36F)}])*")
#: Text that already is its own form: printable ASCII and precomposed Latin letters without look-alikes elsewhere.
_LETTERS = f"!-~{chr(0xC0)}-{chr(0xD6)}{chr(0xD8)}-{chr(0xF6)}{chr(0xF8)}-{chr(0x148)}"
_PLAIN = re.compile(f"[{_LETTERS}](?:[ {_LETTERS}]*[{_LETTERS}])?")


@lru_cache(maxsize=4096)
def _scripts(c: str) -> frozenset[str]:
    """Scripts that have a letter of this look."""
    row = _CLASS.get(c)
    if row is not None:
        return frozenset(row)
    return frozenset([unicodedata.name(c, "?").split(" ")[0]])


def _letters(token: str) -> list[str]:
    return [c for c in token if not unicodedata.combining(c)]


def resolve(text: str | None) -> tuple[str, str] | None:
    """The consistent form and how it was found: ``plain``, ``single``, ``mixed``, ``whole`` or ``none``.

    ``mixed``: some token mixed the letters of scripts and has one consistent spelling; ``whole``: some token can be
    spelled in several scripts and was not in the chosen one; ``none``: some token visibly mixes scripts.
    """
    if text is None:
        return None
    if _PLAIN.fullmatch(text):
        return text, "plain"
    s = unicodedata.normalize("NFKC", _IGNORED.sub("", text).translate(_BEFORE))
    s = _IGNORED.sub("", s)
    s = "".join(SAME_LOOK.get(c, " " if unicodedata.category(c) == "Zs" else c) for c in s).strip()
    s = unicodedata.normalize("NFD", s)
    tokens = list(_TOKEN.finditer(s))
    fits = []
    for t in tokens:
        common: frozenset[str] | None = None
        for c in _letters(t.group()):
            common = _scripts(c) if common is None else common & _scripts(c)
        fits.append(common or frozenset())
    settled: dict[str, int] = {}
    for f in fits:
        if len(f) == 1:
            (only,) = f
            settled[only] = settled.get(only, 0) + 1
    rank = {x: i for i, x in enumerate(SCRIPT_ORDER)}
    out, at, how = [], 0, "single"
    for t, f in zip(tokens, fits):
        out.append(s[at : t.start()])
        at = t.end()
        best = min(f, key=lambda x: (-settled.get(x, 0), rank.get(x, 9), x)) if f else None
        spelled = []
        for c in t.group():
            row = _CLASS.get(c)
            if row is None:
                spelled.append(c)
            elif best is not None:
                spelled.append(row.get(best, c))
            else:
                spelled.append(row[min(row, key=lambda x: rank[x])])
        new = "".join(spelled)
        if not f:
            how = "none"
        elif new != t.group() and how != "none":
            own = {unicodedata.name(c, "?").split(" ")[0] for c in _letters(t.group())}
            how = "mixed" if len(own) > 1 or how == "mixed" else "whole"
        out.append(new)
    out.append(s[at:])
    return unicodedata.normalize("NFC", "".join(out)), how


def name_forms(names: DataFrame, name_col: str = "name") -> DataFrame:
    """``(name, form, how)`` of a column of texts, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(0)
            got = [resolve(x) for x in raw.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [raw, pa.array([g and g[0] for g in got], pa.string()), pa.array([g and g[1] for g in got], pa.string())], ["name", "form", "how"]
            )

    return names.select(F.col(name_col).cast("string").alias("name")).mapInArrow(run, "name string, form string, how string")


def consistent_names(records: DataFrame, name_col: str = "name") -> DataFrame:
    """``records`` with ``form`` and ``how`` per name; each distinct name is resolved once.

    The join back to the records is an ordinary equi-join; a name that holds a large share of the rows is split by
    adaptive execution, as the side with the forms has one row per name.
    """
    distinct = records.select(F.col(name_col).cast("string").alias("_n")).where("_n is not null").distinct()
    forms = name_forms(distinct, "_n").select(F.col("name").alias("_n"), F.col("form").alias("_f"), F.col("how").alias("_h"))
    out = records.join(forms, records[name_col] == forms["_n"], "left")
    return out.select(*[records[c] for c in records.columns if c not in ("form", "how")], F.col("_f").alias("form"), F.col("_h").alias("how"))


def same_looking_pairs(records: DataFrame, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """``(id_a, id_b)``: two ids whose names look the same but are stored differently, the smaller id first.

    Pairs are formed between spellings (distinct stored names of one form), never between all records of a form, and
    only then expanded to ids.
    """
    own = records.select(F.col(id_col).alias("id"), F.col(name_col).cast("string").alias("name")).where("id is not null and name is not null")
    forms = name_forms(own.select("name").distinct()).select("name", "form")
    a = forms.select(F.col("name").alias("name_a"), "form")
    b = forms.select(F.col("name").alias("name_b"), "form")
    spellings = a.join(b, "form").where("name_a <> name_b").select("name_a", "name_b")
    left = own.select(F.col("id").alias("id_a"), F.col("name").alias("name_a"))
    right = own.select(F.col("id").alias("id_b"), F.col("name").alias("name_b"))
    return spellings.join(left, "name_a").join(right, "name_b").where("id_a < id_b").select("id_a", "id_b").distinct()
