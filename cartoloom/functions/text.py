"""Text functions as Catalyst expressions: folding of names, scripts, white space, distances in words."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_mark(c: str) -> bool:
    return unicodedata.category(c) in ("Mn", "Mc", "Me")


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """``translate`` arguments that take the accents off: letters whose decomposition is one letter and marks, and the
    marks themselves.  Stroked letters (ł, ø) are letters of their own."""
    marked, plain, marks = [], [], []
    for o in range(0xC0, 0x10000):
        c = chr(o)
        if 0xAC00 <= o < 0xE000:  # Hangul and surrogates
            continue
        d = "".join(x for x in unicodedata.normalize("NFD", c) if not _is_mark(x))
        if d == c:
            continue
        if len(d) == 1:
            marked.append(c)
            plain.append(d)
        elif not d:
            marks.append(c)
    return "".join(marked + marks), "".join(plain)


def strip_accents(text: Column | str) -> Column:
    """Accents off, everything else kept (œ, ø and ß are letters of their own)."""
    marked, plain = accent_table()
    return F.translate(F.col(text) if isinstance(text, str) else text, marked, plain)


def fold(text: Column | str) -> Column:
    """Case and accents folded; names are compared by this."""
    return strip_accents(F.lower(F.col(text) if isinstance(text, str) else text))


def fold_term(text: str) -> str:
    """``fold`` of a constant, on the driver."""
    marked, plain = accent_table()
    return text.lower().translate({ord(m): (plain[i] if i < len(plain) else None) for i, m in enumerate(marked)})


@lru_cache(maxsize=1)
def compatibility_table() -> tuple[list[tuple[str, str]], tuple[str, str]]:
    """Compatibility forms without marks: replacements by several letters, and ``translate`` arguments for the rest."""
    many, one = [], ([], [])
    for o in range(0xA0, 0x10000 if sys.maxunicode > 0xFFFF else 0x3000):
        c = chr(o)
        if 0xAC00 <= o < 0xD7A4 or 0xD800 <= o < 0xF900:
            continue
        d = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if d == c:
            continue
        if len(d) == 1:
            one[0].append(c)
            one[1].append(d)
        elif len(d) > 1 and o < 0xFB50:
            many.append((c, d))
    marks = [chr(o) for o in range(0x300, 0x370) if unicodedata.combining(chr(o))]
    return many, ("".join(one[0] + marks), "".join(one[1]))


#: Characters of compatibility forms with several letters that occur in Latin names.
LIGATURES = ("ﬀ", "ﬁ", "ﬂ", "ﬃ", "ﬄ", "ĳ", "Ĳ", "ǆ", "ǉ", "ǌ", "…", "½", "¼", "¾")


def without_accents(text: Column | str) -> Column:
    """Compatibility decomposition without marks, as a user types who leaves accents out."""
    many, (marked, plain) = compatibility_table()
    c = F.col(text) if isinstance(text, str) else text
    for a, b in many:
        if a in LIGATURES:
            c = F.replace(c, F.lit(a), F.lit(b))
    return F.translate(c, marked, plain)


def one_line(text: Column | str) -> Column:
    """White space collapsed, ends trimmed."""
    return F.trim(F.regexp_replace(F.col(text) if isinstance(text, str) else text, r"\s+", " "))


#: Letters of the Latin script that are forms of symbols: fullwidth ones, ordinals, the kelvin and angstrom signs.
NOT_LATIN = f"{chr(0xFF21)}-{chr(0xFF5A)}{chr(0xAA)}{chr(0xBA)}{chr(0x212A)}{chr(0x212B)}"


def is_latin(text: Column | str) -> Column:
    """Whether a non-empty text has no letter outside the Latin script (fullwidth and symbol letters are outside)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.length(c) > 0, F.lit(False)) & ~F.coalesce(c.rlike(r"[\p{L}&&[^\p{IsLatin}]]|[" + NOT_LATIN + "]"), F.lit(False))


def pick_name(local: Column, exonym: Column, use_local: Column) -> Column:
    """The first usable of the two names, the preferred one first; null when neither is in Latin script."""
    a, b = F.when(is_latin(local), local), F.when(is_latin(exonym), exonym)
    return F.when(use_local, F.coalesce(a, b)).otherwise(F.coalesce(b, a))


def distance_text(metres: float | None, lang: str | None) -> str | None:
    """``1500 -> 1.5km`` (French ``1,5km``), ``250 -> 250m``; rounded from the exact binary value, halves to even."""
    if metres is None or metres != metres:
        return None
    if metres < 1000:
        return f"{round(metres):g}m"
    km = f"{round(metres / 1000, 1):g}km"
    return km.replace(".", ",") if lang == "fr" else km


@F.pandas_udf(T.StringType())
def format_distance(metres: pd.Series, lang: pd.Series) -> pd.Series:
    """``distance_text`` of columns; no built-in rounds from the exact binary value."""
    return pd.Series([distance_text(m, x) for m, x in zip(metres, lang)], dtype=object)


def fenced_sql(text: Column) -> Column:
    """The statement inside a fenced block, or the whole text, trimmed."""
    inner = F.regexp_extract(text, r"(?is)```(?:sql)?\s*(.*?)```", 1)
    return F.regexp_replace(F.when(inner != "", inner).otherwise(text), r"^\s+|\s+$", "")
