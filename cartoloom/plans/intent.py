"""From a question in English or French to an operator call, by inverting the phrase table."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame

from cartoloom.functions.text import fold_term
from cartoloom.operators import spatial
from cartoloom.plans import phrases as P


@dataclass(frozen=True)
class Intent:
    """A template and its parameters."""

    template: str
    params: dict = field(default_factory=dict)


_DISTANCE = r"(?P<distance>\d+(?:[.,]\d+)?\s*(?:km|m))"
_FR_NAME = r"(?:du |des |de la |de l'|de |d')(?P<place>.+)"
_FR_AT = r"(?:au |aux |à la |à l'|à )(?P<place>.+)"


def _pattern(phrase: str, lang: str) -> re.Pattern:
    parts = {
        "category": r"(?P<category>.+?)", "place": r"(?P<place>.+?)", "de_place": _FR_NAME, "a_place": _FR_AT, "feature": r"(?P<feature>.+)",
        "distance": _DISTANCE, "se_trouve": r"se trouve(?:nt)?",
        "direction": "(?P<direction>" + "|".join(P.DIRECTIONS_FR.values() if lang == "fr" else P.DIRECTIONS_FR) + ")",
        "side": "(?P<side>" + "|".join(P.SIDES_FR.values() if lang == "fr" else P.SIDES_FR) + ")",
    }
    out = re.escape(phrase)
    for k, v in parts.items():
        out = out.replace(re.escape("{" + k + "}"), v)
    return re.compile(out, re.IGNORECASE)


@lru_cache(maxsize=1)
def _table() -> list[tuple[str, re.Pattern]]:
    """Templates and patterns, those with most fixed text first."""
    rows = sorted(P.phrases(), key=lambda r: (-len(re.sub(r"\{\w+\}", "", r[3])), r[0]))
    return [(template, _pattern(phrase, lang)) for template, lang, _, phrase in rows]


@lru_cache(maxsize=1)
def _labels() -> dict[str, dict]:
    out: dict[str, dict] = {}
    for subtype, klass, en, fr in P.CLASS_LABELS:
        for x in (en, fr):
            out.setdefault(fold_term(x), {"subtype": subtype, "klass": klass})
    for key, en, fr in P.CATEGORY_LABELS:
        for x in (en, fr):
            out.setdefault(fold_term(x), {"category": key})
    return out


def _metres(text: str) -> float:
    n = float(re.match(r"[\d.,]+", text).group().replace(",", "."))
    return n * 1000 if "km" in text else n


def parse(question: str) -> Intent | None:
    """The intent of a question; the most specific phrase that fits wins, ``None`` if none does."""
    q = question.strip().rstrip("?.! ").strip()
    labels, table = _labels(), _table()
    for template, pattern in table:
        m = pattern.fullmatch(q)
        if not m:
            continue
        got = m.groupdict()
        params: dict = {}
        if "category" in got:
            what = labels.get(fold_term(got["category"]))
            if what is None or ("category" in what) != template.startswith("places_"):
                continue
            params |= what
        for k in ("place", "feature"):
            if got.get(k):
                params[k] = got[k].strip()
        if got.get("distance"):
            params["distance_m"] = _metres(got["distance"])
        if got.get("direction"):
            params["direction"] = {v: k for k, v in P.DIRECTIONS_FR.items()}.get(got["direction"].lower(), got["direction"].lower())
        if got.get("side"):
            side = {v: k for k, v in P.SIDES_FR.items()}.get(got["side"].lower(), got["side"].lower())
            params["side_sign"] = 1 if side == "left" else -1
        return Intent(template, params)
    return None


def answer(views: dict[str, DataFrame], question: str | Intent) -> DataFrame:
    """The features that answer a question (``id, name, geometry``)."""
    intent = parse(question) if isinstance(question, str) else question
    if intent is None:
        raise ValueError(f"no known phrase fits: {question}")
    return spatial.OPERATORS[intent.template](views, **intent.params)
