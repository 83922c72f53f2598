"""Shapes of personal items, for the training labels of the documents only.

The tagger is trained on composed items (``pii_forms``); these shapes say where the documents of the training sample
hold items of their own, so that those are labelled too or exchanged for composed ones.  Nothing here is used when
text is searched.
"""

from __future__ import annotations

import re

KINDS = ("email", "phone", "id_number", "address", "person")

_AT = r"(?: ?@ ?|＠| ?[(\[{] ?(?:at|AT|arroba|chiocciola) ?[)\]}] ?| (?:AT|at) )"
_DOT = r"(?:\.| ?[(\[{] ?(?:dot|DOT|punto|point|punkt) ?[)\]}] ?| (?:dot|DOT) )"
EMAIL = re.compile(rf"(?<![\w.+-])[\w](?:[\w.+'-]*[\w])?{_AT}[A-Za-z0-9](?:[\w-]*\w)?(?:{_DOT}[A-Za-z0-9](?:[\w-]*\w)?)*{_DOT}[A-Za-z]{{2,}}(?![\w@-])", re.UNICODE)

_GAP = "[ \xa0 .\\-/]"
_PHONE = re.compile(rf"(?<![\w+.,/-])(?<!\d[ \xa0])(?:\(\+\d{{1,3}}\)|\(\d{{3,5}}\)|\+\d|\d)(?:{_GAP}?(?:\(0\)|\d))+(?![\w])(?!-\w)")
_OBJECT = re.compile(r"\d{5,8}-\d{1,4}")  # codes of map objects, not numbers to call
_NORTH = re.compile(r"(?:\+?1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}")

_NINO = r"[A-Za-z]{2}(?:[ -]?\d{2} ?\d{2} ?\d{2}[ -]?[A-Da-d])"
_NIR = r"[12][ .]?\d{2}[ .]?\d{2}[ .]?\d{2}[ .]?\d{3}[ .]?\d{3}[ .-]?\d{2}"
_CARD = r"[A-Z]{2}(?=[0-9A-Z]*\d)[0-9A-Z]{7}[ -]?\d"
_DNI = r"(?:\d{8}|\d{2}\.\d{3}\.\d{3})[ -]?[A-Za-z]|[XYZ][ -]?\d{7}[ -]?[A-Z]"
_FISCAL = r"(?i:[A-Z]{3} ?[A-Z]{3} ?\d{2}[A-EHLMPR-T]\d{2} ?[A-Z]\d{3}[A-Z])"
_TAX = r"[1-9]\d{10}|[1-9]\d \d{3} \d{3} \d{3}"
ID = re.compile(rf"(?<![\w.+,/-])(?:{_NINO}|{_NIR}|{_CARD}|{_FISCAL}|{_DNI}|{_TAX})(?![\w])(?![.,-]\d)")

_CAP = r"[A-ZÀ-ÖØ-ÞŁŚŻ][\w'’]*(?:-[\w'’]+)*"
_NUM = r"\d{1,4}"
_EN = rf"{_NUM}[A-Za-z]?,? (?:{_CAP} ){{1,3}}(?:Street|St|Lane|Ln|Road|Rd|Close|Row|Rise|Avenue|Ave|Way|Drive|Terrace|Court|Place|Square|Hill|Walk|Gardens|Crescent|Grove|Mews|Yard)\b"
_FR = (
    rf"{_NUM}(?: ?(?:bis|ter|quater|[A-Ca-c]))?,? (?:rue|avenue|av\.|bd\.?|boulevard|chemin|place|pl\.|quai|impasse|imp\.|all[ée]e|route|cours|square|passage|sentier) "
    rf"(?:(?:de la |de l['’]|des |du |de |d['’]))?{_CAP}(?: {_CAP})*"
)
_DE = (
    rf"(?:(?:Am|An der|An den|Im|In der|Zum|Zur|Auf der|Auf dem|Unter den) (?:(?:Alten|Alter|Neuen|Oberen|Unteren|Hohen) )?{_CAP}|"
    rf"(?:(?:Alte|Alter|Neue|Neuer|Obere|Untere) )?(?:{_CAP}[ -])?[A-ZÄÖÜ][\wäöüß]*(?:straße|strasse|str\.|weg|platz|gasse|allee|ring|ufer|damm|steig|markt)) {_NUM}(?: ?[a-zA-Z])?(?!\w)"
)
_END = rf",? (?:n[.]?[º°o][.]? ?|n\. ?|núm\. ?)?{_NUM}(?: ?[a-zA-Z])?(?!\w)"
_ES = rf"(?:Calle|C/|C\.|Avenida|Avda\.|Av\.|Plaza|Pza\.|Pl\.|Paseo|P\.º|Camino|Cno\.|Ronda|Travesía|Cuesta) ?(?:(?:de la|de los|de las|del|de) )?{_CAP}(?: (?:(?:de la|del|de) )?{_CAP}){{0,3}}{_END}"
_IT = rf"(?:Via|V\.|Viale|V\.le|Corso|C\.so|Piazza|P\.za|Piazzale|Largo|L\.go|Vicolo|Strada) (?:(?:della |delle |dei |degli |del |dell['’]|di ))?{_CAP}(?: {_CAP}){{0,3}}{_END}"
ADDRESS = re.compile(rf"(?<![\w/.-])(?:{_EN}|{_FR}|{_ES}|{_IT}|{_DE})")

def phones(text: str) -> list[tuple[int, int]]:
    """Spans of telephone numbers: an international or trunk prefix, or the North American grouping."""
    out = []
    for m in _PHONE.finditer(text):
        s = m.group()
        digits = sum(c.isdigit() for c in s)
        if 9 <= digits <= 15 and (s[0] in "+(0" or _NORTH.fullmatch(s)) and not (ID.fullmatch(s) and s[0] not in "+(0"):
            if (s[0] == "(" and ")" not in s) or _OBJECT.fullmatch(s):
                continue
            out.append(m.span())
    return out


def shaped(text: str) -> list[tuple[int, int, str]]:
    """Spans of the text that have the shape of an item; where items overlap, the earlier kind of ``KINDS`` wins."""
    taken: list[tuple[int, int, str]] = []
    for kind, found in (("email", EMAIL.finditer), ("phone", None), ("id_number", ID.finditer), ("address", ADDRESS.finditer)):
        for a, b in phones(text) if found is None else [m.span() for m in found(text)]:
            if all(b <= x or a >= y for x, y, _ in taken):
                taken.append((a, b, kind))
    return sorted(taken)
