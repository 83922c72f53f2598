"""Train the tagger on a bounded sample of documents with composed items and store its weights beside this module.

    python -m cartoloom.llm.pii_train FOLDER [SECONDS [more]]

With ``more`` the training goes on from the stored weights and skips the first phase.

``FOLDER`` holds ``documents.parquet`` and the tables with place names.  ``MAX_DOCUMENTS`` bounds the sample, which is
drawn by a hash of the id.  In all phases frames with composed items and items among random words (``pii_forms``)
stand between the documents' own sentences, and items of the documents are mostly exchanged for composed ones of their
kind.  Items other than persons are seen in the documents by their shape (``pii_labels``).  No shape tells a person, so
the first phase leaves out every sentence with two adjacent capitalised words that are no known place, and the later
phases take the persons that the tagger has found by then, cleaned of what cannot be a person (``likely``): known places,
phrases that recur in many texts, and words that only ever begin sentences.
"""

from __future__ import annotations

import multiprocessing
import re
import sys
from pathlib import Path

import numpy as np

from cartoloom.llm.pii_forms import Makers
from cartoloom.llm.pii_labels import KINDS, shaped
from cartoloom.llm.pii_model import TAGS, Tagger, Vocabulary
from cartoloom.llm.tokens import VOCAB_DIR

MAX_DOCUMENTS = 12_000
PHASES = (0.4, 0.3, 0.3)  # shares of the time
WINDOW = 192
EXCHANGED = 0.6
SWAPPED = 0.15
FRAMES_PER_TEXT = 2.0
SCATTERED_PER_TEXT = 2.0
VOCABULARIES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")
WEIGHTS = "pii_weights.npz"
SEED = 3
OFTEN = 12
NAME_TABLES = ("divisions", "division_areas", "water")

Span = tuple[int, int, str]
_PIECE = re.compile(r".+?(?:(?:(?<!\b[A-ZÀ-Þ])\.|[!?;])(?=[\s<]|$)[ ]*|<[^<>]{1,12}>|[\r\n]+|$)", re.DOTALL)  # not after an initial
_WORD = r"[^\W\d_][\w'’-]*"


def pieces(text: str, spans: list[Span]) -> list[tuple[str, list[Span]]]:
    """The sentences of a text with the spans in each; a sentence never ends inside a span."""
    out, start = [], 0
    inside = np.zeros(len(text) + 1, bool)
    for a, b, _ in spans:
        inside[a + 1 : b] = True
    for m in _PIECE.finditer(text):
        if not inside[m.end()]:
            out.append((text[start : m.end()], [(a - start, b - start, k) for a, b, k in spans if start <= a < m.end()]))
            start = m.end()
    return out


def doubtful(sentence: str, spans: list[Span], places: dict[str, list[str]]) -> bool:
    """Whether some words outside the spans could be a person: two capitalised ones side by side, not a known place.

    ``places`` maps each word to the names that have it.
    """
    hidden = list(sentence)
    for a, b, _ in spans:
        hidden[a:b] = ";" * (b - a)
    words = [(m.group(), m.end()) for m in re.finditer(rf"[^\W\d_]\.|{_WORD}|[;:.!?<>{{}}()\[\]=*/]", "".join(hidden))]
    known = {w for x, _ in words for p in places.get(x, ()) if p in sentence for w in re.findall(_WORD, p)}
    open_ = [w[0].isupper() and w not in known for w, _ in words]
    return any(x and y for x, y in zip(open_, open_[1:]))


def known(text: str, span: Span, places: dict[str, list[str]]) -> bool:
    """Whether a found person overlaps a known place."""
    near = text[max(0, span[0] - 40) : span[1] + 40]
    at = max(0, span[0] - 40)
    for w in re.findall(_WORD, text[span[0] : span[1]]):
        for p in places.get(w, ()):
            x = near.find(p)
            if x >= 0 and x + at < span[1] and x + at + len(p) > span[0]:
                return True
    return False


def likely(texts: list[str], found: list[list[Span]], places: dict[str, list[str]]) -> list[list[Span]]:
    """The found persons without known places and recurring phrases, and without leading words that only begin sentences."""
    begins: dict[str, int] = {}
    other: set[str] = set()
    spread: dict[str, int] = {}
    for text, spans in zip(texts, found):
        for m in re.finditer(_WORD, text):
            before = text[: m.start()].rstrip(" \xa0")[-1:]
            if not before or before in ".!?>\r\n":
                begins[m.group()] = begins.get(m.group(), 0) + 1
            else:
                other.add(m.group())
        for t in {text[a:b] for a, b, k in spans if k == "person"}:
            spread[t] = spread.get(t, 0) + 1
    leading = {w for w, n in begins.items() if n >= OFTEN and w not in other}
    out = []
    for text, spans in zip(texts, found):
        own = []
        for a, b, k in spans:
            if k != "person" or spread[text[a:b]] > OFTEN:
                continue
            words = list(re.finditer(_WORD, text[a:b]))
            while len(words) > 2 and words[0].group() in leading:
                words = words[1:]
                a, words = a + words[0].start(), [m for m in re.finditer(_WORD, text[a + words[0].start() : b])]
            if words and not known(text, (a, b, k), places):
                own.append((a, b, k))
        out.append(own)
    return out


def exchanged(text: str, spans: list[Span], make: Makers) -> tuple[str, list[Span]]:
    """The text with most items exchanged for composed ones of their kind, and the moved spans."""
    out, moved, at, size = [], [], 0, 0
    for a, b, kind in spans:
        out.append(text[at:a])
        size += a - at
        new = getattr(make, kind)() if make.odds(EXCHANGED) else text[a:b]
        out.append(new)
        moved.append((size, size + len(new), kind))
        size += len(new)
        at = b
    return "".join([*out, text[at:]]), moved


def swapped(text: str, spans: list[Span], make: Makers, places: dict[str, list[str]]) -> tuple[str, list[Span]]:
    """The sentence with a person (or an address) in the place of a known place outside its spans."""
    found = [(text.find(p), p) for w in set(re.findall(_WORD, text)) for p in places.get(w, ()) if len(p) > 3 and p in text]
    found = [(x, p) for x, p in found if not text[x + len(p) : x + len(p) + 1].isalnum() and not text[x - 1 : x].isalnum() and all(x + len(p) <= a or x >= b for a, b, _ in spans)]
    if not found:
        return text, spans
    x, p = max(found, key=lambda f: (len(f[1]), f[0]))
    kind = "person" if make.odds(0.8) else "address"
    new = getattr(make, kind)()
    moved = [(a, b, k) if a < x else (a + len(new) - len(p), b + len(new) - len(p), k) for a, b, k in spans]
    return text[:x] + new + text[x + len(p) :], sorted([*moved, (x, x + len(new), kind)])


def composed(sentences: list[tuple[str, list[Span]]], make: Makers, places: dict[str, list[str]]) -> tuple[str, list[Span]]:
    """Sentences of a document, with exchanged items, some places exchanged for persons, and frames between them."""
    parts = [exchanged(*(swapped(t, s, make, places) if make.odds(SWAPPED) else (t, s)), make) for t, s in sentences]
    gap = make.one([" ", " ", "\n", "\r\n", "<br/>", "  "])
    made = [make.framed() for _ in range(int(make.r.poisson(FRAMES_PER_TEXT)))] + [make.scattered() for _ in range(int(make.r.poisson(SCATTERED_PER_TEXT)))]
    for t, s in made:
        parts.insert(int(make.r.integers(0, len(parts) + 1)), (t + gap, s))
    text, spans = "", []
    for t, s in parts:
        spans += [(len(text) + a, len(text) + b, k) for a, b, k in s]
        text += t
    return text, spans


def windows(labelled: list[tuple[str, list[Span]]], vocabulary: Vocabulary, make: Makers) -> tuple[np.ndarray, np.ndarray]:
    """Windows of character codes and tags: one about every other item at a random offset, and others anywhere."""
    ids, tags = [], []
    for text, spans in labelled:
        codes, gold = vocabulary.codes(text), np.zeros(len(text), np.int8)
        for a, b, k in spans:
            j = 1 + 2 * KINDS.index(k)
            gold[a] = j
            gold[a + 1 : b] = j + 1
        starts = [a - int(make.r.integers(0, WINDOW - 24)) for a, _, _ in spans if make.odds(0.5)]
        starts += [int(make.r.integers(0, max(1, len(text)))) for _ in range(make.r.poisson(0.5 + len(text) / 700))]
        for s in starts:
            s = max(0, s)
            for a, b, _ in spans:  # no window begins inside an item
                if a < s < b:
                    s = a
            x, y = np.zeros(WINDOW, np.int16), np.zeros(WINDOW, np.int8)
            n = min(WINDOW, len(text) - s)
            x[:n], y[:n] = codes[s : s + n], gold[s : s + n]
            ids.append(x)
            tags.append(y)
    return np.array(ids), np.array(tags)


_SHARED: dict = {}


def _found(texts: list[str]) -> list[list[Span]]:
    from cartoloom.llm import pii

    return pii.find_items(texts, _SHARED["tagger"])


def _persons(tagger: Tagger, texts: list[str], workers: int) -> list[list[Span]]:
    _SHARED["tagger"] = tagger
    with multiprocessing.get_context("fork").Pool(workers) as pool:
        found = [f for part in pool.map(_found, [texts[i : i + 100] for i in range(0, len(texts), 100)], 1) for f in part]
    return likely(texts, found, _SHARED["places"])


def _phase_windows(job: tuple) -> tuple[np.ndarray, np.ndarray]:
    part, seed, sure = job
    make = Makers(seed, *_SHARED["words"])
    out = []
    for text, persons in part:
        spans = shaped(text)
        spans = sorted(spans + [p for p in persons if all(p[1] <= a or p[0] >= b for a, b, _ in spans)])
        own = pieces(text, spans)
        if sure:
            own = [(t, s) for t, s in own if not doubtful(t, s, _SHARED["places"])]
        if len(own) > 40:  # a long text gives some runs of its sentences
            at = int(make.r.integers(0, len(own) - 40))
            own = own[at : at + 40]
        out.append(composed(own, make, _SHARED["places"]))
    return windows(out, _SHARED["vocabulary"], make)


def vocabulary_words(folder: str) -> tuple[list[str], list[str]]:
    """Lower-case and capitalised words of the public vocabularies, frequent ones first."""
    import base64

    low, high = {}, {}
    for name in VOCABULARIES:
        for at, line in enumerate((Path(folder) / name).read_bytes().splitlines()):
            w = base64.b64decode(line.split()[0]).decode("utf-8", "ignore")
            if re.fullmatch(r" [^\W\d_]{2,}", w) and w[-1] <= "\u024f":
                to = low if w.islower() else high if w[1:].istitle() and len(w) > 3 else {}
                to[w[1:]] = min(at, to.get(w[1:], at))
    return sorted(low, key=low.get), sorted(high, key=high.get)


def train(texts: list[str], places: list[str], vocab_dir: str = VOCAB_DIR, hidden: int = 64, seconds: float = 720, workers: int = 8, batch: int = 256, start: Tagger | None = None, log=print) -> Tagger:
    """A tagger for the sample ``texts``; ``places`` are names that are no persons."""
    texts = [t for t in texts if t][:MAX_DOCUMENTS]
    _SHARED["words"] = vocabulary_words(vocab_dir)
    make = Makers(SEED, *_SHARED["words"])
    _SHARED["vocabulary"] = vocabulary = Vocabulary.of([*texts, *(f()[0] for f in (make.framed, make.scattered) for _ in range(3000))])
    _SHARED["places"] = {}
    for p in places:
        for w in re.findall(_WORD, p):
            _SHARED["places"].setdefault(w, []).append(p)
    t = start or Tagger(vocabulary, hidden)
    persons: list[list[Span]] = [[] for _ in texts]
    if start is not None:
        _SHARED["vocabulary"] = vocabulary = start.vocabulary
        persons = _persons(t, texts, workers)
    for phase, length in enumerate(PHASES):
        if start is not None and phase == 0:
            continue
        if start is not None:
            length /= 1 - PHASES[0]
        with multiprocessing.get_context("fork").Pool(workers) as pool:
            jobs = [(list(zip(texts[i::64], persons[i::64])), SEED * 1000 + phase * 100 + i, phase < 1) for i in range(64)]
            got = pool.map(_phase_windows, jobs, 1)
        ids, tags = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        log(f"phase {phase + 1}: {len(ids)} windows, {len(vocabulary.entries)} characters, {len(TAGS)} tags, {sum(map(len, persons))} persons seen")
        t.fit(ids, tags, epochs=100, batch=batch, rate=(6e-3, 4e-3, 3e-3)[min(phase, 2)], seed=phase, seconds=seconds * length, workers=workers, log=log)
        if phase < len(PHASES) - 1:
            persons = _persons(t, texts, workers)
    return t


def main(args: list[str]) -> None:
    import pyarrow.parquet as pq
    import xxhash

    folder = Path(args[0])
    docs = pq.read_table(folder / "documents.parquet", columns=["doc_id", "text"]).to_pylist()
    docs.sort(key=lambda r: xxhash.xxh64_intdigest(str(r["doc_id"])))
    places = {n for name in NAME_TABLES for n in pq.read_table(folder / f"{name}.parquet", columns=["name"])["name"].to_pylist() if n}
    weights = Path(__file__).with_name(WEIGHTS)
    start = Tagger.from_bytes(weights.read_bytes()) if args[2:] == ["more"] else None
    t = train([r["text"] for r in docs], sorted(places), seconds=float(args[1]) if len(args) > 1 else 720, start=start)
    weights.write_bytes(t.to_bytes())


if __name__ == "__main__":
    main(sys.argv[1:])
