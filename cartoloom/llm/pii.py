"""Personal information inside free text: found by a character-level tagger, replaced by typed placeholders.

Each text is read whole, in overlapping windows, by the bidirectional LSTM of ``pii_model``.  Where windows overlap,
their scores are blended, so both are decoded (Viterbi, with the CRF transitions) from the same scores there; the tags
of a document pass from one window to the next at a character of the overlap that both place outside of any item, so
an item at a border is taken whole from the window that saw all of it.  The tags alone decide what an item is and of
which kind; afterwards punctuation is trimmed from its ends and half words are made whole.

Defined results: a null text has no items and stays null; an empty text stays empty; an item found several times in
one document is listed once and replaced everywhere it was found; documents delivered twice are each treated alike;
very long texts are streamed through in windows; extra columns are kept by ``redact`` unless their names clash with
its own (``items``, ``redacted``), which replace them; an empty table gives an empty result.
"""

from __future__ import annotations

import pkgutil
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartoloom.llm.pii_model import KINDS, TAGS, Tagger
from cartoloom.llm.pii_train import WEIGHTS
from cartoloom.session import shuffle_width

CORE = 256
OVERLAP = 64
BATCH = 192  # windows scored at once
ITEM = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("found_text", T.StringType())])


@lru_cache(maxsize=1)
def tagger() -> Tagger:
    """The trained tagger, loaded once per process."""
    raw = pkgutil.get_data("cartoloom.llm", WEIGHTS)
    if raw is None:
        raise FileNotFoundError(WEIGHTS)
    return Tagger.from_bytes(raw)


def _tagged(model: Tagger, docs: Iterable[str]) -> Iterator[np.ndarray]:
    """Tags of every character, document by document; windows of many documents are scored and decoded together."""
    ramp = ((np.arange(OVERLAP) + 0.5) / OVERLAP).astype(np.float32)[:, None, None]
    tags: dict[int, np.ndarray] = {}
    queue: list[tuple[int, int, np.ndarray]] = []
    held: list[tuple[int, int, np.ndarray]] = []  # the last window waits for the scores of the next
    held_scores: np.ndarray | None = None

    def place(doc: int, at: int, path: np.ndarray) -> None:
        own = tags[doc]
        n = min(len(path), len(own) - at)
        cut = 0
        if at:
            here = min(OVERLAP, n)
            both = np.flatnonzero((own[at : at + here] == 0) & (path[:here] == 0))
            if not len(both):  # one item fills the whole overlap
                both = np.flatnonzero(own[at : at + here] == path[:here])
            cut = int(both[np.abs(both - here // 2).argmin()]) if len(both) else here // 2
        own[at + cut : at + n] = path[cut:n]

    def score(last: bool) -> None:
        nonlocal held, held_scores
        ids = np.zeros((CORE + OVERLAP, len(queue)), np.int16)
        for j, (_, _, codes) in enumerate(queue):
            ids[: len(codes), j] = codes
        e = model.scores(ids) if queue else np.zeros((CORE + OVERLAP, 0, len(TAGS)), np.float32)
        all_ = held + queue
        if held_scores is not None:
            e = np.concatenate([held_scores, e], axis=1)
        later = np.asarray([j for j in range(1, len(all_)) if all_[j][1] > 0], dtype=int)
        if len(later):
            blend = ramp * e[:OVERLAP, later] + (1 - ramp) * e[CORE:, later - 1]
            e[:OVERLAP, later] = blend
            e[CORE:, later - 1] = blend
        n = len(all_) if last else len(all_) - 1
        if n:
            for (doc, at, _), path in zip(all_[:n], model.best_paths(e[:, :n]).T):
                place(doc, at, path)
        held, held_scores = ([], None) if last else ([all_[-1]], e[:, -1:].copy())
        queue.clear()

    done = total = 0
    for doc, text in enumerate(docs):
        codes = model.vocabulary.codes(text)
        tags[doc] = np.zeros(len(codes), np.int8)
        total = doc + 1
        for at in range(0, len(codes), CORE):
            queue.append((doc, at, codes[at : at + CORE + OVERLAP]))
            if len(queue) == BATCH:
                score(False)
                while done < held[0][0]:
                    yield tags.pop(done)
                    done += 1
    score(True)
    while done < total:
        yield tags.pop(done)
        done += 1


def _spans(path: np.ndarray) -> list[tuple[int, int, str]]:
    """Items of one document's tags."""
    on = np.flatnonzero(path)
    if not len(on):
        return []
    kind = (path[on] - 1) // 2
    first = np.ones(len(on), bool)
    first[1:] = (np.diff(on) > 1) | (path[on[1:]] % 2 == 1) | (kind[1:] != kind[:-1])
    at = np.flatnonzero(first)
    ends = np.append(at[1:], len(on)) - 1
    return [(int(on[a]), int(on[b]) + 1, KINDS[int(kind[a])]) for a, b in zip(at, ends)]


_EDGE = " \t\r\n\xa0,;:()[]{}<>\"'“”«»|*=-–—/"


def trimmed(text: str, a: int, b: int, kind: str) -> tuple[int, int]:
    """A span without punctuation at its ends and with whole words; a telephone number ends in digits."""
    while 0 < a < b and text[a].isalnum() and text[a - 1].isalnum():
        a -= 1
    while a < b < len(text) and text[b - 1].isalnum() and text[b].isalnum():
        b += 1
    if kind == "phone":
        while a < b and not (text[a].isdigit() or text[a] in "+("):
            a += 1
        while a < b and not text[b - 1].isdigit():
            b -= 1
        return a, b
    while a < b and text[a] in _EDGE:
        a += 1
    while a < b and (text[b - 1] in _EDGE or text[b - 1] in ".!?" and not (kind == "person" and text[b - 2 : b - 1].isupper() and not text[b - 3 : b - 2].isalpha())):
        b -= 1
    return a, b


def checked(text: str, raw: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans with tidy ends and without overlaps: the earlier and then the longer one stays."""
    exact = [(*trimmed(text, a, b, kind), kind) for a, b, kind in raw]
    out: list[tuple[int, int, str]] = []
    for a, b, kind in sorted({s for s in exact if s[0] < s[1]}, key=lambda s: (s[0], -s[1], s[2])):
        if not out or a >= out[-1][1]:
            out.append((a, b, kind))
    return out


def find_items(texts: list[str | None], model: Tagger | None = None) -> list[list[tuple[int, int, str]]]:
    """Items ``(start, end, kind)`` of each text."""
    model = model or tagger()
    whole = [t or "" for t in texts]
    return [checked(t, _spans(path)) for t, path in zip(whole, _tagged(model, whole))]


def _replaced(text: str, items: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in items:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", spread: bool = True, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``items`` (kind, start, end, found_text; offsets in characters) and the ``redacted`` text.

    Scoring is bound by the processor, so the rows are spread evenly over the tasks first.
    """
    own = [f for f in docs.schema.fields if f.name not in ("items", "redacted") and (keep_text or f.name != text_col)]
    kept = [f.name for f in own]
    schema = T.StructType([*own, T.StructField("items", T.ArrayType(ITEM)), T.StructField("redacted", T.StringType())])
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("found_text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                texts = b.column(b.num_columns - 1).to_pylist()
                items = find_items(texts)
                lists = [None if t is None else [{"kind": k, "start": x, "end": y, "found_text": t[x:y]} for x, y, k in i] for t, i in zip(texts, items)]
                clean = [None if t is None else _replaced(t, i) for t, i in zip(texts, items)]
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), pa.array(lists, item), pa.array(clean, pa.string())], [*kept, "items", "redacted"])

    rows = docs.select(*kept, F.col(text_col).alias("_text"))
    if spread:
        rows = rows.repartition(4 * shuffle_width(docs.sparkSession))
    return rows.mapInArrow(run, schema)


def found(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, kind, found_text)``: each distinct item of each document once."""
    rows = redact(docs.select(key, text_col), text_col, keep_text=False)
    once = F.array_distinct(F.transform("items", lambda i: F.struct(i["kind"].alias("kind"), i["found_text"].alias("found_text"))))
    return rows.select(key, F.explode(once).alias("i")).select(key, "i.kind", "i.found_text")
