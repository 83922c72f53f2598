"""Duplicate clusters for the packing operator: texts whose five-word shingles have a Jaccard similarity of 0.8 or more.

The search is exact up to collisions of 64-bit hashes, and forms no pairs within a group of copies.  Every text's
shingles are put into one common order, rare ones first.  A text of n shingles has at most n - ceil(0.8 n) that a
similar text lacks, so the first m of the shared ones lie among the first n - ceil(0.8 n) + m of either; two texts are
candidates only if they share m = n/20 (at least one) of these prefixes, and if lengths and positions still allow the
similarity.

* Of the texts that share a prefix shingle, the one in whose prefix it stands first represents it, and each text is first
  compared with the representative it meets most often; texts that are not linked by that are compared in the same way
  with those that share the largest part of their prefix.  Near copies of one text are linked that way, and each text carries the root of its
  component.
* Then the candidates of different components are compared: texts that are not linked yet with each other and with the
  linked ones, and members of two components where the two share a prefix shingle.

So copies of one text meet their representatives only, and the pairs are linear in the number of copies.
Clusters are the connected components of all similar pairs found.  The common order needs no exact frequencies:
shingles are counted in a histogram of fixed size, which is all that the driver and the executors hold of the corpus.

Defined results: texts without a word form no pairs and get no cluster; texts of fewer than five words are one
shingle; case and white space do not matter; repeated ids are one text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoloom.llm.group_split import components
from cartoloom.session import checkpointed

WORDS = 5
SIMILARITY = 0.8
BUCKETS = 1 << 18
_WORD = re.compile(r"\w+")
#: Ids of copies up to this number are broadcast (16 MB); more are joined by a shuffle.
MAX_BROADCAST = 2_000_000
_CACHE = 200_000  # words whose hashes a task remembers


def shingles(text: str, cache: dict[str, int]) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of five words."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    if len(cache) > _CACHE:
        cache.clear()
    codes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    k = min(WORDS, len(codes))
    out = np.zeros(len(codes) - k + 1, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[j : len(codes) - k + 1 + j]
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s % np.uint64(BUCKETS)).astype(np.int64)


def wanted(n: int) -> int:
    """How many shingles the prefixes of two similar texts must share, by the size of the smaller set."""
    return max(1, n // 20)


def prefix_length(n: int) -> int:
    return n - math.ceil(SIMILARITY * n - 1e-9) + wanted(n)


class _Codes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        import xxhash

        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


def _sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        cache = _Codes()
        for b in batches:
            ids, codes, raw = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = shingles(t, cache)
                if len(s):
                    ids.append(i)
                    raw.append(s.tobytes())
                    codes.append(xxhash.xxh3_128_digest(raw[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(codes, pa.binary()), pa.array(raw, pa.binary())], ["doc_id", "code", "s"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, code binary, s binary")


def _histogram(sets: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                raw = b"".join(b.column(0).slice(i, 256).to_pylist())
                n += np.bincount(_bucket(np.frombuffer(raw, np.uint64)), minlength=BUCKETS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    rows = sets.select("s").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows at most
    out = np.zeros(BUCKETS, np.int64)
    out[rows["bucket"].to_numpy(dtype=int)] = rows["n"].to_numpy()
    return out


def _prefixes(sets: DataFrame, counts: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, d, at = [], [], []
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = np.frombuffer(raw, np.uint64)
                first = s[np.lexsort((s, counts[_bucket(s)]))[: prefix_length(len(s))]]
                h.append(first.view(np.int64))
                d.append(np.full(len(first), i))
                at.append((len(s) << 32) + np.arange(len(first)))
            if h:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (h, d, at)], ["h", "doc_id", "at"])

    return sets.select("doc_id", "s").mapInArrow(run, "h bigint, doc_id bigint, at bigint")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b, j)``: the Jaccard similarity of pairs ``(a, b)``; only the sets that are needed travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            j = np.empty(b.num_rows)
            for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) if x.shape == y.shape and (x == y).all() else len(np.intersect1d(x, y, assume_unique=True))
                j[i] = both / (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(j)], ["a", "b", "j"])

    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    some = checkpointed(sets.select("doc_id", "s").join(needed, "doc_id", "left_semi"))
    left, right = some.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), some.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    return checkpointed(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint, j double"))


def _side(name: str, doc: str = "doc_id", at: str = "at") -> list:
    """Columns of one side of a pair; ``at`` holds the size of the set above 32 bits and the position in the prefix below."""
    return [F.col(doc).alias(name), F.shiftright(at, 32).alias(name + "n"), F.col(at).bitwiseAND(F.lit(0xFFFFFFFF)).alias(name + "p")]


def _best(rows: DataFrame) -> DataFrame:
    """Of each ``b`` the representative ``a`` that it shares most prefix shingles with, at least a third of those that
    similar texts share (they may have others with other representatives)."""
    k = _candidates(rows, 3, counted=True)
    return k.groupBy("b").agg(F.max_by("a", "k").alias("a")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _candidates(rows: DataFrame, part: int = 1, counted: bool = False) -> DataFrame:
    """Pairs ``(a, b)`` of rows ``(a, an, ap, b, bn, bp)``, one for each prefix shingle they share, that may be similar.

    They share all the prefix shingles that similar texts do, or a ``part`` of them; ``counted`` keeps the order of the
    pair and the count.
    """
    need = F.ceil(F.lit(SIMILARITY / (1 + SIMILARITY)) * (F.col("an") + F.col("bn")) - 1e-9)
    # at most so many shingles can be shared: those from here on, and those before that both prefixes could hold;
    # the bound holds at every shared shingle, so no count falls short because of it
    most = F.least(F.col("an") - F.col("ap"), F.col("bn") - F.col("bp")) + F.least("ap", "bp")
    near = (F.least("an", "bn") >= SIMILARITY * F.greatest("an", "bn") - 1e-9) & (most >= need)
    least = F.greatest(F.lit(1), F.floor(F.least("an", "bn") / 20))
    pair = ["a", "b"] if counted else [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    out = rows.where(near).groupBy(*pair, least.alias("least")).agg(F.count("*").alias("k")).where(F.col("k") * part >= F.col("least"))
    return out.select("a", "b", "k") if counted else out.select("a", "b")


def similar_links(sets: DataFrame, prefix: DataFrame) -> DataFrame:
    """``(a, b)``: similar pairs that connect every text to all others it is similar to, directly or through others.

    ``sets`` has ``doc_id, s``, ``prefix`` the prefix shingles ``h, doc_id, at`` of the texts to be compared.
    """
    similar = F.col("j") >= SIMILARITY - 1e-9
    # most shingles of a prefix occur nowhere else; they are dropped before the join
    # the representative is the text in whose prefix the shingle stands first: it has least of its own
    early = F.shiftleft(F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)), 32) + F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    shared = prefix.groupBy("h").agg(F.min_by("doc_id", early).alias("low"), F.min_by("at", early).alias("low_at"), F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
    own = checkpointed(prefix.join(shared.where("x <> y").drop("x", "y"), "h"))
    star = _compared(checkpointed(_best(own.where("doc_id <> low").select(*_side("a", "low", "low_at"), *_side("b")))), sets)
    star = star.where(similar).select("a", "b")
    # once more for the texts that are not linked: now the text that shares most of its prefix represents its shingles
    seen = star.select(F.explode(F.array("a", "b")).alias("doc_id"), F.lit(1).alias("links")).distinct()
    common = own.groupBy("doc_id").agg(F.count("*").alias("k"))
    rows = own.select("h", "doc_id", "at").join(common, "doc_id").join(seen, "doc_id", "left")
    share = F.floor(F.col("k") * 1_000_000 / F.shiftright("at", 32))
    most = F.shiftleft(share, 32) + F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    hubs = rows.groupBy("h").agg(F.max_by("doc_id", most).alias("hub"), F.max_by("at", most).alias("hub_at"))
    late = rows.where("links is null").join(hubs, "h").where("doc_id <> hub").select(*_side("a", "hub", "hub_at"), *_side("b"))
    star = star.unionByName(_compared(checkpointed(_best(late)), sets).where(similar).select("a", "b"))
    linked = checkpointed(components(star).select(F.col("node").alias("doc_id"), "root"))
    own = own.select("h", "doc_id", "at").join(linked, "doc_id", "left")
    single, grouped = own.where("root is null").drop("root"), checkpointed(own.where("root is not null"))
    left, right = single.select("h", *_side("a")), single.select("h", *_side("b"))
    rows = [left.join(right, "h").where("a < b"), left.join(grouped.select("h", *_side("b")), "h")]
    roots = grouped.select("h", "root").distinct()
    meet = roots.join(roots.select("h", F.col("root").alias("other")), "h").where("root < other")
    first = meet.join(grouped.select("h", "root", *_side("a")), ["h", "root"]).select("h", "other", "a", "an", "ap")
    rows.append(first.join(grouped.select("h", F.col("root").alias("other"), *_side("b")), ["h", "other"]))
    cols = ["a", "an", "ap", "b", "bn", "bp"]
    met = _candidates(rows[0].select(cols)).unionByName(_candidates(rows[1].select(cols).unionByName(rows[2].select(cols))))
    return star.unionByName(_compared(checkpointed(met), sets).where(similar).select("a", "b"))


def duplicate_clusters(docs: DataFrame) -> DataFrame:
    """``(doc_id, cluster)`` of every text with a word (``doc_id, text``); the cluster is the smallest id in it."""
    sets = checkpointed(_sets(docs))
    first = sets.groupBy("code").agg(F.min("doc_id").alias("first"))  # one code, one set
    named = checkpointed(sets.select("doc_id", "code").join(first, "code").select("doc_id", "first").distinct())
    # texts of an equal set take part once
    extra = named.where("doc_id <> first").select("doc_id").distinct()
    if extra.count() <= MAX_BROADCAST:
        extra = F.broadcast(extra)
    own = sets.join(extra, "doc_id", "left_anti")
    linked = components(similar_links(sets, _prefixes(own, _histogram(sets)))).select(F.col("node").alias("first"), "root")
    return named.join(linked, "first", "left").select("doc_id", F.coalesce("root", "first").alias("cluster"))
