"""Filling containers of fixed capacity with texts, little space left unused.

Best fit by decreasing size: open containers are ordered by the space they have left, and an item goes to the
tightest container that has room for it and no conflict with it.  A container carries two bitmaps: the sources it
holds and the duplicate clusters it holds.  An item conflicts with a container that holds its duplicate cluster
(near copies of one text belong in different containers) or, where the item's source is listed in ``one_per_source``, its
source.  On a conflict the search goes on to the next tighter-than-all-others container, and so on until one is
compatible; only then is a new container opened.  An item larger than the capacity is cut into full pieces and a
rest, each packed on its own.

Items are dealt to shards by a hash and packed per shard; a shard has a bounded number of items, so no task holds a
group of unbounded size, and what a shard leaves open is one container in thousands.

Defined results: null and empty texts have no tokens and are not packed; null keys are dropped; a null source is a
source of its own; repeated rows are items of their own that share a duplicate cluster; ties in size go by key and
piece; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoloom.llm.copies import duplicate_clusters
from cartoloom.llm.tokens import VOCAB_DIR, VOCABULARY, with_tokens
from cartoloom.session import checkpointed

ITEMS_PER_SHARD = 20_000
#: The table of containers is read to the driver; it must stay below this many rows.
MAX_CONTAINERS = 1000
PACKED = (
    "container string, container_no bigint, position int, offset bigint, doc_id bigint, source string, piece int, n_pieces int, token_start bigint, tokens bigint"
)


class Bins:
    """Open containers of one capacity, ordered by the space left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.left: dict[int, dict[int, None]] = {}  # space left -> containers, oldest first
        self.present = 0  # bit r is set when some container has r left
        self.clusters: list[int] = []
        self.sources: list[int] = []
        self.space: list[int] = []
        self.items: list[list] = []

    def _take(self, b: int, size: int) -> None:
        r = self.space[b]
        same = self.left[r]
        del same[b]
        if not same:
            del self.left[r]
            self.present &= ~(1 << r)
        self._file(b, r - size)

    def _file(self, b: int, r: int) -> None:
        self.space[b] = r
        if r > 0:
            self.left.setdefault(r, {})[b] = None
            self.present |= 1 << r

    def place(self, size: int, cluster: int, source: int, item) -> int:
        """Put an item into the tightest compatible container; ``cluster`` and ``source`` are bit masks."""
        above = self.present >> size
        base = size
        while above:
            step = (above & -above).bit_length() - 1
            base += step
            for b in self.left[base]:
                if not (self.clusters[b] & cluster) and not (self.sources[b] & source):
                    self._take(b, size)
                    self.clusters[b] |= cluster
                    self.sources[b] |= source
                    self.items[b].append(item)
                    return b
            above >>= step + 1
            base += 1
        b = len(self.space)
        self.space.append(0)
        self.clusters.append(cluster)
        self.sources.append(source)
        self.items.append([item])
        self._file(b, self.capacity - size)
        return b


def pack_shard(items: pd.DataFrame, capacity: int, one_per_source: tuple[str, ...] = ()) -> list[list]:
    """Pack items (columns ``doc_id, source, cluster, piece, tokens``) and return the rows of each container."""
    repeated = items["cluster"].value_counts()
    bound = items["cluster"].isin(repeated.index[repeated > 1]) | items["source"].isin(one_per_source)
    # items that can conflict come first, while every container still has room
    rows = items.assign(bound=bound).sort_values(["bound", "tokens", "doc_id", "piece"], ascending=[False, False, True, True], kind="stable")
    bit = {c: 1 << i for i, c in enumerate(repeated.index[repeated > 1])}
    alone = {s: 1 << i for i, s in enumerate(one_per_source)}
    bins = Bins(capacity)
    for row in rows.itertuples(index=False):
        bins.place(int(row.tokens), bit.get(row.cluster, 0), alone.get(row.source, 0), row)
    return bins.items


def pack(
    docs: DataFrame, containers: DataFrame, one_per_source: tuple[str, ...] = (), clusters: DataFrame | None = None, items_per_shard: int = ITEMS_PER_SHARD,
    vocab_dir: str = VOCAB_DIR, vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Container, position and token range of each text or piece, for each row of ``containers``.

    ``clusters`` (``doc_id, cluster``) defaults to the clusters of near copies of ``copies.duplicate_clusters``.
    """
    sizes = {r["container"]: int(r["capacity_tokens"]) for r in containers.where("capacity_tokens > 0").limit(MAX_CONTAINERS + 1).collect()}
    if len(sizes) > MAX_CONTAINERS:
        raise ValueError(f"more than {MAX_CONTAINERS} containers")
    spark = docs.sparkSession
    if not sizes:
        return spark.createDataFrame([], PACKED)
    own = docs.where("doc_id is not null and text is not null and text <> ''")
    own = own.select("doc_id", "source", "text")
    clusters = duplicate_clusters(own) if clusters is None else clusters
    sized = with_tokens(own, vocab_dir=vocab_dir, vocabulary=vocabulary).where("tokens > 0")
    counted = checkpointed(sized.join(clusters.select("doc_id", "cluster"), "doc_id", "left").withColumn("cluster", F.coalesce("cluster", "doc_id")))
    table = F.array(*[F.struct(F.lit(c).alias("container"), F.lit(n).cast("bigint").alias("capacity")) for c, n in sorted(sizes.items())])
    each = counted.withColumn("_c", F.explode(table)).select("doc_id", "source", "cluster", "tokens", "_c.container", "_c.capacity")
    each = each.withColumn("n_pieces", F.expr("cast(ceil(tokens / capacity) as int)"))
    pieces = each.withColumn("piece", F.explode(F.sequence(F.lit(1), "n_pieces"))).select(
        "container", "capacity", "doc_id", "source", "cluster", "piece", "n_pieces",
        F.expr("(piece - 1) * capacity").alias("token_start"), F.expr("least(capacity, tokens - (piece - 1) * capacity)").alias("tokens"),
    )
    least = min(sizes.values())
    n = counted.agg(F.sum(F.ceil(F.col("tokens") / least))).first()[0] or 0
    shards = max(1, math.ceil(n / items_per_shard))
    sharded = pieces.withColumn("shard", F.expr(f"cast(pmod(xxhash64(doc_id, piece), {shards}) as int)"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        container, capacity, shard = key
        out = []
        for no, items in enumerate(pack_shard(pdf, int(capacity), one_per_source)):
            at = 0
            for pos, r in enumerate(items, 1):
                out.append((container, (int(shard) << 32) + no, pos, at, r.doc_id, r.source, r.piece, r.n_pieces, r.token_start, r.tokens))
                at += int(r.tokens)
        return pd.DataFrame(out, columns=[c.split(" ")[0] for c in PACKED.split(", ")])

    return sharded.groupBy("container", "capacity", "shard").applyInPandas(run, PACKED)


def oversized(packed: DataFrame) -> DataFrame:
    """``(container, doc_id)`` of the texts that had to be cut."""
    return packed.where("n_pieces > 1").select("container", "doc_id").distinct()


def fill_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """Containers used, tokens packed and share of the capacity filled, per kind of container."""
    used = packed.groupBy("container", "container_no").agg(F.sum("tokens").alias("t"), F.count("*").alias("k")).groupBy("container").agg(
        F.count("*").alias("n_containers"), F.sum("k").alias("n_items"), F.sum("t").alias("tokens")
    )
    return used.join(F.broadcast(containers.select("container", "capacity_tokens")), "container").select(
        "container", "n_containers", "n_items", "tokens", (F.col("tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("fill_share")
    )
