"""Train, validation and test splits that keep related records together.

Records are related when they share an entity or when their entities share a key (here the SQL text, white space
folded).  Groups come from a distributed union-find: each task builds a local forest over its part of the links; a
node that lies in several parts links the roots it has there, and these links form the next, smaller level.  Levels
are merged by fewer tasks each time, but never by so few that a task would hold more than about ``LINKS_PER_TASK``
links; every level is checkpointed.  The links of one node go to one task, so that smallest labels travel twice as far
with every round; a node of very many links is spread over as many tasks as its links need, and the roots it gets
there are linked on the next level.

Groups are then assigned largest first, each to the split that is furthest below its target, with the targets of
every template in view.  Groups of one composition (so many records of this template, so many of that) are
interchangeable, so the whole greedy assignment is computed on the table of compositions, with the number of groups of
each, and the groups of a composition are dealt out by a random rank.  So it is the same at every size, and no task
ranks more than a bucket of groups.  For a template whose groups have that template only, the records of each split
differ from the target by less than the template's largest group (times the number of splits).  Where a template has
at least as many groups as there are splits, every split gets one.

Defined results: records with a null key are dropped; a null entity makes a record a group of its own; a null or
empty link key links nothing; a record delivered twice is assigned once; ties between compositions go by their text,
ties between splits by the larger share and then by name; empty tables give empty results; shares are
normalised, and extra columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartoloom.session import checkpointed

LINKS_PER_LEAF = 20_000
LINKS_PER_TASK = 200_000
FAN_IN = 4  # tasks merged into one per level
GROUPS_PER_BUCKET = 50_000
#: The table of compositions is read to the driver; it must stay below this many rows.
MAX_COMPOSITIONS = 500_000
SPACE = r"(?U)[\s\p{Z}]+"


def folded(column: str) -> F.Column:
    """The text with every run of white space as one space and none at the ends; empty becomes null."""
    text = F.trim(F.regexp_replace(F.col(column), SPACE, " "))
    return F.when(text != "", text)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and their smallest node among the linked ones, by min-label hooking with pointer jumping."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        open_ = rx != ry
        if not open_.any():
            return nodes, nodes[root]
        lo, hi = np.minimum(rx, ry)[open_], np.maximum(rx, ry)[open_]
        np.minimum.at(root, hi, lo)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def placed(links: DataFrame, tasks: int, limit: int) -> DataFrame:
    """Both directions of the links, those of one node ``a`` together, but for nodes of more than ``limit`` links.

    Their links are spread by the other end, so that no task gets more than its share of a hub.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hubs = both.groupBy("a").agg(F.ceil(F.count("*") / limit).alias("n")).where("n > 1")
    spread = both.join(hubs, "a", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("n")), F.lit(0)).alias("part"))
    return spread.repartition(tasks, "a", "part").select("a", "b")


def _local_forests(links: DataFrame, tasks: int, limit: int) -> DataFrame:
    """``(node, root)`` of a forest per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for t in batches:
            a.append(t.column(0).to_numpy())
            b.append(t.column(1).to_numpy())
        if a:
            node, root = _forest(np.concatenate(a), np.concatenate(b))
            for i in range(0, len(node), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(node[i : i + 100_000]), pa.array(root[i : i + 100_000])], ["node", "root"])

    parts = placed(links, tasks, limit) if tasks > 1 else links.select("a", "b").coalesce(1)
    return parts.mapInArrow(run, "node bigint, root bigint")


def components(links: DataFrame, links_per_leaf: int = LINKS_PER_LEAF, links_per_task: int = LINKS_PER_TASK) -> DataFrame:
    """``(node, root)`` of every linked node: the smallest node of its component.  ``links`` has ``a, b bigint``."""
    links = checkpointed(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    tasks = max(1, math.ceil(links.count() / links_per_leaf))
    levels: list[DataFrame] = []
    while True:
        forest = _local_forests(links, tasks, links_per_leaf)
        if tasks == 1:
            levels.append(checkpointed(forest))
            break
        forest = checkpointed(forest.distinct())
        levels.append(checkpointed(forest.groupBy("node").agg(F.min("root").alias("root"))))
        # a node with several roots links them
        more = forest.select("node", F.col("root").alias("r")).join(levels[-1], "node")
        links = checkpointed(more.where("r <> root").select(F.col("root").alias("a"), F.col("r").alias("b")).distinct())
        n = links.count()
        if n == 0:
            break
        tasks = max(math.ceil(tasks / FAN_IN), math.ceil(n / links_per_task))
    out = levels[-1]
    for lower in reversed(levels[:-1]):
        up = out.select(F.col("node").alias("root"), F.col("root").alias("top"))
        out = lower.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return out


def links_by_key(records: DataFrame, entity: str, key: F.Column) -> DataFrame:
    """Star links ``(a, b)``: every entity of a key with the key's smallest entity.

    The smallest entity is found with partial aggregation, so a key shared by a third of all rows costs one row per
    task; only keys with several entities take part in the join.
    """
    own = records.select(F.col(entity).cast("bigint").alias("b"), F.xxhash64(key).alias("k1"), F.xxhash64(F.reverse(key)).alias("k2"), key.isNotNull().alias("ok"))
    own = own.where("ok and b is not null").select("b", "k1", "k2").distinct()
    least = own.groupBy("k1", "k2").agg(F.min("b").alias("a"), F.max("b").alias("z")).where("a <> z").select("k1", "k2", "a")
    return own.join(least, ["k1", "k2"]).where("a <> b").select("a", "b")


def entity_groups(records: DataFrame, entity: str = "entity", link: str = "sql", **sizes) -> DataFrame:
    """``(entity, group_entity)`` of every entity that is linked to another; the smallest of a group has itself."""
    return components(links_by_key(records, entity, folded(link)), **sizes).select(F.col("node").alias("entity"), F.col("root").alias("group_entity"))


def shared_out(score: np.ndarray, step: float, n: int) -> np.ndarray:
    """How many of ``n`` like groups each split gets when each goes to the split of the highest score, which then falls
    by ``step``; ties go to the earlier split."""
    got = np.zeros(len(score), dtype=np.int64)
    if n > 4 * len(score):  # the bulk at once: down to a common level that leaves a few
        order = np.sort(score)[::-1]
        rest = (n - 2 * len(score)) * step
        for k in range(1, len(order) + 1):
            level = (order[:k].sum() - rest) / k
            if k == len(order) or level >= order[k]:
                break
        got = np.maximum(0, np.floor((score - level) / step)).astype(np.int64)
    now = score - got * step
    for _ in range(n - int(got.sum())):
        j = int(np.argmax(now))
        got[j] += 1
        now[j] -= step
    return got


def assigned(compositions: list[tuple[dict[str, int], int]], share: np.ndarray) -> list[np.ndarray]:
    """Groups of each composition per split; ``compositions`` (records per template, number of groups), largest first."""
    totals: dict[str, int] = {}
    for c, n in compositions:
        for s, k in c.items():
            totals[s] = totals.get(s, 0) + k * n
    have = {s: np.zeros(len(share)) for s in totals}
    groups = {s: np.zeros(len(share), dtype=np.int64) for s in totals}
    out = []
    for c, n in compositions:
        score = sum(k * (share - have[s] / totals[s]) for s, k in c.items())
        got = shared_out(score, sum(k * k / totals[s] for s, k in c.items()), n)
        for s, k in c.items():
            have[s] += got * k
            groups[s] += got
        out.append(got)
    for s in sorted(totals):  # no split without a group of a template that has enough of them
        for j in np.flatnonzero((groups[s] == 0) & (share > 0)):
            while groups[s][j] == 0 and groups[s].max() > 1:
                d = int(np.argmax(groups[s]))
                i = max((i for i, (c, _) in enumerate(compositions) if s in c and out[i][d] > 0), key=lambda i: -sum(compositions[i][0].values()))
                out[i][d] -= 1
                out[i][j] += 1
                for t in compositions[i][0]:
                    groups[t][d] -= 1
                    groups[t][j] += 1
    return out


def split_records(
    records: DataFrame, targets: DataFrame, key: str = "sample_id", entity: str = "entity", link: str = "sql", stratum: str = "template", **sizes
) -> DataFrame:
    """``(key, entity, template, group_entity, split_name)``, one row per distinct record.

    The driver sees the split targets and one row per composition of groups.
    """
    spark = records.sparkSession
    want = sorted(((r["split_name"], float(r["share"])) for r in targets.select("split_name", "share").collect()), key=lambda x: (-x[1], x[0]))
    names, share = [w[0] for w in want], np.asarray([w[1] for w in want]) / sum(w[1] for w in want)
    rows = (
        records.select(F.col(key).alias("_key"), F.col(entity).cast("bigint").alias("_entity"), F.col(stratum).cast("string").alias("_s")).where("_key is not null")
        .groupBy("_key").agg(F.min(F.struct("_entity", "_s")).alias("_r")).select("_key", "_r._entity", "_r._s")
    )
    groups = entity_groups(records, entity, link, **sizes).select(F.col("entity").alias("_entity"), F.col("group_entity").alias("_linked"))
    placed_rows = rows.join(groups, "_entity", "left").withColumn("_group", F.coalesce("_linked", "_entity")).drop("_linked")
    code = F.coalesce(F.concat(F.lit("e"), F.col("_group").cast("string")), F.concat(F.lit("r"), F.col("_key").cast("string")))
    placed_rows = checkpointed(placed_rows.withColumn("_code", code))
    per = placed_rows.groupBy("_code", F.coalesce("_s", F.lit("")).alias("_s")).agg(F.count("*").alias("n"))
    # a group has at most one entry per template
    group = checkpointed(per.groupBy("_code").agg(F.to_json(F.array_sort(F.collect_list(F.struct("_s", "n")))).alias("_mix"), F.sum("n").alias("n")))
    mixes = group.groupBy("_mix").agg(F.count("*").alias("k"), F.first("n").alias("n")).limit(MAX_COMPOSITIONS + 1).collect()
    if len(mixes) > MAX_COMPOSITIONS:
        raise ValueError(f"more than {MAX_COMPOSITIONS} compositions of groups")
    mixes.sort(key=lambda r: (-r["n"], r["_mix"]))
    parts = assigned([({x["_s"]: x["n"] for x in json.loads(r["_mix"])}, r["k"]) for r in mixes], share)
    cuts = spark.createDataFrame([(r["_mix"], np.cumsum(p).tolist()) for r, p in zip(mixes, parts)], "_mix string, _cuts array<bigint>")
    buckets = 8 * max(1, math.ceil(sum(r["k"] for r in mixes) / GROUPS_PER_BUCKET))
    ranked = group.select("_code", "_mix", F.xxhash64("_code").alias("_u")).withColumn("_b", F.expr(f"cast(floor((_u / 18446744073709551616D + 0.5D) * {buckets}) as int)"))
    lower = Window.partitionBy("_mix").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = ranked.groupBy("_mix", "_b").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(lower), F.lit(0))).drop("_n")
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_mix", "_b").orderBy("_u", "_code"))
    dealt = ranked.join(before, ["_mix", "_b"]).withColumn("_rank", rank).join(F.broadcast(cuts), "_mix")  # bounded by MAX_COMPOSITIONS
    which = F.size(F.filter("_cuts", lambda c: c < F.col("_rank")))
    split = dealt.select("_code", F.element_at(F.array(*[F.lit(x) for x in names]), which + 1).alias("split_name"))
    return placed_rows.join(split, "_code").select(
        F.col("_key").alias(key), F.col("_entity").alias("entity"), F.col("_s").alias("template"), F.col("_group").alias("group_entity"), "split_name"
    )
