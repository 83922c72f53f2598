"""A sample whose category shares follow given targets, by divisor-method priorities.

Every record gets a random rank within its category; record number r of a category with target t has the priority
(r - 1/2) / t, the first ``min_rows`` of each category come before all others, and the sample is the seats with the
globally smallest priorities.  A category that runs out of records simply has no more priorities, so its seats go to
the others without a further rule.

Two facts keep this distributed.  Priorities of a category are known from its size alone, so the number of seats per
category is found on the small table of categories, with no global sort of records.  And the random rank of a record
is its rank within a hash bucket plus the sizes of the lower buckets, so a category with a third of all rows is ranked
by many tasks.

Defined results: records with a null key are dropped from the draw; a record delivered twice counts once; a null
category or one without a target is never drawn and counts in the total; a category without records is reported with
0; ties between priorities go to the smaller category name, ties between equal hashes to the smaller key; an empty
table gives an empty sample and a report of zeros; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FRACTION = 0.25
SEED = 7
ROWS_PER_BUCKET = 50_000
#: The table of targets is read to the driver; it must stay below this many categories.
MAX_CATEGORIES = 100_000


def seats_by_priority(sizes: dict[str, int], targets: dict[str, tuple[float, int]], seats: int) -> dict[str, int]:
    """Seats of each category: the ``seats`` smallest priorities, floors first.

    The threshold is bracketed by bisection, so the cost does not depend on the number of seats; the last few seats
    are handed out one by one.
    """
    got = {c: min(sizes.get(c, 0), floor) for c, (_, floor) in targets.items()}
    order = sorted(targets)
    while sum(got.values()) > seats:  # floors alone exceed the sample: the largest targets give way last
        c = max((c for c in order if got[c] > 0), key=lambda c: (got[c] / max(targets[c][0], 1e-300), c))
        got[c] -= 1
    open_ = [c for c in order if targets[c][0] > 0 and got[c] < sizes.get(c, 0)]

    def at(limit: float) -> dict[str, int]:
        return {c: min(sizes[c], max(got[c], math.floor(limit * targets[c][0] + 0.5))) for c in open_}

    rest = seats - sum(n for c, n in got.items() if c not in open_)
    if open_ and sum(sizes[c] for c in open_) <= rest:
        return got | {c: sizes[c] for c in open_}
    if open_:
        low, high = 0.0, max((sizes[c] + 1) / targets[c][0] for c in open_)
        for _ in range(200):
            mid = (low + high) / 2
            if sum(at(mid).values()) <= rest:
                low = mid
            else:
                high = mid
        got |= at(low)
        left = seats - sum(got.values())
        heap = [((got[c] + 0.5) / targets[c][0], c) for c in open_ if got[c] < sizes[c]]
        heapq.heapify(heap)
        while left > 0 and heap:
            _, c = heapq.heappop(heap)
            got[c] += 1
            left -= 1
            if got[c] < sizes[c]:
                heapq.heappush(heap, ((got[c] + 0.5) / targets[c][0], c))
    return got


def _distinct(records: DataFrame, field: str, key: str) -> DataFrame:
    return (
        records.select(F.col(key).alias("_key"), F.col(field).cast("string").alias("_category")).where("_key is not null")
        .groupBy("_key").agg(F.min("_category").alias("_category"))
    )


def _plan(records: DataFrame, targets: DataFrame, field: str, key: str, fraction: float) -> tuple[DataFrame, list[dict], int]:
    """Distinct records, one entry per category, and the number of distinct records."""
    own = _distinct(records, field, key)
    wanted = targets.where(F.col("field") == field).select("category", "target_share", "min_rows")
    rows = wanted.groupBy("category").agg(F.max("target_share").alias("share"), F.max("min_rows").alias("floor")).limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} target categories")
    names = [r["category"] for r in rows if r["category"] is not None]
    counts = own.groupBy(F.when(F.col("_category").isin(names), F.col("_category")).alias("c")).agg(F.count("*").alias("n")).collect()
    sizes = {r["c"]: r["n"] for r in counts}
    total = sum(sizes.values())
    spec = {r["category"]: (float(r["share"] or 0), int(r["floor"] or 0)) for r in rows if r["category"] is not None}
    size = fraction * total
    seats = seats_by_priority({c: sizes.get(c, 0) for c in spec}, spec, math.floor(size))
    plan = []
    for c, (share, floor) in sorted(spec.items()):
        plan.append(
            {
                "field": field, "category": c, "target_share": share, "min_rows": floor, "available": sizes.get(c, 0), "seats": seats[c],
                "required": max(float(floor), share * size),
            }
        )
    return own, plan, total


REPORT = (
    "field string, category string, target_share double, min_rows int, available bigint, seats bigint, reached_share double, required double, met boolean"
)


def quota_report(records: DataFrame, targets: DataFrame, field: str, key: str = "sample_id", fraction: float = FRACTION, seed: int = SEED) -> DataFrame:
    """One row per target category: what is there, what was drawn, and whether the target could be met.

    The seats are counted on the drawn records.  A category is not met when the draw leaves it short of its requirement
    because it has too few records; the seat that rounding or the floors of others take from it does not count.
    """
    own, plan, total = _plan(records, targets, field, key, fraction)
    spark = records.sparkSession
    drawn = {r["category"]: r["n"] for r in _draw(own, plan, total, key, seed).groupBy("category").agg(F.count("*").alias("n")).collect()}
    whole = max(1, sum(drawn.values()))
    rows = []
    for p in plan:
        n = drawn.get(p["category"], 0)
        short = n < p["required"] and p["available"] < p["required"]
        rows.append((p["field"], p["category"], p["target_share"], p["min_rows"], p["available"], n, n / whole, p["required"], not short))
    return spark.createDataFrame(rows, REPORT)


def quota_sample(records: DataFrame, targets: DataFrame, field: str, key: str = "sample_id", fraction: float = FRACTION, seed: int = SEED) -> DataFrame:
    """``(key, category, rank, priority)`` of the drawn records."""
    own, plan, total = _plan(records, targets, field, key, fraction)
    return _draw(own, plan, total, key, seed)


def _draw(own: DataFrame, plan: list[dict], total: int, key: str, seed: int) -> DataFrame:
    spark = own.sparkSession
    seats = spark.createDataFrame(
        [(p["category"], p["seats"], p["target_share"], p["min_rows"]) for p in plan if p["seats"]], "_category string, _seats bigint, _share double, _floor int"
    )
    buckets = max(1, math.ceil(total / ROWS_PER_BUCKET)) * 8
    u = F.xxhash64(F.col("_key").cast("string"), F.lit(seed))
    # the high bits of the hash order the buckets, so bucket order and hash order agree
    ranked = own.join(F.broadcast(seats), "_category").withColumn("_u", u).withColumn("_b", F.expr(f"cast(floor((_u / 18446744073709551616D + 0.5D) * {buckets}) as int)"))
    per_bucket = ranked.groupBy("_category", "_b").agg(F.count("*").alias("_n"))
    lower = Window.partitionBy("_category").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("_before", F.coalesce(F.sum("_n").over(lower), F.lit(0))).drop("_n")
    in_bucket = Window.partitionBy("_category", "_b").orderBy("_u", "_key")
    out = (
        ranked.join(offsets, ["_category", "_b"]).where("_before < _seats")
        .withColumn("_rank", F.col("_before") + F.row_number().over(in_bucket)).where("_rank <= _seats")
    )
    priority = F.when(F.col("_rank") <= F.col("_floor"), F.lit(0.0)).otherwise((F.col("_rank") - 0.5) / F.col("_share"))
    return out.select(F.col("_key").alias(key), F.col("_category").alias("category"), F.col("_rank").cast("bigint").alias("rank"), priority.alias("priority"))
