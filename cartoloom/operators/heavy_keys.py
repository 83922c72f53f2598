"""Per-key results when a few keys hold most rows.

``heavy_hitters`` finds every key above a share of all rows: each input partition keeps a Misra-Gries sketch with a
fixed number of counters (a sketch of k counters over n rows undercounts by at most n/k, and so does the sum of the
partitions' sketches), which yields a superset of the heavy keys of proven size; one pass then counts the candidates
exactly.

``per_key_summary`` splits the rows by that result.  Heavy keys are marked by a broadcast join (the marking table
has at most 1/share rows) and aggregated in two steps over hashed parts of the key; the other keys go through an
ordinary shuffle; the results are united.

Defined results
* a null key is a key of its own in the summary, where it may be heavy, and is never listed as a heavy hitter;
* null ids count as rows, not as distinct ids; null times are ignored by first and last and come last in top rows;
* repeated rows count as delivered; an id is listed once among the top ids, with its latest time; ties are broken by
  id;
* an empty table gives empty results; extra columns are ignored, and the operators' own columns cannot clash with
  them, since only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartoloom.session import checkpointed

#: Counters of a partition's sketch, as a multiple of 1/share: undercounting stays below a quarter of the share.
SKETCH_FACTOR = 4
#: A heavy key's rows are spread over one part for so many rows, so that no task holds more of one key.
ROWS_PER_PART = 200_000


def _merge(counts: dict, batch: dict, k: int) -> dict:
    for key, n in batch.items():
        counts[key] = counts.get(key, 0) + n
    if len(counts) > k:
        cut = sorted(counts.values(), reverse=True)[k]
        counts = {key: n - cut for key, n in counts.items() if n > cut}
    return counts


def _coded(key: str) -> F.Column:
    """The key as a string in which null has a code of its own."""
    return F.coalesce(F.concat(F.lit("v"), F.col(key).cast("string")), F.lit("n"))


def sketch(codes: DataFrame, counters: int) -> DataFrame:
    """Misra-Gries counters ``(code, n)`` of a one-column table of strings, one sketch per input partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        for b in batches:
            got = pc.value_counts(b.column(0))
            counts = _merge(counts, dict(zip(got.field(0).to_pylist(), got.field(1).to_pylist())), counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["code", "n"])

    return codes.mapInArrow(run, "code string, n bigint")


def _heavy_codes(codes: DataFrame, share: float) -> DataFrame:
    k = math.ceil(SKETCH_FACTOR / share)
    total = codes.agg(F.count("*").alias("total"))
    merged = sketch(codes, k).groupBy("code").agg(F.sum("n").alias("low"))
    candidates = merged.crossJoin(F.broadcast(total)).where(F.col("low") >= F.col("total") * (share - 1 / k)).select("code", "total")
    exact = codes.join(F.broadcast(candidates), "code").groupBy("code", "total").agg(F.count("*").alias("n"))
    return exact.where(F.col("n") >= F.col("total") * share)


def heavy_hitters(rows: DataFrame, key: str, share: float = 0.08) -> DataFrame:
    """``(key, n, total)`` of each non-null key that holds at least ``share`` of all rows, counted exactly.

    After merging, at most ``4 / (3 * share)`` candidates can pass the sketch's threshold; the broadcast of the
    candidates relies on that bound.
    """
    found = _heavy_codes(rows.select(_coded(key).alias("code")), share)
    return found.where("code <> 'n'").select(F.expr("substring(code, 2)").alias("key"), "n", "total")


def per_key_summary(
    rows: DataFrame, key: str, id_col: str = "id", time_col: str = "update_time", version_col: str = "version", top: int = 3, share: float = 0.08
) -> DataFrame:
    """``key, n_rows, n_ids, first_time, last_time, top_ids`` per key.

    ``n_ids`` counts distinct ids; ``top_ids`` joins by commas the ids with the latest times, newest first.
    """
    base = rows.select(_coded(key).alias("code"), F.col(id_col).cast("string").alias("id"), F.col(time_col).alias("t"), F.col(version_col).alias("v"))
    heavy = _heavy_codes(base.select("code"), share)
    # found once for both branches; it has at most 1/share rows
    heavy = checkpointed(heavy.select("code", F.expr(f"cast(greatest(2, ceil(n / {ROWS_PER_PART})) as int)").alias("parts")))
    marked = base.join(F.broadcast(heavy), "code", "left")
    hot = marked.where("parts is not null").withColumn("part", F.expr("cast(pmod(xxhash64(id), parts) as int)")).drop("parts")
    cold = marked.where("parts is null").drop("parts")
    out = _folded(_summary(hot, ["code", "part"], top), top).unionByName(_summary(cold, ["code"], top))
    best = F.array_join(F.transform(F.array_sort("best"), lambda b: b["id"]), ",")
    return out.select(
        F.expr("if(code = 'n', null, substring(code, 2))").alias("key"), "n_rows", "n_ids", "first_time", "last_time", best.alias("top_ids")
    )


def _ranked(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    """The newest ``top`` ids of each key, as an array of at most ``top`` entries."""
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("t"), F.asc_nulls_last("id"), F.desc_nulls_last("v"))
    kept = rows.where("id is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return kept.groupBy(*keys).agg(F.collect_list(F.struct("rank", "id", "t", "v")).alias("best"))


def _summary(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    """Sums and newest ids per key, from one row per (key, id): the id's own repeats are folded before they travel on."""
    per_id = rows.groupBy(*keys, "id").agg(
        F.count("*").alias("n"), F.min("t").alias("t0"), F.max(F.struct("t", "v")).alias("newest")
    )
    sums = per_id.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"), F.count("id").alias("n_ids"), F.min("t0").alias("first_time"), F.max("newest.t").alias("last_time")
    )
    best = _ranked(per_id.select(*keys, "id", F.col("newest.t").alias("t"), F.col("newest.v").alias("v")), keys, top)
    return sums.join(best, keys, "left")


def _folded(parts: DataFrame, top: int) -> DataFrame:
    """Unite the parts of each heavy key; the input has one row per part."""
    sums = parts.groupBy("code").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_ids").alias("n_ids"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time")
    )
    best = _ranked(parts.select("code", F.explode("best").alias("b")).select("code", "b.id", "b.t", "b.v"), ["code"], top)
    return sums.join(best, "code", "left").select("code", "n_rows", "n_ids", "first_time", "last_time", "best")
