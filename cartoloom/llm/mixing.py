"""Mixing sources to target weights with a cap on repeats.

Targets are met by capped water-filling on the small table of sources: a source whose target exceeds its size times
its largest number of repeats is clamped there, the weight it leaves goes to the others in proportion, and so on until
no source is above its cap.  Every source is then drawn as whole repetitions of all its documents plus a seeded
fraction: documents ordered by a hash until the rest of the target is filled.

The order by hash is cut in two steps, token sums of hash buckets first and then the rows of the one bucket in which
the cut falls, so that a source with a third of all rows is never sorted by one task.

Defined results: null keys and null or empty texts are dropped (they have no tokens); a document delivered twice
counts once; documents of a null source or of one without a target are not drawn, and those of a null source do not
count in the total; a source without documents reaches 0; ties of the hash go by key; empty tables give an empty draw;
extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartoloom.llm.tokens import VOCAB_DIR, VOCABULARY, with_tokens
from cartoloom.session import checkpointed

SEED = 11
ROWS_PER_BUCKET = 20_000
#: The table of targets is read to the driver; it must stay below this many sources.
MAX_SOURCES = 100_000


def water_fill(sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: float) -> dict[str, float]:
    """Tokens allotted to each source: proportional to its weight, at most its size times its repeats."""
    cap = {s: float(sizes.get(s, 0)) * r for s, (_, r) in targets.items()}
    got: dict[str, float] = {}
    open_ = {s for s, (w, _) in targets.items() if w > 0}
    rest = float(total)
    while open_:
        weight = sum(targets[s][0] for s in open_)
        over = {s for s in open_ if cap[s] <= rest * targets[s][0] / weight}
        if not over:
            got |= {s: rest * targets[s][0] / weight for s in open_}
            break
        for s in sorted(over):
            got[s] = cap[s]
        rest -= sum(cap[s] for s in over)
        open_ -= over
    return {s: got.get(s, 0.0) for s in targets}


def sized(docs: DataFrame, vocab_dir: str = VOCAB_DIR, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, source, tokens)`` of the distinct documents with a source and some text, checkpointed."""
    own = docs.select("doc_id", "source", "text").where("doc_id is not null and source is not null and text is not null and text <> ''")
    counted = with_tokens(own, vocab_dir=vocab_dir, vocabulary=vocabulary)
    return checkpointed(counted.groupBy("doc_id").agg(F.min(F.struct("source", "tokens")).alias("r")).select("doc_id", "r.source", "r.tokens"))


def _plan(counted: DataFrame, targets: DataFrame) -> list[dict]:
    """One entry per target source.  A source is below its target when the water-filling clamps it there: what it is
    allotted then is all that its largest number of repeats can give."""
    rows = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("w"), F.max("max_repeats").alias("r")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    spec = {r["source"]: (float(r["w"] or 0), int(r["r"] or 0)) for r in rows}
    total = counted.agg(F.sum("tokens")).first()[0] or 0
    named = counted.where(F.col("source").isin(list(spec))) if spec else counted.limit(0)
    sizes = {r["source"]: r["t"] for r in named.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    got = water_fill(sizes, spec, total)
    return [
        {
            "source": s, "target_share": w, "max_repeats": r, "source_tokens": int(sizes.get(s, 0)), "target_tokens": w * total, "allotted_tokens": got[s],
            "epochs": got[s] / sizes[s] if sizes.get(s) else 0.0, "below_target": got[s] < w * total * (1 - 1e-9),
        }
        for s, (w, r) in sorted(spec.items())
    ]


PLAN = (
    "source string, target_share double, max_repeats int, source_tokens bigint, target_tokens double, allotted_tokens double, epochs double, below_target boolean"
)


def mix_plan(docs: DataFrame, targets: DataFrame, **vocab) -> DataFrame:
    """What each source is allotted, how often it is repeated, and whether it stays below its target."""
    plan = _plan(sized(docs, **vocab), targets)
    names = [c.split(" ")[0] for c in PLAN.split(", ")]
    return docs.sparkSession.createDataFrame([tuple(p[n] for n in names) for p in plan], PLAN)


def _draw(counted: DataFrame, plan: list[dict], seed: int) -> DataFrame:
    spark = counted.sparkSession
    buckets = 64 * max(1, math.ceil(counted.count() / ROWS_PER_BUCKET))
    rows = []
    for p in plan:
        if p["allotted_tokens"] > 0:
            whole = min(int(p["epochs"] + 1e-12), p["max_repeats"])
            rows.append((p["source"], whole, max(0.0, p["allotted_tokens"] - whole * p["source_tokens"])))
    allotted = F.broadcast(spark.createDataFrame(rows, "source string, _whole int, _rest double"))  # one row per target source
    u = F.xxhash64("doc_id", F.lit(seed))
    own = counted.join(allotted, "source").withColumn("_u", u).withColumn("_b", F.expr(f"cast(floor((_u / 18446744073709551616D + 0.5D) * {buckets}) as int)"))
    sums = own.groupBy("source", "_b", "_rest").agg(F.sum("tokens").alias("_t"))
    lower = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cut = sums.withColumn("_low", F.coalesce(F.sum("_t").over(lower), F.lit(0))).where("_low < _rest").groupBy("source").agg(
        F.max("_b").alias("_cut"), F.max("_low").alias("_base")
    )
    marked = own.join(F.broadcast(cut), "source", "left")
    inside = Window.partitionBy("source").orderBy("_u", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    at_cut = marked.where("_b = _cut").withColumn("_run", F.col("_base") + F.sum("tokens").over(inside))
    at_cut = at_cut.withColumn("repeats", F.expr("_whole + if(_run - tokens / 2.0D <= _rest, 1, 0)"))
    others = marked.where("_cut is null or _b <> _cut").withColumn("repeats", F.expr("_whole + if(_cut is not null and _b < _cut, 1, 0)"))
    cols = ["doc_id", "source", "repeats", "tokens"]
    return at_cut.select(cols).unionByName(others.select(cols)).where("repeats > 0")


def mix(docs: DataFrame, targets: DataFrame, seed: int = SEED, **vocab) -> DataFrame:
    """``(doc_id, source, repeats, tokens)`` of the chosen documents."""
    counted = sized(docs, **vocab)
    return _draw(counted, _plan(counted, targets), seed)


def mix_report(docs: DataFrame, targets: DataFrame, seed: int = SEED, **vocab) -> DataFrame:
    """The plan with the tokens and shares that the draw actually reached."""
    counted = sized(docs, **vocab)
    plan = _plan(counted, targets)
    names = [c.split(" ")[0] for c in PLAN.split(", ")]
    base = docs.sparkSession.createDataFrame([tuple(p[n] for n in names) for p in plan], PLAN)
    drawn = _draw(counted, plan, seed).groupBy("source").agg(F.count("*").alias("n_documents"), F.sum(F.col("tokens") * F.col("repeats")).alias("drawn_tokens"))
    out = base.join(drawn, "source", "left").fillna(0, ["n_documents", "drawn_tokens"])
    whole = F.sum("drawn_tokens").over(Window.partitionBy(F.lit(1)))  # one row per target source
    return out.withColumn("reached_share", F.when(whole > 0, F.col("drawn_tokens") / whole).otherwise(F.lit(0.0)))
