"""JSON lines in and out, and parts by template with append, overwrite and merge."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON object per line, with a given schema; malformed lines are kept as rows of nulls."""
    return spark.read.schema(schema).json(path)


def write(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).json(path)


def write_parts(rows: DataFrame, path: str, by: str = "template", mode: str = "overwrite") -> None:
    """One folder per value of ``by``; overwriting replaces only the parts that the rows contain."""
    w = rows.write.partitionBy(by).mode(mode)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def merged(spark: SparkSession, path: str) -> DataFrame:
    """All parts together."""
    return spark.read.parquet(path)


def merge_parts(spark: SparkSession, path: str, target: str, order: list[str], mode: str = "overwrite", by: str = "template") -> list[str]:
    """Write the parts of ``path`` into one data set, in the given order, and return the missing parts, each also warned of.

    ``mode``: ``overwrite`` replaces the target, ``merge`` adds to it, ``cancel`` leaves it alone where it exists.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    there = lambda p: hadoop.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop.Path(p))
    if mode not in ("overwrite", "merge", "cancel"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "cancel" and there(target):
        return []
    missing = [t for t in order if not there(f"{path}/{by}={t}")]
    for t in missing:
        warnings.warn(f"no part for {t}; it is left out", stacklevel=2)
    own = [t for t in order if t not in missing]
    if own:
        rank = F.create_map(*[F.lit(x) for kv in enumerate(own) for x in reversed(kv)])
        rows = merged(spark, path).where(F.col(by).isin(own)).withColumn("_rank", rank[F.col(by)]).orderBy("_rank").drop("_rank")
        rows.write.mode("append" if mode == "merge" else "overwrite").json(target)
    return missing
