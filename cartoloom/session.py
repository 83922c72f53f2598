"""Session helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g", **conf) -> SparkSession:
    """A local session with the settings the tests and the bench share."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cartoloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` in the folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``.  Only a local session may leave that setting out (tests, a
    laptop); then the helper chooses a temporary folder itself.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        chosen = spark.conf.get("spark.checkpoint.dir", "")
        if not chosen and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(chosen or os.path.join(tempfile.gettempdir(), f"cartoloom-{sc.applicationId}"))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Let the executors import this package, wherever the driver was started from; once per application."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_cartoloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="cartoloom-")) / "cartoloom.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*")):
            if p.is_file() and "__pycache__" not in p.parts:
                z.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(str(to))
    sc._cartoloom_shipped = True
