"""Streams: windowed counts with a watermark, and points matched to areas as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoloom.operators.spatial import FOUND, _within


def windowed_counts(events: DataFrame, time: str = "ts", key: str = "event_type", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events and summed values per window and key; works on a stream and on a table alike."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    w = rows.groupBy(F.window(time, width), key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("window_start"), key, "n", "total")


def inside_areas(points: DataFrame, areas: DataFrame) -> DataFrame:
    """Points (``id, name, geometry``) of a stream or table that lie in one of the static areas; no state is kept."""
    return _within(points.select("id", "name", "geometry"), areas)


SCHEMA = FOUND
