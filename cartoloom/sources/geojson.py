"""GeoJSON out of rows with a WKB geometry."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoloom.geo.wkb import Shape, decode


def geometry_json(shape: Shape | None) -> dict | None:
    """The geometry object of a shape; ``None`` for no shape."""
    if shape is None:
        return None
    paths = [p.tolist() for p in shape.paths]
    if shape.kind == "POINT":
        c = paths[0][0]
    elif shape.kind == "LINESTRING":
        c = paths[0]
    elif shape.kind in ("POLYGON", "MULTILINESTRING"):
        c = paths
    elif shape.kind == "MULTIPOINT":
        c = [p[0] for p in paths]
    elif shape.kind == "MULTIPOLYGON":
        parts: dict[int, list] = {}
        for p, o in zip(paths, shape.owners):
            parts.setdefault(o, []).append(p)
        c = list(parts.values())
    else:
        return None
    kinds = {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon", "MULTIPOINT": "MultiPoint", "MULTILINESTRING": "MultiLineString", "MULTIPOLYGON": "MultiPolygon"}
    return {"type": kinds[shape.kind], "coordinates": c}


def features(rows: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One GeoJSON feature per row (column ``feature``); every other column becomes a property."""
    others = [c for c in rows.columns if c != geometry]
    props = F.to_json(F.struct(*others), {"ignoreNullFields": "false"}) if others else F.lit("{}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [
                f'{{"type":"Feature","geometry":{json.dumps(geometry_json(decode(g)), separators=(",", ":"))},"properties":{p}}}'
                for g, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["feature"])

    return rows.select(F.col(geometry).alias("g"), props.alias("p")).mapInArrow(run, "feature string")


def feature_collection(rows: DataFrame, geometry: str = "geometry") -> dict:
    """The whole result as one collection, for results meant to be shown on a map."""
    return {"type": "FeatureCollection", "features": [json.loads(r["feature"]) for r in features(rows, geometry).toLocalIterator()]}
