"""The five logical views over the raw map tables: flat columns, fixed names, optional newest versions only."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Languages of the name columns, in their order.
LANGUAGES = "fr es it de en pt ru uk nl pl th zh ar".split()
# Languages searched for a place name, beside the primary name.
SEARCHED = "fr es it de en pt".split()
# Fixed values: (subtype, class) pairs of the infrastructure view.
PAIRS = """
transit parking
transit parking_space
bridge bridge
transit bus_stop
transit bicycle_parking
transit railway_station
transit subway_station
transit railway_halt
transit bus_station
aerialway aerialway_station
pedestrian toilets
waste_management waste_basket
waste_management recycling
waste_management waste_disposal
airport airport
airport international_airport
airport regional_airport
airport municipal_airport
airport military_airport
airport private_airport
airport heliport
airport helipad
airport runway
airport taxiway
airport taxilane
airport apron
airport airport_gate
airport airstrip
airport stopway
communication communication_tower
communication mobile_phone_tower
communication communication_pole
communication communication_line
"""
ALLOWED = [tuple(line.split()) for line in PAIRS.strip().split("\n")]
# Categories of which a place must have one.
CATEGORIES = "restaurant lodging school hospital shopping_mall grocery_store".split()

NAME_COLUMNS = ["name", *(f"name_{x}" for x in LANGUAGES)]
SEARCH_COLUMNS = ["name", *(f"name_{x}" for x in SEARCHED)]


def newest(raw: DataFrame) -> DataFrame:
    """One row per id: the highest version, then the latest times."""
    w = Window.partitionBy("id").orderBy(F.desc_nulls_last("version"), F.desc_nulls_last("update_time"), F.desc_nulls_last("loaded_at"))
    return raw.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _names() -> list:
    return [F.col("names.primary").alias("name"), *(F.col("names.common")[x].alias(f"name_{x}") for x in LANGUAGES)]


def divisions(raw: DataFrame) -> DataFrame:
    return raw.select("id", *_names(), "country", "subtype", "class", "admin_level", "population", "geometry")


def division_areas(raw: DataFrame) -> DataFrame:
    return raw.select("id", "division_id", *_names(), "country", "subtype", "class", "is_land", "is_territorial", "geometry")


def infrastructures(raw: DataFrame) -> DataFrame:
    """Only the pairs of ``ALLOWED``, as an OR of equalities, which the Parquet reader can push down."""
    keep = None
    for subtype, klass in ALLOWED:
        one = (F.col("subtype") == subtype) & (F.col("class") == klass)
        keep = one if keep is None else keep | one
    return raw.where(keep).select("id", *_names(), "subtype", "class", "level", "geometry")


def water(raw: DataFrame) -> DataFrame:
    return raw.select("id", *_names(), "subtype", "class", "is_salt", "is_intermittent", "geometry")


def places(raw: DataFrame) -> DataFrame:
    kept = raw.where(F.arrays_overlap("taxonomy.hierarchy", F.array(*[F.lit(c) for c in CATEGORIES])))
    return kept.select(
        "id", F.col("names.primary").alias("name"), F.col("taxonomy.primary").alias("category"), F.col("taxonomy.hierarchy").alias("category_hierarchy"), "geometry"
    )


VIEWS = {f.__name__: f for f in (divisions, division_areas, infrastructures, water, places)}


def open_views(spark: SparkSession, root: str, latest: bool = False, register: bool = False) -> dict[str, DataFrame]:
    """All views over the Parquet tables below ``root`` (any file system Spark can read)."""
    out = {}
    for name, view in VIEWS.items():
        raw = spark.read.parquet(f"{root}/{name}.parquet")
        out[name] = view(newest(raw) if latest else raw)
        if register:
            out[name].createOrReplaceTempView(name)
    return out


def in_box(raw: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rows whose stored box meets the given one; the comparisons on the struct's fields are pushed to the reader."""
    return raw.where((F.col("bbox.xmax") >= xmin) & (F.col("bbox.xmin") <= xmax) & (F.col("bbox.ymax") >= ymin) & (F.col("bbox.ymin") <= ymax))


def open_partitioned(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """One feature type of a release laid out as ``theme=<theme>/type=<type>/``; other types are not even listed."""
    return spark.read.option("basePath", root).parquet(f"{root}/theme=*/type={kind}")


@F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("xmin", "xmax", "ymin", "ymax")]))
def box_of(g: pd.Series) -> pd.DataFrame:
    """The box of a shape; null where there is none."""
    from cartoloom.geo.wkb import decode

    rows = []
    for raw in g:
        s = decode(raw)
        x0, y0, x1, y1 = s.bbox if s is not None else (None,) * 4
        rows.append((x0, x1, y0, y1))
    return pd.DataFrame(rows, columns=["xmin", "xmax", "ymin", "ymax"], dtype="float64")


def ingest(raw: DataFrame, path: str, box: tuple[float, float, float, float] | None = None, degrees: float = 5.0, mode: str = "overwrite") -> None:
    """Write the features that meet a box (xmin, ymin, xmax, ymax; all without one), each with its own box stored.

    Rows are ranged by cells of the given width, so that row groups cover small regions and later scans with ``in_box``
    skip the others.  Features without a shape are left out.
    """
    own = raw if "bbox" in raw.columns else raw.withColumn("bbox", box_of("geometry"))
    own = own.where("bbox is not null and bbox.xmin is not null")
    if box is not None:
        own = in_box(own, *box)
    cell = [F.floor(F.col("bbox.ymin") / degrees), F.floor(F.col("bbox.xmin") / degrees)]
    own.repartitionByRange(*cell).sortWithinPartitions(*cell).write.mode(mode).parquet(path)
