"""Item catalogue: one JSON document with all items and the item lists of all sets."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import schemas


class Catalogue(NamedTuple):
    """``items``: pos, apiName, icon. ``sets``: set_pos, number, item (one row per item)."""

    items: DataFrame
    sets: DataFrame


def read_item_catalogue(spark: SparkSession, path: str) -> Catalogue:
    """Read the document; one without an item list, as a truncated one, raises."""
    document = spark.read.schema(schemas.ITEM_CATALOGUE).option("multiLine", True).json(path)
    broken = F.raise_error(F.lit(f"no item catalogue in {path}"))
    document = document.withColumn("items", F.coalesce("items", broken)).withColumn(
        "setData", F.when(F.size("items") >= 0, F.col("setData"))
    )
    items = document.select(F.posexplode("items").alias("pos", "item")).select(
        F.col("pos").cast("long").alias("pos"), "item.apiName", "item.icon"
    )
    sets = document.select(F.posexplode("setData").alias("set_pos", "s")).select(
        F.col("set_pos").cast("long").alias("set_pos"),
        F.col("s.number").alias("number"),
        F.explode_outer("s.items").alias("item"),
    )
    return Catalogue(items, sets)
