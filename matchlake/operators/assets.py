"""Addresses of champion and item icons still to be fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake import config
from matchlake.functions import asset_url, champion_source_url, set_number_of


def item_lookup(items: DataFrame) -> DataFrame:
    """Icon path per lower-case item id, the last entry by ``pos`` winning; blanks go."""
    named = items.select(F.lower("apiName").alias("api_name"), "icon", "pos")
    named = named.filter((F.col("api_name") != "") & (F.col("icon") != ""))
    return named.groupBy("api_name").agg(F.max_by("icon", "pos").alias("icon"))


def latest_set(sets: DataFrame) -> DataFrame:
    """The rows of the set with the highest number; a missing number counts as 0.

    ``sets`` has a row per set and item: ``set_pos``, ``number``, ``item``.
    """
    number = F.coalesce("number", F.lit(0))
    newest = sets.agg(F.max_by("set_pos", F.struct(number, -F.col("set_pos"))).alias("set_pos"))
    return sets.join(F.broadcast(newest), "set_pos", "left_semi")  # newest is one row


def pending_assets(wanted: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Wanted assets that are not stored yet."""
    return wanted if existing is None else wanted.join(existing.select(key), key, "left_anti")


def item_icon_urls(
    items: DataFrame,
    sets: DataFrame,
    existing: DataFrame | None = None,
    base: str = config.SOURCE_CDN_BASE,
) -> DataFrame:
    """Image address of every item of the latest set that the catalogue has an icon for.

    Both sides are reduced to one row per item id before they meet.
    """
    wanted = (
        latest_set(sets)
        .select(F.lower("item").alias("api_name"))
        .filter(F.col("api_name").isNotNull())
        .distinct()
    )
    found = pending_assets(wanted, existing, "api_name").join(item_lookup(items), "api_name")
    return found.select("api_name", asset_url(F.col("icon"), base).alias("icon_url"))


def distinct_champions(units: DataFrame) -> DataFrame:
    """Lower-case champion ids in order."""
    return units.select(F.lower("character_id").alias("id")).distinct().orderBy("id")


def distinct_items(units: DataFrame) -> DataFrame:
    """Item ids in order."""
    items = F.from_json("item_names_json", "array<string>", {"mode": "FAILFAST"})
    return units.select(F.explode(items).alias("item")).distinct().orderBy("item")


def champion_icon_urls(
    units: DataFrame, existing: DataFrame | None = None, base: str = config.SOURCE_CDN_BASE
) -> DataFrame:
    """Target path and source address per champion, minus the stored ones."""
    champions = units.select(F.lower("character_id").alias("id")).distinct().filter(F.col("id") != "")
    return pending_assets(champions, existing, "id").select(
        "id",
        set_number_of(F.col("id")).alias("set_number"),
        F.concat(F.lit("champions/"), F.col("id"), F.lit(".png")).alias("target_path"),
        champion_source_url(F.col("id"), base).alias("source_url"),
    )
