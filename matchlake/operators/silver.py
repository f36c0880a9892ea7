"""Staged matches to player, trait and unit facts. All three are narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake import config, schemas
from matchlake.functions import json_bool, patch_of
from matchlake.operators.staging import STRICT, audit_time

CONTEXT = ["match_id", "patch", "puuid", "game_datetime", "tft_set_number", "placement", "top4", "win"]


def player_results(
    staged: DataFrame,
    patch_pattern: str = config.PATCH_PATTERN,
    top: int = config.TOP_PLACEMENT,
    as_of: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per player and match. Matches without participants give no rows.

    ``staged`` carries the participants as JSON text, or as an array where the reader has
    taken the documents apart already. ``keep`` names further columns to carry.
    """
    if "participants" in staged.columns:
        participants = F.col("participants")
    else:
        participants = F.from_json("participants_json", schemas.PARTICIPANTS, STRICT)
    players = staged.select(
        "match_id",
        "game_datetime",
        "tft_set_number",
        "ingestion_date",
        patch_of(F.col("game_version"), patch_pattern).alias("patch"),
        *keep,
        F.explode(participants).alias("p"),
    )
    placement = F.col("p.placement").cast("bigint")
    return players.select(
        "match_id",
        "game_datetime",
        "tft_set_number",
        "ingestion_date",
        "patch",
        F.col("p.puuid").alias("puuid"),
        F.col("p.riotIdGameName").alias("riot_id_game_name"),
        F.col("p.riotIdTagline").alias("riot_id_tagline"),
        placement.alias("placement"),
        json_bool(F.col("p.win")).alias("win"),
        F.col("p.level").cast("bigint").alias("level"),
        F.col("p.last_round").cast("bigint").alias("last_round"),
        F.col("p.gold_left").cast("bigint").alias("gold_left"),
        F.col("p.players_eliminated").cast("bigint").alias("players_eliminated"),
        F.col("p.total_damage_to_players").cast("bigint").alias("total_damage_to_players"),
        F.col("p.time_eliminated").cast("double").alias("time_eliminated_seconds"),
        (placement <= top).alias("top4"),
        F.col("p.traits").alias("traits_json"),
        F.col("p.units").alias("units_json"),
        F.col("p.companion.species").alias("companion_species"),
        audit_time(as_of).alias("dbt_updated_at"),
        *keep,
    )


def trait_facts(players: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per trait, player and match."""
    traits = players.select(
        *CONTEXT,
        "ingestion_date",
        F.explode(F.from_json("traits_json", schemas.TRAITS, STRICT)).alias("t"),
    )
    tier = F.col("t.tier_current").cast("bigint")
    return traits.select(
        *CONTEXT,
        F.col("t.name").alias("trait_name"),
        F.col("t.num_units").cast("bigint").alias("num_units"),
        tier.alias("tier_current"),
        F.col("t.tier_total").cast("bigint").alias("tier_total"),
        F.col("t.style").cast("bigint").alias("style"),
        (tier > 0).alias("is_active"),
        "ingestion_date",
        audit_time(as_of).alias("dbt_updated_at"),
    )


def unit_facts(players: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per unit copy, player and match, numbered by champion and star level.

    A player's units lie in one row and ``(match_id, puuid)`` is the players' key, so the
    numbering is a sort inside the row instead of a window over a shuffle. Star levels
    compare as text; identical copies keep the order of the document.
    """
    board = F.transform(
        F.from_json("units_json", schemas.UNITS, STRICT),
        lambda unit, index: F.struct(
            unit["character_id"].alias("character_id"),
            unit["tier"].alias("tier"),
            index.alias("index"),
            unit["rarity"].alias("rarity"),
            unit["itemNames"].alias("items"),
        ),
    )
    units = players.select(
        *CONTEXT, "ingestion_date", F.posexplode(F.sort_array(board)).alias("index", "u")
    )
    position = F.col("index").cast("bigint") + 1
    return units.select(
        F.concat("match_id", F.lit("_"), "puuid", F.lit("_"), position.cast("string")).alias("unit_key"),
        *CONTEXT,
        position.alias("unit_position"),
        F.col("u.character_id").alias("character_id"),
        F.col("u.tier").cast("bigint").alias("tier"),
        F.col("u.rarity").cast("bigint").alias("rarity"),
        F.col("u.items").alias("item_names_json"),
        F.json_array_length("u.items").cast("bigint").alias("item_count"),
        "ingestion_date",
        audit_time(as_of).alias("dbt_updated_at"),
    )
