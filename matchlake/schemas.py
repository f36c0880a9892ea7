"""Schemas of documents, tables and messages.

Scalars inside JSON documents are read as text and then cast, so a number sent as a
JSON string is accepted and a malformed one raises under ANSI mode. Nested arrays
declared as STRING keep their JSON text.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


BRONZE = "metadata string, info string, date date"

METADATA = T.StructType(_text("match_id", "data_version"))

INFO = T.StructType(
    _text(
        "gameId",
        "game_datetime",
        "game_length",
        "game_version",
        "queue_id",
        "tft_set_core_name",
        "tft_set_number",
        "tft_game_type",
        "endOfGameResult",
        "participants",
    )
)

PARTICIPANTS = T.ArrayType(
    T.StructType(
        _text(
            "puuid",
            "riotIdGameName",
            "riotIdTagline",
            "placement",
            "win",
            "level",
            "last_round",
            "gold_left",
            "players_eliminated",
            "total_damage_to_players",
            "time_eliminated",
            "traits",
            "units",
        )
        + [T.StructField("companion", T.StructType(_text("species")))]
    )
)

# The same document for readers that take it apart in one pass.
DOCUMENT = T.StructType(
    [
        T.StructField("metadata", METADATA),
        T.StructField(
            "info",
            T.StructType([*INFO.fields[:-1], T.StructField("participants", PARTICIPANTS)]),
        ),
        T.StructField("date", T.DateType()),
    ]
)

TRAITS = T.ArrayType(T.StructType(_text("name", "num_units", "tier_current", "tier_total", "style")))

UNITS = T.ArrayType(T.StructType(_text("character_id", "tier", "rarity", "itemNames")))

MESSAGE = "match_ids array<string>, batch_id string, size int"

ITEM_CATALOGUE = (
    "items array<struct<apiName:string,icon:string>>, "
    "setData array<struct<number:long,items:array<string>>>"
)

LEDGER_EVENT = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("retries", T.LongType()),
        T.StructField("last_error", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("dlq_attempts", T.LongType()),
        T.StructField("requeue", T.BooleanType()),
    ]
)

# Model and column descriptions; ``describe`` attaches them as field metadata.
DESCRIPTIONS: dict[str, dict[str, str]] = {
    "raw_matches": {
        "": "one JSON document per match",
        "metadata": "identity block of the document",
        "info": "game block of the document with its participants",
        "date": "ingestion date, taken from the folder name",
    },
    "stg_matches": {"": "one typed row per match document"},
    "fact_player_results": {
        "": "one row per player and match",
        "match_id": "match identifier",
        "puuid": "player identifier",
        "placement": "final rank in the match, 1 is best",
        "win": "won the match",
        "level": "player level at the end",
    },
    "fact_traits": {
        "": "one row per trait, player and match",
        "trait_name": "trait identifier",
        "tier_current": "reached trait tier, 0 when inactive",
    },
    "fact_units": {
        "": "one row per unit copy, player and match",
        "character_id": "champion identifier",
        "tier": "star level",
    },
    "unit_winrate": {"": "top-4 and win rates per champion, star level and rarity"},
    "core_comp_winrate": {"": "top-4 and win rates per composition and primary trait"},
    "item_combo_winrate": {"": "top-4 and win rates per champion and item build"},
}


def describe(df, table: str):
    """Attach the known column descriptions of ``table`` to its schema."""
    for name, comment in DESCRIPTIONS.get(table, {}).items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": comment})
    return df
