"""Bronze documents to typed match rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake import schemas

STRICT = {"mode": "FAILFAST"}


def audit_time(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def stage_matches(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One typed row per match document; documents without a match id are dropped.

    Each of the two JSON blocks is parsed once with a fixed schema. The participants
    stay JSON text, to be exploded by ``player_results``.
    """
    source_file = F.col("source_file") if "source_file" in bronze.columns else F.lit(None).cast("string")
    parsed = bronze.select(
        F.from_json("metadata", schemas.METADATA, STRICT).alias("m"),
        F.from_json("info", schemas.INFO, STRICT).alias("i"),
        F.col("date").alias("ingestion_date"),
        source_file.alias("source_file"),
    ).filter(F.col("m.match_id").isNotNull())
    return parsed.select(
        F.col("m.match_id").alias("match_id"),
        F.col("m.data_version").alias("data_version"),
        F.col("i.gameId").cast("bigint").alias("game_id"),
        F.timestamp_millis(F.col("i.game_datetime").cast("bigint")).alias("game_datetime"),
        F.col("i.game_length").cast("double").alias("game_length_seconds"),
        F.col("i.game_version").alias("game_version"),
        F.col("i.queue_id").cast("bigint").alias("queue_id"),
        F.col("i.tft_set_core_name").alias("tft_set_core_name"),
        F.col("i.tft_set_number").cast("bigint").alias("tft_set_number"),
        F.col("i.tft_game_type").alias("tft_game_type"),
        F.col("i.endOfGameResult").alias("end_of_game_result"),
        F.col("i.participants").alias("participants_json"),
        "ingestion_date",
        "source_file",
        audit_time(as_of).alias("dbt_updated_at"),
    )
