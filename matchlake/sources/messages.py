"""Queue messages: base64 of a JSON payload with a batch of match ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake import config, schemas


def decode_messages(df: DataFrame, unknown: str = "UNKNOWN") -> DataFrame:
    """Decode the column ``data``; nothing raises, bad messages come with ``rejected``.

    Rejected are messages that are not base64, not UTF-8, not JSON, or without ids.
    """
    text = F.try_validate_utf8(F.try_to_binary("data", F.lit("base64")).cast("string"))
    payload = F.from_json(F.trim(text), schemas.MESSAGE)
    decoded = df.withColumn("_payload", payload)
    ids = F.col("_payload.match_ids")
    return decoded.select(
        *df.columns,
        F.coalesce("_payload.batch_id", F.lit(unknown)).alias("batch_id"),
        ids.alias("match_ids"),
        F.col("_payload.size").cast("long").alias("size"),
        (~F.coalesce(F.size(ids) > 0, F.lit(False))).alias("rejected"),
    )


def message_ids(decoded: DataFrame) -> DataFrame:
    """One row per batch and match id of the accepted messages."""
    return decoded.filter(~F.col("rejected")).select("batch_id", F.explode("match_ids").alias("match_id"))


def split_dead_letters(
    deliveries: DataFrame, limit: int = config.MAX_DELIVERIES
) -> tuple[DataFrame, DataFrame]:
    """Deliveries still to be tried, and those tried ``limit`` times already."""
    spent = F.coalesce(F.col("deliveries"), F.lit(0)) >= limit
    return deliveries.filter(~spent), deliveries.filter(spent)
