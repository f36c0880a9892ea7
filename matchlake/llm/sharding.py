"""Contiguous shards of equal bytes, from a global prefix sum over per-block totals.

DataFrame functions only. Rows are dealt into ranges of the order columns, and each range (a
block) is summed by itself; the running sum of the block totals gives every block its place
in the whole, and a window inside the block gives every row its place. A shard is an equal
cut of that byte line. No task sees more than one block, whatever the number of shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import Scratch, pack, replace_columns

#: Bytes that a row takes besides its text.
ROW_OVERHEAD = 8
ROWS_PER_BLOCK = 200_000
MADE = ["size", "text_crc32", "shard", "slot"]


def assign_shards(
    docs: DataFrame,
    n_shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_block: int = ROWS_PER_BLOCK,
    carry: list[str] | None = None,
) -> DataFrame:
    """``docs`` with size, text_crc32, shard and slot; contiguous in the order of ``id_col``.

    A row lies in the shard that holds the middle of its bytes, so no shard misses the equal
    share by more than its longest rows. Slots count from 0 without gaps in every shard.
    NULL ids come first; rows of one id are ordered by size, checksum and place in the input.
    A NULL text has 0 bytes and the checksum 0. An empty table gives an empty result; with
    fewer rows than shards some shards stay empty. Columns of ``docs`` named like a result
    column are replaced. Only the columns of ``carry`` (all by default) are moved and written.
    ``2 * n_shards * total bytes`` must stay below 2**63, else the sum raises.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    text = F.col(f"`{text_col}`").cast("binary")
    sized = docs.select(
        pack(docs.select(*[f"`{x}`" for x in carry]) if carry else docs),
        F.col(f"`{id_col}`").alias("_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_OVERHEAD).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("_at"),
    )
    order = ["_id", "size", "text_crc32", "_at"]
    blocks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // rows_per_block)
    )
    placed = scratch.save(
        sized.repartitionByRange(blocks, *order).withColumn("_block", F.spark_partition_id()),
        "blocks",
    )

    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy("_block").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    starts = (
        placed.groupBy("_block")
        .agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_block",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
            F.sum("_bytes").over(everywhere).alias("_total"),
        )
    )
    inside = Window.partitionBy("_block").orderBy(*order)
    sums = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    # one row per block: rows / rows_per_block of them, a few bytes each
    numbered = (
        placed.withColumn("_end", sums)
        .withColumn("_n", F.row_number().over(inside))
        .join(F.broadcast(starts), "_block")
        .withColumn("_middle", 2 * (F.col("_byte0") + F.col("_end")) - F.col("size"))
        .withColumn(
            "shard",
            F.least(
                F.expr(f"(_middle * {int(n_shards)}L) div (2 * _total)"), F.lit(n_shards - 1)
            ).cast("int"),
        )
        .withColumn("_index", F.col("_row0") + F.col("_n") - 1)
    )
    firsts = numbered.groupBy("shard").agg(F.min("_index").alias("_first"))
    result = numbered.join(F.broadcast(firsts), "shard").withColumn(
        "slot", (F.col("_index") - F.col("_first")).cast("long")
    )
    return replace_columns(result, "_row", MADE)


def shard_table(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, the law (equal bytes), shard, slot; carries nothing but the id."""
    placed = assign_shards(docs, n_shards, carry=["doc_id"])
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the result of ``assign_shards`` as one folder per shard, rows in slot order.

    Rows are dealt by ranges of (shard, slot): a shard of any size is written by many tasks
    and its files follow each other in slot order.
    """
    (
        sharded.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .mode("errorifexists")
        .parquet(path)
    )
