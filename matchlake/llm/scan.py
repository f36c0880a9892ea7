"""Running totals inside keys of any size.

Rows are dealt into ranges of (key, order), the blocks. A window totals every key inside its block;
a key that goes on from one block to the next is moved by the totals of the blocks before, of
which there are two rows per block at most. So no task sees more than a block, whatever share of
the rows one key holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import Scratch

ROWS_PER_BLOCK = 200_000
#: How totals are taken and put together.
SUM = (F.sum, lambda a, b: a + b)
XOR = (F.bit_xor, lambda a, b: a.bitwiseXOR(b))


def place(
    frame: DataFrame, order: list[str], rows: int, scratch: Scratch, name: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """``frame`` written in ranges of ``order``, with the range in ``_block``; ``rows`` bounds its length."""
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(parts, -(-rows // rows_per_block))
    dealt = frame.repartitionByRange(blocks, *order)
    return scratch.save(dealt.withColumn("_block", F.spark_partition_id()), name)


def running(placed: DataFrame, key: str, order: list[str], values: dict[str, tuple[tuple, Column]]) -> DataFrame:
    """``placed`` with running totals per ``key``, each row's own value included.

    ``values`` has for every new column how to total (``SUM``, ``XOR``) and what; ``key`` is never NULL.
    """
    inside = Window.partitionBy("_block", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.groupBy("_block").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    both = ends.select(F.explode(F.array_distinct(F.array("first", "last"))).alias(key))
    going_on = both.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    # a key in several blocks is the first or the last of each: two rows per block at most
    totals = (
        placed.join(F.broadcast(going_on), key, "left_semi")
        .groupBy("_block", key)
        .agg(*[total(value).alias(f"_{name}") for name, ((total, _), value) in values.items()])
    )
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    moved = totals.select(
        "_block",
        key,
        *[F.coalesce(total(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name, ((total, _), _) in values.items()],
    )
    own = placed.select("*", *[total(value).over(inside).alias(name) for name, ((total, _), value) in values.items()])
    joined = own.join(F.broadcast(moved), ["_block", key], "left")
    whole = {name: join(F.col(name), F.coalesce(f"_{name}", F.lit(0))) for name, ((_, join), _) in values.items()}
    return joined.select(*placed.columns, *[c.alias(name) for name, c in whole.items()])
