"""Helpers that several operators share: tables, shared scratch space, column packing."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A frame of at most this many rows, counted first, may be broadcast.
BROADCAST_ROWS = 500_000
#: Rows of a few numbers that one task writes.
ROWS_PER_FILE = 200_000


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return folder.rstrip("/")


class Scratch:
    """Written tables in the shared folder, which cut lineage and survive lost executors.

    ``drop`` removes a table nobody reads any more; the rest goes when Python ends, as a
    returned frame still reads it.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.folder)

    def save(self, frame: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write and read again. ``rows``, an upper bound known by counting, keeps files few."""
        path = f"{self.folder}/{name}"
        if rows is not None:
            frame = frame.coalesce(rows // ROWS_PER_FILE + 1)
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, name: str) -> None:
        self._remove(f"{self.folder}/{name}")

    def _remove(self, folder: str) -> None:
        context = self.spark.sparkContext
        if context._jsc is None:
            return
        try:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the session has ended already; a leftover folder does no harm
            return


def bounded(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``frame`` if a count shows that it has at most ``rows`` rows."""
    few = frame.limit(rows + 1).count() <= rows
    return F.broadcast(frame) if few else frame


def replace_columns(frame: DataFrame, packed: str, made: list[str]) -> DataFrame:
    """Unpack the struct column ``packed``; of clashing names the columns of ``made`` stay."""
    names = {x.lower() for x in made}
    kept = [
        F.col(packed)[name].alias(name)
        for name in frame.schema[packed].dataType.fieldNames()
        if name.lower() not in names
    ]
    return frame.select(*kept, *made)


def text_key(text: Column) -> Column:
    """128 bits of a text, by which rows of one id are told apart; NULL counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def pack(frame: DataFrame, name: str = "_row") -> Column:
    """All columns of ``frame`` as one struct, so that new columns clash with none."""
    return F.struct(*[F.col(f"`{x}`") for x in frame.columns]).alias(name)


def number_rows(
    frame: DataFrame, order: list, scratch: Scratch, name: str, rows_per_block: int = 200_000
) -> DataFrame:
    """``frame`` with ``_index``, the place of each row in the whole order, from 0.

    Ranges of the order are numbered by themselves and moved by the rows of the ranges before.
    Rows that the order leaves alike are told apart by their place in the input.
    """
    spark = frame.sparkSession
    named = [x if isinstance(x, Column) else F.col(x) for x in order]
    blocks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-frame.count() // rows_per_block)
    )
    dealt = frame.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(blocks, *named, "_at")
    placed = scratch.save(dealt.withColumn("_block", F.spark_partition_id()), name)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"))
    )
    inside = Window.partitionBy("_block").orderBy(*named, "_at")
    # one row per block: rows / rows_per_block of them
    numbered = placed.withColumn("_n", F.row_number().over(inside)).join(F.broadcast(starts), "_block")
    return numbered.withColumn("_index", F.col("_row0") + F.col("_n") - 1).drop("_n", "_row0", "_block", "_at")
