"""Which copies of the bronze documents count.

Bronze files are only ever added, so a document that changed lies in several files of its date, and
the newest file's copy counts. Two narrow tables beside the documents say so without reading them:

* ``index``: (date, key, content digest, file, file time) of every document in a file;
* ``replaced``: (date, key, file) of the copies that no longer count, for dates that have any.

Both are made from the files themselves. Whatever file of a date the index lacks (left by another
writer, or by a write that was cut off) is indexed at the next write to that date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.sources import files, partitions, scratch
from matchlake.sources.partitions import Dataset

INDEX = "key string, content string, file string, file_time timestamp, date date"
#: A list of this many copies or less is sent to every task that reads documents.
BROADCAST_ROWS = 500_000


def match_id_of(metadata: Column) -> Column:
    return F.from_json(metadata, schemas.METADATA)["match_id"]


def content_digest(metadata: Column, info: Column) -> Column:
    return F.sha2(F.concat_ws("|", metadata, info), 256)


def document_key(metadata: Column, info: Column) -> Column:
    """The match id; documents without one go by their content."""
    return F.coalesce(match_id_of(metadata), F.concat(F.lit("#"), content_digest(metadata, info)))


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` if a count says that it is small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


class Copies:
    """The two tables of one bronze folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.index = f"{self.root}/_copies/index"
        self.replaced = Dataset(spark, f"{self.root}/_copies/replaced", "date")

    def _rows(self, dates: list[date | None]) -> DataFrame | None:
        if not files.has_data(self.spark, self.index):
            return None
        return self.spark.read.schema(INDEX).parquet(self.index).filter(partitions.touched("date", dates))

    def newest(self, dates: list[date | None]) -> DataFrame | None:
        """(date, key, content) of the copies that count."""
        rows = self._rows(dates)
        return None if rows is None else _ranked(rows).filter("_rank = 1").select("date", "key", "content")

    def record(self, dates: list[date | None]) -> None:
        """Index the files of ``dates`` that are not indexed, and list the copies they replace."""
        rows = self._rows(dates)
        # a date's files are few and large
        seen = set() if rows is None else {(r.date, r.file) for r in rows.select("date", "file").distinct().collect()}
        missing = []
        for day in dates:
            folder = f"{self.root}/{partitions.folder_of('date', day)}"
            names = [n for n in files.names(self.spark, folder) if not n.startswith(("_", "."))]
            missing += [f"{folder}/{n}" for n in names if (day, n) not in seen]
        if not missing:
            return
        added = self.spark.read.schema(schemas.BRONZE).option("mode", "FAILFAST").option("basePath", self.root).json(missing)
        metadata, info = (F.translate(c, "\r\n", "  ") for c in ("metadata", "info"))
        added.select(
            document_key(metadata, info).alias("key"),
            content_digest(metadata, info).alias("content"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_modification_time").alias("file_time"),
            "date",
        ).write.mode("append").options(**scratch.PACKED).partitionBy("date").parquet(self.index)
        older = _ranked(self._rows(dates)).filter("_rank > 1").select("key", "file", "date")
        if self.replaced.live() is not None or not older.isEmpty():
            self.replaced.replace(older, dates if self.replaced.live() is not None else None)

    def drop(self, documents: DataFrame, key: Column, date_column: str) -> DataFrame:
        """``documents`` (with ``source_file``) without the copies that are replaced.

        Dates without such copies are read as they are. On the others the list is compared; as long
        as it has at most ``BROADCAST_ROWS`` rows no document is shuffled.
        """
        prefix = "date="
        names = [p.removeprefix(prefix) for p in self.replaced.partitions()]
        if not names:
            return documents
        dates = [None if n == partitions.NULL_FOLDER else date.fromisoformat(n) for n in names]
        listed = self.replaced.read().select(
            F.col("date").alias("_date"), F.col("key").alias("_key"), F.col("file").alias("_file")
        )
        concerned = F.coalesce(partitions.touched(date_column, dates), F.lit(False))
        name = F.element_at(F.split("source_file", "/"), -1)
        same = F.col(date_column).eqNullSafe(F.col("_date")) & (key == F.col("_key")) & (F.url_decode(name) == F.col("_file"))
        left = documents.filter(concerned).join(bounded(listed), same, "left_anti")
        return documents.filter(~concerned).unionByName(left)


def _ranked(rows: DataFrame) -> DataFrame:
    order = [F.col("file_time").desc(), F.col("file").desc()]
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy("date", "key").orderBy(*order)))
