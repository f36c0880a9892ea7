"""Stored tables whose content is replaced as a whole or not at all.

Every write goes to new folders, ``<partition>/gen=<id>``; nothing a reader may have open is
touched. Then one small numbered note is put in place that lists the live folder of every
partition, and the schema. Readers open what the newest note lists, so they see the table as
it was or as it is now, whatever a write was cut off at. Folders that neither the newest nor
the last note but one lists are removed. A table has one writer at a time.

What readers look for may be laid out for them: a table that is rebuilt as a whole is sorted
(``order``) into small row groups, and files of a table that is searched for keys carry Bloom
filters of these (``bloom``). Scans then skip row groups by their own statistics.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.operators.quality import Watch
from matchlake.sources import files, scratch

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
GENERATION = "gen"
# Row groups and pages of sorted tables: small, as these are what a scan can skip.
SORTED_ROW_GROUP_BYTES = 4 << 20
SORTED_PAGE_ROWS = 1000


def folder_of(column: str, value: date | None) -> str:
    return f"{column}={NULL_FOLDER if value is None else value.isoformat()}"


def touched(column: str, values: list[date | None]) -> Column:
    """Filter on the touched partitions; literals, so that the scan prunes folders."""
    dates = [v for v in values if v is not None]
    inside = F.col(column).isin(dates) if dates else F.lit(False)
    return inside | F.col(column).isNull() if None in values else inside


def partition_values(df: DataFrame, column: str) -> list[date | None]:
    """Distinct partition values of ``df``: one per day, however many rows there are."""
    return [row[0] for row in df.select(column).distinct().collect()]


class Dataset:
    """A parquet table below ``path``, partitioned by a date ``column`` or not at all.

    ``order`` sorts the files of a table without partitions by those of its columns it names.
    """

    def __init__(
        self, spark: SparkSession, path: str, column: str | None = None, order: tuple[str, ...] = ()
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.column = column
        self.order = order

    def _notes(self) -> list[int]:
        return sorted(int(n) for n in files.names(self.spark, f"{self.path}/_live") if n.isdigit())

    def _note(self, number: int) -> dict:
        return files.read_note(self.spark, f"{self.path}/_live/{number:010d}") or {}

    def live(self) -> dict | None:
        """The newest note: schema, live folders, and columns only old files have."""
        notes = self._notes()
        return self._note(notes[-1]) if notes else None

    def _open(self, schema: T.StructType, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(GENERATION, T.StringType())])
        reader = self.spark.read.schema(stored).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders]).select(*schema.fieldNames())

    def read(self) -> DataFrame:
        note = self.live()
        if note is None:
            raise LookupError(f"no table in {self.path}")
        return self._open(T.StructType.fromJson(note["schema"]), note["folders"])

    def partitions(self) -> list[str]:
        """Names of the live partition folders."""
        note = self.live()
        return sorted(f.split("/")[0] for f in note["folders"]) if note else []

    def replace(
        self,
        df: DataFrame,
        values: list[date | None] | None = None,
        check: Callable[[DataFrame], None] | None = None,
        stale: list[str] | None = None,
        made_of: dict[str, list[str]] | None = None,
        watch: Watch | None = None,
        bloom: str | None = None,
    ) -> None:
        """Make ``df`` the whole content of the partitions ``values``, or of the table.

        ``check`` sees the new content before it counts, and may raise; ``watch`` judges counts
        that the write itself has taken, without a second look. Rows are rebalanced
        by partition: a date becomes a few files of good size however many tasks held its
        rows, and a large date is split over several tasks. ``made_of`` is kept in the note.
        ``bloom`` names a column that rows will be searched by.
        """
        generation = uuid.uuid4().hex
        own = f"{GENERATION}={generation}"
        order = [c for c in self.order if c in df.columns]
        dealt = df
        if self.column is not None:
            dealt = df.withColumn(GENERATION, F.lit(generation)).hint("rebalance", self.column)
        elif order:
            # Few values lead the order, so each lies in few files; large ones are split.
            dealt = df.hint("rebalance", *order[:2]).sortWithinPartitions(*order)
        seen = None
        if watch is not None:
            # In the tasks that write: a task that is run again counts once.
            seen = Observation()
            dealt = dealt.observe(seen, *watch.counts)
        writer = dealt.write.mode("append").options(**scratch.PACKED)
        if bloom is not None:
            writer = writer.option(f"parquet.bloom.filter.enabled#{bloom}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        if self.column is None:
            if order:
                writer = writer.option("parquet.block.size", str(SORTED_ROW_GROUP_BYTES))
                writer = writer.option("parquet.page.row.count.limit", str(SORTED_PAGE_ROWS))
            with scratch.tidy(df.sparkSession):
                writer.parquet(f"{self.path}/{own}")
            filled = [own] if files.exists(self.spark, f"{self.path}/{own}") else []
        else:
            with scratch.tidy(df.sparkSession):
                writer.partitionBy(self.column, GENERATION).parquet(self.path)
            names = [n for n in files.folders(self.spark, self.path) if n.startswith(f"{self.column}=")]
            filled = [f"{n}/{own}" for n in names if files.exists(self.spark, f"{self.path}/{n}/{own}")]
        if seen is not None:
            # Without any row there is nothing to count, and nothing wrong.
            watch.judge({name: n or 0 for name, n in seen.get.items()})
        if check is not None:
            check(self._open(df.schema, filled))
        before = self.live()
        kept: list[str] = []
        if values is not None and before is not None:
            gone = {folder_of(self.column, v) for v in values}
            strange = {f.split("/")[0] for f in filled} - gone
            if strange:
                raise ValueError(f"rows outside the replaced partitions: {sorted(strange)}")
            kept = [f for f in before["folders"] if f.split("/")[0] not in gone]
        number = (self._notes() or [0])[-1] + 1
        note = {"schema": df.schema.jsonValue(), "folders": sorted(kept + filled), "stale": stale or [], "made_of": made_of or {}}
        files.write_note(self.spark, f"{self.path}/_live/{number:010d}", note)
        self._tidy()
        self.spark.catalog.refreshByPath(self.path)

    def _tidy(self) -> None:
        """Keep what the last two notes list: readers may still have the older one open."""
        notes = self._notes()
        wanted = {f for n in notes[-2:] for f in self._note(n)["folders"]}
        for number in notes[:-2]:
            for folder in set(self._note(number)["folders"]) - wanted:
                files.remove(self.spark, f"{self.path}/{folder}")
            files.remove(self.spark, f"{self.path}/_live/{number:010d}")
