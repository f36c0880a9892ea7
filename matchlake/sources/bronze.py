"""Bronze layer: match documents as JSON lines in one folder per ingestion date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import config, schemas
from matchlake.operators.ranking import top_per_group
from matchlake.sources import files, partitions, scratch
from matchlake.sources.copies import Copies, bounded, content_digest, document_key, match_id_of

#: The same lines in a tenth of the space; a file is then read by one task, and holds one shuffle partition.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _columns(df: DataFrame) -> DataFrame:
    return df.select("metadata", "info", "date", F.col("_metadata.file_path").alias("source_file"))


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """``metadata, info`` as JSON text, ``date`` from the folder, ``source_file``.

    Of a document that came again, changed, on its date the last copy is read, as far as ``write_bronze``
    has recorded it. Filters on ``date`` prune folders. A malformed line raises.
    """
    documents = _columns(spark.read.schema(schemas.BRONZE).option("mode", "FAILFAST").json(root))
    return Copies(spark, root).drop(documents, document_key(F.col("metadata"), F.col("info")), "date")


def read_matches(spark: SparkSession, root: str) -> DataFrame:
    """What ``player_results`` needs of the documents, taken apart in a single pass.

    Staging keeps the blocks and the participants as JSON text, which costs a pass over
    the text each. Here the file reader yields the participants directly.
    """
    matches = _matches(spark.read.schema(schemas.DOCUMENT).option("mode", "FAILFAST").json(root))
    return Copies(spark, root).drop(matches, F.col("match_id"), "ingestion_date")


def latest_matches(matches: DataFrame) -> DataFrame:
    """One document per match: of the newest date, and there of the newest file."""
    order = [F.col(c).desc() for c in ("ingestion_date", "file_time", "source_file")]
    return top_per_group(matches, ["match_id"], order)


def stream_matches(
    spark: SparkSession, root: str, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """``read_matches`` of newly arrived files, each file once."""
    reader = spark.readStream.schema(schemas.DOCUMENT).option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    elif bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return _matches(reader.json(root))


def _matches(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col("metadata.match_id").isNotNull()).select(
        "metadata.match_id",
        F.timestamp_millis(F.col("info.game_datetime").cast("bigint")).alias("game_datetime"),
        F.col("info.game_version").alias("game_version"),
        F.col("info.tft_set_number").cast("bigint").alias("tft_set_number"),
        "info.participants",
        F.col("date").alias("ingestion_date"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )


def stream_bronze(
    spark: SparkSession,
    root: str,
    dedupe: bool = False,
    files_per_batch: int | None = None,
    dedupe_days: int | None = None,
) -> DataFrame:
    """Documents of newly arrived files, each file once.

    ``dedupe`` also drops documents whose match id came before. That keeps every id in
    the state store; loading through ``upsert`` needs no such state. With ``dedupe_days`` an id
    is forgotten once the newest date of earlier batches is ``2 * dedupe_days`` past its own, so
    the state ends as retention ends the files. Copies at most ``dedupe_days`` later never
    come through; one that comes after its id was forgotten is a document again. Documents more
    than ``dedupe_days`` older than the newest date of earlier batches, which retention would
    remove, are left out. Documents without a match id count as copies of each other. Those
    without a date are never too old, and their ids may be forgotten with their batch.
    """
    reader = spark.readStream.schema(schemas.BRONZE).option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    documents = _columns(reader.json(root))
    if not dedupe:
        return documents
    documents = documents.withColumn("match_id", match_id_of(F.col("metadata")))
    if dedupe_days is None:
        return documents.dropDuplicates(["match_id"])
    dated = documents.withColumn("_day", F.col("date").cast("timestamp")).withWatermark("_day", f"{dedupe_days} days")
    return dated.dropDuplicatesWithinWatermark(["match_id"]).drop("_day")


def json_lines(df: DataFrame) -> DataFrame:
    """One line of JSON text per document, beside its ``date``."""
    block = lambda name: F.translate(F.coalesce(name, F.lit("null")), "\r\n", "  ")
    line = F.concat(F.lit('{"metadata":'), block("metadata"), F.lit(',"info":'), block("info"), F.lit("}"))
    return df.select(line.alias("value"), "date")


def write_bronze(
    df: DataFrame, root: str, order: list[Column] | None = None, as_of: Column | None = None
) -> None:
    """Store documents; one that has come before on the same date replaces the old one.

    New and changed documents are appended in files of their own, unchanged ones are left
    out; readers take the copy of the newest file. Files once written stay as they are, so a
    file stream loads a document again only where it has changed. What is there already is
    known from a narrow index (``copies``), not from the documents. ``order`` says which of
    several copies in ``df`` is the last (largest first); without it the choice is arbitrary
    but repeatable. Documents without a match id go by their content. Documents share files,
    so a day of many small documents is a few large files, packed by gzip. Without a column ``date`` the
    documents go to the UTC date of ``as_of``, or of now. A folder has one writer at a time;
    between the last file and its record a reader may see both copies of a changed document.
    """
    spark = df.sparkSession
    if "date" not in df.columns:
        df = df.withColumn("date", F.to_date(F.current_timestamp() if as_of is None else as_of))
    flat = df.withColumns({"metadata": F.translate("metadata", "\r\n", "  "), "info": F.translate("info", "\r\n", "  ")})
    key, content = (make(F.col("metadata"), F.col("info")) for make in (document_key, content_digest))
    # The staged copy of the documents goes as soon as they are written.
    with scratch.scope(), scratch.tidy(spark):
        docs = scratch.save(flat.withColumns({"_key": key, "_content": content}), "bronze")
        if order is None:
            order = [F.xxhash64("metadata", "info").desc()]
        # Whole documents are only dealt where some came twice.
        if not docs.groupBy("date", "_key").count().filter("count > 1").isEmpty():
            docs = top_per_group(docs, ["date", "_key"], order)
        dates = partitions.partition_values(docs, "date")
        copies = Copies(spark, root)
        if files.has_data(spark, root):
            copies.record(dates)
            known = copies.newest(dates)
            if known is not None:
                known = known.select(F.col("date").alias("_date"), F.col("key").alias("_known"), F.col("content").alias("_same"))
                same = F.col("date").eqNullSafe(F.col("_date")) & (F.col("_key") == F.col("_known")) & (F.col("_content") == F.col("_same"))
                docs = docs.join(bounded(known), same, "left_anti")
        lines = json_lines(docs).hint("rebalance", "date")
        lines.write.mode("append").options(**PACKED).partitionBy("date").text(root)
        copies.record(dates)


def bronze_partition_counts(bronze: DataFrame, n: int = 5) -> DataFrame:
    """Documents per ingestion date for the newest ``n`` dates."""
    counts = bronze.groupBy("date").agg(F.count(F.lit(1)).alias("total"))
    return counts.orderBy(F.col("date").desc()).limit(n)


def expire_bronze(
    spark: SparkSession, root: str, days: int = config.RETENTION_DAYS, as_of: date | None = None
) -> list[date]:
    """Remove date folders older than ``days`` days; returns their dates."""
    today = as_of or spark.range(1).select(F.current_date()).first()[0]
    limit = today - timedelta(days=days)
    gone = []
    for name in files.folders(spark, root):
        if not name.startswith("date=") or name.endswith(partitions.NULL_FOLDER):
            continue
        day = date.fromisoformat(name.removeprefix("date="))
        if day < limit:
            files.remove(spark, f"{root}/{name}")
            files.remove(spark, f"{root}/_copies/index/{name}")
            gone.append(day)
    return gone
