"""The ledger kept up to date from a stream of events."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from matchlake import config, schemas
from matchlake.functions import truncate_error
from matchlake.operators.ledger import requeue
from matchlake.operators.ranking import top_per_group
from matchlake.sources import files

VERSIONED = T.StructType([*schemas.LEDGER.fields, T.StructField("version", T.LongType())])


class LedgerTable:
    """Ledger documents by the micro-batch that changed them.

    ``batch=N`` holds the documents batch N touched, ``full=N`` all documents after it.
    The newest document of an id counts. A batch that is run again, as after a lost
    driver, reads only what batches before it wrote and overwrites its own folder, so
    every event counts once.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folders(self, before: int | None) -> list[str]:
        found = []
        for name in files.folders(self.spark, self.root):
            kind, _, number = name.partition("=")
            done = files.exists(self.spark, f"{self.root}/{name}/_SUCCESS")
            if kind in ("batch", "full") and done and (before is None or int(number) < before):
                found.append((int(number), kind))
        start = max((n for n, kind in found if kind == "full"), default=-1)
        return [
            f"{self.root}/{kind}={n}"
            for n, kind in sorted(found)
            if n > start or (n == start and kind == "full")
        ]

    def current(self, before: int | None = None, ids: DataFrame | None = None) -> DataFrame | None:
        """The ledger, optionally as it was before a batch, or of some ids only."""
        folders = self._folders(before)
        if not folders:
            return None
        parts = self.spark.read.schema(VERSIONED).parquet(*folders)
        if ids is not None:  # ahead of the shuffle that finds the newest documents
            parts = parts.join(ids, "match_id", "left_semi")
        return top_per_group(parts, ["match_id"], [F.col("version").desc()]).drop("version")

    def tidy(self) -> None:
        """Remove what lies before the last but one full ledger.

        The batch that wrote the last one may be run again, and then reads what came before.
        """
        found = [name.partition("=") for name in files.folders(self.spark, self.root)]
        full = sorted(int(n) for kind, _, n in found if kind == "full")
        for kind, _, n in found:
            if len(full) > 1 and kind in ("batch", "full") and int(n) < full[-2]:
                files.remove(self.spark, f"{self.root}/{kind}={n}")

    def requests(self, number: int) -> DataFrame:
        """Ids that one micro-batch asks for again: only those it had events of."""
        touched = self.spark.read.schema(VERSIONED).parquet(f"{self.root}/batch={number}")
        return requeue(touched)

    def write(self, documents: DataFrame, number: int, kind: str = "batch") -> None:
        versioned = documents.withColumn("version", F.lit(number).cast("long"))
        versioned.write.mode("overwrite").parquet(f"{self.root}/{kind}={number}")


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times are whole microseconds here: they mean the same in every process and zone.
TIMES = ("created_at", "updated_at", "processed_at")
KEPT = T.StructType(
    [T.StructField(f.name, T.LongType() if f.name in TIMES else f.dataType) for f in schemas.LEDGER.fields[1:]]
)
EVENT = ("event_time", "seq", "kind", "message")


def next_document(doc: dict, event: tuple, max_retries: int, max_dlq: int) -> dict:
    """The document after one event (time, sequence, kind, message); ``{}`` where there was none."""
    now, _, kind, message = event
    status, tries, dead = doc.get("status"), doc.get("retries") or 0, doc.get("dlq_attempts") or 0
    if kind == "dead_letter":
        if status == config.STATUS_SUCCESS:
            return doc
        if dead >= max_dlq:
            text = config.DEAD_LETTER_GIVE_UP_MESSAGE.format(dead)
            return doc | {"status": config.STATUS_ABANDONED, "last_error": text, "updated_at": now, "requeue": False}
        revived = {"status": config.STATUS_ERROR, "retries": 0, "dlq_attempts": dead + 1, "requeue": True}
        return doc | revived | {"last_error": config.DEAD_LETTER_RETRY_MESSAGE, "updated_at": now}
    if status in (config.STATUS_SUCCESS, config.STATUS_ABANDONED):
        return doc
    if kind == "discovered":
        return {"status": config.STATUS_PENDING, "created_at": now, "retries": 0, "requeue": False}
    if kind == "fetch_ok":
        return doc | {"status": config.STATUS_SUCCESS, "processed_at": now, "requeue": False}
    if kind not in ("fetch_error", "not_found"):
        return doc
    spent = tries + 1 >= max_retries
    refused = any(code in (message or "") for code in config.FATAL_HTTP_CODES)
    return doc | {
        "status": config.STATUS_ABANDONED if spent else config.STATUS_ERROR,
        "retries": tries + 1,
        "last_error": config.NOT_FOUND_MESSAGE if kind == "not_found" else message,
        "updated_at": now,
        "requeue": kind == "fetch_error" and not spent and not refused,
    }


class LedgerFold(StatefulProcessor):
    """One document per id in the state store; a micro-batch reads those of its own ids only."""

    def __init__(self, max_retries: int, max_dlq: int):
        self.max_retries = max_retries
        self.max_dlq = max_dlq

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.document = handle.getValueState("document", KEPT)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.document.update(tuple(initialState[f.name] for f in KEPT.fields))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        known = self.document.get() if self.document.exists() else None
        doc = dict(zip(KEPT.fieldNames(), known, strict=True)) if known else {}
        events = [tuple(row[name] for name in EVENT) for row in rows]
        # NULLs first, as in the batch fold
        for event in sorted(events, key=lambda e: [(x is not None, x) if x is not None else (False,) for x in e]):
            doc = next_document(doc, event, self.max_retries, self.max_dlq)
        doc = {f.name: doc.get(f.name) for f in KEPT.fields} | {"requeue": bool(doc.get("requeue"))}
        self.document.update(tuple(doc.values()))
        yield Row(match_id=key[0], **doc)

    def close(self) -> None:
        pass


def _in_microseconds(ledger: DataFrame) -> DataFrame:
    names = [f.name for f in schemas.LEDGER.fields]
    return ledger.select(*[F.unix_micros(c).alias(c) if c in TIMES else F.col(c) for c in names])


def stream_ledger(
    events: DataFrame,
    table: LedgerTable,
    checkpoint: str,
    max_retries: int = config.MAX_RETRIES,
    max_dlq: int = config.MAX_DLQ_ATTEMPTS,
    compact_every: int = 24,
    initial: DataFrame | None = None,
) -> StreamingQuery:
    """Fold a stream of events into ``table``, up to the events there are at the start.

    Documents are kept by id in RocksDB state below ``checkpoint``, so a micro-batch costs what its
    own events and ids cost, however many documents there are; ``table`` gets those it touched, and
    ``table.requests(N)`` has what micro-batch N asks for again. Within a micro-batch the events of an
    id apply in the order of time and sequence, and are held in one task; between micro-batches in
    the order of arrival. ``initial`` has the documents of an earlier ledger for a new checkpoint, to
    be used with a new ``table``. The number of shuffle partitions at the first start stays the
    number of partitions of the state. Every ``compact_every`` micro-batches (0: never) the newest
    documents are written down together, for readers.
    """
    spark = config.configure(table.spark)
    if initial is not None:
        # among the documents to read as well: the stream itself writes only what it touches
        table.write(initial, -1, "full")
        initial = _in_microseconds(initial).groupBy("match_id")

    def load(batch: DataFrame, number: int) -> None:
        shown = batch.select(*[F.timestamp_micros(c).alias(c) if c in TIMES else F.col(c) for c in batch.columns])
        table.write(shown, number)
        if compact_every and number % compact_every == compact_every - 1:
            table.write(table.current(before=number + 1), number, "full")
            table.tidy()

    narrow = events.filter(F.col("match_id").isNotNull()).select(
        "match_id", F.unix_micros("event_time").alias("event_time"), "seq", "kind", truncate_error(F.col("message")).alias("message")
    )
    documents = narrow.groupBy("match_id").transformWithState(
        LedgerFold(max_retries, max_dlq),
        T.StructType([schemas.LEDGER.fields[0], *KEPT.fields]),
        outputMode="Update",
        timeMode="None",
        initialState=initial,
    )
    # A query copies the session's settings as it starts; the session keeps its own.
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, STATE_STORE)
    try:
        return (
            documents.writeStream.foreachBatch(load)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(provider, before)
