"""Intermediate tables in the shared folder: computed once, and safe from lost executors."""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from matchlake import config
from matchlake.sources import files


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared space, removed when Python ends."""
    folder = f"{config.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return folder


_scopes = threading.local()
#: Shuffle files otherwise stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Of tables that are written and read back: far smaller than by the default, at little time.
PACKED = {"compression": "zstd"}


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query that ends inside the block go as it ends.

    A stream keeps the setting it was started under, a frame that is collected the one it was made
    under; counts and writes go by the present one. A frame collected again computes its shuffles again.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


@contextmanager
def scope() -> Iterator[None]:
    """Folders that ``save`` makes inside the block are removed when it ends, not only when Python ends.

    Nothing read from them may be used after the block.
    """
    made: list[tuple[SparkSession, str]] = []
    stack = _scopes.__dict__.setdefault("stack", [])
    stack.append(made)
    try:
        yield
    finally:
        stack.remove(made)
        for spark, folder in made:
            _remove(spark, folder)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back."""
    folder = run_folder(df.sparkSession, name)
    if stack := _scopes.__dict__.get("stack"):
        stack[-1].append((df.sparkSession, folder))
    with tidy(df.sparkSession):
        df.write.options(**PACKED).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    try:
        files.remove(spark, folder)
    except Exception:  # noqa: BLE001  the session is gone already, and the folder harms nobody
        return
