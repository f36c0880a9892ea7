"""Incremental loading: high-water mark, upsert and column sync."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.operators.ranking import top_per_group

NEWEST_FIRST = ["ingestion_date", "source_file", "dbt_updated_at"]


class DuplicateKeyError(ValueError):
    """Several update rows claim the same key."""


def incremental_slice(
    df: DataFrame,
    target: DataFrame | date | None,
    column: str = "ingestion_date",
    lookback_days: int = 0,
) -> DataFrame:
    """Rows not older than the newest row of ``target``, all rows for an empty target.

    ``target`` is the table loaded so far or its mark. The mark is a literal by the time
    it is used, so the scan of ``df`` prunes whole folders. ``lookback_days`` moves it
    back to admit late files in older folders.
    """
    mark = target
    if isinstance(target, DataFrame):
        mark = target.agg(F.max(column).alias("mark")).first()["mark"]
    if mark is None:
        return df
    bound = F.lit(mark) if not lookback_days else F.date_sub(F.lit(mark), lookback_days)
    return df.filter(F.col(column) >= bound)


def complete_key(keys: list[str]) -> Column:
    """A NULL in any key column never matches anything."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def unique_updates(updates: DataFrame, keys: list[str], on_duplicate: str = "error") -> DataFrame:
    """Updates with at most one row per key.

    ``error`` raises when a key occurs twice; ``latest`` keeps the newest row of a key by
    whichever of the newest-first columns there are; ``checked`` takes the caller's word
    that keys are unique. Rows with a NULL key all stay.
    """
    if on_duplicate == "checked":
        return updates
    if on_duplicate == "error":
        refuse_duplicates(updates, keys)
        return updates
    if on_duplicate != "latest":
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    order = [F.col(name).desc() for name in NEWEST_FIRST if name in updates.columns]
    # Whatever still ties is settled by the row itself, to have the same winner each run.
    order.append(F.xxhash64(*[n for n in updates.columns if n != "dbt_updated_at"]).desc())
    # Each row with an incomplete key is a group of its own.
    alone = F.when(~complete_key(keys), F.monotonically_increasing_id())
    return top_per_group(updates.withColumn("_alone", alone), [*keys, "_alone"], order).drop("_alone")


def repeated_keys(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Complete keys that occur more than once, found on the key columns alone."""
    return updates.filter(complete_key(keys)).groupBy(*keys).count().filter("count > 1")


def refuse_duplicates(updates: DataFrame, keys: list[str]) -> None:
    """Raise when a complete key occurs twice."""
    found = repeated_keys(updates, keys).limit(1).collect()
    if found:
        raise DuplicateKeyError(f"more than one row for key {found[0].asDict()}")


def sync_columns(target: DataFrame, updates: DataFrame) -> DataFrame:
    """``target`` in the shape of ``updates``: dropped columns go, new ones are NULL."""
    return target.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in target.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in updates.schema.fields
        ]
    )


def upsert(
    target: DataFrame, updates: DataFrame, keys: list[str], on_duplicate: str = "error"
) -> DataFrame:
    """``target`` with the rows of ``updates`` replacing those of the same key."""
    updates = unique_updates(updates, keys, on_duplicate)
    kept = sync_columns(target, updates).join(updates.select(*keys), keys, "left_anti")
    return kept.select(*updates.columns).unionByName(updates)
