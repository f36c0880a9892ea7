"""Top rows per group and first distinct rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame,
    partition: list[str],
    order: list[Column],
    k: int = 1,
    rank_name: str | None = None,
) -> DataFrame:
    """The first ``k`` rows of every group by ``order``.

    A hot group costs little: Spark trims every input task to the ``k`` best rows of each
    group before the shuffle (WindowGroupLimit), for any ``k`` up to the threshold in
    ``config.SESSION_SETTINGS``.
    """
    rank = "_rank"
    ranked = df.withColumn(
        rank, F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
    ).filter(F.col(rank) <= k)
    if rank_name is None:
        return ranked.drop(rank)
    return ranked.withColumn(rank_name, F.col(rank).cast("long")).drop(rank)


def first_distinct(df: DataFrame, key: str, pos: str, n: int) -> DataFrame:
    """The first ``n`` distinct keys in arrival order, with their first position."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(pos).alias(pos))
        .orderBy(pos, key)
        .limit(n)
    )
