"""Column and key checks."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(AssertionError):
    """A table broke one of its checks."""


# Columns that must not be NULL, per table.
NOT_NULL: dict[str, list[str]] = {
    "fact_player_results": ["match_id", "puuid", "placement", "win"],
    "fact_traits": ["match_id", "puuid", "trait_name", "tier_current"],
    "fact_units": ["match_id", "puuid", "character_id"],
    "core_comp_winrate": ["core_key", "core_key_display", "primary_trait", "top4_rate", "win_rate"],
    "unit_winrate": ["character_id", "top4_rate", "win_rate"],
    "item_combo_winrate": ["character_id", "item_combo", "top4_rate", "win_rate"],
}
# A player without an active trait has none, so this check reports instead of failing.
WARN_ONLY = {("core_comp_winrate", "primary_trait")}

KEYS: dict[str, list[str]] = {
    "fact_player_results": ["match_id", "puuid"],
    "fact_traits": ["match_id", "puuid", "trait_name"],
    "fact_units": ["unit_key"],
}
# Part of every one of these keys: what old rows of an update are searched by.
SEARCH = ["match_id"]


class Watch(NamedTuple):
    """Counts to take of rows while these are written, and who judges them."""

    counts: list[Column]
    judge: Callable[[dict[str, int]], None]


def _null_counts(cols: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in cols]


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Number of NULLs per column, found in one pass over the table."""
    return df.agg(*_null_counts(cols)).unpivot([], cols, "column_name", "null_count")


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def judge_nulls(nulls: dict[str, int], table: str, strict: bool = False) -> None:
    """Raise, or warn where that is enough, when a column of ``table`` has NULLs."""
    broken = {c: n for c, n in nulls.items() if n > 0}
    fatal = {c: n for c, n in broken.items() if strict or (table, c) not in WARN_ONLY}
    if fatal:
        raise QualityError(f"{table} has NULLs: {fatal}")
    if broken:
        warnings.warn(f"{table} has NULLs: {broken}", stacklevel=3)


def assert_quality(df: DataFrame, table: str, strict: bool = False) -> None:
    """Raise when a NOT NULL check of ``table`` fails. ``strict`` knows no warnings."""
    if table in NOT_NULL:
        nulls = {row["column_name"]: row["null_count"] for row in check_not_null(df, NOT_NULL[table]).collect()}
        judge_nulls(nulls, table, strict)


def watch_quality(table: str, strict: bool = False) -> Watch | None:
    """The checks of ``assert_quality`` on rows as they are written; nothing is read again."""
    if table not in NOT_NULL:
        return None
    return Watch(_null_counts(NOT_NULL[table]), lambda nulls: judge_nulls(nulls, table, strict))
