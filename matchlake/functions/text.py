"""Scalar and aggregate expressions. All are built-ins, nothing leaves the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlake import config


def patch_of(version: Column, pattern: str = config.PATCH_PATTERN) -> Column:
    """Patch number inside a game version text; NULL where the pattern is absent."""
    return F.regexp_substr(version, F.lit(pattern))


def strip_set_prefix(name: Column, anywhere: bool = False) -> Column:
    """Drop the set prefix at the start of an identifier, or wherever it occurs."""
    pattern = config.SET_PREFIX_ANYWHERE_PATTERN if anywhere else config.SET_PREFIX_PATTERN
    return F.regexp_replace(name, pattern, "")


def strip_item_prefix(names: Column) -> Column:
    """Drop every set and item prefix in a joined list of item identifiers."""
    return F.regexp_replace(names, config.ITEM_PREFIX_PATTERN, "")


def icon_url(name: Column, kind: str, base: str = config.ASSET_BASE) -> Column:
    """Address of an icon; ``kind`` is the folder, such as ``champions`` or ``items``."""
    return F.concat(F.lit(f"{base}/{kind}/"), F.lower(name), F.lit(".png"))


def joined(values: Column, separator: str) -> Column:
    """Text of an array of strings; NULL for an empty array, as for an empty group."""
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def ordered_concat(value: Column, order: Column, separator: str = config.UNIT_SEPARATOR) -> Column:
    """Aggregate: the group's values joined in the order of ``order``.

    Duplicates stay, NULL values are skipped, a group without values gives NULL. Equal
    order keys are settled by the value, so the result does not depend on row order.
    """
    pairs = F.collect_list(
        F.when(value.isNotNull(), F.struct(order.alias("position"), value.alias("value")))
    )
    return joined(F.transform(F.sort_array(pairs), lambda pair: pair["value"]), separator)


def array_slots(values: Column, count: int, prefix: str) -> list[Column]:
    """The first ``count`` elements as columns ``prefix1`` ...; NULL beyond the end."""
    return [F.get(values, F.lit(i)).alias(f"{prefix}{i + 1}") for i in range(count)]


def icon_slots(
    urls: Column, count: int, prefix: str = "icon_", separator: str = config.UNIT_SEPARATOR
) -> list[Column]:
    """Split a joined list of addresses into ``count`` fixed columns."""
    return array_slots(F.split(urls, re.escape(separator)), count, prefix)


def round2(value: Column) -> Column:
    """Two decimals, halves away from zero, as decided on the scaled floating-point value.

    ``F.round`` decides on the shortest decimal text instead: it takes 4.475 for a half,
    though the stored number and its hundredfold lie below.
    """
    return F.round(value * 100, 0) / 100


def performance_tier(
    games: Column, top4_rate: Column, min_games: int = config.MIN_TIER_GAMES
) -> Column:
    """Letter grade of a rounded top-4 rate; too few games give ``N/A``."""
    return (
        F.when(games < min_games, "N/A")
        .when(top4_rate >= 80, "S")
        .when(top4_rate >= 70, "A")
        .when(top4_rate >= 50, "B")
        .otherwise("C")
    )


def json_bool(text: Column) -> Column:
    """Boolean from JSON text. Anything but true/false in any case raises."""
    return (
        F.when(F.lower(text) == "true", F.lit(True))
        .when(F.lower(text) == "false", F.lit(False))
        .when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a boolean: "), text)).cast("boolean"))
    )


def asset_url(path: Column, base: str = config.SOURCE_CDN_BASE) -> Column:
    """Address of a game image from its path in the item catalogue."""
    flat = F.replace(F.replace(F.lower(path), F.lit(" "), F.lit("")), F.lit(".tex"), F.lit(".png"))
    return F.concat(F.lit(f"{base.rstrip('/')}/assets/"), F.regexp_replace(flat, "^assets/", ""))


def set_number_of(champion: Column) -> Column:
    """Digits of the set in a lower-case champion id; other ids come back whole."""
    return F.regexp_replace(champion, config.SET_NUMBER_PATTERN, "$1")


def champion_source_url(champion: Column, base: str = config.SOURCE_CDN_BASE) -> Column:
    """Address of a champion's square portrait."""
    return F.concat(
        F.lit(f"{base.rstrip('/')}/assets/characters/"),
        champion,
        F.lit("/hud/"),
        champion,
        F.lit("_square.tft_set"),
        set_number_of(champion),
        F.lit(".png"),
    )


def batch_label(as_of: Column, number: Column) -> Column:
    """Batch id: UTC minute of publication and the batch's sequence number."""
    return F.concat_ws("-", F.date_format(as_of, "yyyyMMdd-HHmm"), number.cast("string"))


def truncate_error(message: Column, limit: int = config.ERROR_TEXT_LIMIT) -> Column:
    return F.substring(message, 1, limit)
