"""Win-rate tables over the silver facts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake import config
from matchlake.functions import (
    array_slots,
    icon_url,
    joined,
    performance_tier,
    round2,
    strip_item_prefix,
    strip_set_prefix,
)
from matchlake.operators.ranking import top_per_group

METRICS = [
    "total_games",
    "total_top4",
    "total_wins",
    "top4_rate",
    "win_rate",
    "avg_placement",
    "tier_winrate",
]
PLAYER = ["match_id", "patch", "puuid", "tft_set_number", "placement", "top4", "win"]


def win_rate_rollup(
    df: DataFrame, keys: list[str], min_games: int = 1, min_tier_games: int = config.MIN_TIER_GAMES
) -> DataFrame:
    """Games, top-4 and win counts and rates, mean placement and grade per group.

    Groups with fewer than ``min_games`` rows are left out. A hot group is combined in
    every input task first, so it needs no salting.
    """
    counted = (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("total_games"),
            F.count_if("top4").alias("total_top4"),
            F.count_if("win").alias("total_wins"),
            F.avg("placement").alias("_placement"),
        )
        .filter(F.col("total_games") >= min_games)
    )
    rate = lambda part: round2(F.col(part) / F.col("total_games") * 100)
    top4_rate = rate("total_top4")
    return counted.select(
        *keys,
        "total_games",
        "total_top4",
        "total_wins",
        top4_rate.alias("top4_rate"),
        rate("total_wins").alias("win_rate"),
        round2(F.col("_placement")).alias("avg_placement"),
        performance_tier(F.col("total_games"), top4_rate, min_tier_games).alias("tier_winrate"),
    )


def rate_sums(df: DataFrame, keys: list[str]) -> DataFrame:
    """What rates are made of, per group: sums, which can be added up further."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("games"),
        F.count_if("top4").alias("top4s"),
        F.count_if("win").alias("wins"),
        F.sum("placement").alias("placements"),
        F.count("placement").alias("placed"),
    )


def rates_of_sums(
    sums: DataFrame, keys: list[str], min_games: int = 1, min_tier_games: int = config.MIN_TIER_GAMES
) -> DataFrame:
    """``win_rate_rollup`` of the rows that ``rate_sums`` has summed, in however many parts."""
    added = sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("games", "top4s", "wins", "placements", "placed")])
    added = added.filter(F.col("games") >= min_games)
    rate = lambda part: round2(F.col(part) / F.col("games") * 100)
    placement = F.when(F.col("placed") > 0, F.col("placements").cast("double") / F.col("placed"))
    return added.select(
        *keys,
        F.col("games").alias("total_games"),
        F.col("top4s").alias("total_top4"),
        F.col("wins").alias("total_wins"),
        rate("top4s").alias("top4_rate"),
        rate("wins").alias("win_rate"),
        round2(placement).alias("avg_placement"),
        performance_tier(F.col("games"), rate("top4s"), min_tier_games).alias("tier_winrate"),
    )


UNIT_KEYS = ["tft_set_number", "patch", "character_id", "tier", "rarity"]
COMP_KEYS = ["tft_set_number", "patch", "champions", "primary_trait"]
ITEM_KEYS = ["tft_set_number", "patch", "character_id", "items", "item_combo_size"]


def units_once(units: DataFrame, *carry: str) -> DataFrame:
    """A row per player, champion, star level and rarity."""
    return units.select(*PLAYER, *carry, "character_id", "tier", "rarity").distinct()


def unit_winrate(
    units: DataFrame, min_games: int = config.MIN_UNIT_GAMES, base: str = config.ASSET_BASE
) -> DataFrame:
    """Rates per champion, star level and rarity; equal copies of a player count once."""
    return shaped_units(win_rate_rollup(units_once(units), UNIT_KEYS, min_games), base)


def shaped_units(rates: DataFrame, base: str = config.ASSET_BASE) -> DataFrame:
    """Names and icons beside the rates of ``UNIT_KEYS``."""
    champion = F.col("character_id")
    return rates.select(
        "tft_set_number",
        "patch",
        "character_id",
        strip_set_prefix(champion).alias("character_name"),
        icon_url(champion, "champions", base).alias("icon_url"),
        "tier",
        "rarity",
        *METRICS,
    )


def primary_trait(traits: DataFrame) -> DataFrame:
    """The strongest active trait of every player and match."""
    active = traits.filter("is_active").select(
        "match_id", "puuid", "trait_name", "tier_current", "num_units"
    )
    order = [F.col("tier_current").desc(), F.col("num_units").desc(), F.col("trait_name").asc()]
    best = top_per_group(active, ["match_id", "puuid"], order)
    return best.select("match_id", "puuid", F.col("trait_name").alias("primary_trait"))


def rank_units(units: DataFrame) -> DataFrame:
    """Units of a player by rarity, rarest first, then by champion.

    A window's group is one player's board, which came out of a single document.
    """
    order = [F.col("rarity").desc(), F.col("character_id").asc(), F.col("unit_position").asc()]
    rank = F.row_number().over(Window.partitionBy("match_id", "puuid").orderBy(*order))
    return units.select(
        "match_id", "puuid", "character_id", "rarity", "unit_position", rank.cast("long").alias("unit_rank")
    )


def core_units(units: DataFrame, *carry: str) -> DataFrame:
    """The composition of every player and match: its champions, sorted, copies kept.

    A group is one player's board. Everything derived from the champions (key, display
    text, icon addresses) is left to the end, where one row per composition is left.
    """
    champions = F.sort_array(F.collect_list("character_id"))
    return units.groupBy(*PLAYER, *carry).agg(champions.alias("champions"))


def core_size(champions: Column) -> Column:
    """Number of distinct champions."""
    return F.size(F.array_distinct(champions)).cast("long")


def core_comp_winrate(
    units: DataFrame,
    traits: DataFrame,
    min_games: int = config.MIN_COMP_GAMES,
    slots: int = config.COMP_SLOTS,
    base: str = config.ASSET_BASE,
) -> DataFrame:
    """Rates per full composition and primary trait.

    Players without an active trait keep a NULL primary trait.
    """
    return shaped_comps(win_rate_rollup(played_comps(units, traits), COMP_KEYS, min_games), slots, base)


def played_comps(units: DataFrame, traits: DataFrame, *carry: str) -> DataFrame:
    """The board of every player with its primary trait."""
    # Dealt once: the grouping, the window over traits and the join all keep this partitioning.
    player = ["match_id", "puuid"]
    boards, active = core_units(units.repartition(*player), *carry), primary_trait(traits.repartition(*player))
    return boards.join(active, player, "left")


def shaped_comps(rates: DataFrame, slots: int = config.COMP_SLOTS, base: str = config.ASSET_BASE) -> DataFrame:
    """Keys, texts and icons of the compositions beside the rates of ``COMP_KEYS``."""
    champions = F.col("champions")
    names = F.transform(champions, lambda c: strip_set_prefix(c, anywhere=True))
    icons = F.transform(champions, lambda c: icon_url(c, "champions", base))
    separator = config.UNIT_SEPARATOR
    return (
        rates.withColumn("_icons", icons)
        .select(
            "tft_set_number",
            "patch",
            joined(champions, separator).alias("core_key"),
            joined(names, separator).alias("core_key_display"),
            joined(F.col("_icons"), separator).alias("core_icon_urls"),
            *array_slots(F.col("_icons"), slots, "unit_icon_"),
            core_size(champions).alias("core_size"),
            "primary_trait",
            strip_set_prefix(F.col("primary_trait")).alias("primary_trait_display"),
            *METRICS,
        )
    )


def item_builds(
    units: DataFrame, min_items: int = config.MIN_ITEMS, per_copy: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The sorted items a champion carried, per player and match.

    Copies of one champion with the same number of items merge into one build holding
    the items of all of them; ``per_copy=True`` keeps the copies apart. Each unit brings
    its whole item array, so nothing is exploded only to be grouped again.
    """
    # An empty list has no item to make a build of, whatever the minimum.
    carried = units.filter(
        F.col("item_names_json").isNotNull() & (F.col("item_count") >= max(min_items, 1))
    ).select(
        *PLAYER,
        *carry,
        "character_id",
        F.col("item_count").alias("item_combo_size"),
        *(["unit_key"] if per_copy else []),
        F.from_json("item_names_json", "array<string>", {"mode": "FAILFAST"}).alias("items"),
    )
    own_keys = [name for name in carried.columns if name != "items"]
    builds = carried.groupBy(*own_keys).agg(F.collect_list("items").alias("items"))
    carried_items = F.filter(F.flatten("items"), lambda item: item.isNotNull())
    return builds.withColumn("items", F.sort_array(carried_items))


def item_combo_winrate(
    units: DataFrame,
    min_items: int = config.MIN_ITEMS,
    min_games: int = config.MIN_ITEM_GAMES,
    slots: int = config.ITEM_SLOTS,
    per_copy: bool = False,
    base: str = config.ASSET_BASE,
) -> DataFrame:
    """Rates per champion and item build, the order of items not mattering."""
    return shaped_items(win_rate_rollup(item_builds(units, min_items, per_copy), ITEM_KEYS, min_games), slots, base)


def shaped_items(rates: DataFrame, slots: int = config.ITEM_SLOTS, base: str = config.ASSET_BASE) -> DataFrame:
    """Texts and icons of the builds beside the rates of ``ITEM_KEYS``."""
    champion, combo = F.col("character_id"), joined(F.col("items"), config.ITEM_SEPARATOR)
    icons = F.transform("items", lambda item: icon_url(item, "items", base))
    return (
        rates.withColumn("item_combo", combo)
        .withColumn("_icons", icons)
        .select(
            "tft_set_number",
            "patch",
            "character_id",
            strip_set_prefix(champion).alias("character_name"),
            icon_url(champion, "champions", base).alias("icon_url"),
            "item_combo",
            strip_item_prefix(F.col("item_combo")).alias("item_combo_display"),
            joined(F.col("_icons"), config.UNIT_SEPARATOR).alias("item_icon_urls"),
            *array_slots(F.col("_icons"), slots, "item_icon_url_"),
            "item_combo_size",
            *METRICS,
        )
    )


def meta_view(
    gold: DataFrame,
    patch: str | None = None,
    character: str | None = None,
    tier: str | None = None,
) -> DataFrame:
    """A gold table narrowed by patch, champion and grade, best top-4 rate first.

    Tables by item build are ordered by champion first. Of compositions those stay that
    the champion is part of.
    """
    if patch is not None:
        gold = gold.filter(F.col("patch") == patch)
    if tier is not None:
        gold = gold.filter(F.col("tier_winrate") == tier)
    if character is not None and "core_key" in gold.columns:
        members = F.split("core_key", re.escape(config.UNIT_SEPARATOR))
        gold = gold.filter(F.array_contains(members, character))
    elif character is not None:
        gold = gold.filter(F.col("character_id") == character)
    order: list[Column] = [F.col("top4_rate").desc()]
    if "item_combo" in gold.columns:
        order.insert(0, F.col("character_id").asc())
    return gold.orderBy(*order)
