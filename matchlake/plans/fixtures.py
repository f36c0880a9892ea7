"""Match-shaped tables out of the star schema the queries are checked on.

Eight consecutive orders make a match, an order a player, a line a unit. ``documents``
nests them into JSON match documents; the fact tables can also be had directly, which
gathers nothing per match or player.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlake.functions import patch_of
from matchlake.operators.silver import CONTEXT



class Tables:
    """The tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def match_of(order_key: Column) -> Column:
    return F.shiftright(order_key, 3)  # eight orders to a match


def match_id_of(order_key: Column) -> Column:
    return F.concat(F.lit("M"), match_of(order_key).cast("string"))


def players(t: Tables) -> DataFrame:
    """One row per order: its match, its place in it and what the match is about.

    The window's group is a match: eight order keys, which are unique.
    """
    match = Window.partitionBy("m")
    by_price = match.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc())
    tft_set = 15 + F.col("m") % 2
    version = F.concat(
        F.lit("Version "),
        tft_set.cast("string"),
        F.lit("."),
        (1 + F.col("m") % 3).cast("string"),
        F.lit(".700.1234"),
    )
    rows = t.orders.withColumn("m", match_of(F.col("o_orderkey"))).select(
        "*",
        F.row_number().over(by_price).cast("long").alias("placement"),
        F.min("o_orderdate").over(match).alias("started"),
        F.min_by("o_orderpriority", "o_orderkey").over(match).alias("first_priority"),
    )
    return rows.select(
        "m",
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.concat(F.lit("M"), F.col("m").cast("string")).alias("match_id"),
        F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("puuid"),
        "placement",
        (F.col("placement") <= 4).alias("top4"),
        (F.col("placement") == 1).alias("win"),
        F.col("started").cast("timestamp").alias("game_datetime"),
        tft_set.alias("tft_set_number"),
        version.alias("game_version"),
        patch_of(version).alias("patch"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("m") % 10).cast("int")).alias("ingestion_date"),
        F.when(F.col("first_priority") != "5-LOW", 1100).otherwise(1090).cast("long").alias("queue_id"),
    )


def _unit_columns(tft_set: Column) -> dict[str, Column]:
    prefix = F.concat(F.lit("TFT"), tft_set.cast("string"), F.lit("_"))
    own = F.concat(prefix, F.lit("Item_"), F.col("p_type"))
    shared = F.concat(F.lit("TFT_Item_S"), (F.col("p_size") % 4).cast("string"))
    return {
        "character_id": F.concat(prefix, F.replace("p_brand", F.lit("#"), F.lit(""))),
        "tier": (1 + F.col("l_linenumber") % 3).cast("long"),
        "rarity": (F.col("p_size") % 7).cast("long"),
        "items": F.slice(F.array(own, shared, own), 1, F.col("l_linenumber") % 4),
    }


def _lines(t: Tables) -> DataFrame:
    part = t.part.select("p_partkey", "p_brand", "p_type", "p_size")
    line = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    tft_set = 15 + match_of(F.col("l_orderkey")) % 2
    columns = [value.alias(name) for name, value in _unit_columns(tft_set).items()]
    return line.join(part, line.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "p_type", *columns
    )


def unit_rows(t: Tables) -> DataFrame:
    """Unit facts without position: what the gold tables read."""
    who = players(t).select("o_orderkey", *CONTEXT, "ingestion_date")
    lines = _lines(t)
    return lines.join(who, lines.l_orderkey == who.o_orderkey).select(
        *CONTEXT,
        "character_id",
        "tier",
        "rarity",
        F.to_json("items").alias("item_names_json"),
        F.size("items").cast("long").alias("item_count"),
        "ingestion_date",
    )


def trait_rows(t: Tables) -> DataFrame:
    """Trait facts: a player's lines counted per part type."""
    lines = _lines(t).groupBy("l_orderkey", "p_type").agg(F.count(F.lit(1)).alias("num_units"))
    who = players(t).select("o_orderkey", *CONTEXT, "ingestion_date")
    tier = F.col("num_units") - 1 + F.col("o_orderkey") % 2
    name = F.concat(F.lit("TFT"), F.col("tft_set_number").cast("string"), F.lit("_"), "p_type")
    return lines.join(who, lines.l_orderkey == who.o_orderkey).select(
        *CONTEXT,
        name.alias("trait_name"),
        "num_units",
        tier.alias("tier_current"),
        F.lit(3).cast("long").alias("tier_total"),
        F.least(tier, F.lit(4).cast("long")).alias("style"),
        (tier > 0).alias("is_active"),
        "ingestion_date",
    )


def documents(t: Tables) -> DataFrame:
    """Match documents: ``metadata`` and ``info`` as JSON text, and ``date``.

    A document is what the source delivers in one piece, so a match is gathered whole.
    """
    lines = _lines(t)
    unit_order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "character_id", "tier"]
    unit = F.struct(*unit_order, "rarity", "items", "p_type")
    boards = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(unit)).alias("board"))
    units = F.transform(
        "board",
        lambda u: F.struct(
            u["character_id"].alias("character_id"),
            u["tier"].alias("tier"),
            u["rarity"].alias("rarity"),
            u["items"].alias("itemNames"),
        ),
    )
    kinds = F.sort_array(F.array_distinct(F.col("board.p_type")))

    def trait(kind: Column) -> Column:
        count = F.size(F.filter(F.col("board.p_type"), lambda p: p == kind)).cast("long")
        tier = count - 1 + F.col("o_orderkey") % 2
        return F.struct(
            F.concat(F.lit("TFT"), F.col("tft_set_number").cast("string"), F.lit("_"), kind).alias("name"),
            count.alias("num_units"),
            tier.alias("tier_current"),
            F.lit(3).alias("tier_total"),
            F.least(tier, F.lit(4).cast("long")).alias("style"),
        )

    who = players(t)
    seats = who.join(boards, who.o_orderkey == boards.l_orderkey, "left").select(
        "m",
        "match_id",
        "game_datetime",
        "tft_set_number",
        "game_version",
        "ingestion_date",
        "queue_id",
        F.struct(
            "placement",
            "puuid",
            F.concat(F.lit("Player "), F.col("o_custkey").cast("string")).alias("riotIdGameName"),
            F.concat(F.lit("T"), (F.col("o_custkey") % 10).cast("string")).alias("riotIdTagline"),
            "win",
            (1 + F.col("o_orderkey") % 10).alias("level"),
            (10 + F.col("o_orderkey") % 30).alias("last_round"),
            (F.col("o_custkey") % 60).alias("gold_left"),
            (F.col("o_orderkey") % 8).alias("players_eliminated"),
            F.floor(F.col("o_totalprice") / 1000).cast("long").alias("total_damage_to_players"),
            (F.col("o_orderkey") % 2400 + 0.5).alias("time_eliminated"),
            F.struct(F.concat(F.lit("Pet"), (F.col("o_custkey") % 5).cast("string")).alias("species")).alias(
                "companion"
            ),
            F.transform(kinds, trait).alias("traits"),
            F.coalesce(units, F.array()).alias("units"),
        ).alias("participant"),
    )
    match = ["m", "match_id", "game_datetime", "tft_set_number", "game_version", "ingestion_date", "queue_id"]
    matches = seats.groupBy(*match).agg(F.sort_array(F.collect_list("participant")).alias("participants"))
    metadata = F.struct("match_id", F.lit("6").alias("data_version"))
    info = F.struct(
        F.col("m").alias("gameId"),
        F.unix_millis("game_datetime").alias("game_datetime"),
        (1800 + F.col("m") % 600 + 0.25).alias("game_length"),
        "game_version",
        "queue_id",
        F.concat(F.lit("TFTSet"), F.col("tft_set_number").cast("string")).alias("tft_set_core_name"),
        "tft_set_number",
        F.lit("standard").alias("tft_game_type"),
        F.lit("GameComplete").alias("endOfGameResult"),
        "participants",
    )
    return matches.select(
        F.to_json(metadata).alias("metadata"), F.to_json(info).alias("info"), F.col("ingestion_date").alias("date")
    )


def ladder(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_mktsegment").alias("tier"),
        F.col("c_custkey").alias("pos"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("puuid"),
        F.col("c_acctbal").cast("long").alias("leaguePoints"),
    )


def history(t: Tables) -> DataFrame:
    """Matches per player; a player with several orders in a match has it once."""
    return t.orders.groupBy(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("puuid"),
        match_id_of(F.col("o_orderkey")).alias("match_id"),
    ).agg(
        F.max("o_orderdate").cast("timestamp").alias("game_datetime"),
        F.min(F.when(F.col("o_orderpriority") != "5-LOW", 1100).otherwise(1090)).cast("long").alias("queue_id"),
    )


KINDS = {
    "signup": ("discovered", None),
    "purchase": ("fetch_ok", None),
    "error": ("fetch_error", "connection reset"),
    "click": ("fetch_error", "API key refused (401)"),
    "view": ("dead_letter", None),
}


def shape_events(events: DataFrame) -> DataFrame:
    """Ledger events out of user events: a user and day is a match id."""
    pick = lambda i: F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[i])])
    return events.select(
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyy-MM-dd")).alias("match_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.element_at(pick(0), F.col("event_type")).alias("kind"),
        F.element_at(pick(1), F.col("event_type")).alias("message"),
    )


def ledger_events(t: Tables) -> DataFrame:
    return shape_events(t.events)


def catalogue_items(t: Tables) -> DataFrame:
    icon = F.concat(F.lit("ASSETS/Maps/"), "p_brand", F.lit(" "), "p_type", F.lit(".tex"))
    return t.part.select(F.col("p_partkey").alias("pos"), F.col("p_name").alias("apiName"), icon.alias("icon"))


def catalogue_sets(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("long")
    return t.part.select(size.alias("set_pos"), size.alias("number"), F.col("p_name").alias("item"))


def stored_items(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_partkey") % 97 == 0).select(F.lower("p_name").alias("api_name")).distinct()


def ledger(t: Tables) -> DataFrame:
    """A ledger of matches: the state of a match is that of its first order."""
    first = t.orders.groupBy(match_id_of(F.col("o_orderkey")).alias("match_id")).agg(
        F.min_by("o_orderstatus", "o_orderkey").alias("first_status"), F.min("o_orderkey").alias("first_key")
    )
    status = F.when(F.col("first_status") == "F", "success").when(F.col("first_status") == "P", "abandoned")
    return first.select("match_id", status.otherwise("error").alias("status"), (F.col("first_key") % 3).alias("retries"))


def _event_number() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def fetch_attempts(t: Tables) -> DataFrame:
    """A fetch per event; the batches are the days."""
    kinds = {"signup": "not_found", "purchase": "fetch_ok", "view": "fetch_ok", "error": "fetch_error", "click": "fetch_error"}
    pick = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    message = F.when(F.col("event_type") == "error", "connection reset").when(F.col("event_type") == "click", "refused (403)")
    return t.events.select(
        F.date_format("ts", "yyyyMMdd").alias("batch_id"),
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("match_id"),
        F.element_at(pick, F.col("event_type")).alias("kind"),
        message.alias("message"),
    )


def ledger_before(t: Tables) -> DataFrame:
    """The ledger those fetches find, by the number each event carries."""
    number = _event_number()
    status = F.when(number % 5 == 0, "success").when(number % 5 == 1, "abandoned").otherwise("error")
    return t.events.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("match_id"),
        status.alias("status"),
        (number % 3).alias("retries"),
    )


def queue_messages(t: Tables) -> DataFrame:
    """Messages of fifty event ids each; some are broken in one of three ways."""
    number = F.floor(F.col("event_id") / 50).cast("long")
    batches = t.events.groupBy(number.alias("number")).agg(
        F.sort_array(F.collect_list(F.concat(F.lit("E"), F.col("event_id").cast("string")))).alias("ids")
    )
    payload = F.to_json(
        F.struct(
            F.when(F.col("number") % 11 == 3, F.array().cast("array<string>")).otherwise(F.col("ids")).alias("match_ids"),
            F.concat(F.lit("20240101-0000-"), F.col("number").cast("string")).alias("batch_id"),
            F.size("ids").alias("size"),
        )
    )
    text = F.when(F.col("number") % 13 == 5, F.lit("{not json")).otherwise(payload)
    data = F.when(F.col("number") % 7 == 2, F.lit("!no base64!")).otherwise(F.base64(text.cast("binary")))
    return batches.select("number", data.alias("data"))
