"""One query per operator, over the tables of a scale factor.

Every query reads whole tables. Wall-clock columns are left out and timestamps are given
without a zone, so that results can be compared between engines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import config
from matchlake.functions import icon_slots, icon_url, ordered_concat, patch_of, performance_tier, round2, strip_set_prefix
from matchlake.operators import assets, discovery, gold, incremental, ledger, quality, silver
from matchlake.operators.ranking import first_distinct, top_per_group
from matchlake.operators.staging import stage_matches
from matchlake.plans import fixtures as fx
from matchlake.plans.catalog import Catalog
from matchlake.plans.medallion import run_model, run_pipeline
from matchlake.sources import bronze, messages, scratch
from matchlake.sources.catalogue import read_item_catalogue
from matchlake.streaming.events import announce_collector, read_events, refresh_on_events
from matchlake.streaming.ingest import run_incremental
from matchlake.streaming.ledger import LedgerTable, stream_ledger

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2001-08-02 00:00:00"
HOURS = 24 * 365 * 3
WALL_CLOCK = ("dbt_updated_at", "source_file")


def plain(df: DataFrame) -> DataFrame:
    """``df`` without wall-clock columns and with timestamps without a zone."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
            for f in df.schema.fields
            if f.name not in WALL_CLOCK
        ]
    )


def query(build: Callable[[fx.Tables], DataFrame]) -> Callable[[fx.Tables], DataFrame]:
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        config.configure(spark)
        return plain(build(fx.Tables(spark, folder)))

    # The suffix keeps a query from hiding the operator it is named after.
    QUERIES[build.__name__.removesuffix("_query")] = run
    return build


def run_folder(t: fx.Tables, name: str) -> str:
    """A new folder in the shared space for one run of a query that stores tables."""
    return scratch.run_folder(t.spark, name)


@contextmanager
def once(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` made once for several uses inside the block."""
    with scratch.scope():
        yield scratch.save(df, "documents")


# --- documents to facts ----------------------------------------------------------


def _players(t: fx.Tables) -> DataFrame:
    return silver.player_results(stage_matches(fx.documents(t)))


@query
def stage_matches_query(t):
    staged = stage_matches(fx.documents(t))
    count = F.json_array_length("participants_json").cast("long").alias("n_participants")
    return staged.select("*", count).drop("participants_json")


@query
def player_results(t):
    return _players(t)


@query
def trait_facts(t):
    return silver.trait_facts(_players(t))


@query
def unit_facts(t):
    return silver.unit_facts(_players(t))


@query
def documents_to_unit_winrate(t):
    return gold.unit_winrate(silver.unit_facts(_players(t)))


@query
def documents_to_core_comp_winrate(t):
    players = _players(t)
    return gold.core_comp_winrate(silver.unit_facts(players), silver.trait_facts(players))


@query
def item_combo_per_copy(t):
    return gold.item_combo_winrate(silver.unit_facts(_players(t)), per_copy=True)


@query
def rank_units(t):
    return gold.rank_units(silver.unit_facts(_players(t)))


# --- facts to win rates ----------------------------------------------------------


@query
def unit_winrate(t):
    return gold.unit_winrate(fx.unit_rows(t))


@query
def core_comp_winrate(t):
    return gold.core_comp_winrate(fx.unit_rows(t), fx.trait_rows(t))


@query
def item_combo_winrate(t):
    return gold.item_combo_winrate(fx.unit_rows(t))


@query
def primary_trait(t):
    return gold.primary_trait(fx.trait_rows(t))


@query
def win_rate_rollup(t):
    return gold.win_rate_rollup(fx.trait_rows(t), ["tft_set_number", "trait_name", "tier_current"], min_games=5)


@query
def top_per_group_query(t):
    best = top_per_group(
        t.orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], k=3, rank_name="seat"
    )
    return best.select("o_custkey", "o_orderkey", "o_totalprice", "seat")


@query
def distinct_rows(t):
    return fx.unit_rows(t).select(*gold.PLAYER, "character_id", "tier", "rarity").distinct()


@query
def ordered_concat_query(t):
    champion = F.col("character_id")
    return (
        fx.unit_rows(t)
        .groupBy("match_id", "puuid")
        .agg(
            ordered_concat(champion, champion).alias("core_key"),
            ordered_concat(strip_set_prefix(champion, anywhere=True), champion).alias("core_key_display"),
            ordered_concat(icon_url(champion, "champions"), champion).alias("core_icon_urls"),
        )
    )


@query
def count_distinct_core(t):
    size = gold.core_size(F.col("champions"))
    return gold.core_units(fx.unit_rows(t)).select("match_id", "puuid", size.alias("core_size"))


@query
def icon_slots_query(t):
    champion = F.col("character_id")
    urls = (
        fx.unit_rows(t)
        .groupBy("match_id", "puuid")
        .agg(ordered_concat(icon_url(champion, "champions"), champion).alias("urls"))
    )
    return urls.select("match_id", "puuid", *icon_slots(F.col("urls"), config.COMP_SLOTS, "unit_icon_"))


@query
def performance_tier_query(t):
    games, rate = F.count(F.lit(1)), round2(F.count_if("top4") / F.count(F.lit(1)) * 100)
    return (
        fx.unit_rows(t)
        .groupBy("character_id", "tier", "rarity")
        .agg(games.alias("games"), rate.alias("top4_rate"))
        .withColumn("grade", performance_tier(F.col("games"), F.col("top4_rate")))
    )


@query
def patch_extract(t):
    return fx.players(t).select("match_id", "puuid", "game_version", patch_of(F.col("game_version")).alias("patch"))


@query
def meta_view(t):
    return gold.meta_view(gold.item_combo_winrate(fx.unit_rows(t)), patch="16.2.700", tier="B")


@query
def meta_view_stored(t):
    """The same view of a stored table, sorted for it."""
    catalog = Catalog(t.spark, run_folder(t, "views"))
    items = catalog.materialize(gold.item_combo_winrate(fx.unit_rows(t)), "item_combo_winrate", "table")
    return gold.meta_view(items, patch="16.2.700", tier="B")


# --- incremental loading ---------------------------------------------------------


@query
def incremental_slice(t):
    rows = fx.players(t).select("match_id", "puuid", "placement", "ingestion_date")
    target = rows.filter(F.col("ingestion_date") <= "2024-01-07")
    return incremental.incremental_slice(rows, target, lookback_days=1)


def _upsert_sides(t: fx.Tables) -> tuple[DataFrame, DataFrame]:
    target = fx.players(t).select("puuid", F.col("o_totalprice").alias("amount"), "ingestion_date")
    key = F.concat(F.lit("P"), (F.col("c_custkey") * 20).cast("string"))
    day = F.date_add(F.lit("2024-01-05").cast("date"), (F.col("c_custkey") % 10).cast("int"))
    updates = t.customer.select(key.alias("puuid"), F.col("c_acctbal").alias("amount"), day.alias("ingestion_date"))
    return target, updates


@query
def upsert(t):
    return incremental.upsert(*_upsert_sides(t), ["puuid"])


@query
def upsert_table(t):
    """The same upsert on a stored table, where updates also move rows between dates."""
    target, updates = _upsert_sides(t)
    catalog = Catalog(t.spark, run_folder(t, "upsert"))
    for rows in (target, updates):
        catalog.materialize(rows, "fact_player_results", "incremental", ["puuid"])
    return catalog.table("fact_player_results")


@query
def full_refresh_table(t):
    """A rebuilt table holds the second load only."""
    target, updates = _upsert_sides(t)
    catalog = Catalog(t.spark, run_folder(t, "full"))
    catalog.materialize(target, "fact_player_results", "incremental", ["puuid"])
    catalog.materialize(updates, "fact_player_results", "incremental", ["puuid"], full_refresh=True)
    return catalog.table("fact_player_results")


@query
def sync_columns_table(t):
    """Three loads: with ``amount``, without it, and with it again; ``seat`` becomes text on the way."""
    day = F.col("ingestion_date")
    seats = fx.players(t).select("puuid", "placement", "o_totalprice", day)
    kind = F.pmod(F.col("o_totalprice").cast("long"), F.lit(3))
    first = seats.filter(kind == 0).select("puuid", F.col("o_totalprice").alias("amount"), F.col("placement").alias("seat"), day)
    second = seats.filter(kind == 1).select("puuid", F.col("placement").alias("seat"), day)
    text = F.concat(F.lit("S"), F.col("placement").cast("string")).alias("seat")
    third = seats.filter(kind == 2).select("puuid", F.col("o_totalprice").alias("amount"), text, day)
    catalog = Catalog(t.spark, run_folder(t, "sync"))
    for rows in (first, second, third):
        catalog.materialize(rows, "fact_player_results", "incremental", ["puuid"])
    return catalog.table("fact_player_results")


@query
def sync_columns(t):
    old = fx.players(t).select("puuid", "placement", F.lit(1).alias("dropped"))
    new = fx.players(t).select("puuid", "placement", F.col("o_totalprice").alias("added"))
    return incremental.sync_columns(old, new)


# --- bronze ----------------------------------------------------------------------


@query
def bronze_partition_counts(t):
    return bronze.bronze_partition_counts(fx.documents(t), n=5)


@query
def bronze_round_trip(t):
    root = run_folder(t, "bronze")
    bronze.write_bronze(fx.documents(t), root)
    staged = stage_matches(bronze.read_bronze(t.spark, root))
    return staged.select("match_id", "game_id", "game_datetime", "game_length_seconds", "queue_id", "ingestion_date")


@query
def staged_view(t):
    """The staging model as the view it is stored as, with the date of the folder each document lies in."""
    catalog = Catalog(t.spark, run_folder(t, "view"))
    bronze.write_bronze(fx.documents(t), catalog.path("raw_matches"))
    run_model(catalog, "stg_matches")
    folder = F.regexp_extract("source_file", "/date=([0-9-]+)/[^/]+$", 1).alias("folder_date")
    return t.spark.table("stg_matches").select("match_id", "data_version", "game_id", "ingestion_date", folder)


@query
def bronze_as_of(t):
    """Documents without a date go to the UTC date of the moment they are written at."""
    root = run_folder(t, "as-of")
    moment = F.lit("2024-03-01 23:30:00").cast("timestamp")
    bronze.write_bronze(fx.documents(t).drop("date"), root, as_of=moment)
    return stage_matches(bronze.read_bronze(t.spark, root)).select("match_id", "ingestion_date")


@query
def layer_folders(t):
    """Rows of the stored tables, read from the folders that renamed layers put them in."""
    root = run_folder(t, "layers")
    catalog = Catalog(t.spark, root, layer_schemas={"bronze": "raw", "silver": " facts "})
    bronze.write_bronze(fx.documents(t), catalog.path("raw_matches"))
    run_pipeline(catalog, mode="full")
    parts = []
    for name in ("raw/raw_matches", "facts/fact_player_results", "facts/fact_traits", "facts/fact_units"):
        reader = t.spark.read.text if name.startswith("raw") else t.spark.read.parquet
        parts.append(reader(f"{root}/{name}").agg(F.lit(name).alias("folder"), F.count(F.lit(1)).alias("n")))
    return reduce(DataFrame.unionByName, parts)


@query
def collector_refresh(t):
    """The log after a collector run, the refresh it starts, and a second look that finds nothing new."""
    root = run_folder(t, "events")
    catalog = Catalog(t.spark, root)
    summary = discovery.collector_summary(discovery.classify_ids(fx.history(t), fx.ledger(t)))
    announce_collector(catalog, summary)
    bronze.write_bronze(fx.documents(t), catalog.path("raw_matches"))
    for _ in range(2):
        refresh_on_events(catalog, f"{root}/events-done", lambda: run_incremental(catalog, f"{root}/checkpoint"))
    facts = [F.max(F.get_json_object("payload", f"$.{c}").cast("long")).alias(c) for c in ("new_ids", "batches")]
    return read_events(catalog).groupBy("event").agg(F.count(F.lit(1)).alias("n"), *facts)


@query
def expire_bronze(t):
    """Documents per date that retention leaves."""
    root = run_folder(t, "expire")
    bronze.write_bronze(fx.documents(t), root)
    bronze.expire_bronze(t.spark, root, days=10, as_of=date(2024, 1, 18))
    return bronze.bronze_partition_counts(bronze.read_bronze(t.spark, root), n=1000)


@query
def stream_dedupe(t):
    """Ids of a stream of documents that come on two dates, each once."""
    root, out = run_folder(t, "dedupe"), run_folder(t, "dedupe-out")
    with once(fx.documents(t)) as documents:
        bronze.write_bronze(documents.unionByName(documents.withColumn("date", F.date_add("date", 40))), root)
    stream = bronze.stream_bronze(t.spark, root, dedupe=True).select("match_id").writeStream.format("parquet")
    with scratch.tidy(t.spark):
        stream.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    return t.spark.read.schema("match_id string").parquet(f"{out}/rows")


@query
def stream_dedupe_expiry(t):
    """Documents of a stream that keeps ids for 30 days: copies 10 and 101 days later, a third of them, then 100 days later."""
    root, out = run_folder(t, "expiry"), run_folder(t, "expiry-out")
    third = F.pmod(F.xxhash64("metadata"), F.lit(3)) == 0
    with once(fx.documents(t)) as documents, scratch.tidy(t.spark):
        for later, part in ((0, documents), (10, documents), (101, documents.filter(third)), (100, documents)):
            bronze.write_bronze(part.withColumn("date", F.date_add("date", later)), root)
            stream = bronze.stream_bronze(t.spark, root, dedupe=True, dedupe_days=30).select("match_id", "date")
            writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint")
            writer.trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    return t.spark.read.schema("match_id string, date date").parquet(f"{out}/rows")


@query
def changed_documents_refresh(t):
    """Two writes to the same dates, the second changing documents, each followed by a refresh."""
    root = run_folder(t, "changed")
    catalog = Catalog(t.spark, root)
    other = F.regexp_replace("info", '"placement":[0-9]+', '"placement":8')
    odd = F.pmod(F.xxhash64("metadata"), F.lit(2)) == 1
    with once(fx.documents(t)) as documents:
        for version in (documents.withColumn("info", F.when(odd, other).otherwise(F.col("info"))), documents):
            bronze.write_bronze(version, catalog.path("raw_matches"))
            run_incremental(catalog, f"{root}/checkpoint")
    return catalog.table("core_comp_winrate")


@query
def medallion_players(t):
    """The stored player facts of a full refresh."""
    catalog = Catalog(t.spark, run_folder(t, "medallion"))
    bronze.write_bronze(fx.documents(t), catalog.path("raw_matches"))
    run_pipeline(catalog, mode="full", full_refresh=True)
    return catalog.table("fact_player_results")


@query
def medallion_refresh(t):
    """Documents to stored gold tables through the layer runner."""
    catalog = Catalog(t.spark, run_folder(t, "medallion"))
    bronze.write_bronze(fx.documents(t), catalog.path("raw_matches"))
    run_pipeline(catalog, mode="daily")
    return catalog.table("item_combo_winrate")


@query
def incremental_refresh(t):
    """Documents to stored gold tables through the file stream."""
    root = run_folder(t, "incremental")
    catalog = Catalog(t.spark, root)
    bronze.write_bronze(fx.documents(t), catalog.path("raw_matches"))
    run_incremental(catalog, f"{root}/checkpoint", on_duplicate="error")
    return catalog.table("unit_winrate")


@query
def incremental_gold(t):
    """Gold after three loads: some dates, further ones, then late and changed documents of all dates."""
    root = run_folder(t, "gold")
    catalog = Catalog(t.spark, root)
    late = F.pmod(F.xxhash64("metadata"), F.lit(3)) == 0
    early = F.col("date") < "2024-01-05"
    with once(fx.documents(t)) as documents:
        other = documents.withColumn("info", F.regexp_replace("info", '"placement":[0-9]+', '"placement":8'))
        for part in (documents.filter(early & ~late), other.filter(~early & ~late), documents):
            bronze.write_bronze(part, catalog.path("raw_matches"))
            run_incremental(catalog, f"{root}/checkpoint")
    return catalog.table("item_combo_winrate")


# --- discovery -------------------------------------------------------------------


@query
def tracked_players(t):
    return discovery.tracked_players(
        fx.ladder(t), {"MACHINERY": 200, "HOUSEHOLD": 50}, paged_tier="BUILDING", paged_limit=200
    )


@query
def first_distinct_query(t):
    return first_distinct(t.events.select("user_id", "event_id"), "user_id", "event_id", 100)


@query
def recent_matches(t):
    return discovery.recent_matches(fx.history(t), hours=HOURS, per_player=5, as_of=AS_OF)


@query
def discover_matches(t):
    players = fx.ladder(t).filter(F.col("tier").isin("MACHINERY", "HOUSEHOLD"))
    return discovery.discover_matches(fx.history(t), players, as_of=AS_OF, hours=HOURS, per_player=5)


@query
def select_unhandled(t):
    return discovery.select_unhandled(fx.history(t).select("match_id").distinct(), fx.ledger(t))


@query
def collector_summary(t):
    return discovery.collector_summary(discovery.classify_ids(fx.history(t), fx.ledger(t)))


@query
def batch_ids(t):
    batches = discovery.batch_ids(fx.history(t), as_of="2024-01-01 06:30:00")
    return batches.withColumn("match_ids", F.array_join("match_ids", ","))


@query
def decode_messages(t):
    decoded = messages.decode_messages(fx.queue_messages(t))
    return decoded.select("number", "batch_id", F.array_join("match_ids", ",").alias("match_ids"), "size", "rejected")


@query
def message_ids(t):
    return messages.message_ids(messages.decode_messages(fx.queue_messages(t)))


@query
def split_dead_letters(t):
    deliveries = fx.ledger_events(t).groupBy("match_id").agg(F.count(F.lit(1)).alias("deliveries"))
    _, spent = messages.split_dead_letters(deliveries)
    return spent


# --- ledger ----------------------------------------------------------------------


@query
def fold_ledger(t):
    return ledger.fold_ledger(fx.ledger_events(t))


@query
def fold_ledger_long_errors(t):
    """Error texts of many hundred characters; documents keep the first 500."""
    return ledger.fold_ledger(fx.ledger_events(t).withColumn("message", F.repeat("message", F.lit(60))))


@query
def fold_ledger_sliced(t):
    """The same fold in slices of a few events, so that nearly every id lies in several."""
    return ledger.fold_ledger(fx.ledger_events(t), slice_events=4)


@query
def fold_ledger_prior(t):
    """Morning events folded onto nothing, all others onto that."""
    events = fx.ledger_events(t)
    noon = F.hour("event_time") < 12
    return ledger.fold_ledger(events.filter(~noon), ledger.fold_ledger(events.filter(noon)))


@query
def fold_ledger_lowered_limits(t):
    """Documents made under high limits, folded on under low ones, in slices."""
    events = fx.ledger_events(t)
    noon = F.hour("event_time") < 12
    before = ledger.fold_ledger(events.filter(noon), max_retries=6, max_dlq=5)
    return ledger.fold_ledger(events.filter(~noon), before, max_retries=2, max_dlq=1, slice_events=3)


@query
def requeue_second_load(t):
    """What the second of two loads asks for again."""
    events = fx.ledger_events(t)
    noon = F.hour("event_time") < 12
    late = events.filter(~noon)
    folded = ledger.fold_ledger(late, ledger.fold_ledger(events.filter(noon)))
    return ledger.requeue(folded, F.lit("2024-02-01 00:00:00").cast("timestamp"), touched=late)


@query
def stream_ledger_query(t):
    """The ledger after three micro-batches, each the next third of the time, by a restarted stream."""
    root, source = run_folder(t, "ledger"), run_folder(t, "ledger-events")
    events = fx.ledger_events(t)
    first, last = events.agg(F.min(F.unix_micros("event_time")), F.max(F.unix_micros("event_time"))).first()
    third = F.floor((F.unix_micros("event_time") - first) * 3 / F.lit(max(last - first, 1)))
    table = LedgerTable(t.spark, f"{root}/ledger")
    for number in range(3):
        part = F.least(third, F.lit(2)) == number
        events.filter(part).write.mode("append").parquet(source)
        stream = t.spark.readStream.schema(events.schema).parquet(source)
        stream_ledger(stream, table, f"{root}/checkpoint").awaitTermination()
    return table.current()


@query
def requeue(t):
    return ledger.requeue(ledger.fold_ledger(fx.ledger_events(t)), F.lit("2024-02-01 00:00:00").cast("timestamp"))


@query
def ledger_status_counts(t):
    return ledger.ledger_status_counts(ledger.fold_ledger(fx.ledger_events(t)))


@query
def batch_outcomes(t):
    return ledger.batch_outcomes(fx.fetch_attempts(t), fx.ledger_before(t))


# --- assets ----------------------------------------------------------------------


@query
def item_catalogue(t):
    """The items of a catalogue document, written as one piece and read back."""
    path = run_folder(t, "catalogue")
    items = fx.catalogue_items(t).groupBy().agg(F.sort_array(F.collect_list(F.struct("pos", "apiName", "icon"))).alias("items"))
    one = F.struct(F.lit(1).alias("number"), F.transform("items", lambda x: x["apiName"]).alias("items"))
    items.select(F.to_json(F.struct("items", F.array(one).alias("setData"))).alias("value")).coalesce(1).write.text(path)
    return read_item_catalogue(t.spark, path).items


@query
def item_lookup(t):
    return assets.item_lookup(fx.catalogue_items(t))


@query
def latest_set(t):
    return assets.latest_set(fx.catalogue_sets(t))


@query
def item_icon_urls(t):
    return assets.item_icon_urls(fx.catalogue_items(t), fx.catalogue_sets(t), fx.stored_items(t))


@query
def champion_icon_urls(t):
    stored = fx.unit_rows(t).filter("character_id like '%Brand2%'").select(F.lower("character_id").alias("id"))
    return assets.champion_icon_urls(fx.unit_rows(t), stored.distinct())


@query
def distinct_champions(t):
    return assets.distinct_champions(fx.unit_rows(t))


@query
def distinct_items(t):
    return assets.distinct_items(fx.unit_rows(t))


# --- quality ---------------------------------------------------------------------


@query
def check_not_null(t):
    probe = fx.players(t).select(
        "match_id", "patch", F.nullif(F.col("placement"), F.lit(3)).alias("placement"), "queue_id"
    )
    return quality.check_not_null(probe, ["match_id", "patch", "placement", "queue_id"])


@query
def check_unique(t):
    return quality.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])
