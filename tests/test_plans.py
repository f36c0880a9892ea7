"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from matchlake.operators import discovery, gold, silver
from matchlake.operators.ranking import top_per_group
from matchlake.operators.staging import stage_matches
from matchlake.plans import fixtures as fx
from matchlake.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """Documents and facts as parquet, so that plans start at a scan."""
    root = str(tmp_path_factory.mktemp("facts"))
    tables = fx.Tables(spark, small)
    fx.documents(tables).write.parquet(f"{root}/documents")
    players = silver.player_results(stage_matches(spark.read.parquet(f"{root}/documents")))
    players.write.parquet(f"{root}/players")
    players = spark.read.parquet(f"{root}/players")
    silver.unit_facts(players).write.parquet(f"{root}/units")
    silver.trait_facts(players).write.parquet(f"{root}/traits")
    return lambda name: spark.read.parquet(f"{root}/{name}")


def test_facts_need_no_shuffle(stored):
    players = silver.player_results(stage_matches(stored("documents")))
    for df in (players, silver.unit_facts(stored("players")), silver.trait_facts(stored("players"))):
        assert "Exchange" not in plan(df)
    operators = "".join(line for line in plan(players).splitlines() if "FileScan" not in line)
    assert operators.count("from_json") == 4  # metadata twice (filter, columns), info, participants


def test_scans_read_needed_columns_only(stored):
    read = re.search(r"ReadSchema: (\S+)", plan(gold.unit_winrate(stored("units")))).group(1)
    assert "item_names_json" not in read and "game_datetime" not in read
    assert "traits_json" not in plan(silver.unit_facts(stored("players")))


def test_filters_reach_the_scan(stored):
    assert "PushedFilters: [IsNotNull(is_active), EqualTo(is_active,true)]" in plan(gold.primary_trait(stored("traits")))
    assert "GreaterThanOrEqual(item_count,2)" in plan(gold.item_combo_winrate(stored("units")))


def test_rollups_combine_before_the_shuffle(stored):
    text = plan(gold.unit_winrate(stored("units")))
    assert text.count("Exchange hashpartitioning") == 2 and "partial_count" in text


def test_hot_groups_are_cut_before_the_shuffle(stored):
    text = plan(gold.primary_trait(stored("traits")))
    assert re.search(r"Exchange hashpartitioning.*?WindowGroupLimit .*?Partial", text, re.S)
    text = plan(top_per_group(stored("units"), ["patch"], [F.col("placement").asc()], k=200))
    assert re.search(r"Exchange hashpartitioning.*?WindowGroupLimit .*?Partial", text, re.S)


def test_compositions_are_dealt_once(spark, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(gold.core_comp_winrate(stored("units"), stored("traits")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # units, traits, and the rates by composition
    assert text.count("Exchange hashpartitioning") == 3


def test_players_come_before_their_matches_are_ranked(spark, small):
    tables = fx.Tables(spark, small)
    text = plan(discovery.discover_matches(fx.history(tables), fx.ladder(tables).limit(5), as_of="2024-01-01"))
    assert text.index("row_number") < text.index("LeftSemi")


def test_large_cuts_come_before_the_shuffle_too(stored):
    text = plan(top_per_group(stored("units"), ["patch"], [F.col("placement").asc()], k=5000))
    assert re.search(r"Exchange hashpartitioning.*?WindowGroupLimit .*?Partial", text, re.S) and text.count("Exchange") == 1


def test_a_ledger_batch_reads_its_own_ids_only(spark, tmp_path):
    from matchlake.operators.ledger import fold_ledger
    from matchlake.streaming.ledger import LedgerTable

    table = LedgerTable(spark, str(tmp_path))
    events = fx.ledger_events(fx.Tables(spark, "/root/testdata/sf0.001"))
    table.write(fold_ledger(events), 0)
    ids = spark.createDataFrame([("1_2024-01-01",)], "match_id string")
    text = plan(table.current(ids=ids))
    assert text.index("Window") < text.index("LeftSemi")  # the join lies below the window


def test_bronze_is_read_without_shuffling_documents(spark, small, tmp_path):
    from matchlake.sources import bronze

    documents, root = fx.documents(fx.Tables(spark, small)), str(tmp_path / "bronze")
    changed = documents.withColumn("info", F.regexp_replace("info", '"placement":[0-9]+', '"placement":8'))
    bronze.write_bronze(documents, root)
    for read in (bronze.read_bronze, bronze.read_matches):
        assert "Exchange" not in plan(read(spark, root)) and "Join" not in plan(read(spark, root))
    bronze.write_bronze(changed.filter("date = '2024-01-03'"), root)
    assert bronze.read_bronze(spark, root).count() == documents.count()
    for read in (bronze.read_bronze, bronze.read_matches):
        text = plan(read(spark, root))
        # the one exchange sends the narrow list of replaced copies to the tasks
        assert text.count("Exchange") == 1 and "BroadcastExchange" in text
        assert "Window" not in text


STORING = {"meta_view_stored", "stream_dedupe_expiry", "upsert_table", "bronze_round_trip", "medallion_refresh", "incremental_refresh", "stream_ledger", "full_refresh_table", "sync_columns_table", "expire_bronze", "stream_dedupe", "changed_documents_refresh", "medallion_players", "incremental_gold", "staged_view", "bronze_as_of", "layer_folders", "collector_refresh"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORING))
def test_nothing_leaves_the_jvm_and_nothing_is_crossed(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
