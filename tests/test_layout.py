"""What stored tables spare their readers: checks taken on the way, searches and views that skip."""

import hashlib
import warnings
from datetime import date
from functools import partial

import pytest
from pyspark.sql import functions as F

from docs import bronze, document, player, trait, unit
from matchlake.operators import gold
from matchlake.operators.quality import KEYS, SEARCH, QualityError, assert_quality, watch_quality
from matchlake.plans import catalog as catalogs
from matchlake.plans.catalog import PARTITION, Catalog
from matchlake.sources import partitions
from matchlake.sources.bronze import write_bronze
from matchlake.streaming.ingest import run_incremental

DAYS = [date(2024, 1, d) for d in range(1, 7)]
PLAYERS = "match_id string, puuid string, placement long, win boolean, ingestion_date date"


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, str(tmp_path))


def rows_scanned(df):
    """Rows that the scan of ``df`` gave, once ``df`` has been collected."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    assert leaves.size() == 1
    return leaves.head().metrics().get("numOutputRows").get().value()


def jobs_of(spark, work):
    group = f"group-{id(work)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def players(spark, *data):
    return spark.createDataFrame(list(data), PLAYERS)


GOOD = ("M1", "a", 1, True, DAYS[0])


@pytest.mark.parametrize("bad", [(None, "b", 1, True, DAYS[0]), ("M1", "b", None, True, DAYS[1]), ("M1", "b", 1, None, None)])
def test_checks_on_the_way_refuse_what_checks_afterwards_do(spark, catalog, bad):
    name, found = "fact_player_results", []
    for how in ({"check": partial(assert_quality, table=name)}, {"watch": watch_quality(name)}):
        with pytest.raises(QualityError) as error:
            catalog.materialize(players(spark, GOOD, bad), name, "incremental", KEYS[name], **how)
        assert not catalog.has(name)
        found.append(str(error.value))
    assert found[0] == found[1]
    # and on a later load, that rewrites one date
    catalog.materialize(players(spark, GOOD), name, "incremental", KEYS[name], watch=watch_quality(name))
    with pytest.raises(QualityError):
        catalog.materialize(players(spark, bad), name, "incremental", KEYS[name], watch=watch_quality(name))
    assert [tuple(r) for r in catalog.table(name).collect()] == [GOOD]


def test_a_warning_on_the_way(spark, catalog):
    shape = "core_key string, core_key_display string, primary_trait string, top4_rate double, win_rate double"
    df = spark.createDataFrame([("a", "a", None, 1.0, 1.0), ("b", "b", None, 1.0, 1.0)], shape)
    with pytest.warns(UserWarning, match="'primary_trait': 2"):
        catalog.materialize(df, "core_comp_winrate", "table", watch=watch_quality("core_comp_winrate"))
    assert catalog.table("core_comp_winrate").count() == 2
    with pytest.raises(QualityError):
        catalog.materialize(df, "core_comp_winrate", "table", watch=watch_quality("core_comp_winrate", strict=True))
    assert watch_quality("stg_matches") is None


@pytest.mark.parametrize("name", ["fact_player_results", "unit_winrate"])
def test_an_empty_table_has_nothing_to_refuse(spark, catalog, name):
    shapes = {"fact_player_results": PLAYERS, "unit_winrate": "character_id string, top4_rate double, win_rate double"}
    kind = "table" if name == "unit_winrate" else "incremental"
    empties = [spark.createDataFrame([], shapes[name])]
    # empty, but only the job finds out
    empties.append(spark.range(9).filter(F.rand() > 2).select(*[F.lit(None).cast(t).alias(c) for c, t in (s.split() for s in shapes[name].split(", "))]))
    for df in empties:
        with warnings.catch_warnings():
            warnings.simplefilter("error", UserWarning)
            assert catalog.materialize(df, name, kind, KEYS.get(name), watch=watch_quality(name)).count() == 0


def test_a_check_on_the_way_takes_no_job_of_its_own(spark, tmp_path):
    name, df = "unit_winrate", spark.createDataFrame([("A", 1.0, 1.0)], "character_id string, top4_rate double, win_rate double")
    store = lambda folder, **how: jobs_of(spark, lambda: Catalog(spark, f"{tmp_path}/{folder}").stored(name).replace(df, **how))
    plain = store("plain")
    assert store("watch", watch=watch_quality(name)) == plain
    assert store("check", check=partial(assert_quality, table=name)) > plain


def test_a_search_skips_row_groups_without_the_ids(spark, catalog):
    """Ids without any order, so that the smallest and largest of a file say nothing."""
    name, n = "fact_player_results", 4000
    ids = [hashlib.md5(str(i).encode()).hexdigest() for i in range(n * len(DAYS))]
    data = [(key, "p", 1, True, DAYS[i // n]) for i, key in enumerate(ids)]
    table = catalog.materialize(players(spark, *data), name, "incremental", KEYS[name], search=SEARCH)
    files = table.select(F.input_file_name()).distinct().count()
    assert files >= len(DAYS) and rows_scanned(table.filter("puuid > 'a'")) == n * len(DAYS)
    wanted = ids[:20]  # more than would be compared one by one
    assert rows_scanned(table.filter(F.col("match_id").isin(wanted))) <= 2 * n
    assert rows_scanned(table.filter(F.col("match_id").isin(ids[:1] + ids[-1:]))) <= 3 * n
    got = catalog.dates_holding([name], spark.createDataFrame([(i,) for i in wanted + ["none"]], "match_id string"), SEARCH)
    assert got == {name: [DAYS[0]]}


@pytest.mark.parametrize("listed", [0, 3, 10_000])
def test_dates_of_several_tables_by_one_search(spark, catalog, monkeypatch, listed):
    """Few ids one by one or many by their range, and keys of one column or two: the same dates."""
    monkeypatch.setattr(catalogs, "SEARCH_IDS", listed)
    shape = "match_id string, puuid string, ingestion_date date"
    put = lambda name, *data: catalog.stored(name).replace(spark.createDataFrame(list(data), shape))
    put("fact_player_results", ("M1", "a", DAYS[0]), ("M2", "a", DAYS[1]), ("M3", "a", None), (None, "a", DAYS[4]))
    put("fact_traits", ("M1", "b", DAYS[2]), ("M1", "a", DAYS[3]), ("M9", "a", DAYS[4]))
    updates = spark.createDataFrame([("M1", "a"), ("M3", "a"), ("M3", "a"), (None, "a"), ("M5", None)], "match_id string, puuid string")
    names = ["fact_player_results", "fact_traits"]
    plain = {k: set(v) for k, v in catalog.dates_holding(names, updates, SEARCH).items()}
    assert plain == {"fact_player_results": {DAYS[0], None}, "fact_traits": {DAYS[2], DAYS[3]}}
    both = {k: set(v) for k, v in catalog.dates_holding(names, updates, ["match_id", "puuid"]).items()}
    assert both == {"fact_player_results": {DAYS[0], None}, "fact_traits": {DAYS[3]}}
    nothing = catalog.dates_holding(names, updates.filter("match_id is null"), SEARCH)
    assert nothing == {name: [] for name in names}


def test_a_table_behind_the_others_is_searched_for_itself(spark, tmp_path, monkeypatch):
    """A load is cut off after the players have moved to another date; units and traits follow when it is made up for."""
    def match(day):
        board = [player(f"p{i}", i, [unit("TFT16_A", 2)], [trait("TFT16_T", 1)]) for i in range(1, 9)]
        return document("M1", board, day)

    catalog, checkpoint = Catalog(spark, str(tmp_path / "a")), str(tmp_path / "cp")
    write_bronze(bronze(spark, match(DAYS[0])), catalog.path("raw_matches"))
    run_incremental(catalog, checkpoint)
    write_bronze(bronze(spark, match(DAYS[1])), catalog.path("raw_matches"))
    store = Catalog.materialize

    def cut(self, df, name, *args, **more):
        if name == "fact_traits":
            raise OSError("lost")
        return store(self, df, name, *args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(Catalog, "materialize", cut)
        with pytest.raises(Exception, match="lost"):
            run_incremental(catalog, checkpoint)
    assert {r[0] for r in catalog.table("fact_player_results").select(PARTITION).collect()} == {DAYS[1]}
    run_incremental(catalog, checkpoint)
    for name in KEYS:
        assert catalog.table(name).count() == 8
        assert {r[0] for r in catalog.table(name).select(PARTITION).collect()} == {DAYS[1]}


def test_views_of_a_gold_table_skip_what_they_do_not_show(spark, catalog, monkeypatch):
    monkeypatch.setattr(partitions, "SORTED_ROW_GROUP_BYTES", 64 << 10)
    n = 60_000
    grades = F.element_at(F.array(*[F.lit(g) for g in "SABCD"]), (F.pmod(F.xxhash64("id"), F.lit(5)) + 1).cast("int"))
    df = spark.range(n).select(
        F.concat(F.lit("16."), F.pmod(F.hash("id"), F.lit(4)).cast("string"), F.lit(".1")).alias("patch"),
        F.concat(F.lit("TFT16_"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)).cast("string")).alias("character_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("item_combo"),
        grades.alias("tier_winrate"),
        F.rand(1).alias("top4_rate"),
        F.rand(2).alias("win_rate"),
    )
    table = catalog.materialize(df.repartition(7), "item_combo_winrate", "table", watch=watch_quality("item_combo_winrate"))
    assert table.count() == n
    narrowed = {"patch": "16.2.1", "tier": "B"}
    got = gold.meta_view(table, **narrowed)
    want = df.filter("patch = '16.2.1' and tier_winrate = 'B'")
    assert got.count() == want.count() > 0
    scanned = rows_scanned(table.filter("patch = '16.2.1' and tier_winrate = 'B'"))
    assert want.count() <= scanned < n / 4
    one = table.filter("patch = '16.2.1' and tier_winrate = 'B' and character_id = 'TFT16_7'")
    assert one.count() == want.filter("character_id = 'TFT16_7'").count() and rows_scanned(one) < scanned
