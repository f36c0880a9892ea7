"""High-water mark, upsert, stored tables and their recovery."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from matchlake.operators.incremental import DuplicateKeyError, incremental_slice, sync_columns, unique_updates, upsert
from matchlake.plans.catalog import Catalog
from matchlake.sources import files

D = [date(2024, 1, day) for day in range(1, 10)]
SCHEMA = "k string, v long, ingestion_date date"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def content(df):
    return sorted((tuple(r) for r in df.select("k", "v", "ingestion_date").collect()), key=str)


def test_slice(spark):
    source = rows(spark, ("a", 1, D[0]), ("b", 2, D[1]), ("c", 3, D[2]), ("d", 4, None))
    target = rows(spark, ("x", 0, D[1]))
    keys = lambda df: sorted(r.k for r in df.collect())
    assert keys(incremental_slice(source, target)) == ["b", "c"]
    assert keys(incremental_slice(source, target, lookback_days=1)) == ["a", "b", "c"]
    assert keys(incremental_slice(source, D[2])) == ["c"]
    assert source.count() == incremental_slice(source, None).count() == incremental_slice(source, target.limit(0)).count()


def test_upsert_keeps_null_keys_apart(spark):
    target = rows(spark, ("a", 1, D[0]), (None, 2, D[0]))
    got = upsert(target, rows(spark, ("a", 9, D[1]), (None, 8, D[1]), ("n", 7, D[1])), ["k"])
    assert content(got) == sorted([("a", 9, D[1]), ("n", 7, D[1]), (None, 2, D[0]), (None, 8, D[1])], key=str)


def test_duplicate_updates(spark):
    twice = rows(spark, ("a", 1, D[0]), ("a", 2, D[1]), (None, 1, D[0]), (None, 1, D[0]))
    with pytest.raises(DuplicateKeyError):
        upsert(rows(spark), twice, ["k"])
    got = unique_updates(twice, ["k"], "latest")
    assert content(got) == sorted([("a", 2, D[1]), (None, 1, D[0]), (None, 1, D[0])], key=str)


def test_sync_columns(spark):
    target = spark.createDataFrame([("a", 1)], "k string, old long")
    shape = spark.createDataFrame([], "new date, k string")
    got = sync_columns(target, shape)
    assert got.columns == ["new", "k"] and tuple(got.first()) == (None, "a")


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, str(tmp_path))


def load(catalog, df, **options):
    return catalog.materialize(df, "fact_units", "incremental", ["k"], **options)


def folders(catalog):
    return catalog.stored("fact_units").partitions()


def test_stored_upsert_moves_rows_and_drops_emptied_partitions(spark, catalog):
    load(catalog, rows(spark, ("a", 1, D[0]), ("b", 2, D[1]), ("c", 3, D[2])))
    untouched = f"{catalog.path('fact_units')}/ingestion_date=2024-01-03"
    before = sorted(str(p) for p in Path(untouched).rglob("*"))
    got = load(catalog, rows(spark, ("a", 10, D[1]), ("n", 4, D[3])))
    assert content(got) == [("a", 10, D[1]), ("b", 2, D[1]), ("c", 3, D[2]), ("n", 4, D[3])]
    assert folders(catalog) == [f"ingestion_date=2024-01-0{d}" for d in (2, 3, 4)]
    assert before == sorted(str(p) for p in Path(untouched).rglob("*"))
    assert catalog.newest_partition("fact_units") == D[3]


def test_whole_rows_are_dealt_only_where_keys_came_twice(spark, catalog, monkeypatch):
    dealt = []
    monkeypatch.setattr("matchlake.plans.catalog.unique_updates", lambda *a: dealt.append(1) or unique_updates(*a))
    once = [("a", 1, D[0]), ("b", 2, D[1]), (None, 3, D[1]), (None, 3, D[1])]
    assert content(load(catalog, rows(spark, *once), on_duplicate="latest")) == sorted(once, key=str)
    assert not dealt
    got = load(catalog, rows(spark, ("a", 5, D[0]), ("a", 6, D[2]), ("c", 7, D[0]), (None, 8, D[0])), on_duplicate="latest")
    kept = [("a", 6, D[2]), ("c", 7, D[0]), (None, 8, D[0]), *once[1:]]
    assert dealt and content(got) == sorted(kept, key=str)
    with pytest.raises(ValueError, match="unknown on_duplicate"):
        load(catalog, rows(spark, *once), on_duplicate="newest")


def test_a_staged_frame_is_not_staged_again(spark, catalog, monkeypatch):
    rows(spark, ("a", 1, D[0]), ("b", 2, D[1])).write.parquet(f"{catalog.root}/staged")
    staged = spark.read.schema(SCHEMA).parquet(f"{catalog.root}/staged")
    monkeypatch.setattr("matchlake.plans.catalog.scratch.save", None)
    assert content(load(catalog, staged, on_duplicate="latest", staged=True)) == [("a", 1, D[0]), ("b", 2, D[1])]


def test_loading_again_changes_nothing(spark, catalog):
    df = rows(spark, ("a", 1, D[0]), ("b", 2, D[1]))
    first = content(load(catalog, df))
    assert content(load(catalog, df)) == first


def test_updates_without_keys_only_add_rows(spark, catalog):
    load(catalog, rows(spark, ("a", 1, D[0])))
    got = load(catalog, rows(spark, (None, 2, D[0]), (None, 3, D[1])))
    assert content(got) == sorted([("a", 1, D[0]), (None, 2, D[0]), (None, 3, D[1])], key=str)


def test_full_refresh_replaces_all(spark, catalog):
    load(catalog, rows(spark, ("a", 1, D[0]), ("b", 2, D[1])))
    assert content(load(catalog, rows(spark, ("z", 0, D[1])), full_refresh=True)) == [("z", 0, D[1])]
    assert folders(catalog) == ["ingestion_date=2024-01-02"]


def test_duplicates_stop_a_load_before_anything_changes(spark, catalog):
    twice = rows(spark, ("a", 1, D[0]), ("a", 2, D[1]))
    with pytest.raises(DuplicateKeyError):
        load(catalog, twice)
    assert not catalog.has("fact_units")
    load(catalog, rows(spark, ("a", 0, D[0])))
    with pytest.raises(DuplicateKeyError):
        load(catalog, twice)
    assert content(catalog.table("fact_units")) == [("a", 0, D[0])]
    assert content(load(catalog, twice, on_duplicate="latest")) == [("a", 2, D[1])]


def test_columns_come_and_go(spark, catalog):
    load(catalog, rows(spark, ("a", 1, D[0]), ("b", 2, D[1])))
    changed = spark.createDataFrame([("b", "new", D[1])], "k string, extra string, ingestion_date date")
    got = load(catalog, changed)
    assert set(got.columns) == {"k", "extra", "ingestion_date"}
    assert sorted((r.k, r.extra) for r in got.collect()) == [("a", None), ("b", "new")]


def test_a_dropped_column_that_returns_is_empty_in_old_partitions(spark, catalog):
    shape = "k string, v long, ingestion_date date"
    load(catalog, spark.createDataFrame([("a", 1, D[0]), ("b", 2, D[1])], shape))
    load(catalog, spark.createDataFrame([("b", D[1])], "k string, ingestion_date date"))
    got = load(catalog, spark.createDataFrame([("c", 3, D[2])], shape))
    assert sorted((r.k, r.v) for r in got.collect()) == [("a", None), ("b", None), ("c", 3)]


def test_a_retyped_column_reads(spark, catalog):
    load(catalog, spark.createDataFrame([("a", 1, D[0]), ("b", 2, D[1])], "k string, v long, ingestion_date date"))
    got = load(catalog, spark.createDataFrame([("b", "x", D[1])], "k string, v string, ingestion_date date"))
    assert sorted((r.k, r.v) for r in got.collect()) == [("a", "1"), ("b", "x")]


@pytest.mark.parametrize("cut", ["write_note", "exists"])
def test_a_cut_off_replacement_leaves_the_old_rows(spark, catalog, monkeypatch, cut):
    load(catalog, rows(spark, ("a", 1, D[0]), ("b", 2, D[1]), ("c", 3, D[2])))
    old = content(catalog.table("fact_units"))

    def lost(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(files, cut, lost)
        with pytest.raises(OSError):
            load(catalog, rows(spark, ("a", 10, D[1]), ("c", 30, D[2])))
    assert content(catalog.table("fact_units")) == old
    got = load(catalog, rows(spark, ("a", 10, D[1]), ("c", 30, D[2])))
    assert content(got) == [("a", 10, D[1]), ("b", 2, D[1]), ("c", 30, D[2])]


def test_a_failed_build_leaves_the_old_table(spark, catalog):
    catalog.materialize(spark.range(3), "unit_winrate", "table")
    broken = spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        catalog.materialize(broken, "unit_winrate", "table")
    assert catalog.table("unit_winrate").count() == 3

    def refuse(new):
        raise ValueError("checked")

    with pytest.raises(ValueError):
        catalog.materialize(spark.range(9), "unit_winrate", "table", check=refuse)
    assert catalog.table("unit_winrate").count() == 3


def test_old_folders_go_after_two_more_writes(spark, catalog):
    for n in range(5):
        catalog.materialize(spark.range(n + 1), "unit_winrate", "table")
    assert catalog.table("unit_winrate").count() == 5
    assert len(files.folders(spark, catalog.path("unit_winrate"))) == 3  # two of data, and the notes


def test_schema_names_and_unknown_tables(spark, tmp_path):
    catalog = Catalog(spark, f"{tmp_path}/", {"gold": " marts "}, default_schema="staging")
    assert catalog.schema_for(None) == "staging" and catalog.schema_for(" x ") == "x"
    assert catalog.path("unit_winrate").endswith("/marts/unit_winrate")
    with pytest.raises(LookupError):
        catalog.table("unit_winrate")
    with pytest.raises(ValueError):
        catalog.materialize(spark.range(1), "unit_winrate", "cube")


def test_view_and_table(spark, catalog):
    catalog.materialize(spark.range(3), "stg_matches", "view")
    assert spark.table("stg_matches").count() == 3
    catalog.materialize(spark.range(3), "unit_winrate", "table")
    assert catalog.materialize(spark.range(2).filter("id > 0"), "unit_winrate", "table").count() == 1
    described = spark.createDataFrame([("A", 1, D[0])], "character_id string, tier long, ingestion_date date")
    got = catalog.materialize(described, "fact_units", "incremental", ["character_id"])
    assert got.schema["character_id"].metadata["comment"]


def test_pushed_down_mark(spark, catalog):
    got = load(catalog, rows(spark, ("a", 1, D[0]), ("b", 2, D[1])))
    plan = incremental_slice(got.select("k", "ingestion_date"), D[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan and ">= 2024-01-02" in plan
