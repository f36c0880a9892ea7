"""Bronze files, the layer runner, and the file stream."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from docs import bronze, document, player, trait, unit
from matchlake.operators.quality import QualityError, assert_quality, check_not_null, check_unique
from matchlake.plans.catalog import Catalog
from matchlake.plans import daily
from matchlake.plans.medallion import MODELS, collector_event, log_event, run_model, run_pipeline, select_models
from matchlake.sources import partitions
from matchlake.sources.bronze import bronze_partition_counts, expire_bronze, read_bronze, stream_bronze, write_bronze
from matchlake.streaming import ingest
from matchlake.streaming.events import announce_collector, read_events, refresh_on_events
from matchlake.streaming.ingest import run_incremental

DAYS = [date(2024, 1, d) for d in (1, 2, 3)]
SILVER = ["fact_player_results", "fact_traits", "fact_units"]
GOLD = ["unit_winrate", "core_comp_winrate", "item_combo_winrate"]


def match(number, day, **info):
    board = [unit("TFT16_A", 2, 1, ["TFT16_Item_X", "TFT_Item_Y"]), unit("TFT16_B")]
    players = [player(f"p{i}", i, board, [trait("TFT16_T", 1)]) for i in range(1, 9)]
    return document(f"M{number}", players, day, gameId=number, **info)


def rows(df):
    names = sorted(c for c in df.columns if c not in ("dbt_updated_at", "source_file"))
    return sorted(df.select(names).toJSON().collect())


def tables(catalog):
    return {name: rows(catalog.table(name)) for name in SILVER + GOLD}


def put(catalog, *documents):
    write_bronze(bronze(catalog.spark, *documents), catalog.path("raw_matches"))


def test_bronze_files(spark, tmp_path):
    root = str(tmp_path / "bronze")
    pretty = json.dumps(json.loads(match(1, DAYS[0])[1]), indent=1)
    write_bronze(bronze(spark, (match(1, DAYS[0])[0], pretty, DAYS[0]), match(2, DAYS[1])), root)
    write_bronze(bronze(spark, match(1, DAYS[0], queue_id=7), match(3, DAYS[0])), root)
    got = read_bronze(spark, root)
    info = {(json.loads(r.metadata)["match_id"], r.date): json.loads(r.info)["queue_id"] for r in got.collect()}
    assert info == {("M1", DAYS[0]): 7, ("M2", DAYS[1]): 1100, ("M3", DAYS[0]): 1100}
    assert got.filter(F.col("source_file").contains("date=2024-01-0")).count() == 3
    assert [tuple(r) for r in bronze_partition_counts(got, 1).collect()] == [(DAYS[1], 1)]
    plan = got.filter(F.col("date") == DAYS[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert expire_bronze(spark, root, 90, date(2024, 4, 1)) == [DAYS[0]]
    assert read_bronze(spark, root).count() == 1


def test_the_last_copy_in_one_write_wins(spark, tmp_path):
    root = str(tmp_path / "bronze")
    copies = [match(1, DAYS[0], queue_id=q) for q in (1, 3, 2)]
    order = F.get_json_object("info", "$.queue_id").cast("int").desc()
    write_bronze(bronze(spark, *copies), root, [order])
    assert [json.loads(r.info)["queue_id"] for r in read_bronze(spark, root).collect()] == [3]
    late = F.lit("2024-01-03 23:59:59").cast("timestamp")
    write_bronze(bronze(spark, match(1, DAYS[0])).drop("date"), root, as_of=late)
    assert {r.date for r in read_bronze(spark, root).collect()} == {DAYS[0], DAYS[2]}


def test_refresh_in_steps_equals_a_full_one(spark, tmp_path):
    steps, whole = Catalog(spark, str(tmp_path / "a")), Catalog(spark, str(tmp_path / "b"))
    put(steps, match(1, DAYS[0]), match(2, DAYS[0]))
    run_pipeline(steps, "daily")
    put(steps, match(3, DAYS[0]), match(4, DAYS[1]))
    run_pipeline(steps, "gold")
    put(whole, *[match(n, d) for n, d in ((1, DAYS[0]), (2, DAYS[0]), (3, DAYS[0]), (4, DAYS[1]))])
    run_pipeline(whole, "full", full_refresh=True)
    want = tables(whole)
    assert tables(steps) == want and all(want.values())
    log = spark.read.json(f"{steps.root}/events")
    assert log.filter("event = 'transformation_finished'").count() == 2


def test_late_files_need_a_look_back(spark, tmp_path):
    catalog, name = Catalog(spark, str(tmp_path)), "fact_player_results"
    put(catalog, match(1, DAYS[0]), match(2, DAYS[1]))

    def load(**options):
        run_model(catalog, "stg_matches")
        return run_model(catalog, name, **options).count()

    assert load() == 16
    put(catalog, match(9, DAYS[0]))
    assert load() == 16
    assert load(lookback_days=1) == 24


def test_modes(spark, tmp_path):
    assert select_models(["gold"], ancestors=True) == ["stg_matches", *SILVER, *GOLD]
    assert select_models(["silver"]) == SILVER
    with pytest.raises(ValueError):
        run_pipeline(Catalog(spark, str(tmp_path)), "weekly")


def test_a_failed_check_stops_the_run(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    put(catalog, document("M1", [player("a", None, [unit("A")])], DAYS[0]))
    with pytest.raises(QualityError):
        run_pipeline(catalog)
    assert not catalog.has("fact_player_results") and not catalog.has("unit_winrate")


def test_checks(spark):
    df = spark.createDataFrame([("a", None), (None, 1), ("a", 2)], "k string, v int")
    assert {tuple(r) for r in check_not_null(df, ["k", "v"]).collect()} == {("k", 1), ("v", 1)}
    assert [tuple(r) for r in check_unique(df, ["k"]).collect()] == [("a", 2)]
    gold = spark.createDataFrame([("a", "a", None, 1.0, 1.0)], "core_key string, core_key_display string, primary_trait string, top4_rate double, win_rate double")
    with pytest.warns(UserWarning):
        assert_quality(gold, "core_comp_winrate")
    with pytest.raises(QualityError):
        assert_quality(gold, "core_comp_winrate", strict=True)


def test_stream_refresh_takes_each_file_once_and_late_ones_too(spark, tmp_path):
    catalog, whole = Catalog(spark, str(tmp_path / "a")), Catalog(spark, str(tmp_path / "b"))
    put(whole, match(1, DAYS[1]), match(2, DAYS[1]), match(3, DAYS[0]))
    run_pipeline(whole, "full")
    checkpoint, root = str(tmp_path / "cp"), catalog.path("raw_matches")
    for arrival in ([(1, DAYS[1]), (2, DAYS[1])], [(3, DAYS[0])], []):
        # Arrival of files, as other writers would leave them.
        lines = [('{"metadata":%s,"info":%s}' % match(number, day)[:2], day) for number, day in arrival]
        if lines:
            new = spark.createDataFrame(lines, "value string, date date")
            new.write.mode("append").partitionBy("date").text(root)
        run_incremental(catalog, checkpoint)
    assert tables(catalog) == tables(whole)


def test_gold_is_summed_anew_for_changed_dates_only(spark, tmp_path):
    """Inserts, late files, a match that moves to another date, and a date that goes."""
    catalog, checkpoint = Catalog(spark, str(tmp_path / "a")), str(tmp_path / "cp")
    steps = [
        ([match(n, DAYS[n % 2]) for n in range(12)], {DAYS[0], DAYS[1]}),
        ([match(20, DAYS[2])], {DAYS[2]}),
        ([match(21, DAYS[0], tft_set_number=17)], {DAYS[0]}),
        ([match(0, DAYS[2])], {DAYS[0], DAYS[2]}),
        ([], set()),
    ]
    for documents, touched in steps:
        if documents:
            put(catalog, *documents)
        dates = {name: daily.changed_dates(catalog, name)[1] for name in GOLD}
        assert all(not d for d in dates.values())
        load = daily.refresh_gold
        seen = {}
        daily_refresh = lambda c: seen.update(load(c))
        ingest.refresh_gold, before = daily_refresh, ingest.refresh_gold
        try:
            run_incremental(catalog, checkpoint)
        finally:
            ingest.refresh_gold = before
        assert all(set(d) == touched for d in seen.values()) and set(seen) == set(GOLD)
        for name in GOLD:
            assert rows(catalog.table(name)) == rows(MODELS[name].build(*[catalog.table(n) for n in MODELS[name].needs]))


def test_a_cut_off_refresh_is_made_up_for(spark, tmp_path, monkeypatch):
    catalog, checkpoint = Catalog(spark, str(tmp_path / "a")), str(tmp_path / "cp")
    put(catalog, match(1, DAYS[0]))
    monkeypatch.setattr(ingest, "refresh_gold", lambda c: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_incremental(catalog, checkpoint)
    monkeypatch.undo()
    run_incremental(catalog, checkpoint)  # nothing new arrives, yet gold is behind
    whole = Catalog(spark, str(tmp_path / "b"))
    put(whole, match(1, DAYS[0]))
    run_pipeline(whole, "full")
    assert tables(catalog) == tables(whole)
    text = catalog.table("fact_units").filter(partitions.touched("ingestion_date", [DAYS[0]]))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in text


def test_a_second_write_to_a_date_loads_only_what_changed(spark, tmp_path):
    catalog, checkpoint = Catalog(spark, str(tmp_path / "a")), str(tmp_path / "cp")
    root, seen = catalog.path("raw_matches"), []
    put(catalog, match(1, DAYS[0]), match(2, DAYS[0]))
    run_incremental(catalog, checkpoint)
    put(catalog, match(1, DAYS[0]), match(2, DAYS[0], tft_set_number=17), match(3, DAYS[0]))
    query = (
        stream_bronze(spark, root).writeStream.foreachBatch(lambda batch, _: seen.append(sorted(json.loads(r.metadata)["match_id"] for r in batch.collect())))
        .option("checkpointLocation", str(tmp_path / "other")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sum(seen, []) and sorted(sum(seen, [])) == ["M1", "M2", "M2", "M3"]
    run_incremental(catalog, checkpoint)
    whole = Catalog(spark, str(tmp_path / "b"))
    put(whole, match(1, DAYS[0]), match(2, DAYS[0], tft_set_number=17), match(3, DAYS[0]))
    run_pipeline(whole, "full")
    assert tables(catalog) == tables(whole)


def test_one_version_of_a_match_wins_as_a_whole(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))

    def version(order):
        players = [player(f"p{i}", place, [unit("A")]) for i, place in enumerate(order)]
        return document("M1", players, DAYS[0])

    for order in ([1, 2, 3, 4, 5, 6, 7, 8], [8, 7, 6, 5, 4, 3, 2, 1]):
        lines = spark.createDataFrame([('{"metadata":%s,"info":%s}' % version(order)[:2], DAYS[0])], "value string, date date")
        lines.write.mode("append").partitionBy("date").text(catalog.path("raw_matches"))
    run_incremental(catalog, str(tmp_path / "cp"))
    places = {r.puuid: r.placement for r in catalog.table("fact_player_results").collect()}
    assert [places[f"p{i}"] for i in range(8)] in ([1, 2, 3, 4, 5, 6, 7, 8], [8, 7, 6, 5, 4, 3, 2, 1])


def test_documents_without_an_id_are_stored_once(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for _ in range(3):
        write_bronze(spark.createDataFrame([('{"x":1}', '{"y":2}', DAYS[0])], "metadata string, info string, date date"), root)
    assert read_bronze(spark, root).count() == 1


def test_stream_dedupe(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for day in DAYS[:2]:
        write_bronze(bronze(spark, match(1, day), match(2, DAYS[1])), root)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    query = (
        stream_bronze(spark, root, dedupe=True, files_per_batch=1)
        .select("match_id").writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    assert sorted(r.match_id for r in spark.read.parquet(out).collect()) == ["M1", "M2"]


def test_stream_dedupe_forgets_ids_with_retention(spark, tmp_path):
    """Copies inside the limit go, those beyond it are documents again, and what is older than retention stays out."""
    root, out, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "out"), str(tmp_path / "cp")
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)

    def run():
        query = (
            stream_bronze(spark, root, dedupe=True, dedupe_days=10).select("match_id", "date")
            .writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        )
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    write_bronze(bronze(spark, match(1, day(0)), match(2, day(1))), root)
    run()
    write_bronze(bronze(spark, match(1, day(10)), match(2, day(2)), match(3, day(5))), root)
    assert run() == 3
    write_bronze(bronze(spark, match(4, day(40))), root)
    assert run() == 1  # the stream was restarted each time; ids 1 to 3 are forgotten, 4 is kept
    write_bronze(bronze(spark, match(1, day(35)), match(2, day(29)), match(4, day(41))), root)
    run()
    got = sorted((r.match_id, (r.date - day(0)).days) for r in spark.read.parquet(out).collect())
    assert got == [("M1", 0), ("M1", 35), ("M2", 1), ("M3", 5), ("M4", 40)]


def test_same_match_on_two_dates(spark, tmp_path):
    from matchlake.operators.incremental import DuplicateKeyError

    catalog = Catalog(spark, str(tmp_path))
    put(catalog, match(1, DAYS[0]), match(1, DAYS[1], queue_id=5))
    run_model(catalog, "stg_matches")
    with pytest.raises(DuplicateKeyError):
        run_model(catalog, "fact_player_results")
    players = run_model(catalog, "fact_player_results", on_duplicate="latest")
    assert {r.ingestion_date for r in players.collect()} == {DAYS[1]} and players.count() == 8


def test_collector_event(spark):
    summary = spark.createDataFrame([(5, 3, 2, 1, 50), (2, 0, 2, 0, 50)], "total_ids long, new_ids long, skipped long, batches long, batch_size long")
    assert [(r.event, r.new_ids) for r in collector_event(summary).collect()] == [("collector_finished", 3)]


def test_every_collector_run_starts_one_refresh(spark, tmp_path):
    catalog, done, runs = Catalog(spark, str(tmp_path)), str(tmp_path / "done"), []
    shape = "total_ids long, new_ids long, skipped long, batches long, batch_size long"
    log_event(catalog, "other")  # the log has events of others as well
    for new_ids, want in ((3, 1), (0, 1), (2, 2)):
        announce_collector(catalog, spark.createDataFrame([(5, new_ids, 0, 1, 50)], shape))
        for _ in range(2):
            refresh_on_events(catalog, done, lambda: runs.append(1))
        assert len(runs) == want
    # cut off inside a refresh: the next call makes up for it, and only for it
    announce_collector(catalog, spark.createDataFrame([(5, 1, 0, 1, 50)], shape))
    with pytest.raises(Exception, match="ZeroDivision"):
        refresh_on_events(catalog, done, lambda: 1 / 0)
    refresh_on_events(catalog, done, lambda: runs.append(1))
    assert len(runs) == 3
    assert read_events(catalog).filter("event = 'collector_handled'").count() == 3
