"""Ladder to batches, messages, and icon addresses."""

import base64
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.functions import asset_url
from matchlake.operators import assets, discovery
from matchlake.operators.ranking import first_distinct, top_per_group
from matchlake.sources.catalogue import read_item_catalogue
from matchlake.sources.messages import decode_messages, message_ids, split_dead_letters

NOW = datetime(2024, 1, 2)


def test_tracked_players(spark):
    ladder = spark.createDataFrame(
        [
            ("MASTER", 1, "a", 10), ("MASTER", 2, "b", 30), ("MASTER", 3, None, 40), ("MASTER", 4, "d", None),
            ("MASTER", 5, "e", 30), ("DIAMOND", 6, "x", 1), ("DIAMOND", 7, "b", 99), ("DIAMOND", 8, "x", 1),
            ("DIAMOND", 9, "", 1), ("DIAMOND", 10, "y", 1), ("DIAMOND", 11, "z", 1), ("GOLD", 12, "g", 999),
        ],
        "tier string, pos long, puuid string, leaguePoints long",
    )
    got = discovery.tracked_players(ladder, {"MASTER": 4}, "DIAMOND", 3).orderBy("position").collect()
    # The cut at four counts the player without an id; b comes in by the first tier only.
    assert [(r.puuid, r.position) for r in got] == [("b", 1), ("e", 2), ("a", 3), ("x", 4), ("y", 5)]


def test_recent_and_discovered_matches(spark):
    rows = [("p", f"m{i}", NOW - timedelta(hours=i), 1100) for i in range(1, 30)] + [("p", "ranked not", NOW, 1090), ("q", "m1", NOW, 1100), ("r", "other", NOW, 1100)]
    history = spark.createDataFrame(rows, "puuid string, match_id string, game_datetime timestamp, queue_id long")
    got = discovery.recent_matches(history.filter("puuid = 'p'"), as_of=str(NOW)).collect()
    assert {r.match_id for r in got} == {f"m{i}" for i in range(1, 21)}
    got = discovery.recent_matches(history.filter("puuid = 'p'"), as_of=str(NOW), per_player=99)
    assert got.count() == 24
    players = spark.createDataFrame([("p",), ("q",)], "puuid string")
    found = discovery.discover_matches(history, players, as_of=str(NOW), per_player=2)
    assert sorted(r.match_id for r in found.collect()) == ["m1", "m2"]


def test_unhandled_ids_and_summary(spark):
    ids = spark.createDataFrame([(m,) for m in "abcdea"], "match_id string")
    ledger = spark.createDataFrame([("a", "success"), ("b", "abandoned"), ("c", "error"), ("d", "pending")], "match_id string, status string")
    assert sorted(r.match_id for r in discovery.select_unhandled(ids.distinct(), ledger).collect()) == ["c", "d", "e"]
    summary = discovery.collector_summary(discovery.classify_ids(ids, ledger), size=2).first()
    assert tuple(summary) == (5, 3, 2, 2, 2)
    none = discovery.collector_summary(discovery.classify_ids(ids.limit(0), ledger)).first()
    assert tuple(none) == (0, 0, 0, 0, 50)


@pytest.mark.parametrize("count,size", [(0, 50), (1, 50), (50, 50), (51, 50), (1234, 50), (7, 3)])
def test_batches(spark, count, size):
    ids = spark.range(count).select(F.concat(F.lit("BR1_"), "id").alias("match_id"))
    got = discovery.batch_ids(ids.union(ids), size, as_of="2024-01-01 06:30:00").orderBy("batch_num").collect()
    assert [r.batch_num for r in got] == list(range(1, -(-count // size) + 1))
    assert all(r.size == size for r in got[:-1])
    assert sorted(m for r in got for m in r.match_ids) == sorted(f"BR1_{i}" for i in range(count))
    assert all(r.batch_id == f"20240101-0630-{r.batch_num}" for r in got)


def test_messages(spark):
    encode = lambda text: base64.b64encode(text if isinstance(text, bytes) else text.encode()).decode()
    good = json.dumps({"match_ids": ["a", "b"], "batch_id": "x-1", "size": 2})
    cases = [
        ("good", encode(f" {good}\n")), ("nameless", encode('{"match_ids":["c"]}')), ("empty", encode('{"match_ids":[]}')),
        ("no ids", encode("{}")), ("not json", encode("{oops")), ("not base64", "%%%"), ("not utf8", encode(b"\xff\xfe{")), ("null", None), ("a list", encode("[1]")),
    ]
    decoded = decode_messages(spark.createDataFrame(cases, "name string, data string"))
    state = {r.name: (r.rejected, r.batch_id) for r in decoded.collect()}
    assert {n for n, (rejected, _) in state.items() if not rejected} == {"good", "nameless"}
    assert state["good"][1] == "x-1" and state["nameless"][1] == "UNKNOWN"
    assert {tuple(r) for r in message_ids(decoded).collect()} == {("x-1", "a"), ("x-1", "b"), ("UNKNOWN", "c")}


def test_dead_letter_split(spark):
    retry, dead = split_dead_letters(spark.createDataFrame([("a", 4), ("b", 5), ("c", None)], "id string, deliveries int"))
    assert sorted(r.id for r in retry.collect()) == ["a", "c"] and [r.id for r in dead.collect()] == ["b"]


def test_top_per_group_beyond_the_threshold(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id").repartition(6)
    got = top_per_group(df, ["g"], [F.col("id").desc()], k=1500, rank_name="n")
    assert got.count() == 3000 and got.agg(F.min("id"), F.max("n")).first()[:] == (2000, 1500)


def test_first_distinct(spark):
    df = spark.createDataFrame([("b", 2), ("a", 3), ("b", 1), (None, 0), ("c", 9)], "k string, pos long")
    assert [tuple(r) for r in first_distinct(df, "k", "pos", 2).collect()] == [("b", 1), ("a", 3)]


def test_item_icons(spark, tmp_path):
    document = {
        "items": [
            {"apiName": "TFT16_Item_A", "icon": "ASSETS/Maps/Old Name.tex"}, {"apiName": "tft16_item_a", "icon": "ASSETS/Maps/New Name.tex"},
            {"apiName": "TFT16_Item_A", "icon": ""}, {"apiName": "TFT16_Item_B", "icon": "b.png"}, {"apiName": "", "icon": "x"}, {"icon": "y"}, {"apiName": "Old", "icon": "o"},
        ],
        "setData": [{"number": 15, "items": ["Old"]}, {"items": ["Old"]}, {"number": 16, "items": ["TFT16_Item_A", "tft16_item_b", "unknown", "TFT16_ITEM_A"]}, {"number": 16, "items": ["Old"]}],
    }
    path = tmp_path / "catalogue.json"
    path.write_text(json.dumps(document, indent=1))
    items, sets = read_item_catalogue(spark, str(path))
    got = {tuple(r) for r in assets.item_icon_urls(items, sets, base="cdn/").collect()}
    assert got == {("tft16_item_a", "cdn/assets/maps/newname.png"), ("tft16_item_b", "cdn/assets/b.png")}
    stored = spark.createDataFrame([("tft16_item_a",)], "api_name string")
    assert [r.api_name for r in assets.item_icon_urls(items, sets, stored).collect()] == ["tft16_item_b"]


def test_a_broken_catalogue_raises(spark, tmp_path):
    path = tmp_path / "broken.json"
    path.write_text('{"items": [{"apiName": "A", "icon"')
    with pytest.raises(Exception, match="no item catalogue"):
        read_item_catalogue(spark, str(path)).items.collect()
    with pytest.raises(Exception, match="no item catalogue"):
        read_item_catalogue(spark, str(path)).sets.collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_broken_messages_are_rejected_in_any_session(spark, ansi):
    data = [("eyJtYXRjaF9pZHMiOlsiYSJdfQ==", False), ("!!", True), ("e30=", True), ("eyJtYXRjaF9pZHMiOltdfQ==", True), (None, True)]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = decode_messages(spark.createDataFrame([(d,) for d, _ in data], "data string")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert [r.rejected for r in got] == [broken for _, broken in data]


def test_asset_paths(spark):
    paths = ["ASSETS/A b.TEX", "x/assets/c.tex"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").select(asset_url(F.col("p"), "u")).collect()]
    assert got == ["u/assets/ab.png", "u/assets/x/assets/c.png"]


def test_champion_icons(spark):
    units = spark.createDataFrame([("TFT16_Ahri", '["B","A"]'), ("tft16_ahri", None), ("TFT9_Old", '["A"]'), (None, None), ("Plain", "[]")], "character_id string, item_names_json string")
    got = {r.id: (r.set_number, r.source_url) for r in assets.champion_icon_urls(units, base="u").collect()}
    assert got["tft16_ahri"] == ("16", "u/assets/characters/tft16_ahri/hud/tft16_ahri_square.tft_set16.png")
    assert got["plain"][0] == "plain" and set(got) == {"tft16_ahri", "tft9_old", "plain"}
    stored = spark.createDataFrame([("tft9_old",)], "id string")
    assert "tft9_old" not in {r.id for r in assets.champion_icon_urls(units, stored).collect()}
    assert [r.id for r in assets.distinct_champions(units).collect()] == [None, "plain", "tft16_ahri", "tft9_old"]
    assert [r.item for r in assets.distinct_items(units).collect()] == ["A", "B"]
