"""Edge cases of staging, facts and gold tables, on hand-made documents."""

import json
from datetime import date, datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docs import bronze, document, player, trait, unit
from matchlake.functions import icon_slots, ordered_concat, patch_of, strip_item_prefix, strip_set_prefix
from matchlake.operators import gold, silver
from matchlake.operators.staging import stage_matches


def facts(spark, *documents):
    players = silver.player_results(stage_matches(bronze(spark, *documents)))
    return players, silver.trait_facts(players), silver.unit_facts(players)


def units_frame(spark, rows):
    """(match, puuid, placement, character, items json, item count) to unit facts."""
    data = [
        (m, "16.1.1", p, 16, place, place <= 4, place == 1, c, 1, 0, items, n)
        for m, p, place, c, items, n in rows
    ]
    return spark.createDataFrame(
        data,
        "match_id string, patch string, puuid string, tft_set_number long, placement long, top4 boolean, win boolean, "
        "character_id string, tier long, rarity long, item_names_json string, item_count long",
    )


def test_staging_types_and_missing_ids(spark):
    good = document("M1", [player("a", 1)])
    no_id = ('{"data_version":"6"}', good[1], good[2])
    null_id = ('{"match_id":null}', good[1], good[2])
    rows = stage_matches(bronze(spark, good, no_id, null_id)).collect()
    assert len(rows) == 1
    row = rows[0]
    assert row.game_datetime == datetime.fromisoformat("2024-01-01T00:00:00.123")
    assert (row.game_id, row.game_length_seconds, row.queue_id, row.tft_set_number) == (1, 2100.5, 1100, 16)
    assert row.ingestion_date == date(2024, 1, 1) and row.participants_json.startswith("[{")


def test_one_pass_reader_equals_staging(spark, tmp_path):
    from matchlake.sources.bronze import read_bronze, read_matches, write_bronze

    board = [unit('TFT16_"A"', 2, 1, ["x", "é\\"]), unit("TFT16_B")]
    docs = [
        document("M1", [player("a", 1, board, [trait("T", 2)]), player("b", 2, units=None)], game_length=1.0),
        document("M2", None), document("M3", ..., queue_id="1100"), document(None, [player("c", 3)]),
    ]
    write_bronze(bronze(spark, *docs), str(tmp_path / "b"))
    now = F.lit("2024-01-01").cast("timestamp")
    staged = silver.player_results(stage_matches(read_bronze(spark, str(tmp_path / "b"))), as_of=now)
    direct = silver.player_results(read_matches(spark, str(tmp_path / "b")), as_of=now)
    assert direct.columns == staged.columns

    def rows(df):
        # Blanks inside the kept JSON text are of no account.
        return sorted(
            str({**r.asDict(), **{c: json.loads(r[c] or "null") for c in ("traits_json", "units_json")}}) for r in df.collect()
        )

    assert rows(direct) == rows(staged) and len(rows(direct)) == 2
    assert sorted(silver.unit_facts(direct, now).collect()) == sorted(silver.unit_facts(staged, now).collect())


def test_numbers_sent_as_text_are_read_and_malformed_ones_raise(spark):
    assert stage_matches(bronze(spark, document("M", [], queue_id="1100"))).first().queue_id == 1100
    with pytest.raises(PySparkException):
        stage_matches(bronze(spark, document("M", [], queue_id="16.0"))).collect()
    with pytest.raises((PySparkException, Py4JJavaError)):
        stage_matches(bronze(spark, ('{"match_id":"M"}', '{"gameId":', date(2024, 1, 1)))).collect()


def test_only_true_and_false_are_booleans(spark):
    with pytest.raises(PySparkException):
        silver.player_results(stage_matches(bronze(spark, document("M", [player("a", 1, win="yes")])))).collect()
    row = silver.player_results(stage_matches(bronze(spark, document("M", [player("a", 1, win="TRUE")])))).first()
    assert row.win is True


@pytest.mark.parametrize(
    "version,patch",
    [("16.4.700.1", "16.4.700"), ("15.24.1", None), ("116.4.7", "16.4.7"), ("16.4", None), (None, None)],
)
def test_patch(spark, version, patch):
    assert spark.range(1).select(patch_of(F.lit(version).cast("string"))).first()[0] == patch


def test_missing_arrays_give_no_rows(spark):
    bare = player("b", 2)
    del bare["units"], bare["traits"]
    players, traits, units = facts(
        spark,
        document("M1", ...),
        document("M2", None),
        document("M3", [player("a", None, units=None, traits=None), bare]),
    )
    assert {(r.puuid, r.top4) for r in players.collect()} == {("a", None), ("b", True)}
    assert traits.count() == 0 and units.count() == 0


def test_unit_positions(spark):
    board = [
        unit("TFT16_B", 2),
        unit("TFT16_A", 10, items=["x"]),
        unit("TFT16_A", 2, items=["second"]),
        unit("TFT16_A", 2, items=["third"]),
        unit(None, 1),
    ]
    _, _, units = facts(spark, document("M", [player("p", 1, units=board)]))
    rows = units.orderBy("unit_position").collect()
    assert [(r.unit_position, r.character_id, r.tier) for r in rows] == [
        (1, None, 1),
        (2, "TFT16_A", 10),  # star levels compare as text
        (3, "TFT16_A", 2),
        (4, "TFT16_A", 2),
        (5, "TFT16_B", 2),
    ]
    assert [r.item_names_json for r in rows[2:4]] == ['["second"]', '["third"]']
    assert rows[1].unit_key == "M_p_2" and rows[1].item_count == 1 and rows[4].item_count == 0


def test_unit_positions_equal_a_window(spark, small):
    from pyspark.sql import Window

    from matchlake.plans import fixtures as fx

    players = silver.player_results(stage_matches(fx.documents(fx.Tables(spark, small))))
    units = silver.unit_facts(players)
    order = Window.partitionBy("match_id", "puuid").orderBy("character_id", F.col("tier").cast("string"), "unit_position")
    assert units.withColumn("n", F.row_number().over(order)).filter("n <> unit_position").count() == 0


def test_item_count_of_missing_list(spark):
    board = [{"character_id": "A", "tier": 1, "rarity": 0}, {"character_id": "B", "tier": 1, "rarity": 0, "itemNames": None}]
    _, _, units = facts(spark, document("M", [player("p", 1, units=board)]))
    assert [(r.item_names_json, r.item_count) for r in units.collect()] == [(None, None), (None, None)]


def test_primary_trait_ties_and_inactive(spark):
    _, traits, _ = facts(
        spark,
        document(
            "M",
            [
                player("a", 1, traits=[trait("T_z", 2, 3), trait("T_b", 2, 4), trait("T_a", 2, 4), trait("T_c", 1, 9)]),
                player("b", 2, traits=[trait("T_z", 0, 3)]),
            ],
        ),
    )
    assert [tuple(r) for r in gold.primary_trait(traits).collect()] == [("M", "a", "T_a")]


def test_core_comp_keeps_copies_and_null_trait(spark):
    board = [unit("TFT16_Bb"), unit("TFT16_Aa"), unit("TFT16_Aa", 2)]
    players = [player(f"p{i}", i, units=board) for i in range(1, 4)]
    _, traits, units = facts(spark, document("M", players))
    row = gold.core_comp_winrate(units, traits, base="u").first()
    assert row.core_key == "TFT16_Aa | TFT16_Aa | TFT16_Bb" and row.core_size == 2
    assert row.core_key_display == "Aa | Aa | Bb"
    assert row.core_icon_urls == "u/champions/tft16_aa.png | u/champions/tft16_aa.png | u/champions/tft16_bb.png"
    assert row.unit_icon_3 == "u/champions/tft16_bb.png" and row.unit_icon_4 is None
    assert row.primary_trait is None and row.primary_trait_display is None
    assert (row.total_games, row.total_top4, row.total_wins, row.avg_placement) == (3, 3, 1, 2.0)


def test_equal_copies_count_once_in_unit_winrate(spark):
    players = [player(f"p{i}", i, units=[unit("TFT16_A", 1), unit("TFT16_A", 1), unit("TFT16_A", 2)]) for i in range(1, 11)]
    _, _, units = facts(spark, document("M", players))
    rows = gold.unit_winrate(units).orderBy("tier").collect()
    assert [(r.tier, r.total_games) for r in rows] == [(1, 10), (2, 10)]
    assert rows[0].character_name == "A"


def test_copies_with_equal_item_count_merge_their_builds(spark):
    rows = []
    for i in range(5):
        rows += [("M", f"p{i}", 1, "TFT16_A", '["b","a"]', 2), ("M", f"p{i}", 1, "TFT16_A", '["d","c"]', 2)]
    units = units_frame(spark, rows).withColumn("unit_key", F.monotonically_increasing_id().cast("string"))
    merged = gold.item_combo_winrate(units).collect()
    assert [(r.item_combo, r.item_combo_size, r.total_games) for r in merged] == [("a + b + c + d", 2, 5)]
    apart = gold.item_combo_winrate(units, per_copy=True).orderBy("item_combo").collect()
    assert [(r.item_combo, r.total_games) for r in apart] == [("a + b", 5), ("c + d", 5)]


def test_build_does_not_depend_on_item_order_and_needs_two_items(spark):
    rows = [("M", f"p{i}", 1, "A", '["x","y"]' if i % 2 else '["y","x"]', 2) for i in range(5)]
    rows += [("M", f"q{i}", 1, "A", '["x"]', 1) for i in range(5)] + [("M", f"r{i}", 1, "A", None, None) for i in range(5)]
    found = gold.item_combo_winrate(units_frame(spark, rows), base="u").collect()
    assert [(r.item_combo, r.item_icon_url_2, r.item_icon_url_3) for r in found] == [("x + y", "u/items/y.png", None)]


@pytest.mark.parametrize("games,kept", [(2, 0), (3, 1)])
def test_threshold_of_compositions(spark, games, kept):
    _, traits, units = facts(spark, document("M", [player(f"p{i}", 1, units=[unit("A")]) for i in range(games)]))
    assert gold.core_comp_winrate(units, traits).count() == kept


@pytest.mark.parametrize("games,kept", [(4, 0), (5, 1)])
def test_threshold_of_builds(spark, games, kept):
    rows = [("M", f"p{i}", 1, "A", '["x","y"]', 2) for i in range(games)]
    assert gold.item_combo_winrate(units_frame(spark, rows)).count() == kept


@pytest.mark.parametrize("games,kept", [(9, 0), (10, 1)])
def test_threshold_of_units(spark, games, kept):
    rows = [("M", f"p{i}", 1, "A", None, None) for i in range(games)]
    assert gold.unit_winrate(units_frame(spark, rows)).count() == kept


@pytest.mark.parametrize(
    "top4,games,grade",
    [(14, 14, "N/A"), (15, 15, "S"), (16, 20, "S"), (14, 20, "A"), (10, 20, "B"), (9, 20, "C"), (4999, 10000, "C"), (5000, 10000, "B"), (99999, 200000, "B")],
)
def test_grades(spark, top4, games, grade):
    df = spark.range(games).select(
        F.lit(1).alias("k"), (F.col("id") < top4).alias("top4"), F.lit(False).alias("win"), F.lit(1).alias("placement")
    )
    assert gold.win_rate_rollup(df, ["k"]).first().tier_winrate == grade


def test_null_placement_counts_as_a_game_only(spark):
    df = spark.createDataFrame([("g", None, None, None), ("g", 2, True, False)], "k string, placement long, top4 boolean, win boolean")
    row = gold.win_rate_rollup(df, ["k"]).first()
    assert (row.total_games, row.total_top4, row.top4_rate, row.avg_placement) == (2, 1, 50.0, 2.0)


def test_null_keys_group_together(spark):
    df = spark.createDataFrame([(None, 1, True, True), (None, 2, True, False)], "k string, placement long, top4 boolean, win boolean")
    assert gold.win_rate_rollup(df, ["k"]).first().total_games == 2


def test_games_are_conserved_without_thresholds(spark, small):
    from matchlake.plans import fixtures as fx

    units = fx.unit_rows(fx.Tables(spark, small))
    once = units.select(*gold.PLAYER, "character_id", "tier", "rarity").distinct().count()
    rates = gold.unit_winrate(units, min_games=1)
    total = rates.agg(F.sum("total_games"), F.count_if(F.col("total_wins") > F.col("total_top4"))).first()
    assert tuple(total) == (once, 0)


def test_prefixes(spark):
    row = spark.range(1).select(
        strip_set_prefix(F.lit("tft9_y")),
        strip_set_prefix(F.lit("TFT_Item_X")),
        strip_set_prefix(F.lit("xTFT9_y")),
        strip_set_prefix(F.lit("xTFT9_y"), anywhere=True),
        strip_item_prefix(F.lit("TFT9_Item_A + tft10_b + TFT_Item_C")),
    ).first()
    assert list(row) == ["y", "TFT_Item_X", "xTFT9_y", "xy", "A + b + TFT_Item_C"]


def test_ordered_concat(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 3, None), ("a", 1, "y"), ("b", 1, None)], "k string, o int, v string")
    rows = df.groupBy("k").agg(ordered_concat(F.col("v"), F.col("o")).alias("s")).collect()
    assert {tuple(r) for r in rows} == {("a", "y | y | x"), ("b", None)}


def test_icon_slots(spark):
    row = spark.createDataFrame([("a | b",), (None,)], "u string").select(*icon_slots(F.col("u"), 3)).collect()
    assert [tuple(r) for r in row] == [("a", "b", None), (None, None, None)]


def test_meta_view(spark):
    df = spark.createDataFrame([("p", "A", "S", 90.0), ("p", "B", "S", 95.0), ("q", "A", "B", 55.0)], "patch string, character_id string, tier_winrate string, top4_rate double")
    assert [r.character_id for r in gold.meta_view(df, patch="p", tier="S").collect()] == ["B", "A"]
    assert gold.meta_view(df, character="A").count() == 2
    comps = spark.createDataFrame([("A | B", 60.0), ("AA | B", 70.0)], "core_key string, top4_rate double")
    assert [r.core_key for r in gold.meta_view(comps, character="A").collect()] == ["A | B"]
