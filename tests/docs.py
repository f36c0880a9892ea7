"""Hand-made match documents."""

import json
from datetime import date

SCHEMA = "metadata string, info string, date date"


def unit(character, tier=1, rarity=0, items=()):
    return {"character_id": character, "tier": tier, "rarity": rarity, "itemNames": list(items)}


def trait(name, tier=1, units=1):
    return {"name": name, "num_units": units, "tier_current": tier, "tier_total": 3, "style": tier}


def player(puuid, placement, units=(), traits=(), **more):
    return {
        "puuid": puuid,
        "riotIdGameName": f"name {puuid}",
        "riotIdTagline": "TAG",
        "placement": placement,
        "win": placement == 1,
        "level": 8,
        "last_round": 30,
        "gold_left": 2,
        "players_eliminated": 1,
        "total_damage_to_players": 90,
        "time_eliminated": 1800.5,
        "companion": {"species": "Pet"},
        "units": None if units is None else list(units),
        "traits": None if traits is None else list(traits),
        **more,
    }


def document(match_id, players, day=date(2024, 1, 1), **info):
    body = {
        "gameId": 1,
        "game_datetime": 1704067200123,
        "game_length": 2100.5,
        "game_version": "Version 16.4.700.1 (Jan)",
        "queue_id": 1100,
        "tft_set_core_name": "TFTSet16",
        "tft_set_number": 16,
        "tft_game_type": "standard",
        "endOfGameResult": "GameComplete",
        "participants": players,
        **info,
    }
    body = {k: v for k, v in body.items() if v is not ...}
    return json.dumps({"match_id": match_id, "data_version": "6"}), json.dumps(body, ensure_ascii=False), day


def bronze(spark, *documents):
    return spark.createDataFrame(list(documents), SCHEMA)
