"""SQL counterparts of the queries, for DuckDB on the same tables.

They start from the relational columns and never see a JSON document, so the documents'
way there and back is checked as well.
"""

from __future__ import annotations

from matchlake import config
from matchlake.plans.queries import AS_OF, HOURS

BASE = config.ASSET_BASE
CDN = config.SOURCE_CDN_BASE

SEATS = """
seats AS (
  SELECT o_orderkey // 8 AS m, o_orderkey, o_custkey, o_totalprice,
    row_number() OVER (PARTITION BY o_orderkey // 8 ORDER BY o_totalprice DESC, o_orderkey) AS placement,
    min(o_orderdate) OVER (PARTITION BY o_orderkey // 8) AS game_datetime,
    arg_min(o_orderpriority, o_orderkey) OVER (PARTITION BY o_orderkey // 8) AS first_priority
  FROM orders),
players AS (
  SELECT m, o_orderkey, o_custkey, o_totalprice, 'M' || m AS match_id, 'P' || o_orderkey AS puuid,
    placement, placement <= 4 AS top4, placement = 1 AS win, game_datetime, 15 + m % 2 AS tft_set_number,
    'Version ' || (15 + m % 2) || '.' || (1 + m % 3) || '.700.1234' AS game_version,
    nullif(regexp_extract('Version ' || (15 + m % 2) || '.' || (1 + m % 3) || '.700.1234', '16\\.\\d+\\.\\d+'), '') AS patch,
    DATE '2024-01-01' + CAST(m % 10 AS INTEGER) AS ingestion_date,
    CASE WHEN first_priority <> '5-LOW' THEN 1100 ELSE 1090 END::BIGINT AS queue_id
  FROM seats)"""

UNITS = f"""{SEATS},
units AS (
  SELECT p.match_id, p.patch, p.puuid, p.game_datetime, p.tft_set_number, p.placement, p.top4, p.win,
    p.ingestion_date, p.o_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, p_type,
    'TFT' || p.tft_set_number || '_' || replace(p_brand, '#', '') AS character_id,
    CAST(1 + l_linenumber % 3 AS BIGINT) AS tier, CAST(p_size % 7 AS BIGINT) AS rarity,
    list_slice(['TFT' || p.tft_set_number || '_Item_' || p_type, 'TFT_Item_S' || (p_size % 4),
      'TFT' || p.tft_set_number || '_Item_' || p_type], 1, l_linenumber % 4) AS items,
    CAST(l_linenumber % 4 AS BIGINT) AS item_count
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN players p ON l_orderkey = p.o_orderkey)"""

TRAITS = f"""{UNITS},
traits AS (
  SELECT match_id, patch, puuid, game_datetime, tft_set_number, placement, top4, win,
    'TFT' || tft_set_number || '_' || p_type AS trait_name, count(*) AS num_units,
    count(*) - 1 + o_orderkey % 2 AS tier_current, 3::BIGINT AS tier_total,
    least(count(*) - 1 + o_orderkey % 2, 4) AS style, count(*) - 1 + o_orderkey % 2 > 0 AS is_active, ingestion_date,
    p_type
  FROM units
  GROUP BY match_id, patch, puuid, game_datetime, tft_set_number, placement, top4, win, p_type, o_orderkey, ingestion_date)"""

UNIT_FACTS = f"""{UNITS},
facts AS (
  SELECT *, row_number() OVER (PARTITION BY match_id, puuid ORDER BY character_id, CAST(tier AS VARCHAR),
    l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, rarity) AS unit_position
  FROM units)"""

PRIMARY = """
best AS (
  SELECT match_id, puuid, trait_name AS primary_trait FROM traits WHERE is_active
  QUALIFY row_number() OVER (PARTITION BY match_id, puuid
    ORDER BY tier_current DESC, num_units DESC, trait_name) = 1)"""

METRICS = """count(*) AS total_games, count(*) FILTER (top4) AS total_top4, count(*) FILTER (win) AS total_wins,
  round(count(*) FILTER (top4) / count(*) * 100, 2) AS top4_rate,
  round(count(*) FILTER (win) / count(*) * 100, 2) AS win_rate,
  round(avg(placement), 2) AS avg_placement,
  CASE WHEN count(*) < 15 THEN 'N/A'
    WHEN round(count(*) FILTER (top4) / count(*) * 100, 2) >= 80 THEN 'S'
    WHEN round(count(*) FILTER (top4) / count(*) * 100, 2) >= 70 THEN 'A'
    WHEN round(count(*) FILTER (top4) / count(*) * 100, 2) >= 50 THEN 'B' ELSE 'C' END AS tier_winrate"""

PLAYER = "match_id, patch, puuid, tft_set_number, placement, top4, win"


def _slots(column: str, count: int, prefix: str) -> str:
    return ", ".join(f"string_split({column}, ' | ')[{i}] AS {prefix}{i}" for i in range(1, count + 1))


UNIT_WINRATE = f"""WITH {UNITS},
once AS (SELECT DISTINCT {PLAYER}, character_id, tier, rarity FROM units)
SELECT tft_set_number, patch, character_id, regexp_replace(character_id, '^(?i)tft\\d+_', '') AS character_name,
  '{BASE}/champions/' || lower(character_id) || '.png' AS icon_url, tier, rarity, {METRICS}
FROM once GROUP BY tft_set_number, patch, character_id, tier, rarity HAVING count(*) >= 10"""

CORE = f"""
core AS (
  SELECT {PLAYER}, string_agg(character_id, ' | ' ORDER BY character_id) AS core_key,
    string_agg(regexp_replace(character_id, '(?i)tft\\d+_', '', 'g'), ' | ' ORDER BY character_id) AS core_key_display,
    string_agg('{BASE}/champions/' || lower(character_id) || '.png', ' | ' ORDER BY character_id) AS core_icon_urls,
    count(DISTINCT character_id) AS core_size
  FROM units GROUP BY {PLAYER})"""

CORE_COMP = f"""WITH {TRAITS}, {PRIMARY}, {CORE}
SELECT tft_set_number, patch, core_key, core_key_display, core_icon_urls,
  {_slots("core_icon_urls", 9, "unit_icon_")}, core_size, primary_trait,
  regexp_replace(primary_trait, '^(?i)tft\\d+_', '') AS primary_trait_display, {METRICS}
FROM core LEFT JOIN best USING (match_id, puuid)
GROUP BY tft_set_number, patch, core_key, core_key_display, core_icon_urls, core_size, primary_trait
HAVING count(*) >= 3"""


def _item_combo(source: str, copy: str = "") -> str:
    return f"""WITH {source},
exploded AS (
  SELECT {PLAYER}, character_id, item_count, {copy or "0"} AS copy_no, unnest(items) AS item
  FROM {"facts" if copy else "units"} WHERE item_count >= 2),
builds AS (
  SELECT {PLAYER}, character_id, item_count AS item_combo_size, string_agg(item, ' + ' ORDER BY item) AS item_combo,
    string_agg('{BASE}/items/' || lower(item) || '.png', ' | ' ORDER BY item) AS item_icon_urls
  FROM exploded GROUP BY {PLAYER}, character_id, item_count, copy_no)
SELECT tft_set_number, patch, character_id, regexp_replace(character_id, '^(?i)tft\\d+_', '') AS character_name,
  '{BASE}/champions/' || lower(character_id) || '.png' AS icon_url, item_combo,
  regexp_replace(item_combo, '(?i)tft\\d+_item_|(?i)tft\\d+_', '', 'g') AS item_combo_display, item_icon_urls,
  {_slots("item_icon_urls", 3, "item_icon_url_")}, item_combo_size, {METRICS}
FROM builds GROUP BY tft_set_number, patch, character_id, item_combo, item_combo_size, item_icon_urls
HAVING count(*) >= 5"""


ITEM_COMBO = _item_combo(UNITS)

LADDER = "SELECT c_mktsegment AS tier, c_custkey AS pos, 'C' || c_custkey AS puuid, CAST(floor(c_acctbal) AS BIGINT) AS points FROM customer"

HISTORY = """
history AS (
  SELECT 'C' || o_custkey AS puuid, 'M' || (o_orderkey // 8) AS match_id, max(o_orderdate) AS game_datetime,
    min(CASE WHEN o_orderpriority <> '5-LOW' THEN 1100 ELSE 1090 END)::BIGINT AS queue_id
  FROM orders GROUP BY 1, 2)"""


def _recent(extra: str = "") -> str:
    return f"""{HISTORY},
recent AS (
  SELECT * FROM history
  WHERE game_datetime >= TIMESTAMP '{AS_OF}' - INTERVAL {HOURS} HOUR AND queue_id = 1100 {extra}
  QUALIFY row_number() OVER (PARTITION BY puuid ORDER BY game_datetime DESC, match_id) <= 5)"""


MATCH_LEDGER = """
ledger AS (
  SELECT 'M' || (o_orderkey // 8) AS match_id,
    CASE arg_min(o_orderstatus, o_orderkey) WHEN 'F' THEN 'success' WHEN 'P' THEN 'abandoned' ELSE 'error' END AS status
  FROM orders GROUP BY 1)"""


def _fold(order: str = "ts, event_id", retries: str = "3", dead: str = "2") -> str:
    return f"""RECURSIVE ev AS (
  SELECT user_id || '_' || strftime(ts, '%Y-%m-%d') AS match_id, ts AS event_time,
    CASE event_type WHEN 'signup' THEN 'discovered' WHEN 'purchase' THEN 'fetch_ok' WHEN 'view' THEN 'dead_letter'
      ELSE 'fetch_error' END AS kind,
    CASE event_type WHEN 'error' THEN 'connection reset' WHEN 'click' THEN 'API key refused (401)' END AS message,
    row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY {order}) AS rn
  FROM events),
fold AS (
  SELECT DISTINCT match_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS status,
    CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS BIGINT) AS retries, CAST(NULL AS VARCHAR) AS last_error,
    CAST(NULL AS TIMESTAMP) AS updated_at, CAST(NULL AS TIMESTAMP) AS processed_at,
    CAST(NULL AS BIGINT) AS dlq_attempts, false AS requeue
  FROM ev
  UNION ALL
  SELECT match_id, rn,
    CASE effect WHEN 'give_up' THEN 'abandoned' WHEN 'revive' THEN 'error' WHEN 'fresh' THEN 'pending'
      WHEN 'ok' THEN 'success' WHEN 'fail' THEN CASE WHEN coalesce(retries, 0) + 1 >= {retries} THEN 'abandoned' ELSE 'error' END
      ELSE status END,
    CASE effect WHEN 'fresh' THEN event_time ELSE created_at END,
    CASE effect WHEN 'revive' THEN 0 WHEN 'fresh' THEN 0 WHEN 'fail' THEN coalesce(retries, 0) + 1 ELSE retries END,
    CASE effect WHEN 'give_up' THEN 'Abandonado após ' || coalesce(dlq_attempts, 0) || ' tentativas de DLQ'
      WHEN 'revive' THEN 'Reprocessado via DLQ' WHEN 'fresh' THEN NULL WHEN 'fail' THEN message ELSE last_error END,
    CASE WHEN effect = 'fresh' THEN NULL WHEN effect IN ('give_up', 'revive', 'fail') THEN event_time ELSE updated_at END,
    CASE effect WHEN 'ok' THEN event_time WHEN 'fresh' THEN NULL ELSE processed_at END,
    CASE effect WHEN 'revive' THEN coalesce(dlq_attempts, 0) + 1 WHEN 'fresh' THEN NULL ELSE dlq_attempts END,
    CASE effect WHEN 'revive' THEN true WHEN 'fail' THEN coalesce(retries, 0) + 1 < {retries} AND NOT contains(message, '401')
      WHEN 'none' THEN requeue ELSE false END
  FROM (
    SELECT f.match_id, ev.rn, f.status, f.created_at, f.retries, f.last_error, f.updated_at, f.processed_at,
      f.dlq_attempts, f.requeue, ev.event_time, ev.message,
      CASE WHEN ev.kind = 'dead_letter' AND f.status IS DISTINCT FROM 'success'
          THEN CASE WHEN coalesce(f.dlq_attempts, 0) >= {dead} THEN 'give_up' ELSE 'revive' END
        WHEN f.status IN ('success', 'abandoned') THEN 'none'
        WHEN ev.kind = 'discovered' THEN 'fresh' WHEN ev.kind = 'fetch_ok' THEN 'ok'
        WHEN ev.kind = 'fetch_error' THEN 'fail' ELSE 'none' END AS effect
    FROM fold f JOIN ev ON ev.match_id = f.match_id AND ev.rn = f.rn + 1)),
folded AS (
  SELECT match_id, status, created_at, retries, last_error, updated_at, processed_at, dlq_attempts, requeue
  FROM fold QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY rn DESC) = 1)"""


FOLD = f"WITH {_fold()} SELECT * FROM folded"
NOON_FIRST = "hour(ts) >= 12, ts, event_id"
LOWERED = _fold(
    NOON_FIRST,
    "CASE WHEN hour(event_time) < 12 THEN 6 ELSE 2 END",
    "CASE WHEN hour(ev.event_time) < 12 THEN 5 ELSE 1 END",
)

MESSAGES = """
batches AS (
  SELECT event_id // 50 AS number, list('E' || event_id ORDER BY 'E' || event_id) AS ids FROM events GROUP BY 1),
decoded AS (
  SELECT number, ids, number % 7 = 2 OR number % 13 = 5 AS broken, number % 11 = 3 AS empty FROM batches)"""

LOOKUP = """
lookup AS (
  SELECT lower(p_name) AS api_name, arg_max('ASSETS/Maps/' || p_brand || ' ' || p_type || '.tex', p_partkey) AS icon
  FROM part GROUP BY 1)"""

STAGED = """SELECT 'M' || m AS match_id, '6' AS data_version, m AS game_id, any_value(game_datetime) AS game_datetime,
  1800 + m % 600 + 0.25::DOUBLE AS game_length_seconds, any_value(game_version) AS game_version,
  any_value(queue_id) AS queue_id, 'TFTSet' || any_value(tft_set_number) AS tft_set_core_name,
  any_value(tft_set_number) AS tft_set_number, 'standard' AS tft_game_type, 'GameComplete' AS end_of_game_result,
  any_value(ingestion_date) AS ingestion_date, count(*) AS n_participants
FROM players GROUP BY m"""

PLAYER_RESULTS = f"""WITH {TRAITS},
trait_lists AS (
  SELECT puuid, CAST(to_json(list(struct_pack(name := trait_name, num_units := num_units, tier_current := tier_current,
    tier_total := tier_total, style := style) ORDER BY p_type)) AS VARCHAR) AS traits_json
  FROM traits GROUP BY puuid),
unit_lists AS (
  SELECT puuid, CAST(to_json(list(struct_pack(character_id := character_id, tier := tier, rarity := rarity,
    itemNames := items) ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, character_id, tier, rarity))
    AS VARCHAR) AS units_json
  FROM units GROUP BY puuid)
SELECT match_id, game_datetime, tft_set_number, ingestion_date, patch, puuid,
  'Player ' || o_custkey AS riot_id_game_name, 'T' || (o_custkey % 10) AS riot_id_tagline, placement, win,
  1 + o_orderkey % 10 AS level, 10 + o_orderkey % 30 AS last_round, o_custkey % 60 AS gold_left,
  o_orderkey % 8 AS players_eliminated, CAST(floor(o_totalprice / 1000) AS BIGINT) AS total_damage_to_players,
  CAST(o_orderkey % 2400 AS DOUBLE) + 0.5 AS time_eliminated_seconds, top4, traits_json,
  coalesce(units_json, '[]') AS units_json, 'Pet' || (o_custkey % 5) AS companion_species
FROM players LEFT JOIN trait_lists USING (puuid) LEFT JOIN unit_lists USING (puuid)"""

UPSERT = """WITH {players},
updates AS (
  SELECT 'P' || (c_custkey * 20) AS puuid, c_acctbal AS amount,
    DATE '2024-01-05' + CAST(c_custkey % 10 AS INTEGER) AS ingestion_date
  FROM customer)
SELECT puuid, o_totalprice AS amount, ingestion_date FROM players
WHERE puuid NOT IN (SELECT puuid FROM updates)
UNION ALL SELECT * FROM updates""".replace("{players}", SEATS.strip())

ORACLES: dict[str, str] = {
    "stage_matches": f"WITH {SEATS} {STAGED}",
    "bronze_round_trip": f"""WITH {SEATS}, staged AS ({STAGED})
SELECT match_id, game_id, game_datetime, game_length_seconds, queue_id, ingestion_date FROM staged""",
    "player_results": PLAYER_RESULTS,
    "trait_facts": f"WITH {TRAITS} SELECT * EXCLUDE (p_type) FROM traits",
    "unit_facts": f"""WITH {UNIT_FACTS}
SELECT match_id || '_' || puuid || '_' || unit_position AS unit_key, match_id, patch, puuid, game_datetime,
  tft_set_number, placement, top4, win, unit_position, character_id, tier, rarity,
  CAST(to_json(items) AS VARCHAR) AS item_names_json, item_count, ingestion_date
FROM facts""",
    "documents_to_unit_winrate": UNIT_WINRATE,
    "documents_to_core_comp_winrate": CORE_COMP,
    "item_combo_per_copy": _item_combo(UNIT_FACTS, "unit_position"),
    "rank_units": f"""WITH {UNIT_FACTS}
SELECT match_id, puuid, character_id, rarity, unit_position,
  row_number() OVER (PARTITION BY match_id, puuid ORDER BY rarity DESC, character_id, unit_position) AS unit_rank
FROM facts""",
    "unit_winrate": UNIT_WINRATE,
    "incremental_refresh": UNIT_WINRATE,
    "core_comp_winrate": CORE_COMP,
    "item_combo_winrate": ITEM_COMBO,
    "medallion_refresh": ITEM_COMBO,
    "incremental_gold": ITEM_COMBO,
    "primary_trait": f"WITH {TRAITS}, {PRIMARY} SELECT * FROM best",
    "win_rate_rollup": f"""WITH {TRAITS}
SELECT tft_set_number, trait_name, tier_current, {METRICS}
FROM traits GROUP BY tft_set_number, trait_name, tier_current HAVING count(*) >= 5""",
    "top_per_group": """SELECT o_custkey, o_orderkey, o_totalprice,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS seat
FROM orders QUALIFY seat <= 3""",
    "distinct_rows": f"WITH {UNITS} SELECT DISTINCT {PLAYER}, character_id, tier, rarity FROM units",
    "ordered_concat": f"""WITH {UNITS}, {CORE}
SELECT match_id, puuid, core_key, core_key_display, core_icon_urls FROM core""",
    "count_distinct_core": f"WITH {UNITS}, {CORE} SELECT match_id, puuid, core_size FROM core",
    "icon_slots": f"""WITH {UNITS}, {CORE}
SELECT match_id, puuid, {_slots("core_icon_urls", 9, "unit_icon_")} FROM core""",
    "performance_tier": f"""WITH {UNITS}, rates AS (
  SELECT character_id, tier, rarity, count(*) AS games, round(count(*) FILTER (top4) / count(*) * 100, 2) AS top4_rate
  FROM units GROUP BY ALL)
SELECT *, CASE WHEN games < 15 THEN 'N/A' WHEN top4_rate >= 80 THEN 'S' WHEN top4_rate >= 70 THEN 'A'
  WHEN top4_rate >= 50 THEN 'B' ELSE 'C' END AS grade
FROM rates""",
    "patch_extract": f"WITH {SEATS} SELECT match_id, puuid, game_version, patch FROM players",
    "meta_view": f"""SELECT * FROM ({ITEM_COMBO}) WHERE patch = '16.2.700' AND tier_winrate = 'B'
ORDER BY character_id, top4_rate DESC""",
    "meta_view_stored": f"""SELECT * FROM ({ITEM_COMBO}) WHERE patch = '16.2.700' AND tier_winrate = 'B'
ORDER BY character_id, top4_rate DESC""",
    "incremental_slice": f"""WITH {SEATS}
SELECT match_id, puuid, placement, ingestion_date FROM players
WHERE ingestion_date >= (SELECT max(ingestion_date) FROM players WHERE ingestion_date <= DATE '2024-01-07') - 1""",
    "upsert": UPSERT,
    "upsert_table": UPSERT,
    "full_refresh_table": """SELECT 'P' || (c_custkey * 20) AS puuid, c_acctbal AS amount,
  DATE '2024-01-05' + CAST(c_custkey % 10 AS INTEGER) AS ingestion_date FROM customer""",
    "sync_columns_table": f"""WITH {SEATS}
SELECT puuid, CASE WHEN CAST(trunc(o_totalprice) AS BIGINT) % 3 = 2 THEN o_totalprice END AS amount,
  CASE WHEN CAST(trunc(o_totalprice) AS BIGINT) % 3 = 2 THEN 'S' || placement ELSE CAST(placement AS VARCHAR) END AS seat, ingestion_date
FROM players""",
    "staged_view": f"""WITH {SEATS}, staged AS ({STAGED})
SELECT match_id, data_version, game_id, ingestion_date, strftime(ingestion_date, '%Y-%m-%d') AS folder_date FROM staged""",
    "bronze_as_of": f"WITH {SEATS} SELECT DISTINCT 'M' || m AS match_id, DATE '2024-03-01' AS ingestion_date FROM players",
    "expire_bronze": f"""WITH {SEATS}
SELECT ingestion_date AS date, count(DISTINCT m) AS total FROM players WHERE ingestion_date >= DATE '2024-01-08'
GROUP BY 1 ORDER BY 1 DESC""",
    "stream_dedupe": f"WITH {SEATS} SELECT DISTINCT 'M' || m AS match_id FROM players",
    "stream_dedupe_expiry": f"""WITH {SEATS}
SELECT DISTINCT 'M' || m AS match_id, ingestion_date AS date FROM players
UNION ALL SELECT DISTINCT 'M' || m, ingestion_date + 100 FROM players""",
    "changed_documents_refresh": CORE_COMP,
    "medallion_players": PLAYER_RESULTS,
    "item_catalogue": """SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pos, p_name AS "apiName",
  'ASSETS/Maps/' || p_brand || ' ' || p_type || '.tex' AS icon FROM part""",
    "sync_columns": f"WITH {SEATS} SELECT puuid, placement, CAST(NULL AS DOUBLE) AS added FROM players",
    "bronze_partition_counts": f"""WITH {SEATS}
SELECT ingestion_date AS date, count(DISTINCT m) AS total FROM players GROUP BY 1 ORDER BY 1 DESC LIMIT 5""",
    "tracked_players": f"""WITH ladder AS ({LADDER}),
best AS (
  SELECT puuid, CASE tier WHEN 'MACHINERY' THEN 0 ELSE 1 END AS part,
    row_number() OVER (PARTITION BY tier ORDER BY points DESC, pos) AS seat
  FROM ladder WHERE tier IN ('MACHINERY', 'HOUSEHOLD')),
parts AS (
  SELECT puuid, part, seat FROM best WHERE seat <= CASE part WHEN 0 THEN 200 ELSE 50 END
  UNION ALL (SELECT puuid, 2, pos FROM ladder WHERE tier = 'BUILDING' ORDER BY pos LIMIT 200))
SELECT puuid, row_number() OVER (ORDER BY part, seat) AS position FROM parts""",
    "first_distinct": """SELECT user_id, min(event_id) AS event_id FROM events
GROUP BY user_id ORDER BY event_id, user_id LIMIT 100""",
    "recent_matches": f"WITH {_recent()} SELECT * FROM recent",
    "discover_matches": f"""WITH {_recent("AND puuid IN (SELECT 'C' || c_custkey FROM customer WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD'))")}
SELECT DISTINCT match_id FROM recent""",
    "select_unhandled": f"""WITH {HISTORY}, {MATCH_LEDGER}
SELECT DISTINCT match_id FROM history
WHERE match_id NOT IN (SELECT match_id FROM ledger WHERE status IN ('success', 'abandoned'))""",
    "collector_summary": f"""WITH {HISTORY}, {MATCH_LEDGER},
ids AS (
  SELECT DISTINCT match_id, match_id NOT IN
    (SELECT match_id FROM ledger WHERE status IN ('success', 'abandoned')) AS is_new
  FROM history)
SELECT count(*) AS total_ids, count(*) FILTER (is_new) AS new_ids, count(*) FILTER (NOT is_new) AS skipped,
  CAST(ceil(count(*) FILTER (is_new) / 50) AS BIGINT) AS batches, 50::BIGINT AS batch_size
FROM ids""",
    "batch_ids": f"""WITH {HISTORY}, numbered AS (
  SELECT match_id, (row_number() OVER (ORDER BY md5(match_id), match_id) - 1) // 50 + 1 AS batch_num
  FROM (SELECT DISTINCT match_id FROM history))
SELECT batch_num, '20240101-0630-' || batch_num AS batch_id,
  string_agg(match_id, ',' ORDER BY match_id) AS match_ids, count(*) AS size
FROM numbered GROUP BY batch_num""",
    "decode_messages": f"""WITH {MESSAGES}
SELECT number, CASE WHEN broken THEN 'UNKNOWN' ELSE '20240101-0000-' || number END AS batch_id,
  CASE WHEN broken THEN NULL WHEN empty THEN '' ELSE array_to_string(ids, ',') END AS match_ids,
  CASE WHEN broken THEN NULL ELSE len(ids) END AS size, broken OR empty AS rejected
FROM decoded""",
    "message_ids": f"""WITH {MESSAGES}
SELECT '20240101-0000-' || number AS batch_id, unnest(ids) AS match_id FROM decoded WHERE NOT broken AND NOT empty""",
    "split_dead_letters": """SELECT user_id || '_' || strftime(ts, '%Y-%m-%d') AS match_id, count(*) AS deliveries
FROM events GROUP BY 1 HAVING count(*) >= 5""",
    "fold_ledger": FOLD,
    "fold_ledger_long_errors": FOLD.replace("'connection reset'", "substr(repeat('connection reset', 60), 1, 500)").replace(
        "'API key refused (401)'", "substr(repeat('API key refused (401)', 60), 1, 500)"
    ),
    "fold_ledger_sliced": FOLD,
    "stream_ledger": FOLD,
    "fold_ledger_prior": f"WITH {_fold('hour(ts) >= 12, ts, event_id')} SELECT * FROM folded",
    "fold_ledger_lowered_limits": f"WITH {LOWERED} SELECT * FROM folded",
    "requeue_second_load": f"""WITH {_fold(NOON_FIRST)}
SELECT match_id, 0::BIGINT AS batch_num, '20240201-0000-0' AS batch_id FROM folded
WHERE requeue AND match_id IN (SELECT match_id FROM ev WHERE hour(event_time) >= 12)""",
    "requeue": f"""WITH {_fold()}
SELECT match_id, 0::BIGINT AS batch_num, '20240201-0000-0' AS batch_id FROM folded WHERE requeue""",
    "ledger_status_counts": f"""WITH {_fold()}
SELECT status, count(*) AS total FROM folded GROUP BY status ORDER BY status""",
    "batch_outcomes": """WITH numbered AS (
  SELECT strftime(ts, '%Y%m%d') AS batch_id, event_type,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
outcomes AS (
  SELECT batch_id, event_type, CASE WHEN k % 5 IN (0, 1) THEN 'skipped'
    WHEN event_type IN ('purchase', 'view') THEN 'success'
    WHEN k % 3 + 1 >= 3 OR event_type = 'click' THEN 'abandoned' ELSE 'error' END AS outcome
  FROM numbered)
SELECT batch_id, count(*) FILTER (outcome = 'success') AS success, count(*) FILTER (outcome = 'error') AS error,
  count(*) FILTER (outcome = 'abandoned') AS abandoned, count(*) FILTER (outcome = 'skipped') AS skipped,
  count(*) FILTER (outcome = 'error' AND event_type = 'error') AS requeued
FROM outcomes GROUP BY batch_id""",
    "item_lookup": f"WITH {LOOKUP} SELECT * FROM lookup",
    "latest_set": """SELECT CAST(p_size AS BIGINT) AS set_pos, CAST(p_size AS BIGINT) AS number, p_name AS item
FROM part WHERE p_size = (SELECT max(p_size) FROM part)""",
    "item_icon_urls": f"""WITH {LOOKUP},
wanted AS (SELECT DISTINCT lower(p_name) AS api_name FROM part WHERE p_size = (SELECT max(p_size) FROM part))
SELECT api_name, '{CDN}/assets/' || regexp_replace(
  replace(replace(lower(icon), ' ', ''), '.tex', '.png'), '^assets/', '') AS icon_url
FROM wanted JOIN lookup USING (api_name)
WHERE api_name NOT IN (SELECT lower(p_name) FROM part WHERE p_partkey % 97 = 0)""",
    "champion_icon_urls": f"""WITH {UNITS}, champions AS (
  SELECT DISTINCT lower(character_id) AS id FROM units WHERE character_id NOT LIKE '%Brand2%')
SELECT id, regexp_replace(id, 'tft([0-9]*)_.*', '\\1') AS set_number, 'champions/' || id || '.png' AS target_path,
  '{CDN}/assets/characters/' || id || '/hud/' || id || '_square.tft_set' ||
  regexp_replace(id, 'tft([0-9]*)_.*', '\\1') || '.png' AS source_url
FROM champions""",
    "distinct_champions": f"WITH {UNITS} SELECT DISTINCT lower(character_id) AS id FROM units ORDER BY id",
    "distinct_items": f"WITH {UNITS} SELECT DISTINCT unnest(items) AS item FROM units ORDER BY item",
    "check_not_null": f"""WITH {SEATS}
SELECT 'match_id' AS column_name, count(*) FILTER (match_id IS NULL) AS null_count FROM players
UNION ALL SELECT 'patch', count(*) FILTER (patch IS NULL) FROM players
UNION ALL SELECT 'placement', count(*) FILTER (nullif(placement, 3) IS NULL) FROM players
UNION ALL SELECT 'queue_id', count(*) FILTER (queue_id IS NULL) FROM players""",
    "check_unique": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
}

_STORED = {
    "raw/raw_matches": "bronze_round_trip",
    "facts/fact_player_results": "player_results",
    "facts/fact_traits": "trait_facts",
    "facts/fact_units": "unit_facts",
}
ORACLES["layer_folders"] = " UNION ALL ".join(
    f"SELECT '{folder}' AS folder, count(*) AS n FROM ({ORACLES[query]})" for folder, query in _STORED.items()
)
_SUMMARY = ORACLES["collector_summary"]
ORACLES["collector_refresh"] = f"""SELECT 'collector_finished' AS event, 1::BIGINT AS n, new_ids, batches FROM ({_SUMMARY})
UNION ALL SELECT x, 1, NULL, NULL FROM (VALUES ('transformation_finished'), ('collector_handled')) t(x)"""
