"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from matchlake.llm.quality_rules import ALPHA, DELTA, GOOD_WEIGHT, RULES

SPACES = "'[\\x20\\x09-\\x0D]+'"
WORDS = f"list_filter(regexp_split_to_array({{}}, {SPACES}), lambda x: x <> '')"

_ZERO = "3988292384"  # the polynomial of CRC-32, reversed
# steps of CRC-32 by byte
_CRC = f"""bits AS (
  SELECT i AS byte, 0 AS round, i::BIGINT AS v FROM range(256) t(i)
  UNION ALL
  SELECT byte, round + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, {_ZERO}::BIGINT) ELSE v >> 1 END FROM bits WHERE round < 8),
crc AS (SELECT list(v ORDER BY byte) AS step FROM bits WHERE round = 8)"""
SHARDS = f"""WITH RECURSIVE {_CRC},
bytes AS (
  SELECT doc_id, octet_length(encode(text)) AS n,
    list_transform(range(octet_length(encode(text))), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT) AS b
  FROM documents),
sized AS (
  SELECT doc_id, n + 8 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(step[(xor(c, x) & 255) + 1], c >> 8)), 4294967295::BIGINT)::BIGINT AS text_crc32
  FROM bytes, crc),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total
  FROM sized),
sharded AS (
  SELECT *, least(23, ((2 * upto - size) * 24) // (2 * total))::INTEGER AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM sharded"""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
GROUPS = f"""WITH RECURSIVE tokens AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END AS s
  FROM tokens),
flat AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
pairs AS (
  SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS n FROM flat a JOIN flat b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT i, j FROM pairs JOIN sets x ON x.doc_id = i JOIN sets y ON y.doc_id = j
  WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
both_ways AS (SELECT i, j FROM links UNION ALL SELECT j, i FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT r.doc_id, b.j FROM reached r JOIN both_ways b ON b.i = r.other)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1) USING (doc_id)"""

_GRID = ",\n  ".join(
    f"('{rule}', {sign}, {cutoffs})" for rule, (_, sign, cutoffs) in RULES.items()
)
_MEASURE = " ".join(f"WHEN '{rule}' THEN {sql.replace(' div ', ' // ')}" for rule, (sql, _, _) in RULES.items())
VERDICTS = f"""WITH tokens AS (SELECT doc_id, lang, text, {WORDS.format("text")} AS w FROM documents),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS place FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (
        SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) AS g
        FROM tokens WHERE len(w) >= 5)) WHERE c > 1) GROUP BY 1),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
counts AS (
  SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM tokens LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
rules AS (SELECT * FROM (VALUES {_GRID}) t(rule, side, grid)),
cuts AS (SELECT rule, side, unnest(grid) AS cutoff, unnest(range(len(grid))) AS place FROM rules),
held AS (
  SELECT based.*, good FROM based JOIN (SELECT doc_id, max(quality) > 0 AS good FROM labels GROUP BY 1) USING (doc_id) WHERE NOT base_failed),
strata AS (SELECT lang, count_if(good) AS n, (SELECT count(DISTINCT lang) FROM held) AS strata FROM held GROUP BY 1),
measured AS (SELECT lang, good, rule, side, side * (CASE rule {_MEASURE} END) AS m, n_words FROM held, rules),
tallied AS (
  SELECT lang, rule, side, place, cutoff, count_if(good AND m >= side * cutoff) AS g, count_if(NOT good AND m >= side * cutoff) AS b
  FROM measured JOIN cuts USING (rule, side) GROUP BY ALL),
tested AS (
  SELECT t.*, n, CASE WHEN g >= n THEN 1.0 ELSE list_sum(list_transform(range(g::BIGINT + 1), lambda i:
      exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({ALPHA} / {len(RULES)}) + (n - i) * ln(1 - {ALPHA} / {len(RULES)})))) END
    <= {DELTA} / (strata * {len(RULES)}) AS holds
  FROM tallied t JOIN strata USING (lang)),
certified AS (
  SELECT *, bool_and(holds AND n > 0) OVER (PARTITION BY lang, rule ORDER BY place) AS sure, b - {GOOD_WEIGHT} * g AS gain FROM tested),
chosen AS (
  SELECT lang, rule, side, arg_max(cutoff, (gain, -place)) AS cutoff FROM certified WHERE sure AND gain > 0 GROUP BY ALL),
gone AS (
  SELECT DISTINCT doc_id FROM based JOIN chosen USING (lang)
  WHERE NOT base_failed AND side * (CASE rule {_MEASURE} END) >= side * cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM gone) AS kept
FROM based"""

COPIES = f"""WITH lowered AS (SELECT doc_id, {LOWER.replace("text,", "coalesce(text, ''),")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM lowered WINDOW same AS (PARTITION BY t)"""

TRIE = f"""WITH RECURSIVE {_CRC},
turns AS (
  SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
taken AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT)),
    lambda a, x: xor(step[(xor(a, x) & 255) + 1], a >> 8)), 4294967295::BIGINT) % 9 AS h
  FROM turns, crc),
rebuilt AS (
  SELECT o.c, list_concat(coalesce(list_slice(a.s, 1, h), []), coalesce(list_slice(o.s, h + 1, len(o.s)), [])) AS s
  FROM taken JOIN turns o ON o.c = taken.c LEFT JOIN turns a ON a.c = o.c - o.c % 5),
prefixes AS (SELECT c, d, d = len(s) AS ends, s[1:d] AS k, s[d].t AS t FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, k, min(c) AS c, count(*) AS n, count(*) = count_if(ends) AS leaf, coalesce((count(*) - 1) * octet_length(encode(any_value(t))), 0) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY d, k),
below AS (
  SELECT d, k[1:d] AS k, count_if(depth = d + 1) AS n_children, count_if(leaf) AS n_leaves, sum(saved) AS saved
  FROM (SELECT d AS depth, k, leaf, saved, unnest(range(d + 1)) AS d FROM nodes) GROUP BY ALL)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n AS n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
  below.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below ON below.d = n.d AND below.k = n.k LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]"""

ORACLES: dict[str, str] = {
    "op2_sharding": SHARDS,
    "op4_quality_rules": VERDICTS,
    "op8_jaccard": GROUPS,
    "op12_trie": TRIE,
    "op13_copies": COPIES,
}
