import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from matchlake.llm import scan, trie
from matchlake.llm.common import Scratch
from matchlake.llm.queries import QUERIES
from pyspark.sql import functions as F

SHAPE = "conv_id long, turn long, role string, text string"


def _turn_hash(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def _sequences(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append((turn is not None, turn or 0, _turn_hash(role, text), (role, text)))
    return {c: [x[3] for x in sorted(v)] for c, v in convs.items()}


def _rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def _expected(convs):
    members = defaultdict(list)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children, subtree = defaultdict(int), defaultdict(lambda: [0, 0])
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        for d in range(len(node) + 1):
            subtree[node[:d]][0] += not children[node]
            subtree[node[:d]][1] += (len(of) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, of in members.items():
        ends = ",".join(map(str, sorted(c for c in of if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(of), len(node), parent, len(of), children[node], *subtree[node], digest))
    return sorted(out, key=str)


def _got(frame):
    assert frame.columns == trie.COLUMNS
    return sorted((tuple(r) for r in frame.collect()), key=str)


def _frame(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def _forest(seed, convs=60):
    """Conversations that branch often, some of them equal, some the start of others."""
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(draw.choice([1, 2, 3, 5, 12])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "ab" * draw.choice([0, 1, 1, 1, 2])))
    draw.shuffle(rows)
    return rows


def test_query_against_plain_version(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op12_trie"](spark, small)
    assert [t for _, t in found.dtypes] == ["bigint"] * 7 + ["string"]
    assert _got(found) == _expected(_rebuild(_sequences(rows)))


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize("limits", [{}, {"rows_per_block": 7, "hot_rows": 3}, {"rows_per_block": 1, "hot_rows": 1, "pages_mb": 0}])
def test_forest(spark, rebuild, limits):
    rows = _forest(1)
    convs = _sequences(rows)
    found = trie.prefix_trie(_frame(spark, rows), rebuild, **limits)
    assert _got(found) == _expected(_rebuild(convs) if rebuild else convs)


def test_one_conversation_holds_most_rows(spark):
    """Two long ones, equal up to their last turn, and short ones that begin like them."""
    long = [(c, t, "user", f"turn {t}") for c in (3, 8) for t in range(150)] + [(8, 150, "user", "more")]
    rows = long + [(c, t, "user", f"turn {t}") for c in range(20, 30) for t in range(c - 19)]
    found = trie.prefix_trie(_frame(spark, rows), rows_per_block=20, hot_rows=40)
    assert _got(found) == _expected(_sequences(rows))


def test_many_conversations_are_equal(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS_PER_PIECE", 3)
    rows = [(c, t, "user", "same") for c in range(100, 180) for t in range(2)] + [(1, 0, "user", "same")]
    found = trie.prefix_trie(_frame(spark, rows), rows_per_block=16, hot_rows=10)
    assert _got(found) == _expected(_sequences(rows))


def test_all_have_their_own(spark):
    rows = [(c, t, "user", f"{c}") for c in range(30) for t in range(3)]
    assert _got(trie.prefix_trie(_frame(spark, rows))) == _expected(_sequences(rows))


@pytest.mark.parametrize("rebuild", [False, True])
def test_odd_rows(spark, rebuild):
    rows = [
        (0, 0, "user", "a"), (0, 0, "user", "a"), (0, 0, "assistant", "b"), (0, None, None, None), (0, None, "", ""),
        (1, 5, "user", ""), (1, 3, "us", "era"), (1, 3, "user", "a"), (2, None, "user", "x" * 300_000), (None, 0, "user", "lost"),
        (5, 1, "", "é\n"), (6, 1, "", "é\n"), (7, 1, None, "é\n"), (2**62, 0, "user", "a"), (10, 0, "user", "a"),
    ]
    frame = _frame(spark, rows)
    for name in ("depth", "lo", "conv", "_block", "len"):
        frame = frame.withColumn(name, F.lit("clash"))
    convs = _sequences(rows)
    assert _got(trie.prefix_trie(frame, rebuild)) == _expected(_rebuild(convs) if rebuild else convs)


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "a")]])
def test_no_conversations(spark, rows):
    assert trie.prefix_trie(_frame(spark, rows), rebuild=True).count() == 0


@pytest.mark.parametrize("per_block", [1, 5, 10_000])
def test_running_totals(spark, per_block):
    frame = spark.range(500).selectExpr("if(id < 300, 7, id div 3) AS k", "id AS at", "hash(id) AS v")
    placed = scan.place(frame, ["k", "at"], 500, Scratch(spark, "test"), f"p{per_block}", per_block)
    found = scan.running(placed, "k", ["at"], {"s": (scan.SUM, F.col("v")), "x": (scan.XOR, F.col("v"))}).collect()
    sums, xors = defaultdict(int), defaultdict(int)
    assert len(found) == 500
    for r in sorted(found, key=lambda r: (r.k, r["at"])):
        sums[r.k] += r.v
        xors[r.k] ^= r.v
        assert (r.s, r.x) == (sums[r.k], xors[r.k])
