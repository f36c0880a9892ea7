import re
from collections import Counter, defaultdict

import odd
import pytest

from matchlake.llm import jaccard
from matchlake.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_groups(rows):
    """(id, shingles, component) by comparing all rows that share a shingle."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    having = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            having[x].append(i)
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in having[x] if j > i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                up[max(top(i), top(j))] = min(top(i), top(j))
    least = defaultdict(list)
    for i, (row_id, _) in enumerate(rows):
        if row_id is not None:
            least[top(i)].append(row_id)
    return sorted(
        ((row_id, len(sets[i]), min(least[top(i)], default=None) if sets[i] else row_id) for i, (row_id, _) in enumerate(rows)), key=str
    )


def _check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicate_groups(docs, **options).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_groups(rows)


def test_query_against_plain_version(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = QUERIES["op8_jaccard"](spark, small).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_groups(rows)


@pytest.mark.parametrize("rounds", [1, 6])
def test_chains_and_borderline_pairs(spark, monkeypatch, rounds):
    """Copies that differ more and more: links between neighbours only, and pairs next to 0.8."""
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "PAIRS_PER_POSTING", 0)
    rows, base = [], [f"w{i}" for i in range(120)]
    for k in range(30):
        changed = list(base)
        for j in range(k):
            changed[(j * 7) % 120] = f"new{j}"
        rows.append((100 - k, " ".join(changed)))
    rows += [(200 + k, " ".join(base[: 100 + k])) for k in range(10)]
    rows += [(300 + k, " ".join([f"z{k}{i}" for i in range(3)] + base[:40])) for k in range(12)]
    rows += [(400 + k, " ".join(base[40:60] + [f"y{k}{i}" for i in range(60)])) for k in range(6)]
    rows += [(500, "a b c"), (501, "A b  c"), (502, "a b"), (503, "one"), (504, "ONE\n")]
    _check(spark, rows)


def _crowd():
    """400 copies of one text, 300 texts with a long passage in common, 60 near copies, and single ones."""
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join(f"c{j}" for j in range(40))) for i in range(400)]
    rows += [(1000 + i, " ".join([f"d{i}x{j}" for j in range(25)] + passage)) for i in range(300)]
    rows += [(2000 + i, " ".join([f"n{j}" for j in range(60)] + [f"e{i}"])) for i in range(60)]
    rows += [(3000 + i, " ".join(f"s{i}x{j}" for j in range(30))) for i in range(50)]
    return rows


def test_hot_shingles_are_put_together_before_they_are_dealt(spark):
    rows = _crowd()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    entries, counted = Counter(), 0
    for r in jaccard._prefix_entries(docs, 8, 5, 80).collect():
        entries.update(r.shingles)
        counted += bool(r.counts)
    # two for each of the runs, here one in each of three tasks
    assert max(entries.values()) <= 6 and counted


@pytest.mark.parametrize("run", [1, 700, 500_000])
def test_shared_shingles_are_counted_whole(run):
    """However the runs are cut: no class has fewer shared shingles than it should, and single ones none."""
    import pyarrow as pa
    import pyarrow.compute  # noqa: F401

    sets = [jaccard.textscan.shingle_sets(*jaccard.textscan.flat(pa.array([t])))[0] for _, t in dict.fromkeys((None, t) for _, t in _crowd())]
    heads = [x[: len(x) - jaccard._need(len(x), 80) + 1 + len(x) // 10] for x in sets]
    df = Counter(int(s) for x in heads for s in x)
    want = {jaccard._digest(x)[1]: n for x, h in zip(sets, heads) if (n := sum(df[int(s)] > 1 for s in h))}
    packed, shingles, owners = [], [], []
    for i, (x, h) in enumerate(zip(sets, heads)):
        shingles.append(h)
        owners.append(jaccard.np.full(len(h), jaccard._digest(x)[1]))
        if sum(map(len, shingles)) >= run or i == len(sets) - 1:
            packed.append(jaccard._packed(jaccard.np.concatenate(shingles), jaccard.np.concatenate(owners), 4))
            shingles, owners = [], []
    got = Counter()
    for bucket in range(4):
        mine = [b.filter(pa.compute.equal(b.column(0), bucket)).select([1, 2, 3]) for b in packed]
        for out in jaccard._shared(iter(mine)):
            for lo, n in zip(*(c.to_pylist() for c in out.columns)):
                got[lo] += n
    assert got == want


def test_crowd_against_plain_version(spark):
    _check(spark, _crowd())


def test_odd_rows(spark):
    docs = odd.docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = jaccard.near_duplicate_groups(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_groups(rows)
    assert jaccard.near_duplicate_groups(odd.no_docs(spark)).count() == 0
    one = jaccard.keep_one(docs)
    assert one.columns == docs.columns
    # rows without words stay, and one row of every group: that of the only id its four rows have
    assert Counter(r.doc_id for r in one.collect()) == Counter([1, 2, 3, 4, 5, 6, 7])


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_one_row_of_each_group_stays_whatever_its_ids(spark, hot_rows):
    p, o = odd.PLAIN, " ".join(f"other{i}" for i in range(60))
    near, q = o.replace("other59", "changed"), "a third text that stands quite alone and has no copy"
    rows = [(1, p), (2, p), (2, o), (None, p), (4, near), (4, near), (None, q), (None, q), (3, None), (3, None), (None, "")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, place int")
    for name in ("_gone", "_row", "key", "hi", "_id", "wins"):
        docs = docs.withColumn(name, docs.place)
    left = jaccard.keep_one(docs, hot_rows=hot_rows)
    assert left.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in left.collect())
    assert got == Counter([(1, p), (2, o), (None, q), (3, None), (3, None), (None, "")])
    assert all(r["_row"] == r.place == r.key for r in left.collect())


def test_long_words_of_one_polynomial_hash_stay_apart():
    """Thue-Morse strings: alike for any sum of powers modulo 2**64, yet different."""
    import numpy as np

    from matchlake.llm import textscan

    a = b"a"
    for _ in range(12):
        a += a.translate(bytes.maketrans(b"ab", b"ba"))
    b = a.translate(bytes.maketrans(b"ab", b"ba"))
    for size in (1024, 2048, 4096):
        data = np.frombuffer(a[:size] + b[:size] + a[:size].upper(), np.uint8)
        starts = np.arange(3) * size
        plain, low = (textscan.hash_ranges(data, starts, starts + size, t) for t in (textscan.PLAIN, textscan.LOWER))
        assert len(set(plain)) == 3 and low[0] == low[2] != low[1]


def test_components_of_a_long_chain(spark):
    from matchlake.llm.common import Scratch

    labels = spark.range(60).selectExpr("id AS node", "id AS comp")
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 45), (50, 59)], "a long, b long")
    got = jaccard.merge_components(labels, links, Scratch(spark, "test"), "chain")
    want = {i: 0 if i <= 40 else 45 if i in (45, 50, 59) else i for i in range(60)}
    assert {r.node: r.comp for r in got.collect()} == want
