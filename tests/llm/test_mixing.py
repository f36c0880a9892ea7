import re

import numpy as np
import odd
import pytest

from matchlake.llm import mixing
from matchlake.llm.queries import QUERIES


def plain_targets(sizes, weights=(5, 2, 1), cap=3.0):
    """Share by weight, stop at the cap, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        target = {s: cap * sizes[s] if s in capped else left * weight[s] / share for s in names}
        above = {s for s in names if target[s] > cap * sizes[s] * (1 + 1e-12)} - capped
        if not above:
            return target
        capped |= above


def _sizes(rows):
    return [len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for text in rows]


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    size = dict(zip([d.doc_id for d in docs], _sizes([d.text for d in docs])))
    by_source = {}
    for d in docs:
        by_source[d.source] = by_source.get(d.source, 0) + size[d.doc_id]
    source, target = {d.doc_id: d.source for d in docs}, plain_targets(by_source)
    got = QUERIES["op9_mixing"](spark, small).collect()
    assert sorted((r.doc_id, r["size"], r.source_size) for r in got) == sorted((i, size[i], by_source[source[i]]) for i in size)
    taken = {}
    for r in got:
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    # 10 documents per source here; no outcome is further off than one of them
    for s in target:
        assert abs(taken[s] - target[s]) <= max(size[i] for i in size if source[i] == s)
    again = QUERIES["op9_mixing"](spark, small).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_targets_stop_at_the_cap(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 3, None: 700, "e": 0}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    sizes, chances = rng.integers(1, 500, 3000).astype(float), np.full(3000, 0.37)
    ones = np.ones(3000)
    out = mixing.flight(sizes, ones, chances, np.random.default_rng(2))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs((out - chances) @ sizes) < 1e-3 and abs((out - chances).sum()) < 1e-6
    landed = mixing.land(sizes, ones, out)
    assert set(landed) <= {0.0, 1.0} and abs((landed - chances) @ sizes) <= 1000


def test_flight_is_fair():
    hits = np.zeros(6)
    for seed in range(2000):
        hits += mixing.land(np.ones(6), np.ones(6), mixing.flight(np.ones(6), np.ones(6), np.full(6, 0.5), np.random.default_rng(seed)))
    assert np.all(abs(hits / 2000 - 0.5) < 0.06)


def test_a_source_of_many_units_meets_its_target(spark):
    """Some units are large; no unit is over 1% of the target."""
    rows = [(i, f"s{i % 3}", "w " * (300 if i % 10 == 0 else 40 + i % 50)) for i in range(1800)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    taken, target = {}, {}
    source = dict((i, s) for i, s, _ in rows)
    for r in mixing.mix_table(docs).collect():
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) < 0.001 * target[s] for s in taken), (taken, target)


def test_many_blocks_and_rounds(spark):
    rows = [(i, f"s{i % 2}" if i % 10 else None, "w " * (1 + i % 37)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix_table(docs, units_per_block=25).collect()
    taken, target = {}, {}
    for r in got:
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        target[r.source_size] = r.target
    assert all(abs(taken[s] - target[s]) <= 40 for s in taken)


def test_odd_rows(spark):
    docs = odd.docs(spark)
    got = mixing.mix_table(docs).collect()
    rows = docs.collect()
    assert sorted(r["size"] for r in got) == sorted(_sizes([r.text for r in rows]))
    assert all(r.taken <= 3 * r["size"] for r in got)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = sum(_sizes([r.text for r in mixed.collect()]))
    assert taken == sum(r.taken for r in got)
    assert mixing.mix_table(odd.no_docs(spark)).count() == 0
    assert mixing.mix(odd.no_docs(spark)).count() == 0
