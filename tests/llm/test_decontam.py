import random

import numpy as np
import odd
import pyarrow as pa
import pytest

from matchlake.llm import decontam, textscan
from matchlake.llm.queries import QUERIES


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], max(row[j + 1], row[j], last + 1 if x == y else 0)
    return row[-1]


def test_lcs():
    rng = random.Random(4)
    for _ in range(200):
        a = [rng.randint(0, 6) for _ in range(rng.randint(1, 70))]
        b = [rng.randint(0, 6) for _ in range(rng.randint(0, 90))]
        assert decontam.lcs(a, b) == plain_lcs(a, b)


def test_every_embedded_item_is_found_and_nothing_else(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontamination"](spark, small).collect()}
    def words(text):
        return decontam._text_terms(text).tolist()
    # brute force: every item against every document, by what any window of its length shares
    want = set()
    for d in docs:
        w = words(d.text)
        for i in items:
            x = words(i.text)
            if len(set(x) & set(w)) < 0.6 * len(set(x)):
                continue
            best = max(plain_lcs(x, w[s : s + int(1.25 * len(x)) + 2]) for s in range(0, max(1, len(w) - len(x) + 1), max(1, len(x) // 8)))
            if best >= 0.8 * len(x):
                want.add((d.doc_id, i.item_id))
    assert want and len(want & got) >= 0.9 * len(want)
    assert not got - want


@pytest.fixture(scope="module")
def planted():
    """Long documents of random words with rewritten items somewhere inside, and clean ones."""
    rng = random.Random(9)
    common = ["the", "of", "and", "to", "in", "is", "for", "on"]
    rare = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru", "te") for b in ("na", "po", "si", "tu") for c in range(60)]
    def prose(n):
        return [rng.choice(common) if rng.random() < 0.45 else rng.choice(rare) for _ in range(n)]
    items = [(i, prose(rng.randint(15, 90))) for i in range(30)]
    docs, truth = [], set()
    for d in range(120):
        body = prose(rng.randint(50, 1500))
        if d % 3 == 0:
            i, words = rng.choice(items)
            said = [w for w in words if rng.random() > 0.08]
            said = [rng.choice(rare) if rng.random() < 0.08 else w for w in said]
            text = [w.upper() if rng.random() < 0.2 else w + rng.choice(["", "", ",", "."]) for w in said]
            at = rng.randint(0, len(body))
            body[at:at] = text
            truth.add((d, i))
        docs.append((d, " ".join(body)))
    return docs, [(i, " ".join(w)) for i, w in items], truth


@pytest.mark.parametrize("blocks", [5000, 7])
def test_paraphrases(spark, planted, blocks):
    docs, items, truth = planted
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(frame, bench, block_items=blocks).collect()}
    assert len(got & truth) >= 0.9 * len(truth)
    assert not got - truth
    kept = decontam.decontaminate(frame, bench, block_items=blocks)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in got}


@pytest.mark.parametrize("replaced, answer", [(0.2, False), (0.38, True)])
def test_paraphrases_without_the_rare_words(spark, replaced, answer):
    """Copies at every place of the grid whose rarest words are replaced, against plain subsequences."""
    rng = random.Random(17)
    vocabulary = [f"w{i}" for i in range(400)]
    shares = [1 / (i + 2) for i in range(400)]
    def prose(n):
        return rng.choices(vocabulary, shares, k=n)
    place = {w: i for i, w in enumerate(vocabulary)}
    items = [prose(rng.choice((16, 24, 32, 48, 64))) for _ in range(24)]
    docs = [prose(rng.randint(20, 300)) for _ in range(300)]
    want = set()
    for i, words in enumerate(items):
        for offset in range(16):
            # with more replaced, half of the answer stays
            able = range(len(words) - len(words) // 8 if answer else len(words))
            gone = sorted(able, key=lambda k: -place[words[k]])[: int(len(words) * replaced)]
            told = [f"new{rng.randint(0, 10**6)}" if k in gone else w for k, w in enumerate(words)]
            assert plain_lcs(words, told) >= (0.6 if answer else 0.8) * len(words)
            want.add((len(docs), i))
            docs.append([f"x{rng.randint(0, 10**6)}" for _ in range(32 + offset)] + told + [f"x{rng.randint(0, 10**6)}" for _ in range(40)])
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(frame, bench).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_runs_across_the_cuts_of_long_items(spark):
    """64 words in a row of a longer item, wherever they begin, and 88 around the cut of 128 words."""
    items = [[f"a{i}" for i in range(128)], [f"b{i}" for i in range(150)], [f"c{i}" for i in range(300)]]
    runs = [(i, k, k + 64) for i, words in enumerate(items) for k in range(0, len(words) - 63, 5)] + [(0, 27, 115)]
    docs = [[f"x{d}y{j}" for j in range(40 + d)] + items[i][a:b] + [f"z{d}y{j}" for j in range(50)] for d, (i, a, b) in enumerate(runs)]
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(frame, bench).collect()}
    assert got == {(d, i) for d, (i, _, _) in enumerate(runs)}


def test_shares_of_many_pairs(planted):
    """All pairs at once give the subsequences that ``lcs`` gives one by one."""
    rng = np.random.default_rng(3)
    bench = decontam.Benchmark(planted[1])
    at = rng.integers(0, 40, 4000)
    start = rng.integers(0, 3900, 500)
    end, passage = start + rng.integers(1, 97, 500), rng.integers(0, len(bench.passages), 500)
    for k in range(0, 500, 3):  # some windows hold most of their passage
        own = decontam.place(bench.vocabulary, bench.passages[passage[k]])[: end[k] - start[k]]
        at[start[k] : start[k] + len(own)] = own
    share, told = bench.shares(at, start, end, passage)
    seen = 0
    for k in range(500):
        words = decontam.place(bench.vocabulary, bench.passages[passage[k]]).tolist()
        region, answer = at[start[k] : end[k]].tolist(), words[-max(1, len(words) // 4) :]
        if (plain := decontam.lcs(words, region) / len(words)) >= decontam.MIN_LCS:
            assert (share[k], told[k]) == (plain, decontam.lcs(answer, region) / len(answer))
            seen += 1
        else:
            assert share[k] < decontam.MIN_LCS
    assert seen > 50

def test_shared_columns_drop_no_candidate(planted, monkeypatch):
    """Fewer columns than passages only bound the energy; the same candidates come out."""
    docs, items, _ = planted
    text = "\n".join(t for _, t in docs[:6]).encode()
    data = np.frombuffer(text, np.uint8)
    ends = np.cumsum([0] + [len(t.encode()) + 1 for _, t in docs[:6]])
    ends[-1] = len(data)
    doc, hashes = decontam.terms(data, ends)
    last = np.cumsum(np.bincount(doc, minlength=6))
    first = np.concatenate([[0], last[:-1]])
    found = []
    for groups, rows in ((256, 4096), (3, 7)):
        monkeypatch.setattr(decontam, "GROUPS", groups)
        monkeypatch.setattr(decontam, "SLICE", rows)
        bench = decontam.Benchmark(items)
        idf = np.ones(len(bench.vocabulary)) * 3
        basis, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((len(idf), 200)))
        bench.fit(idf, basis)
        at = decontam.place(bench.vocabulary, hashes)
        found.append(sorted(x[:4] for x in bench.candidates(at, first, last)))
    assert found[0] == found[1] and found[0]


def test_rows_are_judged_by_their_own_text(spark):
    clean = "nothing of the sort can be found in here at all"
    bench = spark.createDataFrame([(1, odd.PLAIN)], "item_id long, text string")
    rows = [(None, odd.PLAIN), (None, clean), (1, odd.PLAIN), (1, clean), (1, clean), (2, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumn("_gone", docs.doc_id).withColumn("_row", docs.text)
    left = decontam.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(
        map(str, [(None, clean), (1, clean), (1, clean), (2, None), (None, None)])
    )


def test_no_window_that_could_be_found_is_left_out(planted, monkeypatch):
    """With every term needed nothing is left out beforehand; the same pairs come out."""
    docs, items, _ = planted
    bench = decontam.Benchmark(items)
    idf = np.random.default_rng(1).uniform(1, 9, len(bench.vocabulary))
    basis, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((len(idf), min(100, len(idf)))))
    bench.fit(idf, basis)
    runs = list(decontam._word_runs(pa.array([t for _, t in docs])))
    found = [sorted(x for run in runs for x in bench.verified(*run[1:]))]
    bench.needed[:] = True
    found.append(sorted(x for run in runs for x in bench.verified(*run[1:])))
    assert found[0] == found[1] and found[0]


def test_odd_rows(spark):
    docs = odd.docs(spark)
    bench = spark.createDataFrame([(1, odd.PLAIN), (1, odd.PLAIN), (2, None), (3, ""), (None, "one two three"), (5, "word " * 300)], "item_id long, text string")
    got = decontam.leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(4, 1), (None, 1), (7, None)}
    assert {r.doc_id for r in got} <= {None, 4, 7}
    left = decontam.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, [1, 2, 3, 5, 6]))
    assert decontam.leaks(odd.no_docs(spark), bench).count() == 0
    assert decontam.leaks(docs, bench.limit(0)).count() == 0
    assert textscan.few_none.size == 0


def test_the_fit_reads_every_document(spark, planted):
    """The latent space does not hang on a share of the documents: the bound on passages changes nothing."""
    docs, items, _ = planted
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    fitted = []
    for sample in (1, 10**9):
        bench = decontam.Benchmark(items)
        decontam._fit(frame, bench, decontam.RANK, sample, 5)
        fitted.append(bench.folded)
    assert np.allclose(fitted[0], fitted[1], rtol=1e-4, atol=1e-5)


def test_the_fit_is_summed_in_bounded_chunks(spark, planted, monkeypatch):
    """The fit forms its products a bounded number of words at a time, with the same sum."""
    docs, items, _ = planted
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    fitted = []
    for words in (10**9, 70, 8):
        monkeypatch.setattr(decontam, "GRAM_WORDS", words)
        bench = decontam.Benchmark(items)
        decontam._fit(frame, bench, decontam.RANK, decontam.SAMPLE_PASSAGES, 5)
        fitted.append(bench.folded)
    assert np.allclose(fitted[0], fitted[1], rtol=1e-4, atol=1e-5)
    assert np.allclose(fitted[0], fitted[2], rtol=1e-4, atol=1e-5)
