import math
import re
from collections import Counter

import odd

from matchlake.llm import quality_rules
from matchlake.llm.queries import QUERIES


def _counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def _check(frame, texts):
    rows = frame.collect()
    got = Counter((r.doc_id, *[r[x] for x in quality_rules.COUNTS], r.base_failed) for r in rows)
    want = Counter()
    for i, text in texts:
        c = _counts(text)
        want[(i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0])] += 1
    assert got == want
    assert all(not r.kept for r in rows if r.base_failed)
    return rows


def test_query_against_plain_version(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    _check(QUERIES["op4_quality_rules"](spark, small), [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    docs = odd.docs(spark)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = _check(quality_rules.quality_verdicts(docs, odd.labels(spark)), texts)
    # far too few labels to certify anything
    assert all(r.kept != r.base_failed for r in rows)
    rows = _check(quality_rules.quality_verdicts(docs, odd.no_labels(spark)), texts)
    assert quality_rules.filter_quality(docs, odd.labels(spark)).columns == docs.columns
    assert quality_rules.filter_quality(docs, odd.labels(spark)).count() == sum(r.kept for r in rows)
    assert quality_rules.quality_verdicts(odd.no_docs(spark), odd.labels(spark)).count() == 0
    assert quality_rules.filter_quality(odd.no_docs(spark), odd.no_labels(spark)).count() == 0


def test_binomial_tail_is_exact():
    for n, k, p in ((20, 3, 0.1), (500, 0, 0.01), (3000, 40, 0.02)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(quality_rules.tail(k, n, p), exact, rel_tol=1e-9)
    assert quality_rules.tail(5, 5, 0.1) == 1.0


def test_choose_stops_at_the_first_cutoff_that_fails():
    # the third cutoff isn't certified, so the fourth, which would be, isn't looked at
    assert quality_rules.choose([9, 7, 5, 3], [0, 1, 400, 0], [1, 50, 60, 99], 5000, 0.004, 0.001, 10) == 7
    assert quality_rules.choose([9], [0], [5], 100, 0.004, 0.001, 10) is None
    assert quality_rules.choose([9], [0], [0], 10_000, 0.004, 0.001, 10) is None


def test_certified_cutoff_rejects_junk_and_spares_good(spark):
    good = [(i, "clean words in a row that say something new every time " + f"word{i} end of text {i}", "en") for i in range(4000)]
    junk = [(i, "## ** $$ %% word && || ## ** $$ %% and some text of junk number " + f"{i} here", "en") for i in range(4000, 4400)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, int(i < 4000)) for i, _, _ in good + junk], "doc_id long, quality int")
    kept = {r.doc_id for r in quality_rules.filter_quality(docs, marks).select("doc_id").collect()}
    assert kept == set(range(4000))
