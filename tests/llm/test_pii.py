import hashlib
import re

import odd

from matchlake.llm import pii
from matchlake.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(n // 10 + n % 10 for n in doubled) % 10 == 0
    return 8 <= len(digits) <= 15 if kind == "phone" else True


def plain_base(text):
    return [(i, m.start(), m.end()) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if _passes(k, m[0])]


TRICKY = [
    "a@b.c_d@e.f.g a@b@c.d @x.y z@ .@-.- é1@b.cé x@y..z u%+v@w-.1",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1..2.3.4 9.9.9 1.2.3.4a 12.34.56.78.",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 41111111111111112 4111111111111111",
    "+1 (555) 010-9999 +44.20.7946.0958 ++12345678 +1234567 +1( ( ( 2345678) +12345678901234567 +99999999 9",
    "card 4111111111111111+12 345 678 90 and 1.2.3.4@host.example.com",
    "\U0001f600 mail\U0001f600me@example.com é +49 30 1234567",
]


def test_base_spans():
    for text in TRICKY:
        assert pii.base_spans(text) == plain_base(text)


def test_base_spans_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " (" * 150_000, "a@" * 150_000, "1 " * 150_000, "a.b-" * 80_000):
        pii.base_spans(text)
        list(pii.proposals(text))


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    names = list(PATTERNS)
    for r in QUERIES["op10_pii"](spark, small).collect():
        base = plain_base(texts[r.doc_id])
        told = [f"{names[k]}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
        spans = r.spans.split(",") if r.spans else []
        assert set(told) <= set(spans)
        assert spans == sorted(spans, key=lambda x: (names.index(x.split(":")[0]), *map(int, x.split(":")[1:])))


def _corpus():
    docs = []
    for i in range(150):
        a, b = i % 200 + 10, (i * 7) % 200 + 10
        docs.append((i, f"write to user{i}@mail{i % 9}.example.com about it, from {a}.{b}.{a}.{b} or call +1 (555) {100 + i} {1000 + i}0 today"))
        docs.append((1000 + i, f"version {i % 5}.{i % 7}.{300 + i}.{i} of {1990 + i % 30}-{i % 12:02d}-{i % 28:02d} at page {i}, item {10**7 + i * 977}"))
    return docs


def test_spelled_out_forms_are_added_and_plain_numbers_are_not(spark):
    more = [(5000 + i, f"write to some{i} (at) host{i}.example.org about it and say so") for i in range(20)]
    more += [(6000 + i, f"reach it at {20 + i}[.]{30 + i}[.]40[.]{50 + i} from the office") for i in range(20)]
    docs = spark.createDataFrame(_corpus() + more, "doc_id long, text string")
    got = {r.doc_id: (r.base, r.spans) for r in pii.find_personal_data(docs).collect()}
    found = sum(len(spans) > len(base) for i, (base, spans) in got.items() if i >= 5000)
    assert found >= 36
    wrong = sum(len(spans) > len(base) for i, (base, spans) in got.items() if 1000 <= i < 5000)
    assert wrong <= 0.05 * 150
    for base, spans in got.values():
        assert set(base) <= set(spans)
    red = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert red[0].startswith("write to [email] about it, from [ip] or call [phone]")
    assert red[1001] == dict(_corpus())[1001] or got[1001][1]


def test_every_row_is_cut_by_its_own_spans(spark):
    rows = [(None, "mail a@b.cd now"), (1, "clean words only here"), (1, "mail a@b.cd now"), (1, "mail a@b.cd now"), (2, None), (None, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    red = sorted(((r.doc_id, r.text) for r in pii.redact(docs).collect()), key=str)
    cut = "mail [email] now"
    assert red == sorted([(None, cut), (1, rows[1][1]), (1, cut), (1, cut), (2, None), (None, "clean")], key=str)


def test_a_long_span_is_seen_behind_many_short_ones():
    text = ".".join(["1.2.3.4"] * 12) + ".x@example.org"
    base = pii.base_spans(text)
    starts, reach = [], []
    for _, a, b in sorted(base, key=lambda x: x[1]):
        starts.append(a)
        reach.append(max([b, *reach[-1:]]))
    assert len(base) > 9
    assert pii._overlaps(starts, reach, len(text) - 4, len(text)) and not pii._overlaps(starts, reach, len(text), len(text) + 1)


def test_the_word_at_is_enough_for_a_proposal():
    for text in ("write to jane at example.org", "an anecdotal note: jane at example.org"):
        assert any(kind == 0 and text[a:b].endswith("jane at example.org") for kind, a, b in pii.proposals(text))


def test_odd_rows(spark):
    docs = odd.docs(spark)
    got = pii.find_personal_data(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in docs.collect())
    assert all(r.base == [] and r.spans == [] for r in got)
    assert pii.find_personal_data(odd.no_docs(spark)).count() == 0
    assert pii.redact(odd.no_docs(spark)).count() == 0
    one = spark.createDataFrame([(1, "mail a@b.c"), (1, "mail a@b.c"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, len(r.spans)) for r in pii.find_personal_data(one).collect()) == [(1, 1), (1, 1), (2, 0)]
