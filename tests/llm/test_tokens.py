import random
import re

import numpy as np
import odd
import pytest

from matchlake.llm import tokens
from matchlake.llm.queries import QUERIES


def plain_count(vocabulary, longest, word):
    """Longest entry from the left, one after the other."""
    text, n = b" " + word, 0
    while text:
        size = next(k for k in range(min(longest, len(text)), 0, -1) if text[:k] in vocabulary or k == 1)
        text, n = text[size:], n + 1
    return n


@pytest.fixture(scope="module")
def vocabulary():
    words = tokens.read_vocabulary(tokens.VOCABULARY)
    return set(words), max(map(len, words))


def test_automaton_against_longest_match():
    rng = random.Random(3)
    for _ in range(30):
        entries = {bytes(rng.choice(b" ab") for _ in range(rng.randint(1, 7))) for _ in range(40)}
        machine = tokens.Automaton(list(entries))
        for size in (1, 2, 5, 40, 3000):
            word = bytes(rng.choice(b"ab") for _ in range(size))
            data = np.frombuffer(word, np.uint8)
            got = machine.count(data, np.array([0]), np.array([size]))[0]
            assert got == plain_count(entries, 7, word)


def test_more_than_a_byte_of_pieces_popped_at_once():
    machine = tokens.Automaton([b" ", b"a" * 300, b" " + b"a" * 299 + b"c"])
    word = b"a" * 299 + b"b"
    got = machine.count(np.frombuffer(word, np.uint8), np.array([0]), np.array([300]))[0]
    assert got == plain_count({b" ", b"a" * 300, b" " + b"a" * 299 + b"c"}, 301, word) == 301


def test_query_against_longest_match(spark, small, vocabulary):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    seen = {}
    for r in QUERIES["op3_token_counts"](spark, small).collect():
        words = re.findall(rb"[^\x20\x09-\x0D]+", texts[r.doc_id].encode())
        for w in set(words) - set(seen):
            seen[w] = plain_count(*vocabulary, w)
        assert (r.n_words, r.n_tokens) == (len(words), sum(seen[w] for w in words))


def test_odd_rows(spark, vocabulary):
    docs = odd.docs(spark)
    got = tokens.token_counts(docs).collect()
    texts = docs.collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in texts]
    for r, t in zip(got, texts):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t.text or "").encode())
        assert r.n_words == len(words)
        if len(t.text or "") < 1000:
            assert r.n_tokens == sum(plain_count(*vocabulary, w) for w in words)
    assert tokens.token_counts(odd.no_docs(spark)).count() == 0
