"""Token counts by a linear longest-match automaton.

The vocabulary is a set of byte strings that holds every single byte; a word is tokenised from the
left by the longest entry each time, with the space before it as its first byte. The trie of the
vocabulary gets failure links: where no entry goes on, the longest-match pieces at the front of
what has been read are popped at once, and reading goes on from the node of the rest. Only the number of
popped pieces is kept, per node and byte, so every byte costs one table look-up and no piece
is ever built. Equal words of a batch are counted once, all words side by side.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matchlake.llm import textscan

#: One entry per line: base64 of the bytes, then its number. The file has to exist on every executor.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Longer words are read one by one instead of side by side.
LONG_WORD = 2_000


def read_vocabulary(path: str) -> list[bytes]:
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Automaton:
    """``step[node, byte]`` is the next node, ``popped[node, byte]`` the pieces done by then.

    ``rest[node]`` is the number of pieces in the string of the node itself. Node 0 is empty.
    """

    def __init__(self, vocabulary: list[bytes]) -> None:
        children: list[dict[int, int]] = [{}]
        entry, depth, parent, byte = [False], [0], [0], [0]
        for token in [*vocabulary, *(bytes([b]) for b in range(256))]:
            node = 0
            for b in token:
                below = children[node].get(b)
                if below is None:
                    below = children[node][b] = len(children)
                    children.append({})
                    entry.append(False)
                    depth.append(depth[node] + 1)
                    parent.append(node)
                    byte.append(b)
                node = below
            entry[node] = bool(token)
        n = len(children)
        self.step = np.zeros((n, 256), np.int32)
        # a node pops no more pieces than it has bytes
        self.popped = np.zeros((n, 256), np.uint8 if max(depth) < 255 else np.uint32)
        fail, pops = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.rest = np.zeros(n, np.int32)
        levels = np.array(depth)
        up, by, whole = np.array(parent), np.array(byte), np.array(entry)
        for level in range(levels.max() + 1):
            nodes = np.flatnonzero(levels == level)
            if level:
                above, b = up[nodes], by[nodes]
                # an entry is popped as a whole; else what the parent pops, and its rest reads the byte
                rest = self.step[fail[above], b]
                done = pops[above] + self.popped[fail[above], b]
                fail[nodes] = np.where(whole[nodes], 0, rest)
                pops[nodes] = np.where(whole[nodes], 1, done)
                self.rest[nodes] = pops[nodes] + self.rest[fail[nodes]]
                self.step[nodes] = self.step[fail[nodes]]
                self.popped[nodes] = self.popped[fail[nodes]] + pops[nodes][:, None]
            for node in nodes:
                if below := children[node]:
                    keys = list(below)
                    self.step[node, keys] = list(below.values())
                    self.popped[node, keys] = 0
        self.first = int(self.step[0, 32])

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of pieces of each word ``data[start:end]``."""
        order = np.argsort(starts - ends, kind="stable")
        starts, sizes = starts[order], (ends - starts)[order]
        total, node = np.zeros(len(order), np.int64), np.full(len(order), self.first, np.int32)
        long = int(np.searchsorted(-sizes, -LONG_WORD, "left"))
        for i in range(long):
            state, pieces = self.first, 0
            for b in data[starts[i] : starts[i] + sizes[i]].tolist():
                pieces += int(self.popped[state, b])
                state = int(self.step[state, b])
            node[i], total[i] = state, pieces
        for j in range(int(sizes[long]) if long < len(sizes) else 0):
            some = slice(long, int(np.searchsorted(-sizes, -j, "left")))
            b = data[starts[some] + j]
            total[some] += self.popped[node[some], b]
            node[some] = self.step[node[some], b]
        out = np.empty(len(order), np.int64)
        out[order] = total + self.rest[node]
        return out


_automata: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """The automaton of a vocabulary file, built once in each worker."""
    if path not in _automata:
        _automata[path] = Automaton(read_vocabulary(path))
    return _automata[path]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_tokens.

    NULL and empty texts have no words and no tokens. Every row is counted by itself; extra
    columns are not read. Words are separated by ASCII white space, which isn't counted
    but for the one space in front of a word.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(vocabulary)
        for batch in batches:
            words, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, data, offsets in textscan.runs(batch.column(1)):
                doc, starts, ends = textscan.word_ranges(data, offsets)
                n = len(offsets) - 1
                hashes = textscan.hash_ranges(data, starts, ends)
                _, first, same = np.unique(hashes, return_index=True, return_inverse=True)
                pieces = machine.count(data, starts[first], ends[first])[same]
                words.append(np.bincount(doc, minlength=n).astype(np.int64))
                tokens.append(np.bincount(doc, weights=pieces, minlength=n).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(words)), pa.array(np.concatenate(tokens))],
                names=["doc_id", "n_words", "n_tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(scan, "doc_id long, n_words long, n_tokens long")
