"""Benchmark decontamination by latent semantic retrieval, with subsequence and answer checks.

Benchmark items are cut into passages of at most 64 words, those of longer items overlapping by half. Terms are weighted by TF-IDF, the
document frequencies being counted over all documents. A randomised SVD of the passage matrix
(all benchmark passages, and those of all documents) gives a latent space:
random test vectors go once through ``A'A``, summed up over tasks, and the small sum is
factorised on the driver; its size depends on the benchmark alone. Only benchmark terms
are needed, as no other term adds to a product with a benchmark passage.

Every word of every document is then indexed: windows of 16, 32 and 64 words at a quarter of their
length are compared in the latent space with the benchmark passages of up to that length.
A window is a candidate by its cosine and by how much of the passage's latent energy it
holds. As the latter is a sum over words, it is looked at first, from a table of words
and passages, for windows that hold one of the terms that no subsequence long enough can all miss. Candidates are verified in the same task: longest common subsequence of words, and
the same over the answer, the last quarter of the passage; many pairs at once, as bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm import textscan
from matchlake.llm.common import Scratch, bounded, pack, text_key

SCALES = (16, 32, 64)
RANK = 128
SAMPLE_PASSAGES = 100_000
#: Columns of the table that the first look at a window needs, and windows looked at together.
GROUPS, SLICE = 256, 4096
#: Pairs of a window and a passage verified together.
PAIRS = 16384
BLOCK_ITEMS = 5_000
#: Words of whole passages whose products with the test vectors are formed at once in the fit.
GRAM_WORDS = 16_384
MIN_COSINE = 0.4
#: A window with words of a passage only and this share of its energy has about ``MIN_COSINE``.
MIN_HELD = MIN_COSINE**2
SURE_LCS, MIN_LCS, MIN_ANSWER = 0.8, 0.6, 0.5
FOUND = "item_id long, cosine double, lcs double, answer double"
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?\"'()[]{}*_-")] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every word in lower case, without punctuation around it."""
    doc, starts, ends = textscan.word_ranges(data, offsets)
    for _ in range(3):
        ends = ends - ((ends > starts) & _MARKS[data[np.maximum(ends - 1, 0)]])
        starts = starts + ((ends > starts) & _MARKS[data[np.minimum(starts, max(len(data) - 1, 0))]])
    solid = ends > starts
    return doc[solid], textscan.hash_ranges(data, starts[solid], ends[solid], textscan.LOWER)


def _text_terms(text: str) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return terms(data, np.array([0, len(data)]))[1]


def place(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Number of each hash in the sorted ``vocabulary``; its length where it is not in it."""
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == hashes, at, len(vocabulary))


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one big-integer step per element of ``b``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        if mask := masks.get(x):
            hit = row & mask
            row = (row + hit) | (row - hit)
            row &= full
    return len(a) - row.bit_count()


def _lcs_bits(masks: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``lcs`` for many pairs at once: places of each word (rows) in the sequence of each column."""
    full = np.uint64(2**64 - 1) >> (64 - size).astype(np.uint64)
    row = full.copy()
    for mask in masks:
        hit = row & mask
        row = (row + hit) | (row - hit)
    return size - np.bitwise_count(row & full)


def _slices(waiting: list[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """The rows of all ``waiting`` columns, ``PAIRS`` at a time."""
    columns = [np.concatenate(x) for x in zip(*waiting)]
    for low in range(0, len(columns[0]) if columns else 0, PAIRS):
        yield tuple(x[low : low + PAIRS] for x in columns)


class Benchmark:
    """Passages of one block of benchmark items, and once fitted the latent space."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.items, self.passages = [], []
        for item, text in items:
            hashes = _text_terms(text)
            pieces = -(-len(hashes) // SCALES[-1])
            parts = np.array_split(hashes, max(pieces, 1))
            # passages across each cut, from the middle of one to the middle of the next
            parts += [np.concatenate([a[len(a) // 2 :], b[: len(b) // 2]]) for a, b in zip(parts, parts[1:])]
            for part in parts:
                if len(part):
                    self.items.append(item)
                    self.passages.append(part)
        joined = np.concatenate(self.passages) if self.passages else textscan.few_none
        self.vocabulary = np.unique(joined)
        self.lengths = np.array([len(x) for x in self.passages], np.int64)
        self.scale = np.searchsorted(SCALES, self.lengths)
        # the terms of each passage, and the places of each as bits
        self.places = []
        for part in self.passages:
            known, which = np.unique(place(self.vocabulary, part), return_inverse=True)
            bits = np.zeros(len(known), np.uint64)
            np.bitwise_or.at(bits, which, np.uint64(1) << np.arange(len(part), dtype=np.uint64))
            self.places.append((known, bits))

    def fit(self, idf: np.ndarray, latent: np.ndarray) -> None:
        """``latent``: an orthonormal basis (terms x rank); folds the passages into it."""
        self.weights = np.append(idf, 0.0)[:, None] * np.vstack([latent, np.zeros(latent.shape[1])])
        self.weights = self.weights.astype(np.float32)
        folded = [self.weights[place(self.vocabulary, x)].sum(axis=0) for x in self.passages]
        self.folded = np.array(folded, np.float32)
        self.energy = np.maximum((self.folded**2).sum(axis=1), 1e-9)
        # energy of each passage that one occurrence of a term holds; passages beyond GROUPS
        # share columns, which then hold the most of any of them and so bound them all
        self.columns, self.gains = [], []
        for s in range(len(SCALES)):
            own = np.flatnonzero(self.scale == s)
            groups = min(len(own), GROUPS)
            gains = np.zeros((len(self.weights), groups), np.float32)
            for low in range(0, len(gains), SLICE):
                each = (self.weights[low : low + SLICE] @ self.folded[own].T) / self.energy[own]
                for j in range(groups):
                    gains[low : low + SLICE, j] = each[:, j::groups].max(axis=1)
            self.columns.append([own[j::groups] for j in range(groups)])
            self.gains.append(gains)
        # a subsequence of MIN_LCS of a passage has one of any of its places that are too many to miss:
        # its rarest ones, whose terms few windows hold
        self.needed = np.zeros((len(SCALES), len(self.weights)), bool)
        for part, s in zip(self.passages, self.scale):
            at = place(self.vocabulary, part)
            missed = len(at) - int(np.ceil(MIN_LCS * len(at) - 1e-9))
            self.needed[s, at[np.argsort(-idf[at], kind="stable")[: missed + 1]]] = True

    def _windows(self, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(texts, window starts, window ends, passages) of a run of texts, by energy held.

        ``at``: term numbers of all words; ``first`` and ``last``: word range of each text.
        Words are summed by quarters of a window; four neighbouring sums are a window.
        """
        none = len(self.weights) - 1
        for s, width in enumerate(SCALES):
            if not self.columns[s]:
                continue
            gains, number, step = self.gains[s], self.columns[s], width // 4
            sizes, waiting = np.array([len(x) for x in number]), []
            # texts in quarters, filled up with nothing, and three empty quarters after each
            quarters = -(-(last - first) // step)
            begin = np.cumsum(quarters + 3) - (quarters + 3)
            text = np.repeat(np.arange(len(first)), last - first)
            grid = np.full((int((quarters + 3).sum()), step), none, np.int32)
            grid.reshape(-1)[np.arange(len(at)) - first[text] + begin[text] * step] = at
            owner = np.repeat(np.arange(len(first)), quarters + 3)
            # windows that hold a needed term, a quarter of their length on either side included
            hits = textscan.running(self.needed[s][grid].any(axis=1))
            place_of = np.arange(max(len(grid) - 3, 0))
            near = hits[np.minimum(place_of + 5, len(grid))] > hits[np.maximum(place_of - 1, 0)]
            chosen = place_of[near]
            # windows may lie apart, and each then needs four quarters of its own
            together = max(SLICE // 8, 1)
            room = np.empty((4 * together, gains.shape[1]), np.float32)
            for low in range(0, len(chosen), together):
                window = chosen[low : low + together]
                used = np.unique(window[:, None] + np.arange(4))
                cells = np.ascontiguousarray(grid[used].T)
                sums, more = gains[cells[0]], room[: cells.shape[1]]
                for words in cells[1:]:
                    np.take(gains, words, axis=0, out=more, mode="clip")
                    sums += more
                row = np.searchsorted(used, window)
                held = sums[row] + sums[row + 1] + sums[row + 2] + sums[row + 3]
                i, j = np.nonzero(held >= MIN_HELD)
                doc = owner[window[i]]
                start = first[doc] + (window[i] - begin[doc]) * step
                end = np.minimum(start + width, last[doc])
                inside = start < end
                if not inside.any():
                    continue
                # every passage of a column, for each window that may hold it
                pair = np.repeat(np.flatnonzero(inside), sizes[j[inside]])
                waiting.append((doc[pair], start[pair], end[pair], np.concatenate([number[x] for x in j[inside]])))
                if sum(len(x[0]) for x in waiting) >= PAIRS:
                    yield from _slices(waiting)
                    waiting = []
            yield from _slices(waiting)

    def candidates(self, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(text, window start, window end, passage, cosine) of a run of texts."""
        for text, start, end, passage in self._windows(at, first, last):
            cosine, good = self._cosines(at, start, end, passage)
            for k in np.flatnonzero(good):
                yield int(text[k]), int(start[k]), int(end[k]), int(passage[k]), float(cosine[k])

    def _cosines(self, at: np.ndarray, start: np.ndarray, end: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cosine of each window with its passage, and whether that and the energy held suffice."""
        cosine, good = np.zeros(len(start)), np.zeros(len(start), bool)
        heads = np.flatnonzero(np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[: len(start)])
        for a, b in zip(heads, np.append(heads[1:], len(start))):
            vector = self.weights[at[start[a] : end[a]]].sum(axis=0)
            energy = self.energy[passage[a:b]]
            products = self.folded[passage[a:b]] @ vector
            cosine[a:b] = products / np.sqrt(max(float(vector @ vector), 1e-12)) / np.sqrt(energy)
            good[a:b] = (cosine[a:b] >= MIN_COSINE) & (products >= MIN_HELD * energy)
        return cosine, good

    def shares(self, at: np.ndarray, start: np.ndarray, end: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest common subsequence of each passage, and of its answer, with words ``start`` to ``end``.

        As shares of their words. A passage has at most 64 words, the bits of one integer; below
        ``MIN_LCS`` of them the shares may be 0.
        """
        order = np.argsort(passage, kind="stable")
        start, end, own = start[order], end[order], passage[order]
        inside = (start + np.arange(int((end - start).max()))[:, None]).astype(np.int32)
        words = np.where(inside < end, at[np.minimum(inside, len(at) - 1)], len(self.vocabulary))
        masks, table = np.empty(words.shape, np.uint64), np.zeros(len(self.vocabulary) + 1, np.uint64)
        heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        for a, b in zip(heads, np.append(heads[1:], len(own))):
            known, bits = self.places[own[a]]
            table[known] = bits
            masks[:, a:b] = table[words[:, a:b]]
            table[known] = 0
        size = self.lengths[own]
        # a subsequence has no more words than lie anywhere in the window
        able = np.flatnonzero(np.bitwise_count(np.bitwise_or.reduce(masks, axis=0)) >= MIN_LCS * size)
        masks, size = np.ascontiguousarray(masks[:, able]), size[able]
        last = np.maximum(size // 4, 1)
        share, told = np.zeros(len(own)), np.zeros(len(own))
        share[order[able]] = _lcs_bits(masks, size) / size
        told[order[able]] = _lcs_bits(masks >> (size - last).astype(np.uint64), last) / last
        return share, told

    def verified(self, hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item, cosine, lcs, answer) of the best window of each text and item found.

        The subsequences are looked at before the cosine, as that costs more; both have to suffice.
        """
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        at = place(self.vocabulary, hashes)
        for text, start, end, passage in self._windows(at, first, last):
            room = (end - start) // 4
            share, told = self.shares(at, np.maximum(first[text], start - room), np.minimum(last[text], end + room), passage)
            alike = np.flatnonzero((share >= SURE_LCS) | (share >= MIN_LCS) & (told >= MIN_ANSWER))
            cosine, good = self._cosines(at, start[alike], end[alike], passage[alike])
            for k, near in zip(alike[good], cosine[good]):
                key, found = (int(text[k]), self.items[passage[k]]), (float(share[k]), float(told[k]), float(near))
                best[key] = max(best.get(key, (0.0, 0.0, 0.0)), found)
        for (text, item), (share, told, cosine) in best.items():
            yield text, item, cosine, share, told


def _word_runs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, word hashes, first word, last word of each text) by runs of texts."""
    for row, data, offsets in textscan.runs(texts):
        doc, hashes = terms(data, offsets)
        ends = np.cumsum(np.bincount(doc, minlength=len(offsets) - 1))
        yield row, hashes, np.concatenate([[0], ends[:-1]]), ends


def _document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Documents with each term, documents, and passages of 64 words, over all documents."""
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows, passages = np.zeros(size + 1, np.int64), 0, 0
        for batch in batches:
            rows += batch.num_rows
            for _, hashes, first, last in _word_runs(batch.column(0)):
                at = place(vocabulary, hashes)
                doc = np.repeat(np.arange(len(first)), last - first)
                known = at < size
                pairs = np.unique(doc[known] * np.int64(size) + at[known])
                found += np.bincount(pairs % size, minlength=size + 1) if size else 0
                passages += int((-(-(last - first) // SCALES[-1])).sum())
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, [-1, -2])), pa.array(np.append(found[seen], [rows, passages]))], names=["term", "n"]
        )

    sums = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    # one row per benchmark term of a block, and two more
    got = {int(r.term): int(r.n) for r in sums.collect()}
    return np.array([got.get(i, 0) for i in range(size)], float), got.get(-1, 0), got.get(-2, 0)


def _fit(docs: DataFrame, bench: Benchmark, rank: int, sample: int, seed: int) -> None:
    frequency, rows, passages = _document_frequencies(docs, bench.vocabulary)
    size = len(bench.vocabulary)
    idf = np.log1p((rows + 1) / (frequency + 1))
    rank = min(rank, size)
    tests = np.random.default_rng(seed).standard_normal((size + 1, rank)).astype(np.float32)
    tests[size] = 0
    known = np.append(idf, 0.0).astype(np.float32)
    # every document's passages enter the fit; what a task sends on is one row per benchmark
    # term it saw, so the sum is bounded by the benchmark however many documents there are
    every = docs.select("text")
    vocabulary = bench.vocabulary

    def gram(at: np.ndarray, passage: np.ndarray) -> np.ndarray:
        """A'A times the test vectors, for words ``at`` in numbered passages (in order).

        Whole passages are taken ``GRAM_WORDS`` words or so at a time, so the temporaries
        stay bounded however many words a run of texts holds.
        """
        out = np.zeros((size + 1, rank), np.float32)
        heads = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))[: len(at)]
        start = 0
        while start < len(at):
            end = len(at)
            if end - start > GRAM_WORDS:
                end = int(heads[np.searchsorted(heads, start + GRAM_WORDS, "right") - 1])
                if end <= start:  # a passage longer than a chunk stands alone
                    end = int(heads[np.searchsorted(heads, start, "right")]) if heads[-1] > start else len(at)
            words, part_heads = at[start:end], heads[(heads >= start) & (heads < end)] - start
            number = np.repeat(np.arange(len(part_heads)), np.diff(np.append(part_heads, len(words))))
            sides = np.add.reduceat(known[words][:, None] * tests[words], part_heads, axis=0)
            order = np.argsort(words, kind="stable")
            begin = np.flatnonzero(np.append(True, words[order][1:] != words[order][:-1]))
            out[words[order][begin]] += np.add.reduceat(known[words][order][:, None] * sides[number[order]], begin, axis=0)
            start = end
        out[size] = 0
        return out

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, rank), np.float32)
        for batch in batches:
            for _, hashes, first, last in _word_runs(batch.column(0)):
                doc = np.repeat(np.arange(len(first)), last - first)
                step = (np.arange(len(doc)) - first[doc]) // SCALES[-1]
                new = np.append(True, (doc[1:] != doc[:-1]) | (step[1:] != step[:-1]))[: len(doc)]
                at = place(vocabulary, hashes)
                inside = at < size
                total += gram(at[inside], np.cumsum(new)[inside])
        used = np.flatnonzero(np.abs(total[:size]).sum(axis=1))
        ends = pa.array(np.arange(len(used) + 1, dtype=np.int32) * rank)
        vectors = pa.ListArray.from_arrays(ends, pa.array(total[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), vectors], names=["term", "z"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        z = np.stack(frame["z"].to_list()).astype(float).sum(axis=0)
        return pd.DataFrame({"term": frame["term"].iloc[:1], "z": [z.tolist()]})

    parts = every.mapInArrow(part, "term long, z array<float>")
    sums = parts.groupBy("term").applyInPandas(add, "term long, z array<double>")
    z = np.zeros((size, rank))
    for row in sums.toLocalIterator():  # rank values for each benchmark term of a block
        z[row.term] = row.z
    own = np.concatenate([place(vocabulary, x) for x in bench.passages])
    numbers = np.repeat(np.arange(len(bench.passages)), [len(x) for x in bench.passages])
    z_own = gram(own, numbers)[:size].astype(float)
    # both parts of the matrix weigh the same, however much larger the corpus is
    if (norm := np.linalg.norm(z)) > 0:
        z = z * (np.linalg.norm(z_own) / norm)
    basis, _, _ = np.linalg.svd(z + z_own, full_matrices=False)
    bench.fit(idf, basis)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rank: int = RANK,
    sample_passages: int = SAMPLE_PASSAGES,
    block_items: int = BLOCK_ITEMS,
    seed: int = 5,
) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer): benchmark items that documents repeat.

    ``lcs`` and ``answer`` are shares of the passage's words. A pair is found if lcs >= 0.8, or
    lcs >= 0.6 and half of the answer is there. Items of over 64 words are found by any of their
    passages, which overlap by half, so that a run of 64 words nearly fills one wherever it begins. NULL and empty texts on either side give nothing; every row of a repeated
    doc_id or item_id counts by itself, so rows may repeat. Extra columns are not read. The
    benchmark is searched in blocks of about ``block_items``, each in one pass over ``docs``.
    The latent space is fitted on every document; ``sample_passages`` is kept for callers and
    narrows nothing.
    """
    spark = docs.sparkSession
    bench = benchmark.select("item_id", "text").where("text IS NOT NULL")
    blocks = -(-bench.count() // block_items)
    result = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {FOUND}"
    found = spark.createDataFrame([], result)
    slim = docs.select("doc_id", "text")
    for i in range(blocks):
        block = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        rows = sorted(((r.item_id, r.text) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        own = Benchmark(rows)
        if not own.passages:
            continue
        _fit(slim, own, rank, sample_passages, seed)
        found = found.unionByName(slim.mapInArrow(_search(own), result))
    return found


def _search(bench: Benchmark):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for row, hashes, first, last in _word_runs(batch.column(1)):
                hits = list(bench.verified(hashes, first, last))
                if hits:
                    text, item, cosine, share, told = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([row + x for x in text])), pa.array(item, pa.int64()), pa.array(cosine), pa.array(share), pa.array(told)],
                        names=["doc_id", "item_id", "cosine", "lcs", "answer"],
                    )

    return search


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text repeats no benchmark item.

    Rows are judged by id and text together: of rows that share an id, or have none, only those
    go whose own text leaks. Rows without a text stay. Columns may have any names.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    keyed = docs.select(pack(docs), F.struct("doc_id", text_key(F.col("text")).alias("key")).alias("doc_id"), "text")
    found = leaks(keyed.select("doc_id", "text"), benchmark, **options)
    gone = found.select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.key").alias("_key")).distinct()
    leaking = F.col("doc_id.doc_id").eqNullSafe(F.col("_id")) & (F.col("doc_id.key") == F.col("_key"))
    return keyed.join(bounded(scratch.save(gone, "found")), leaking, "left_anti").select("_row.*")
