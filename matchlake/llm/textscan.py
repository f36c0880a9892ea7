"""Words, lines and their hashes in Arrow string columns, by numpy passes over the bytes.

A small helper for tasks: texts are scanned as one run of UTF-8 bytes, so that cost follows
the number of bytes and not the number of words. Hashes have 64 bits and are made of random
odd factors fixed by a seed; equal byte strings have equal hashes in every run.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.default_rng(0x5EED)
PLAIN = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = PLAIN.copy()
LOWER[65:91] = PLAIN[97:123]
_STEPS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 2**64)
_PIECE = 1 << 20
_powers: list[np.ndarray] = []
#: Longer ranges are hashed by blake2b: sums of powers modulo 2**64 are alike for some
#: different byte strings (Thue-Morse sequences) of 1,024 bytes and more.
LONG_RANGE = 512
#: Texts are scanned in runs of about so many bytes.
RUN_BYTES = 1 << 20


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins; NULL counts as empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    if places is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    all_bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return all_bytes[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return freed memory to the system, which a worker that is used again would keep."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc only
        trim(0)


def runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive runs of texts; a longer text stands alone."""
    data, offsets = flat(column)
    start, last = 0, len(offsets) - 1
    while start < last:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), last)
        yield start, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end
    give_back()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, _PIECE)
        tables = []
        for factor in (_BASE, _UNBASE):
            steps = np.full(n, factor, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps))
        _powers[:] = tables
    return _powers[0], _powers[1]


def hash_ranges(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = PLAIN
) -> np.ndarray:
    """Hash of each byte range; ranges are in order and don't overlap, empty ones give the same."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        first = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, first + _PIECE, "right")))
        part = data[first : ends[j - 1]]
        up, down = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(table[part] * up[: len(part)], out=sums[1:])
        a, b = starts[i:j] - first, ends[i:j] - first
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
        if len(_powers[0]) > 4 * _PIECE:
            _powers.clear()
    for i in np.flatnonzero(ends - starts > LONG_RANGE):
        raw = data[starts[i] : ends[i]].tobytes()
        raw = raw.lower() if table is LOWER else raw  # of bytes: A-Z only
        out[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    return mix(out)


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, end) of every word, in order."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def words(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray = PLAIN
) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every word, in order."""
    doc, starts, ends = word_ranges(data, offsets)
    return doc, hash_ranges(data, starts, ends, table)


def line_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, end) of the \\n-split lines that have a word."""
    breaks = np.flatnonzero(data == 10)
    filled = offsets[1:] > offsets[:-1]
    starts = np.sort(np.concatenate([offsets[:-1][filled], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:][filled]]))
    solid = running(~SPACE[data])
    has = solid[ends] > solid[starts]
    starts, ends = starts[has], ends[has]
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def running(mask: np.ndarray) -> np.ndarray:
    """Sum of the values before each place; differences of it are sums over ranges."""
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of marked bytes in each text."""
    sums = running(mask)
    return sums[offsets[1:]] - sums[offsets[:-1]]


def windows(doc: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first word, hash) of every run of ``k`` words inside one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(doc[:n] == doc[k - 1 :])
    out = np.zeros(len(first), np.uint64)
    for i in range(k):
        out += hashes[first + i] * _STEPS[i]
    return first, mix(out)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, k: int = 5, table: np.ndarray = LOWER
) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``k``-word shingles.

    A text of fewer words gives one hash of its whole sequence, a text without words none.
    """
    doc, hashes = words(data, offsets, table)
    first, shingles = windows(doc, hashes, k)
    n = len(offsets) - 1
    count = np.bincount(doc, minlength=n)
    word_at, at = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    np.cumsum(count, out=word_at[1:])
    np.cumsum(np.maximum(count - k + 1, 0), out=at[1:])
    sets = []
    for i in range(n):
        if count[i] >= k:
            sets.append(np.unique(shingles[at[i] : at[i + 1]]))
        elif count[i]:
            few = hashes[word_at[i] : word_at[i + 1]]
            whole = (few * _STEPS[8 : 8 + len(few)]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mix(whole + _STEPS[16 + len(few)]))
        else:
            sets.append(few_none)
    return sets


few_none = np.zeros(0, np.uint64)


def list_column(parts: list[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit hashes as a list<long> column."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(x) for x in parts], out=ends[1:])
    values = np.concatenate(parts) if parts else few_none
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def lists(column: pa.Array) -> list[np.ndarray]:
    """The reverse of ``list_column``; unsigned, so that order and sorting agree."""
    values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.zeros(len(column) + 1, np.int64)
    np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), out=ends[1:])
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
