"""Words of UTF-8 texts as arrays: the vectorised base of the corpus operators.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. All functions work on the buffers of an Arrow column, never text by text; a
batch is cut into slices of bounded bytes first. NULL texts have no bytes and no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once, unless one text alone has more.
SLICE_BYTES = 2 << 20
#: Bytes whose prefix hashes exist at once.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit over all output bits."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``p`` with ``(p[j] - p[i]) * inverse[i]`` as the hash of ``data[i:j]``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * powers(len(data))[0], out=out[1:])
    return out


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, which are in ascending order; equal bytes, equal hash."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
        p = prefix_hashes(data[base : int(ends[stop - 1])])
        s, e = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = mix64((p[e] - p[s]) * powers(len(p))[1][s] + (e - s).astype(np.uint64))
        at = stop
    return out


@dataclass
class Texts:
    """The texts of one slice: their bytes one after the other and where each begins."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def lowered(self) -> Texts:
        return Texts(_LOWER[self.data], self.offsets)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


@dataclass
class Words:
    """Byte ranges of the words of a slice and the index of the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a string or binary column without a copy."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Every batch cut so that a slice has at most ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        texts = texts_of(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < len(texts):
            end = int(np.searchsorted(texts.offsets, texts.offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), len(texts))
            lo, hi = texts.offsets[at], texts.offsets[end]
            yield batch.slice(at, end - at), Texts(texts.data[lo:hi], texts.offsets[at : end + 1] - lo)
            at = end


def words_of(texts: Texts) -> Words:
    """All words; none crosses from one text into the next."""
    n = len(texts.data)
    word = ~_SPACE[texts.data]
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:n]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:n]
    starts = np.flatnonzero(begin)
    return Words(starts, np.flatnonzero(end) + 1, np.searchsorted(starts, texts.offsets))


def word_hashes(texts: Texts, words: Words) -> np.ndarray:
    return range_hashes(texts.data, words.starts, words.ends)


def sequence_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all ``k`` consecutive values; window ``i`` starts at value ``i``."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _SHINGLE_BASE
        out += hashes[j : j + n]
    return mix64(out)


def windows_within(words: Words, k: int) -> np.ndarray:
    """Which of the windows of ``k`` words lie in one text."""
    n = int(words.first[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    doc = words.doc
    return doc[:n] == doc[k - 1 : k - 1 + n]


def unique_per_doc(doc: np.ndarray, values: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, ascending, and the index at which each text's values begin."""
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    doc, values = doc[keep], values[keep]
    return values, np.searchsorted(doc, np.arange(n_docs + 1))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i+1]]`` for every ``i``; 0 where that is empty."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def column(values, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)
