"""Words, spans of words and their hashes, computed on whole Arrow columns with numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 these bytes occur
only as themselves, so byte positions are enough. A span hash is a polynomial over
the 64-bit values of its parts, taken from running sums, then mixed with the length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once; one longer text is handled whole.
SLICE_BYTES = 1 << 20
#: Words per shingle.
SHINGLE = 5

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class Words(NamedTuple):
    """Bytes of some texts, the spans of their words, and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    at: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@cache
def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[seed]))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if seed not in _POWERS or len(_POWERS[seed][0]) < n:
        size = max(n, SLICE_BYTES + 1024)
        both = []
        for base in (_BASES[seed], pow(_BASES[seed], -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        if size > 4 * SLICE_BYTES:  # not kept for one long text
            return both[0], both[1]
        _POWERS[seed] = (both[0], both[1])
    return _POWERS[seed]


def span_hashes(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0
) -> np.ndarray:
    """Hash of ``values[start:end]`` for every pair."""
    p, inverse = _powers(seed, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[: len(values)], dtype=np.uint64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(_BASES[seed]))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text, or of one row."""
    yield from cuts(utf8(column)[1], max_bytes)


def cuts(off: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows, given their offsets, that hold at most so much, or one row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, off = utf8(column)
    if lower:
        data = LOWER[data]
    space, n = SPACE[data], len(data)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first, last = edge[:n].copy(), edge[1:].copy()
    first[1:] |= space[:-1]
    last[:-1] |= space[1:]
    starts = np.flatnonzero(~space & first)
    ends = np.flatnonzero(~space & last) + 1
    return Words(data, starts, ends, np.searchsorted(starts, off))


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """64-bit hash of every word, in order; long input is taken in pieces."""
    values, starts, ends = _byte_values(seed), words.starts, words.ends
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        lo, hi = starts[i], ends[j - 1]
        part = values[words.data[lo:hi]]
        out[i:j] = span_hashes(part, starts[i:j] - lo, ends[i:j] - lo, seed)
        i = j
    return out


def window_starts(at: np.ndarray, size: int) -> np.ndarray:
    """Word positions at which ``size`` consecutive words of one text begin."""
    counts = np.diff(at)
    last = np.repeat(at[1:], counts)
    here = np.arange(at[0], at[-1])
    return here[here + size <= last]


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased word shingles of all texts and each text's offsets in them.

    A text of fewer words is one shingle, a text without words has none. Repeats stay.
    """
    words = words_of(column, lower=True)
    values, at = word_hashes(words), words.at
    counts = np.diff(at)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = window_starts(at, size)
    short = np.flatnonzero((counts > 0) & (counts < size))
    starts = np.concatenate([begin, at[:-1][short]])
    ends = np.concatenate([begin + size, at[1:][short]])
    order = np.argsort(starts, kind="stable")
    hashes = span_hashes(values, starts[order], ends[order])
    return hashes, np.concatenate([[0], np.cumsum(n)])


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, ascending."""
    for i, j in slices(column):
        hashes, at = shingles(column.slice(i, j - i), size)
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield np.unique(hashes[a:b])
