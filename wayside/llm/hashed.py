"""Hashed features of whole texts, computed on Arrow columns with numpy.

Features are words, stripped of ASCII punctuation at both ends, hashed to ``2**BITS``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from wayside.llm.spans import Words, utf8, word_hashes

BITS = 18

#: ASCII bytes that are neither letters nor digits.
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True


def stripped(words: Words) -> Words:
    """The words without ASCII punctuation at their ends; a word of nothing else stays."""
    starts, ends = words.starts.copy(), words.ends.copy()
    for _ in range(4):  # at most four signs on either side
        inside = ends - starts > 1
        starts += inside & _PUNCT[words.data[starts]]
        inside = ends - starts > 1
        ends -= inside & _PUNCT[words.data[ends - 1]]
    return words._replace(starts=starts, ends=ends)


def word_features(words: Words) -> np.ndarray:
    """A feature for each word."""
    return (word_hashes(stripped(words)) >> np.uint64(64 - BITS)).astype(np.int32)


def byte_shares(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of bytes flagged in ``table``, and the number of bytes."""
    data, off = utf8(column)
    sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
    return sums[off[1:]] - sums[off[:-1]], np.diff(off)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))
