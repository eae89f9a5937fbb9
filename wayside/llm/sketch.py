"""Count-min sketches whose counters stop at two, built by all partitions and merged.

Every cell keeps two bits: seen once, seen twice or more. Merging two sketches adds
their cells, stopping at two. A key seen twice anywhere is always found; a key seen
once may be found too, when its cell in every row is shared. The merged sketch holds
``depth * 2**bits`` cells, whatever the input; ``bits_for`` bounds it, so it can be
broadcast. A sketch that is too small for its input only finds more keys than needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from wayside.llm.spans import mix

#: Cells of one piece of a sketch, the unit of merging.
PIECE_BITS = 20
#: Keys gathered before they are packed.
HELD = 3_000_000
#: Bounds on the cells of a row: 2**28 cells are 32 MB when broadcast.
MIN_BITS, MAX_BITS = 20, 28

_SCHEMA = "piece int, once binary, twice binary"
_CODEC = "zstd"


def bits_for(keys: float, max_bits: int = MAX_BITS) -> int:
    """Bits of a row with at least as many cells as keys, within the bounds."""
    return int(min(max_bits, max(MIN_BITS, np.ceil(np.log2(max(keys, 1))))))


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(keys + np.uint64(0xA0761D6478BD642F * (row + 1) % (1 << 64))) >> np.uint64(64 - bits)


def _pack(flags: np.ndarray) -> bytes:
    return pa.compress(np.packbits(flags, bitorder="little"), codec=_CODEC, asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    size = (1 << PIECE_BITS) // 8
    return np.frombuffer(pa.decompress(data, size, codec=_CODEC, asbytes=True), np.uint8)


def _pieces(keys: np.ndarray, bits: int, depth: int) -> pa.RecordBatch:
    rows: list[tuple[int, bytes, bytes]] = []
    per_row = 1 << (bits - PIECE_BITS)
    for row in range(depth):
        found = cells(keys, row, bits).astype(np.uint32)
        found.sort()
        again = found[1:][found[1:] == found[:-1]]
        edges = np.arange(per_row + 1, dtype=np.uint64) << np.uint64(PIECE_BITS)
        cuts, cuts2 = np.searchsorted(found, edges), np.searchsorted(again, edges)
        for piece in np.flatnonzero(np.diff(cuts)):
            flags = np.zeros((2, 1 << PIECE_BITS), bool)
            for k, (values, at) in enumerate(((found, cuts), (again, cuts2))):
                flags[k, values[at[piece] : at[piece + 1]] & np.uint32((1 << PIECE_BITS) - 1)] = True
            rows.append((row * per_row + int(piece), _pack(flags[0]), _pack(flags[1])))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([r[1] for r in rows], pa.binary()),
            pa.array([r[2] for r in rows], pa.binary()),
        ],
        names=["piece", "once", "twice"],
    )


def repeated(
    df: DataFrame,
    keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
    bits: int,
    depth: int,
) -> Broadcast:
    """The merged sketch of all keys, as packed bits of the cells seen twice or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                n += len(keys)
                if n >= HELD:
                    yield _pieces(np.concatenate(held), bits, depth)
                    held, n = [], 0
        if n:
            yield _pieces(np.concatenate(held), bits, depth)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for piece, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                one, two = _unpack(once), _unpack(twice)
                if piece in sums:
                    one0, two0 = sums[piece]
                    one, two = one | one0, two | two0 | (one & one0)
                sums[piece] = (one, two)
        for piece, (_, two) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece], pa.int32()), pa.array([pa.compress(two, codec=_CODEC, asbytes=True)], pa.binary())],
                names=["piece", "twice"],
            )

    merged = (
        df.mapInArrow(count, _SCHEMA)
        .repartition("piece")
        .mapInArrow(merge, "piece int, twice binary")
    )
    out = np.zeros((depth << bits) // 8, np.uint8)
    size = (1 << PIECE_BITS) // 8
    for piece, twice in merged.collect():  # at most depth * 2**bits bits
        out[piece * size : (piece + 1) * size] = _unpack(bytes(twice))
    return df.sparkSession.sparkContext.broadcast(out.tobytes())


def seen_twice(sketch: bytes, keys: np.ndarray, bits: int, depth: int) -> np.ndarray:
    """Whether each key may occur twice or more; never false for one that does."""
    flags = np.frombuffer(sketch, np.uint8)
    out = np.ones(len(keys), bool)
    for row in range(depth):
        at = cells(keys, row, bits) + np.uint64(row << bits)
        out &= (flags[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def text_bytes(df: DataFrame, text: str) -> int:
    from pyspark.sql import functions as F

    return df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
