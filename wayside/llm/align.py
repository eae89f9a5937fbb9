"""Alignment of two tokenizers: which ids of A and B cover the same bytes, over a corpus.

Both encode a text with a blank before it; where tokens of both end, the bytes are cut into
groups. Neither joins across a blank between two visible characters, so a text is cut there
into units, and each different unit is encoded and aligned once per worker. Links are the
pairs of overlapping tokens; between two neighbouring ends of any token lies just one.

Identity map: an array gives for each id of A the id of B with the same bytes. Links along it,
which is all there is in an exact one-to-one group, are counted in one vector of the length
of A's vocabulary. Only other pairs, from irregular groups, are shuffled. They are counted
per chunk of documents, added up by pair, and sent back to the chunks that hold them, so
that a pair is moved once for a chunk, not for each of its documents.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.spans import SLICE_BYTES, Words, slices, utf8, word_hashes
from wayside.llm.subwords import WordTable
from wayside.session import materialize

#: Text of a chunk of documents, whose pairs are looked up in one group; one longer text is one.
CHUNK_BYTES = 4 << 20
#: Units and tokens that a worker remembers before it starts anew.
MAX_UNITS = 250_000
MAX_TOKENS = 4_000_000

#: Bytes that a character which is not white space may begin with, and end with if ASCII.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_BEGINS = _VISIBLE.copy()
_BEGINS[0xC3:] = True
_BEGINS[[0xE1, 0xE2, 0xE3]] = False  # these and C2 begin all white space beyond ASCII
_BLANKS = ~_BEGINS & (np.arange(256) >= 0xC2)


def units_of(column: pa.Array) -> Words:
    """Spans of the units of all texts, each text with a blank before it.

    A unit begins at the first blank and at every blank between two characters that are
    certainly visible. Which others could be cut too does not matter.
    """
    raw, off = utf8(column)
    rows = len(off) - 1
    data = np.full(len(raw) + rows, 0x20, np.uint8)
    data[np.arange(len(raw)) + np.repeat(np.arange(1, rows + 1), np.diff(off))] = raw
    begin = off + np.arange(rows + 1)
    cut = np.zeros(len(data), bool)
    if len(data) > 2:
        before, after = data[:-2], data[2:]
        ends = _VISIBLE[before] | (before >= 0x80)
        ends[1:] &= (before[1:] < 0x80) | ~_BLANKS[before[:-1]]
        ends[2:] &= (before[2:] < 0x80) | ~_BLANKS[before[:-2]]
        cut[1:-1] = (data[1:-1] == 0x20) & ends & _BEGINS[after]
    cut[begin[:-1]] = True
    starts = np.flatnonzero(cut)
    return Words(data, starts, np.append(starts[1:], len(data)), np.searchsorted(starts, begin))


def _byte_level() -> dict[str, int]:
    """The byte of each character in a byte-level vocabulary: printable Latin-1 characters
    are themselves, the other bytes the characters from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def _ragged(values: np.ndarray, at: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all places in order, and how many each has."""
    length = at[places + 1] - at[places]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(at[places] - (ends - length), length) + np.arange(total)], length


class Joined:
    """Bytes of ids, to be put together for many ids at once."""

    def __init__(self, parts: list[bytes]):
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.length = np.array([len(p) for p in parts], np.int64)
        self.at = np.append(0, np.cumsum(self.length))

    def valid(self, ids: np.ndarray, n: np.ndarray, want: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ids, ``n`` for each unit, make up the unit's bytes; the units follow each other."""
        unit = np.repeat(np.arange(len(n)), n)
        fits = np.bincount(unit, self.length[ids], len(n)).astype(np.int64) == size
        kept = fits[unit]
        found, _ = _ragged(self.data, self.at, ids[kept])
        differs = found != want[np.repeat(fits, size)]
        fits[np.repeat(np.arange(len(n)), size * fits)[differs]] = False
        return fits


class Tokenizers:
    """Both tokenizers, the bytes of their ids, and the identity map."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = _byte_level()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(byte[c] for c in names[i]) if i in names else b"" for i in range(max(names) + 1)]
        ids = range(self.b.get_piece_size())
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)])
            if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids
        ]
        place = {self.bytes_b[i]: i for i in ids if self.b.is_byte(i)}
        place |= {self.bytes_b[i]: i for i in ids if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        self.joined_a, self.joined_b = Joined(self.bytes_a), Joined(self.bytes_b)
        #: For each id of A the id of B with the same bytes, or -1.
        self.same = np.array([place.get(x, -1) for x in self.bytes_a], np.int64)

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for texts that begin with a blank."""
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        return a, self.b.encode([u[1:] for u in units], num_threads=1)  # B adds the blank


@cache
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    length = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(length.sum())), length


class Aligned:
    """What is known of each unit a worker has met, by place."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.forget()

    def forget(self) -> None:
        self.table = WordTable()
        #: Valid, tokens of A and of B, groups, links; text of the groups.
        self.facts = np.zeros((5, 0), np.int64)
        self.text: list[bytes] = []
        #: Ids of A that are linked along the identity map, and other pairs of ids.
        self.same, self.same_at = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.pairs, self.pairs_at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def places(self, units: Words) -> np.ndarray:
        """The place of every unit; those not met before are aligned."""
        hashes = word_hashes(units)
        place = self.table.find(hashes)
        missed = np.flatnonzero(place < 0)
        if len(missed):
            keys, first = np.unique(hashes[missed], return_index=True)
            full = len(self.text) + len(keys) > MAX_UNITS or len(self.same) + len(self.pairs) > MAX_TOKENS
            if len(self.text) and full:
                self.forget()
                return self.places(units)
            at = missed[first]
            for k in range(0, len(at), 10_000):
                spans = zip(units.starts[at[k : k + 10_000]].tolist(), units.ends[at[k : k + 10_000]].tolist(), strict=True)
                self._learn([units.data[i:j].tobytes() for i, j in spans])
            self.table.add(keys)
            place[missed] = self.table.find(hashes[missed])
        return place

    def _learn(self, units: list[bytes]) -> None:
        both = self.both
        (a, n_a), (b, n_b) = map(_flat, both.encode([u.decode() for u in units]))
        size = np.fromiter(map(len, units), np.int64, len(units))
        data = np.frombuffer(b"".join(units), np.uint8)
        valid = both.joined_a.valid(a, n_a, data, size) & both.joined_b.valid(b, n_b, data, size)
        a, b = a[np.repeat(valid, n_a)], b[np.repeat(valid, n_b)]
        n_a, n_b = n_a * valid, n_b * valid
        # bytes at which tokens end, all units in one row
        end_a, end_b = np.cumsum(both.joined_a.length[a]), np.cumsum(both.joined_b.length[b])
        unit_end = np.cumsum(size * valid)
        both_end = np.intersect1d(end_a, end_b, assume_unique=True)
        any_end = np.union1d(end_a, end_b)
        n_groups = np.diff(np.searchsorted(both_end, unit_end, "right"), prepend=0)
        link_at = np.searchsorted(any_end, unit_end, "right")
        linked_a = a[np.searchsorted(end_a, any_end)]
        linked_b = b[np.searchsorted(end_b, any_end)]
        same = both.same[linked_a] == linked_b
        self._append("same", linked_a[same], np.diff(np.cumsum(np.append(0, same))[link_at], prepend=0))
        pairs = linked_a[~same] * len(both.bytes_b) + linked_b[~same]
        self._append("pairs", pairs, np.diff(np.cumsum(np.append(0, ~same))[link_at], prepend=0))
        n_links = np.diff(link_at, prepend=0)
        self.facts = np.concatenate([self.facts, [valid, n_a, n_b, n_groups, n_links]], axis=1)
        self.text += self._texts(a, b, end_a, end_b, both_end, n_a + n_b)

    def _append(self, name: str, values: np.ndarray, length: np.ndarray) -> None:
        setattr(self, name, np.concatenate([getattr(self, name), values]))
        at = getattr(self, f"{name}_at")
        setattr(self, f"{name}_at", np.concatenate([at, at[-1] + np.cumsum(length)]))

    @staticmethod
    def _texts(a, b, end_a, end_b, both_end, n) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` for each unit, whose groups follow each other."""
        group_a, group_b = np.searchsorted(both_end, end_a), np.searchsorted(both_end, end_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        last = np.concatenate([np.where(np.isin(end_a, both_end), "|", ","), np.where(np.isin(end_b, both_end), ";", ",")])
        words = list(map("".join, zip(map(str, np.concatenate([a, b])[order].tolist()), last[order].tolist(), strict=True)))
        stop = np.cumsum(n).tolist()
        return ["".join(words[i:j])[:-1].encode() for i, j in zip([0, *stop[:-1]], stop, strict=True)]


@cache
def aligned(path_a: str, path_b: str) -> Aligned:
    """One for each pair of files and worker."""
    return Aligned(tokenizers(path_a, path_b))


def _added_up(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's numbers."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n[order], first)


def _lists(doc: np.ndarray, value: np.ndarray, n: np.ndarray, rows: int) -> tuple[pa.Array, pa.Array]:
    """For each row its distinct values, and how often each occurs."""
    keys, n = _added_up(doc << 32 | value, n)
    at = pa.array(np.searchsorted(keys >> 32, np.arange(rows + 1)), pa.int32())
    value = pa.array((keys & 0xFFFFFFFF).astype(np.int32))
    return pa.ListArray.from_arrays(at, value), pa.ListArray.from_arrays(at, pa.array(n.astype(np.int32)))


def align_texts(column: pa.Array, known: Aligned) -> dict[str, pa.Array]:
    """Counts, digest, and linked ids with their numbers, for every text of a column."""
    units = units_of(column)
    place = known.places(units).astype(np.int64)
    rows, at = len(column), units.at
    doc = np.repeat(np.arange(rows), np.diff(at))
    raw, off = utf8(column)
    fine = (np.bincount(doc, known.facts[0][place] == 0, rows) == 0) & (np.diff(off) > 0)
    sums = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(known.facts[1:][:, place], axis=1)], axis=1)
    counts = (sums[:, at[1:]] - sums[:, at[:-1]]) * fine
    listed = place.tolist()
    digests = [
        hashlib.sha256(b";".join([known.text[p] for p in listed[i:j]])).hexdigest() if ok else ""
        for i, j, ok in zip(at[:-1].tolist(), at[1:].tolist(), fine.tolist(), strict=True)
    ]
    kept = fine[doc]
    keys, times = _added_up(doc[kept] << 32 | place[kept], np.ones(int(kept.sum()), np.int64))
    doc, place = keys >> 32, keys & 0xFFFFFFFF
    out = dict(zip(("n_a", "n_b", "n_groups", "n_links"), map(pa.array, counts), strict=True))
    out["groups_sha256"] = pa.array(digests, pa.string())
    for name, values, starts in (("same", known.same, known.same_at), ("pairs", known.pairs, known.pairs_at)):
        value, length = _ragged(values, starts, place)
        out[name], out[f"{name}_n"] = _lists(np.repeat(doc, length), value, np.repeat(times, length), rows)
    return out


_LINKED = "same array<int>, same_n array<int>, pairs array<int>, pairs_n array<int>"
_COUNTS = "n_a long, n_b long, n_groups long, n_links long"


def _aligned(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The rows with their chunk and what ``align_texts`` finds, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligned(path_a, path_b)
        chunk, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            text = batch.column("text")
            for i, j in slices(text, SLICE_BYTES):
                part = text.slice(i, j - i)
                size = int(utf8(part)[1][-1])
                if held and held + size > CHUNK_BYTES:
                    chunk, held = chunk + 1, 0
                held += size
                out = {"chunk": pa.array(np.full(j - i, chunk)), "doc_id": batch.column("doc_id").slice(i, j - i)}
                out |= align_texts(part, known)
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return materialize(rows.mapInArrow(run, f"chunk long, doc_id {id_type}, {_COUNTS}, groups_sha256 string, {_LINKED}"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, key, n): documents with each pair, by chunk; without a chunk, those with each id
    of A that is linked along the identity map."""
    vector = np.zeros(0, np.int64)
    for batch in batches:
        lists = batch.column("pairs")
        chunk = np.repeat(batch.column("chunk").to_numpy(), lists.value_lengths().to_numpy())
        key = lists.flatten().to_numpy()
        order = np.lexsort((key, chunk))
        chunk, key = chunk[order], key[order]
        first = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.append(first, len(key)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk[first], pa.int64()), pa.array(key[first], pa.int32()), pa.array(n, pa.int64())],
            names=["chunk", "key", "n"],
        )
        found = np.bincount(batch.column("same").flatten().to_numpy(), minlength=len(vector))
        found[: len(vector)] += vector
        vector = found
    held = np.flatnonzero(vector)
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(len(held), pa.int64()), pa.array(held, pa.int32()), pa.array(vector[held], pa.int64())],
        names=["chunk", "key", "n"],
    )


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A pair's count is the number of rows that hold it linked. n_best counts a row's links
    whose pair has the highest count of all with the same id of A, count_sum adds up the
    counts of all its links. groups_sha256 is the digest of ``a1,a2|b1;a3|b2,b3``. Null and
    empty texts, and those that either tokenizer does not give back byte for byte, have no
    tokens: zeros and an empty digest. Every row counts as a document, with or without an
    id; an empty table gives an empty one; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    both = tokenizers(path_a, path_b)
    size_a, size_b = len(both.bytes_a), len(both.bytes_b)
    if size_a * size_b >= 1 << 31:
        raise ValueError("a pair of ids must fit 31 bits")
    seen = _aligned(rows, path_a, path_b)
    counted = materialize(seen.select("chunk", "same", "pairs").mapInArrow(_count, "chunk long, key int, n long"))
    pairs = counted.where(F.col("chunk").isNotNull())
    totals = materialize(pairs.groupBy("key").agg(F.sum("n").alias("total")))
    # both have at most as many rows as A has ids
    alone = counted.where(F.col("chunk").isNull()).groupBy("key").agg(F.sum("n")).collect()
    highest = totals.groupBy((F.col("key") / size_b).cast("int").alias("a")).agg(F.max("total")).collect()
    vector, best = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    for a, n in alone:
        vector[a] = n
    for a, n in highest:
        best[a] = n
    best = np.maximum(best, vector)

    def look_up(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        # units that this worker remembers are not needed any more
        aligned.cache_clear()
        tokenizers.cache_clear()
        pair, first = np.unique(right.column("pair").to_numpy(), return_index=True)
        total = right.column("total").to_numpy()[first]
        n_best, count_sum = np.zeros(left.num_rows, np.int64), np.zeros(left.num_rows, np.int64)
        for name in ("same", "pairs"):
            lists = left.column(name).combine_chunks()
            values = lists.flatten().to_numpy()
            n = left.column(f"{name}_n").combine_chunks().flatten().to_numpy().astype(np.int64)
            a = values if name == "same" else values // size_b
            count = vector[a] if name == "same" else total[np.searchsorted(pair, values)]
            at = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
            for out, terms in ((n_best, n * (count == best[a])), (count_sum, n * count)):
                out += np.diff(np.append(0, np.cumsum(terms))[at])
        out = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        out = out.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum))
        return out.append_column("groups_sha256", left.column("groups_sha256"))

    back = pairs.join(totals, "key").select(F.col("chunk").alias("of"), F.col("key").alias("pair"), "total")
    found = seen.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(
        look_up, f"doc_id {id_type}, {_COUNTS}, n_best long, count_sum long, groups_sha256 string"
    )
    return found.withColumnRenamed("doc_id", id_col)
