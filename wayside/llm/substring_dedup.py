"""Removal of repeated passages: count-min prefilter, then exact grouping.

A window is ``size`` consecutive words of one document; its key is the smallest hash
among the ``ANCHOR``-word spans inside it. Equal windows have equal keys, and
neighbouring windows mostly share one, so a document has few keys. The first pass
counts, in sketches of all partitions that are merged, the documents' keys: for each
window an overestimate of its occurrences. The second pass takes only windows whose
key is estimated to occur twice and groups them exactly, by 96 bits of hash of their
words; none that repeats is lost. (Of n unequal windows any two share 96 bits with a
chance of about n**2 / 2**97, 6e-8 for 1e11 windows.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm import sketch
from wayside.llm.spans import Words, slices, span_hashes, utf8, window_starts, word_hashes, words_of
from wayside.session import materialize

WINDOW = 50
ANCHOR = 25
DEPTH = 2


def _window_keys(values: np.ndarray, at: np.ndarray, size: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows, and their keys."""
    begin = window_starts(at, size)
    if not len(begin):
        return begin, np.zeros(0, np.uint64)
    spans = np.arange(len(values) - anchor + 1)
    low = span_hashes(values, spans, spans + anchor)
    # minimum over size - anchor + 1 neighbours, by doubling
    need, have = size - anchor + 1, 1
    while have < need:
        step = min(have, need - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return begin, low[begin]


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _texts(column: pa.Array) -> Iterator[list[bytes]]:
    data, off = utf8(column)
    raw = data.tobytes()
    for a, b in zip(off[:-1], off[1:], strict=True):
        yield raw[a:b].split()  # on exactly the six bytes that separate words


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_removed``, ``kept_sha256``, ``kept``.

    Removed is each word covered by a window whose words also start in a row with a
    smaller id, judged on the input. ``kept`` is the remaining words joined by single
    spaces, or null where nothing was removed (the input text then stands).

    A null text has no words. A null id neither removes nor loses anything; rows with
    the same id do not remove each other's words. Repeated rows stay, an empty table
    gives an empty one, other columns are ignored.
    """
    anchor = min(ANCHOR, size)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    bits = sketch.bits_for(sketch.text_bytes(rows, "text") / 8)

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        text = batch.column("text")
        for i, j in slices(text):
            words = words_of(text.slice(i, j - i))
            begin, keys = _window_keys(word_hashes(words), words.at, size, anchor)
            if len(keys):
                doc = np.searchsorted(words.at, begin, "right")
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
                yield keys[new]

    often = sketch.repeated(rows.select("text"), keys_of, bits, DEPTH)

    def estimated(words: Words, first: np.ndarray) -> np.ndarray:
        """Starts of the windows that may repeat."""
        begin, keys = _window_keys(first, words.at, size, anchor)
        return begin[sketch.seen_twice(often.value, keys, bits, DEPTH)]

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for i, j in slices(text):
                part = text.slice(i, j - i)
                words = words_of(part)
                begin = estimated(words, word_hashes(words))
                found = np.diff(np.searchsorted(begin, words.at)) > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(i, j - i),
                        batch.column("doc_id").slice(i, j - i),
                        pa.array(np.diff(words.at), pa.int64()),
                        pa.array([_digest(w) for w in _texts(part)], pa.string()),
                        part.take(pa.array(np.arange(j - i), mask=~found)),
                    ],
                    names=["row", "doc_id", "n_words", "sha", "text"],
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    # the text is kept only where a window may repeat
    seen = materialize(
        rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
            second_pass, f"row long, doc_id {id_type}, n_words long, sha string, text string"
        )
    )
    # a copy of a whole earlier document repeats all its windows; they need no grouping
    known = seen.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    whole = known.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    whole = whole.where(F.col("first") < F.col("last")).select("sha", "first")
    copies = materialize(
        known.select("row", "doc_id", "sha").join(whole, "sha").where(F.col("doc_id") > F.col("first")).select("row")
    )
    single = materialize(known.select("row", "doc_id", "text").join(copies, "row", "left_anti"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for i, j in slices(text):
                words = words_of(text.slice(i, j - i))
                first = word_hashes(words)
                begin = estimated(words, first)
                one = span_hashes(first, begin, begin + size)
                two = span_hashes(word_hashes(words, 1), begin, begin + size, 1) >> np.uint64(32)
                doc = np.searchsorted(words.at, begin, "right") - 1
                at = pa.array(doc + i)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.view(np.int64)),
                        pa.array(two.astype(np.uint32).view(np.int32)),
                        batch.column("doc_id").take(at),
                        batch.column("row").take(at),
                        pa.array(begin - words.at[doc], pa.int32()),
                    ],
                    names=["one", "two", "doc_id", "row", "pos"],
                )

    window = single.mapInArrow(spell, f"one long, two int, doc_id {id_type}, row long, pos int")
    # written, so that Spark can split the rows of a frequent window in the join
    first = materialize(
        window.groupBy("one", "two")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where(F.col("first") < F.col("last"))
        .select("one", "two", "first")
    )
    repeats = (
        window.join(first, ["one", "two"])
        .where(F.col("doc_id") > F.col("first"))
        .groupBy("row")
        .agg(F.collect_list("pos").alias("cut"))
    )

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, shas, kept = [], [], []
            texts = _texts(batch.column("text"))
            for words, cut in zip(texts, batch.column("cut"), strict=True):
                edges = np.zeros(len(words) + 1, np.int64)
                begin = cut.values.to_numpy()
                np.add.at(edges, begin, 1)
                np.add.at(edges, begin + size, -1)
                left = list(compress(words, np.cumsum(edges[:-1]) == 0))
                n.append(len(words) - len(left))
                shas.append(_digest(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(n, pa.int64()),
                    pa.array(shas, pa.string()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["row", "n", "sha2", "kept"],
            )

    stripped = (
        single.select("row", "text")
        .join(repeats, "row")
        .mapInArrow(strip, "row long, n long, sha2 string, kept string")
    )
    gone = copies.select("row", F.lit(True).alias("copy"))
    return (
        seen.select("row", "doc_id", "n_words", "sha")
        .join(stripped, "row", "left")
        .join(gone, "row", "left")
        .select(
            F.col("doc_id").alias(id_col),
            "n_words",
            F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_removed"),
            F.when(F.col("copy"), F.lit(_digest([]))).otherwise(F.coalesce("sha2", "sha")).alias("kept_sha256"),
            F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept")).alias("kept"),
        )
    )
