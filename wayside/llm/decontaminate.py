"""Test items inside documents: size-partitioned MinHash search, verified exactly.

Items are partitioned by the size of their shingle set. A set of at most u shingles is
contained to 3/4 only if at most u / 4 of its shingles are missing, so of its
u // 4 + 1 smallest hashes (its bottom-k MinHash sketch, k set by the partition) at
least one occurs in the document, however long that is: the search loses nothing.

Documents are read once. A bitmap of fixed size, broadcast, says which shingles may
belong to an item's sketch, and a second one which may belong to an item at all; only
documents with a sketch hit send on the shingles they may share. Joins with the items'
sketches and sets then find and count the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.spans import mix, shingle_sets
from wayside.session import materialize

NUM, DEN = 3, 4
#: Bits of the broadcast bitmaps: 4 MB each, whatever the number of items.
BITMAP_BITS = 25


def sketch_size(n: int) -> int:
    """Sketch length of the partition of sets with n shingles; partitions end at 2**i."""
    largest = 1 << max(0, (n - 1).bit_length())
    return min(n, (DEN - NUM) * largest // DEN + 1)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column("text")))
        sizes = [len(s) for s in sets]
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        key = [np.arange(n) < sketch_size(n) for n in sizes]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item_id").take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
                pa.array(flat.view(np.int64)),
                pa.array(np.repeat(sizes, sizes).astype(np.int64)),
                pa.array(np.concatenate(key) if key else np.zeros(0, bool)),
            ],
            names=["item_id", "h", "n_item", "in_sketch"],
        )


def _bit(h: np.ndarray, bits: int) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - bits)).astype(np.int64)


def _bitmap(shingles: DataFrame, bits: int) -> bytes:
    """Bitmap of fixed size of the hashes in ``h``, merged from those of the partitions."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << bits, bool)
        for batch in batches:
            flags[_bit(batch.column("h").to_numpy().view(np.uint64), bits)] = True
        packed = np.packbits(flags, bitorder="little")
        if packed.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([pa.compress(packed, codec="zstd", asbytes=True)], pa.binary())], names=["flags"]
            )

    out = np.zeros((1 << bits) // 8, np.uint8)
    for (flags,) in shingles.select("h").mapInArrow(local, "flags binary").toLocalIterator():
        out |= np.frombuffer(pa.decompress(bytes(flags), len(out), codec="zstd", asbytes=True), np.uint8)
    return out.tobytes()


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item, n_item, n_common): every item of which a document holds 3/4 or more.

    Counted are distinct five-word shingles of lower-cased (A-Z) words. A text of fewer
    words is one shingle, its whole sequence, which only the same short text equals. Null,
    empty and wordless texts hold nothing and are in nothing; null ids are left out. Equal
    items are found each under its own id; rows with the same id count as one text that
    has the shingles of all. Empty tables give an empty result, other columns are ignored.
    """
    doc_id = F.col(f"`{id_col}`").cast("long").alias("doc_id")
    rows = docs.select(doc_id, F.col(f"`{text_col}`").alias("text")).where(F.col("doc_id").isNotNull())
    tests = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    # rows with one id are one set; its size and sketch are taken after they are put together
    per_text = tests.where(F.col("item_id").isNotNull()).mapInArrow(
        _items, "item_id long, h long, n_item long, in_sketch boolean"
    )
    sizes = per_text.groupBy("item_id", "h").agg(F.max("n_item").alias("n1"), F.max("in_sketch").alias("in_sketch"))
    totals = sizes.groupBy("item_id").agg(F.count("h").alias("n_item"))
    parts = sizes.join(totals, "item_id")
    # an item put together from several rows is searched by all its shingles
    parts = materialize(
        parts.select("item_id", "h", "n_item", (F.col("in_sketch") | (F.col("n1") < F.col("n_item"))).alias("in_sketch"))
    )
    sc = docs.sparkSession.sparkContext
    bits = BITMAP_BITS
    keys = sc.broadcast(_bitmap(parts.where("in_sketch"), bits))
    every = sc.broadcast(_bitmap(parts, bits))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, any_of = (np.frombuffer(b.value, np.uint8) for b in (keys, every))

        def held(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
            return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0

        for batch in batches:
            ids, out = batch.column("doc_id").to_numpy(), []
            for i, found in zip(ids, shingle_sets(batch.column("text")), strict=True):
                at = _bit(found, bits)
                if held(key, at).any():
                    out.append((i, found[held(any_of, at)]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([i for i, _ in out], [len(h) for _, h in out]), pa.int64()),
                    pa.array(np.concatenate([h for _, h in out]).view(np.int64) if out else [], pa.int64()),
                ],
                names=["doc_id", "h"],
            )

    shared = materialize(rows.mapInArrow(hits, "doc_id long, h long").distinct())
    # candidates by sketch, then the exact count over each candidate's whole set
    pairs = shared.join(parts.where("in_sketch").select("item_id", "h"), "h").select("doc_id", "item_id").distinct()
    common = (
        shared.join(parts.select("item_id", "h", "n_item"), "h")
        .groupBy("doc_id", "item_id")
        .agg(F.count("h").alias("n_common"), F.first("n_item").alias("n_item"))
        .where(F.col("n_common") * DEN >= F.col("n_item") * NUM)
    )
    return common.join(pairs, ["doc_id", "item_id"], "left_semi").select(
        F.col("doc_id").alias(id_col), F.col("item_id").alias(item_col), "n_item", "n_common"
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; null ids stay."""
    found = contained_items(docs, items, id_col, text_col)
    gone = found.select(F.col(f"`{id_col}`").alias("__gone")).distinct()
    return without(docs, id_col, gone)


def without(docs: DataFrame, id_col: str, gone: DataFrame) -> DataFrame:
    """The rows whose id is not in the one column of ``gone``, whatever their columns are called."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*names.values())
    kept = rows.join(gone, F.col(names[id_col]) == F.col(gone.columns[0]), "left_anti")
    return kept.toDF(*docs.columns)
