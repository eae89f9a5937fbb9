"""Near copies by SimHash: fingerprints of 64 bits, linked if they differ in at most two.

Pigeonhole blocks: a fingerprint is cut into four blocks of 16 bits, and of two that differ
in at most two bits two blocks are equal. Each different fingerprint is put under its six
pairs of blocks; those that share a pair are joined and their Hamming distance is verified.

Where more than ``CROWD`` fingerprints share a pair of blocks (variants of one text), comparing
all of them would grow with the square of their number. Their blocks are split further, down
to single bits: a fingerprint is put under itself and the 64 that differ from it in one bit.
Two that differ in at most two bits share one of these, all that share one differ in at most
two, and no more than 65 can share it. Both ways find every link between what they are given,
or (beyond a crowd) enough links to join the same fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.llm.components import components
from wayside.session import materialize

SHINGLE = 3
#: Seed of XXH64.
SEED = 42
#: Bits in which linked fingerprints may differ; ``BLOCKS`` must be more by two.
BITS = 2
BLOCKS = 4
WIDTH = 64 // BLOCKS
#: Fingerprints under one pair of blocks that are compared with each other.
CROWD = 32
#: Shingles hashed at once.
PIECE = 1 << 16


def fingerprint(text: bytes) -> int:
    """Each bit is 1 if it is set in over half of the hashes of the text's shingles.

    Words are lower-cased (A-Z) runs of non-blank bytes, shingles three words joined by a
    blank, repeats included; fewer words are one shingle, and without words all bits are 0.
    """
    words = text.lower().split()  # of bytes: A-Z, and 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(len(words) - SHINGLE + 1, 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    ends = (ends[-n:] - 1).tolist()
    h = xxhash.xxh64_intdigest
    held = np.zeros(64, np.int64)
    for i in range(0, n, PIECE):
        spans = zip(starts[i : i + PIECE], ends[i : i + PIECE], strict=True)
        hashes = np.array([h(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        held += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * held > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp holds the fingerprint's 64 bits. A null text has no words."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = np.array([fingerprint(t.as_py() or b"") for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64), pa.int64())], names=["doc_id", "fp"]
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _blocks(fp: Column) -> list[Column]:
    """One key for each choice of blocks that must be equal."""
    part = [F.shiftrightunsigned(fp, i * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1)) for i in range(BLOCKS)]
    keys = []
    for k, chosen in enumerate(combinations(part, BLOCKS - BITS)):
        key = F.lit(k).cast("long")
        for p in chosen:
            key = F.shiftleft(key, WIDTH).bitwiseOR(p)
        keys.append(key)
    return keys


def _near(x: str, y: str) -> Column:
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= BITS


def links(fps: DataFrame) -> DataFrame:
    """(x, y), x < y: links between the distinct ``fp``, which connect all that links connect."""
    blocks = fps.select("fp", F.explode(F.array(*_blocks(F.col("fp")))).alias("block"))
    # written before the join, so that AQE can split a block that many share
    held = materialize(blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = materialize(blocks.join(held, "block"))

    few = shared.where(F.col("n") <= CROWD)
    one = few.select("block", F.col("fp").alias("x"))
    two = few.select("block", F.col("fp").alias("y"))
    pairs = one.join(two, "block").where((F.col("x") < F.col("y")) & _near("x", "y")).select("x", "y")

    bits = F.expr("transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))")
    around = F.concat(F.array("fp"), bits)
    crowd = shared.where(F.col("n") > CROWD).select("fp").distinct()
    centres = crowd.select("fp", F.explode(around).alias("centre"))
    # at most 65 fingerprints have a centre in common
    balls = centres.groupBy("centre").agg(F.collect_list("fp").alias("held")).where(F.size("held") > 1)
    stars = balls.select(F.array_min("held").alias("x"), F.explode("held").alias("y"))
    return pairs.union(stars.where((F.col("x") < F.col("y")) & _near("x", "y"))).distinct()


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    fingerprint is 16 lowercase hex digits; component_id is the smallest id among the rows
    reachable by links of fingerprints that differ in at most two bits, the row included.
    Null, empty and blank texts have the fingerprint zero and are linked like others. Rows
    are documents: an id that occurs with several fingerprints has a component for each.
    Rows without an id link nothing; theirs is the component of their fingerprint, or null
    if no row with an id has it. Repeated rows stay, an empty table gives an empty one,
    other columns are ignored.
    """
    seen = materialize(fingerprints(docs, id_col, text_col))
    # all copies of a fingerprint are one node, by the smallest id that has it
    nodes = materialize(seen.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = links(nodes.select("fp"))
    for side in ("x", "y"):
        rep = nodes.select(F.col("fp").alias(side), F.col("rep").alias(f"{side}_rep"))
        found = found.join(rep, side)
    comps = components(materialize(found.select("x_rep", "y_rep")), "x_rep", "y_rep", hubs=True)
    named = materialize(
        nodes.join(comps, F.col("rep") == F.col("node"), "left").select(
            F.col("fp").alias("__fp"), F.coalesce("component", "rep").alias("component_id")
        )
    )
    return seen.join(named, F.col("fp") == F.col("__fp"), "left").select(
        F.col("doc_id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
