"""Components of documents whose word shingles are similar, by prefix filtering in bands.

The bands and partitions are those of PartEnum; its enumerated subsets are replaced by the
first contents in a common order. Components are exact; not every link within one is found.

Two sets with a Jaccard similarity of 3/4 or more differ in at most (|a| + |b|) / 7
elements. Sets are sorted into size bands; every set signs in its own band and in the
later ones that a similar larger set may fall in, so each pair meets in the band of its
larger set. A band whose sets differ in at most k elements cuts the hash domain into
n = 2.5 (k + 1) partitions. Similar sets then agree on at least n - k of them, so in any
common order of the partitions' contents they share one of the first k + 1 subsets: the
signatures. The order is: contents that a sketch of all contents shows to be single, which
no other set can share and which are therefore not sent on; then the rest, fullest first,
which leaves out the empty ones. A set that agrees with others in few partitions only (a
common line, a distant variant) so has few signatures or none, and a frequent content is
a signature only where rarer ones do not suffice. In the bands of small sets
a partition is a single shingle. A similar pair always shares a signature.

Before signing, a count-min sketch of all shingles drops every document of which fewer
than 3/4 of the shingles are estimated to occur twice: it can have no link. Documents
with equal sets are one class. The members of a signature are compared with its pivot,
and all documents with a pivot in common form a group. Of a group only members that are
still in different components are compared with each other, by bitmaps within bounded
tasks that let out the pairs which may be similar; whole sets decide those.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm import sketch
from wayside.llm.components import components
from wayside.llm.decontaminate import without
from wayside.llm.spans import mix, shingle_sets
from wayside.session import materialize

#: Similarity as a fraction: 100 * intersection >= 75 * union. Similar sets of n and m
#: elements then differ in at most (n + m) / (NUM + DEN).
NUM, DEN = 3, 4
#: Largest set of the bands in which every shingle is a partition of its own.
SINGLE = 64
#: Rows of the sketches of contents; they are made of all sets and of these shares.
SIGN_DEPTH = 2
SAMPLES = (1, 64)
#: Documents of a group that are compared in a task with as many others, at most.
BLOCK = 4096


@cache
def _bands(largest: int) -> list[tuple[int, int]]:
    """(smallest, largest) set size of each band, up to the one that holds ``largest``."""
    out, low = [], 1
    while not out or out[-1][1] < largest:
        high = max(low, low * 4 // 3)
        out.append((low, high))
        low = high + 1
    return out


def _contents(items: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each band of a set (ascending distinct hashes): its partitions' contents, how
    many shingles each holds, and of how many the first are signatures."""
    m = len(items)
    # the last band that may hold a similar larger set, which has m * 4 / 3 shingles at most
    for low, high in _bands(m * DEN // NUM + 1):
        if high < m or low * NUM > m * DEN:
            continue
        salt = np.uint64(high * 0xD6E8FEB86659FD93 % (1 << 64))
        if high <= SINGLE:
            # at least 3/4 of m are common, so one of the first m - ceil(3 m / 4) + 1 is
            yield mix(items + salt), np.ones(m, np.int64), m - -(-NUM * m // DEN) + 1
            continue
        k = 2 * high // 7
        n = 5 * (k + 1) // 2
        part = ((items >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        held = np.bincount(part.astype(np.int64), minlength=n)
        sums = np.zeros(m + 1, np.uint64)
        np.cumsum(mix(items + salt), dtype=np.uint64, out=sums[1:])
        ends = np.cumsum(held)
        content = sums[ends] - sums[ends - held]
        yield mix(content + mix(np.arange(n, dtype=np.uint64) * salt + np.uint64(n))), held, k + 1


def signatures(items: np.ndarray, level=lambda c: np.ones(len(c), np.int64)) -> np.ndarray:
    """Signatures of a set; contents of level 0 are known to be no other set's."""
    out = [np.zeros(0, np.uint64)]
    for content, held, first in _contents(items):
        levels = level(content)
        order = np.lexsort((content, -held, levels))[:first]
        out.append(content[order][levels[order] > 0])
    return np.concatenate(out)


def _sets(df: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key, items) of every row; items only where a link is possible."""
    bits = sketch.bits_for(sketch.text_bytes(df, "text") / 4)

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield from shingle_sets(batch.column("text"))

    often = sketch.repeated(df.select("text"), keys_of, bits, 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, held = [], [], [], []
            for items in shingle_sets(batch.column("text")):
                twice = sketch.seen_twice(often.value, items, bits, 1).sum() if len(items) else 0
                near = len(items) > 0 and DEN * twice >= NUM * len(items)
                n.append(len(items))
                one.append(int(mix(items).sum(dtype=np.uint64).view(np.int64)) if near else None)
                two.append(int(mix(items ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64).view(np.int64)) if near else None)
                held.append(items.tobytes() if near else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()),
                    pa.array(held, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "one", "two", "items"],
            )

    return materialize(
        df.select("doc_id", "text").mapInArrow(
            rows, "doc_id long, n_shingles long, one long, two long, items binary"
        )
    )


def _items(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for items in batch.column("items"):
        yield np.frombuffer(items.as_buffer(), np.uint64)


def _signed(sets: DataFrame) -> DataFrame:
    """(sign, doc): the signatures that may be shared, rare ones before frequent ones.

    A content's level is 0 if the sketch of all contents shows it to be single, else 1,
    and one more for each sample of the sets in whose sketch it still occurs twice. Any
    order of contents is right; this one leaves frequent contents to sets that lack rarer.
    """
    total = sets.agg(F.coalesce(F.sum(F.octet_length("items")), F.lit(0))).first()[0]

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for items in _items(batch):
            yield np.concatenate([content for content, _, _ in _contents(items)])

    held = []
    for share in SAMPLES:
        bits = sketch.bits_for(total / 2 / share)
        some = sets.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
        held.append((sketch.repeated(some.select("items"), keys_of, bits, SIGN_DEPTH), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def level(content: np.ndarray) -> np.ndarray:
            return sum(sketch.seen_twice(b.value, content, bits, SIGN_DEPTH).astype(np.int64) for b, bits in held)

        for batch in batches:
            signs = [signatures(items, level) for items in _items(batch)]
            flat = np.concatenate([np.zeros(0, np.uint64), *signs])
            docs = np.repeat(batch.column("doc_id").to_numpy(), [len(s) for s in signs])
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), pa.array(docs, pa.int64())], names=["sign", "doc"])

    return materialize(sets.mapInArrow(run, "sign long, doc long"))


def _groups(signed: DataFrame) -> DataFrame:
    """(a, doc): every document of a signature with the signature's pivot.

    The pivot is the member that has most company in its signatures, which is the centre of
    a group of variants. Two documents that share a signature share its pivot.
    """
    shared = signed.groupBy("sign").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    rows = materialize(signed.join(shared, "sign"))
    company = rows.groupBy("doc").agg(F.sum("n").alias("w"))
    weighed = rows.select("sign", "doc").join(company, "doc")
    pivot = weighed.groupBy("sign").agg(F.max_by("doc", F.struct("w", "doc")).alias("a"))
    return materialize(rows.select("sign", "doc").join(pivot, "sign").select("a", "doc").distinct())


def bitmap(items: np.ndarray) -> bytes:
    """A bit for the low end of each hash, among at least four times as many as there are."""
    size = 1 << max(6, (4 * len(items) - 1).bit_length())
    flags = np.zeros(size, np.uint8)
    flags[(items & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """Two sets differ in at least as many elements as their bitmaps in bits.

    The longer bitmap is folded to the length of the shorter, as if it had been made so.
    """
    if len(x) < len(y):
        x, y = y, x
    p, size = int.from_bytes(x, "little"), 8 * len(x)
    while size > 8 * len(y):
        size //= 2
        p = p >> size | p & ((1 << size) - 1)
    return (p ^ int.from_bytes(y, "little")).bit_count()


def _with_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(_items(batch))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int32()),
                batch.column("items"),
                pa.array([bitmap(s) for s in sets], pa.binary()),
            ],
            names=["doc_id", "n", "items", "bits"],
        )


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("n", "m", "x", "y"))
        keep = [
            NUM * max(n, m) <= DEN * min(n, m) and (NUM + DEN) * least_difference(x, y) <= n + m
            for n, m, x, y in zip(*columns, strict=True)
        ]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            common = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(DEN * common >= NUM * (len(p) + len(q) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar: bitmaps rule most others out, the sets decide."""

    def side(d: str, size: str, column: str, value: str) -> DataFrame:
        return sets.select(F.col("doc_id").alias(d), F.col("n").alias(size), F.col(value).alias(column))

    near = pairs.join(side("a", "n", "x", "bits"), "a").join(side("b", "m", "y", "bits"), "b")
    near = materialize(near.mapInArrow(_possible, "a long, b long"))
    whole = near.join(side("a", "n", "x", "items"), "a").join(side("b", "m", "y", "items"), "b")
    return materialize(whole.mapInArrow(_similar, "a long, b long"))


def _rest(groups: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of a group in different components that their bitmaps do not rule out.

    Bitmaps are compared within tasks of at most two blocks of documents; only the pairs
    that may be similar leave them.
    """
    named = groups.join(comps.withColumnRenamed("node", "doc"), "doc", "left")
    named = named.select("a", "doc", F.coalesce("component", "doc").alias("c"))
    mixed = named.groupBy("a").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count(F.lit(1)).alias("m"))
    mixed = mixed.where(F.col("low") < F.col("high")).select("a", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    bits = sets.select(F.col("doc_id").alias("doc"), "n", "bits")
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    rows = (
        named.join(mixed, "a")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("a", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc", "c")
        .join(bits, "doc")
    )
    return rows.groupBy("a", "i", "j").applyInArrow(_compare, "a long, b long").distinct()


def _words(bitmaps: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bitmaps), np.uint64).reshape(len(bitmaps), -1)


def _folded(words: np.ndarray) -> np.ndarray:
    """Bitmaps of half the length, which is at least a word."""
    half = words.shape[1] // 2
    return words[:, :half] | words[:, half:]


def _compare(table: pa.Table) -> pa.Table:
    cols = {c: table.column(c).to_numpy() for c in ("i", "j", "own", "doc", "c", "n")}
    bitmaps = table.column("bits").to_pylist()
    inside = cols["i"][0] == cols["j"][0]
    length = np.array([len(b) for b in bitmaps])
    ids, counts = np.unique(cols["c"], return_counts=True)
    largest = ids[counts.argmax()]
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def match(xs: np.ndarray, x_bits: np.ndarray, ys: np.ndarray, y_bits: np.ndarray) -> None:
        """Rows xs against rows ys, their bitmaps brought to one length."""
        n, c, own, place = cols["n"][ys], cols["c"][ys], cols["own"][ys], ys
        for k, x in enumerate(xs):
            m = cols["n"][x]
            near = (c != cols["c"][x]) & (NUM * np.maximum(n, m) <= DEN * np.minimum(n, m))
            if not inside:
                near &= own != cols["own"][x]
            # two rows outside the largest component are looked at from the first of them
            near &= (c == largest) | (place > x) | (length[ys] != length[x])
            at = np.flatnonzero(near)
            if len(at):
                apart = np.bitwise_count(y_bits[at] ^ x_bits[k]).sum(axis=1, dtype=np.int64)
                at = at[(NUM + DEN) * apart <= n[at] + m]
                found.append((np.full(len(at), cols["doc"][x]), cols["doc"][ys[at]]))

    rows = {int(size): np.flatnonzero(length == size) for size in np.unique(length)}
    bits = {size: _words([bitmaps[k] for k in at]) for size, at in rows.items()}
    for size, at in rows.items():
        outside = cols["c"][at] != largest
        match(at[outside], bits[size][outside], at, bits[size])
        if 2 * size in rows:
            longer, short = rows[2 * size], _folded(bits[2 * size])
            match(at[outside], bits[size][outside], longer, short)
            # and those outside of the longer ones against the inside of these
            far, main = cols["c"][longer] != largest, ~outside
            match(longer[far], short[far], at[main], bits[size][main])
    x, y = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    return pa.table({"a": pa.array(np.minimum(x, y), pa.int64()), "b": pa.array(np.maximum(x, y), pa.int64())})


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row: the smallest id reachable by links.

    Words are lower-cased (A-Z) runs of non-blank characters; a document's set is its
    distinct five-word shingles, or its whole word sequence if shorter. A null, empty or
    wordless text has an empty set and is linked with nothing. Rows with the same id are
    one document to the links: what reaches one reaches the other. A null id has a null
    component. Repeated rows stay, an empty table gives an empty one, other columns are
    ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    seen = _sets(rows)
    near = seen.where(F.col("items").isNotNull() & F.col("doc_id").isNotNull())
    classes = near.groupBy("one", "two").agg(F.min("doc_id").alias("rep"))
    member = materialize(
        near.select("doc_id", "one", "two").join(classes, ["one", "two"]).select("doc_id", "rep")
    )
    # one row for each set; an id that occurs with several sets may stand for several
    sets = materialize(
        near.join(classes.withColumnRenamed("rep", "doc_id"), ["one", "two", "doc_id"])
        .select("doc_id", "items", "one", "two")
        .dropDuplicates(["doc_id", "one", "two"])
        .mapInArrow(_with_bitmaps, "doc_id long, n int, items binary, bits binary")
    )
    groups = _groups(_signed(sets))
    found = member.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a != b").distinct()
    star = groups.where("a != doc").select(F.least("a", "doc").alias("a"), F.greatest("a", "doc").alias("b")).distinct()
    found = materialize(found.union(_links(star, sets)))
    comps = components(found)
    more = _links(_rest(groups, comps, sets), sets)
    if not more.isEmpty():
        comps = components(found.union(more))
    return seen.join(comps, F.col("doc_id") == F.col("node"), "left").select(
        F.col("doc_id").alias(id_col), "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with all columns.

    Rows with a null id stay, and so do repeated rows of an id that stays.
    """
    gone = (
        link_documents(docs, id_col, text_col)
        .where(F.col("component_id") < F.col(f"`{id_col}`"))
        .select(F.col(f"`{id_col}`").alias("__gone"))
        .distinct()
    )
    return without(docs, id_col, gone)
