"""Importance resampling of documents towards a target distribution of hashed n-grams.

A document's features are its runs of one to three words, hashed to ``BUCKETS``. Counts per
bucket over all documents and over all target texts are two arrays of that length; a
bucket's gain is the logarithm of the ratio of its shares, and a document's weight the sum
of its features' gains, looked up in the array. Weights with Gumbel noise, seeded by the id,
give a draw without replacement when the highest are taken.

The cut is found by a distributed quickselect. Every row has a composite key (score
descending, id, row number) that no other row has. Random pivot keys part the rows that may
hold the k-th key three ways each, into smaller, equal and larger ones; exact counts say
between which pivots it lies, and the others are left behind. Only the rows up to the k-th
key are sorted and ranked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.operators.scale import running_total
from wayside.session import materialize

BUCKETS = 10_000
#: Longest run of words that is a feature.
RUN = 3
#: Documents with fewer words are not drawn; of the others so many in a hundred are.
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Pivot keys in a round of the selection.
PIVOTS = 32
#: Bytes of a text whose words are hashed at once.
PIECE = 1 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BLANK = re.compile(rb"[^0-9a-z\x80-\xff]")


def _word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a lower-cased text, cut between words."""
    at = 0
    while at < len(text):
        gap = _BLANK.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        yield _WORD.findall(text, at, end)
        at = end


def feature_buckets(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them), piece by piece.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A CRC goes
    on from the CRC of the words before, so a run's is made from that of the shorter run.
    """
    before: list[list[int]] = [[]] * (RUN - 1)  # of the runs of 1, 2 .. words that end before
    for words in _word_pieces(text.lower()):
        if not words:
            continue
        joined = [b" " + w for w in words]
        crc = list(map(crc32, words))
        found = list(crc)
        first = 0  # the word of the piece that the first CRC in ``crc`` ends in
        for k in range(RUN - 1):
            shorter = before[k] + crc
            first = first + 1 - len(before[k])
            before[k] = shorter[-1:]
            crc = list(map(crc32, joined[first:], shorter))
            found += crc
        yield len(words), np.array(found, np.int64) % BUCKETS


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts each bucket holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for _, found in feature_buckets(text.as_py() or b""):
                    total += np.bincount(found, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], names=["bucket", "n"]
        )

    counted = _bytes(texts, text_col).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in counted.collect():  # at most BUCKETS rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the ratio of smoothed shares, rounded down."""
    s, t = source.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _bytes(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    return docs.select(*more, F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))


def _noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variable from the hash of seed and id, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(1 << 32))))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column("text")):
                for n, found in feature_buckets(text.as_py() or b""):
                    out[:, i] += n, len(found), gain[found].sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, out)], names=["doc_id", "n_words", "n_features", "weight"]
            )

    rows = _bytes(docs, text_col, F.col(f"`{id_col}`").alias("doc_id"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, n_words long, n_features long, weight long")


KEY = ("below", "doc_id", "row")


def _key(df: DataFrame, values: tuple | None = None) -> Column:
    """The composite key of a row, or the one with these values. Null ids are the smallest."""
    if values is None:
        return F.struct(*KEY)
    types = [df.schema[c].dataType for c in KEY]
    return F.struct(*[F.lit(v).cast(t).alias(c) for c, t, v in zip(KEY, types, values, strict=True)])


def select_kth(keys: DataFrame, k: int) -> tuple:
    """The k-th smallest key (from 1) of a table of distinct keys with at least k rows."""
    active, before, turn = keys, 0, 0
    while True:
        # random rows: those whose number has the smallest hash of this turn
        drawn = active.orderBy(F.xxhash64("row", F.lit(turn)), "row").limit(PIVOTS).select(_key(keys).alias("key"))
        order = F.array_sort(F.collect_list("key"))
        pivots = [tuple(p) for p in drawn.agg(order.alias("keys")).first()["keys"]]
        held = F.array(*[_key(keys, p) for p in pivots])
        # an even number for each gap between pivots, an odd one for each pivot
        less = F.size(F.filter(held, lambda p: p < _key(keys)))
        slot = (2 * less + F.array_contains(held, _key(keys)).cast("int")).alias("slot")
        counts = dict(active.select(slot).groupBy("slot").count().collect())  # at most 2 * PIVOTS + 1 rows
        for slot in range(2 * len(pivots) + 1):
            n = counts.get(slot, 0)
            if before + n >= k:
                break
            before += n
        at = slot // 2
        if slot % 2:
            return pivots[at]
        if at:
            active = active.where((F.col("below") >= pivots[at - 1][0]) & (_key(keys) > _key(keys, pivots[at - 1])))
        if at < len(pivots):
            active = active.where((F.col("below") <= pivots[at][0]) & (_key(keys) < _key(keys, pivots[at])))
        active = materialize(active)
        turn += 1


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; rank from 1 for the drawn, else null.

    Of the rows with at least ``least_words`` words, floor(percent * rows / 100) are drawn:
    the highest scores, ties to smaller ids, then in a fixed order of the rows. A null,
    empty or wordless text has no features, weight 0, and is not drawn; so it is everywhere
    if both tables are empty. Rows without an id are drawn as those of an empty id, and
    first among ties. Repeated rows count each; other columns are ignored.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    rows = weigh(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))
    rows = rows.withColumns({"row": F.monotonically_increasing_id(), "below": -F.col("score")})
    scored = materialize(rows)  # fixes the row numbers
    may = F.col("n_words") >= least_words
    k = percent * scored.where(may).count() // 100
    names = [F.col("doc_id").alias(id_col), "n_features", "weight", "score"]
    if not k:
        return scored.select(*names, F.lit(None).cast("long").alias("rank"))
    keys = scored.where(may).select(*KEY)
    last = select_kth(keys, k)
    wins = may & (_key(keys) <= _key(keys, last))
    drawn = running_total(scored.where(wins).withColumn("one", F.lit(1).cast("long")), KEY, "one", "rank")
    rest = scored.where(~wins).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*names, "rank").union(rest.select(*names, "rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` with a drawn id, with all columns."""
    ids = resample(docs, target, id_col, **how).where(F.col("rank").isNotNull())
    ids = ids.select(F.col(f"`{id_col}`").alias("__drawn")).distinct()
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*names.values())
    kept = rows.join(ids, F.col(names[id_col]).eqNullSafe(F.col("__drawn")), "left_semi")
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
