"""Quality classifier from overlapping heuristics, without using any labels.

Labellers look at a text and vote good, bad, or abstain. How often each pattern of
votes occurs is counted over the whole corpus (there are at most 3**labellers patterns,
so they fit the driver, however many documents there are). Expectation-maximisation over
the patterns estimates each labeller's accuracy and the share of good documents, with
the true label hidden. The posterior of a document's pattern is its soft label; a linear
scorer over hashed words and shape features is trained on the soft labels of a bounded
sample of documents and scores all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.llm.hashed import BITS, byte_shares, sigmoid, word_features
from wayside.llm.spans import SPACE, slices, span_hashes, utf8, word_hashes, words_of

#: The scorer learns from at most so many documents, taken by a hash of their text.
TRAIN_DOCS = 4000
EPOCHS = 200
GOOD, BAD, ABSTAIN = 1, 0, 2

# Fixed values of the labellers: (bad from, good up to) for shares that speak against a text.
LIMITS = {
    "upper": (0.30, 0.10),  # upper-case letters among ASCII letters
    "signs": (0.12, 0.05),  # signs other than . , ; : ' " - among bytes that are not blank
    "shouts": (0.10, 0.02),  # words that end in an exclamation mark
    "runs": (0.20, 0.02),  # words equal to the one before
    "repeats": (0.30, 0.12),  # ten-word spans that occur before in the text
    "bars": (0.10, 0.02),  # words that are a single sign
    "digits": (0.20, 0.06),  # digits among bytes that are not blank
    "tagged": (0.15, 0.03),  # words that end in a sign other than . , ; : ' " - ! ? )
}
SHAPES = tuple(LIMITS)


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


_LOWER = _table("".join(map(chr, range(97, 123))))
_UPPER = _table("".join(map(chr, range(65, 91))))
_DIGIT = _table("0123456789")
_QUIET = _table(".,;:'\"-")
_ENDS = _table(".,;:'\"-!?)")
_SIGN = ~(_LOWER | _UPPER | _DIGIT | _QUIET | SPACE)
_SIGN[0x80:] = False
_ODD_END = _SIGN & ~_ENDS
_ANY_SIGN = ~(_LOWER | _UPPER | _DIGIT | SPACE)
_ANY_SIGN[0x80:] = False


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[at[1:]] - sums[at[:-1]]


def _repeats(hashes: np.ndarray, at: np.ndarray, size: int = 10) -> np.ndarray:
    """Per text the share of its spans of ``size`` words that stand in it before."""
    out = np.zeros(len(at) - 1)
    for d, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        n = b - a - size + 1
        if n > 0:
            begin = np.arange(n)
            spans = span_hashes(hashes[a:b], begin, begin + size)
            out[d] = 1 - len(np.unique(spans)) / n
    return out


def shapes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shares of LIMITS for every text, a row per text, and the number of its words."""
    words = words_of(column)
    hashes, at = word_hashes(words), words.at
    n = np.diff(at)
    blank, total = byte_shares(column, SPACE)
    upper, lower = (byte_shares(column, t)[0] for t in (_UPPER, _LOWER))
    last = words.data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    length = words.ends - words.starts
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[at[:-1][n > 0]] = False
    columns = {
        "upper": _share(upper, upper + lower),
        "signs": _share(byte_shares(column, _SIGN)[0], total - blank),
        "shouts": _share(_per_text(last == ord("!"), at), n),
        "runs": _share(_per_text(same, at), n),
        "repeats": _repeats(hashes, at),
        "bars": _share(_per_text((length == 1) & _ANY_SIGN[last], at), n),
        "digits": _share(byte_shares(column, _DIGIT)[0], total - blank),
        "tagged": _share(_per_text(_ODD_END[last], at), n),
    }
    return np.stack([columns[k] for k in SHAPES], axis=1), n


def votes(shape: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Pattern number of each text: its labellers' votes as digits to base three."""
    out = np.zeros(len(shape), np.int64)
    for j, name in enumerate(SHAPES):
        bad, good = LIMITS[name]
        vote = np.where(shape[:, j] >= bad, BAD, np.where(shape[:, j] <= good, GOOD, ABSTAIN))
        out = out * 3 + np.where(n_words == 0, ABSTAIN, vote)
    return out


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good for every pattern, and the labellers' accuracies (good, bad).

    Votes are independent given the hidden label; abstaining says nothing. The first guess
    is that a text is bad if any labeller says so. Each rate is taken with a small prior,
    so that none becomes certain.
    """
    digits = np.stack([patterns // 3 ** (len(SHAPES) - 1 - j) % 3 for j in range(len(SHAPES))], axis=1)
    good, bad = (digits == GOOD).astype(float), (digits == BAD).astype(float)
    q = np.where(bad.any(axis=1), 0.05, 0.95)
    weight = counts.astype(float)
    for _ in range(rounds):
        w1, w0 = weight * q, weight * (1 - q)
        prior = (w1.sum() + 1) / (weight.sum() + 2)
        # chance that a labeller that votes says good of a good text, and bad of a bad one
        right1 = ((w1[:, None] * good).sum(0) + 9) / ((w1[:, None] * (good + bad)).sum(0) + 10)
        right0 = ((w0[:, None] * bad).sum(0) + 1) / ((w0[:, None] * (good + bad)).sum(0) + 4)
        like1 = good @ np.log(right1) + bad @ np.log(1 - right1) + np.log(prior)
        like0 = good @ np.log(1 - right0) + bad @ np.log(right0) + np.log(1 - prior)
        q = sigmoid(like1 - like0)
    return q, np.stack([right1, right0], axis=1)


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    shape, n = shapes(column)
    words = words_of(column, lower=True)
    return word_features(words), words.at, np.sqrt(shape), n


def _train(index: list[np.ndarray], shape: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of hashed words (averaged over a text) and of shape, by full-batch descent."""
    sizes = np.array([len(i) for i in index], np.int64)
    flat = np.concatenate(index) if len(index) else np.zeros(0, np.int32)
    row = np.repeat(np.arange(len(index)), sizes)
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    used, flat = np.unique(flat, return_inverse=True)
    w, v = np.zeros(len(used)), np.zeros(shape.shape[1] + 1)
    x = np.concatenate([shape, np.ones((len(shape), 1))], axis=1)
    m = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(v), np.zeros_like(v)]
    for t in range(1, EPOCHS + 1):
        z = x @ v
        if len(flat):
            z = z + np.bincount(row, w[flat], len(index)) * scale
        err = (sigmoid(z) - target) / max(len(target), 1)
        gv = x.T @ err + 1e-5 * v
        gw = (np.bincount(flat, (err * scale)[row], len(used)) if len(flat) else 0) + 1e-4 * w
        for a, g, one, two, rate in ((w, gw, 0, 1, 0.003), (v, gv, 2, 3, 0.1)):
            m[one] = 0.9 * m[one] + 0.1 * g
            m[two] = 0.99 * m[two] + 0.01 * g * g
            a -= rate * (m[one] / (1 - 0.9**t)) / (np.sqrt(m[two] / (1 - 0.99**t)) + 1e-8)
    out = np.zeros(1 << BITS)
    out[used] = w
    return out, v


class QualityModel:
    """Accuracies of the labellers and the weights of the scorer."""

    def __init__(self, accuracies: np.ndarray, words: np.ndarray, shape: np.ndarray):
        self.accuracies, self.words, self.shape = accuracies, words.astype(np.float32), shape

    def score(self, column: pa.Array) -> np.ndarray:
        """Probability of good for every text, 0 to 1; a text without words has 0."""
        out = [np.zeros(0)]
        for i, j in slices(column):
            index, at, shape, n = _features(column.slice(i, j - i))
            sums = np.concatenate([[0.0], np.cumsum(self.words[index], dtype=np.float64)])
            z = (sums[at[1:]] - sums[at[:-1]]) / np.sqrt(np.maximum(n, 1))
            z += shape @ self.shape[:-1] + self.shape[-1]
            out.append(np.where(n == 0, 0.0, sigmoid(z)))
        return np.concatenate(out)


def fit(docs: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS) -> QualityModel:
    """Label model over all rows of ``docs``, scorer on a sample of ``train_docs`` at most."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for i, j in slices(text):
                found, n = np.unique(votes(*shapes(text.slice(i, j - i))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["pattern", "n"])

    text = docs.select(F.col(f"`{text_col}`").alias("text"))
    counted = text.mapInArrow(tally, "pattern long, n long").groupBy("pattern").agg(F.sum("n")).collect()
    found = sorted((int(p), int(n)) for p, n in counted)  # at most 3**8 rows
    patterns = np.array([p for p, _ in found], np.int64)
    q, accuracies = label_model(patterns, np.array([n for _, n in found], np.int64))

    total = sum(n for _, n in found)
    # the sample is a share by hash, then cut to the bound in the order of the hash
    share = min(1.0, 1.1 * train_docs / max(total, 1))
    order = F.xxhash64("text", F.lit(7))
    sample = (
        text.where(F.col("text").isNotNull())
        .where(F.pmod(order, F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
        .withColumn("order", order)
    )

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for i, j in slices(column):
                part = column.slice(i, j - i)
                shape, n = shapes(part)
                words = words_of(part, lower=True)
                index = word_features(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("order").slice(i, j - i),
                        pa.array(votes(shape, n)),
                        pa.ListArray.from_arrays(pa.array(words.at, pa.int32()), pa.array(index)),
                        pa.FixedSizeListArray.from_arrays(pa.array(np.sqrt(shape).ravel()), len(SHAPES)).cast(pa.list_(pa.float64())),
                    ],
                    names=["order", "pattern", "words", "shape"],
                )

    rows = (
        sample.mapInArrow(examples, "order long, pattern long, words array<int>, shape array<double>")
        .dropDuplicates(["order"])
        .orderBy("order")
        .limit(train_docs)
        .toArrow()
    )
    index = [np.asarray(w.values) for w in rows.column("words").combine_chunks()] if len(rows) else []
    shape = np.array(rows.column("shape").to_pylist()).reshape(-1, len(SHAPES))
    soft = dict(zip(patterns.tolist(), q.tolist(), strict=True))
    target = np.array([soft[p] for p in rows.column("pattern").to_pylist()])
    words, shape_weights = _train(index, shape, target)
    return QualityModel(accuracies, words, shape_weights)


def scorer(docs: DataFrame, model: QualityModel) -> Column:
    """Function of a text column that gives the score."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights of 4 bytes

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(held.value.score(text), pa.float64())

    return score


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, good) for every row; good is 1 if the score is 0.5 or more.

    A null or empty text, or one without words, scores 0. Equal texts score alike, so
    repeated rows do; other columns and the id are never looked at. An empty table gives
    an empty one.
    """
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("__text"))
    scored = rows.withColumn("score", scorer(docs, fit(docs, text_col))("__text"))
    return scored.select(F.col(f"`{id_col}`"), "score", (F.col("score") >= 0.5).cast("int").alias("good"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are good, with all their columns."""
    model = fit(docs, text_col)
    return docs.where(scorer(docs, model)(F.col(f"`{text_col}`")) >= 0.5)
