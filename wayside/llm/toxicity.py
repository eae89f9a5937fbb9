"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's probability p comes from a logistic scorer over its distinct hashed
words and word beginnings; a document's is noisy-or, 1 - prod(1 - p) over its sentences. A
sentence without learnt features has p = 0, so length alone makes no text toxic. The scorer is
trained through the noisy-or from document labels alone, on a bounded sample of labelled
rows, and then finds the offending sentences of any text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.llm.hashed import BITS, sigmoid, stripped
from wayside.llm.spans import Words, slices, word_hashes, words_of

#: The scorer learns from at most so many labelled rows, taken in the order of a hash.
TRAIN_DOCS = 6000
EPOCHS = 150
#: Bytes of a word's beginning that are features of their own.
PREFIXES = (4, 5)
#: Features are learnt that stand in so many training documents and differ in frequency
#: between the classes by so many standard errors; the rest would only be memorised.
LEAST_DOCS = 4
LEAST_Z = 3.0
#: Sentences end after these, or at the end of the text.
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


def sentences(words: Words) -> np.ndarray:
    """Offsets of sentences among the words; every sentence lies in one text.

    A sentence ends with a word whose last byte is a full stop, ``!`` or ``?``, before a
    line break, and at the end of its text.
    """
    n = len(words.starts)
    if not n:
        return np.zeros(1, np.int64)
    ends = _STOP[words.data[words.ends - 1]]
    breaks = np.concatenate([[0], np.cumsum(words.data == 0x0A)])
    ends[:-1] |= breaks[words.starts[1:]] > breaks[words.ends[:-1]]
    ends[words.at[1:][np.diff(words.at) > 0] - 1] = True
    return np.concatenate([[0], np.flatnonzero(ends) + 1])


def _features(words: Words) -> list[np.ndarray]:
    """Features of every word: the word, and its first four and five bytes."""
    whole = stripped(words)
    cut = [whole._replace(ends=np.minimum(whole.ends, whole.starts + n)) for n in PREFIXES]
    return [(word_hashes(w) >> np.uint64(64 - BITS)).astype(np.int64) for w in (whole, *cut)]


def _distinct(words: Words, at: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentence and feature of all distinct pairs whose feature is flagged in ``known``."""
    sentence = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pairs = [(sentence[k] << BITS) | f[k] for f in _features(words) for k in [known[f]]]
    both = np.unique(np.concatenate(pairs))
    return both >> BITS, both & ((1 << BITS) - 1)


def _logit(sentence: np.ndarray, weight: np.ndarray, n: int, bias: float) -> np.ndarray:
    """Logit of every sentence; minus infinity for those without learnt features."""
    z = np.bincount(sentence, weight, n) + bias
    z[np.bincount(sentence, minlength=n) == 0] = -np.inf
    return z


def _noisy_or(log_rest: np.ndarray) -> np.ndarray:
    """1 - exp of the sum of log(1 - p) of a text's sentences."""
    return -np.expm1(np.minimum(log_rest, 0.0))


class ToxicityModel:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias
        self.known = self.weights != 0

    def _logits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        at = sentences(words)
        sentence, feature = _distinct(words, at, self.known)
        return _logit(sentence, self.weights[feature], len(at) - 1, self.bias), at

    def score(self, column: pa.Array) -> np.ndarray:
        """Probability of toxic for every text; a text without words has 0."""
        out = [np.zeros(0)]
        for i, j in slices(column):
            words = words_of(column.slice(i, j - i), lower=True)
            z, at = self._logits(words)
            rest = np.concatenate([[0.0], np.cumsum(-np.logaddexp(0.0, z))])
            edge = np.searchsorted(at, words.at)
            out.append(_noisy_or(rest[edge[1:]] - rest[edge[:-1]]))
        return np.clip(np.concatenate(out), 0.0, 1.0)

    def spans(self, text: str | None, least: float = 0.5) -> list[tuple[int, int, float]]:
        """(start, end, p) in UTF-8 bytes of the sentences with p of ``least`` or more."""
        words = words_of(pa.array([text], pa.string()), lower=True)
        z, at = self._logits(words)
        p = sigmoid(z)
        return [
            (int(words.starts[at[k]]), int(words.ends[at[k + 1] - 1]), float(p[k]))
            for k in np.flatnonzero(p >= least)
        ]


def _telling(feature: np.ndarray, doc: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Features that tell toxic training documents from others, ascending."""
    in_docs = np.zeros((2, 1 << BITS), np.int64)
    cuts = np.searchsorted(doc, np.arange(0, len(label) + 500, 500))  # 500 documents at once
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        pairs = np.unique(doc[lo:hi].astype(np.int64) << BITS | feature[lo:hi])
        toxic = label[pairs >> BITS] > 0
        for k in (0, 1):
            in_docs[k] += np.bincount(pairs[toxic == k] & ((1 << BITS) - 1), minlength=1 << BITS)
    b, a = in_docs
    n1, n0 = max((label > 0).sum(), 1), max((label == 0).sum(), 1)
    both = (a + b + 1) / (n1 + n0 + 2)
    z = np.abs(a / n1 - b / n0) / np.sqrt(both * (1 - both) * (1 / n1 + 1 / n0))
    return np.flatnonzero((a + b >= LEAST_DOCS) & (z >= LEAST_Z))


def _train(sentence_of: np.ndarray, feature: np.ndarray, doc_of: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Adam on the mean log loss of the noisy-or; ``sentence_of`` ascends, so does ``doc_of``."""
    used = _telling(feature, doc_of[sentence_of], label)
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    known = place[feature] >= 0
    sentence_of, feature = sentence_of[known], place[feature[known]]
    w, b = np.zeros(len(used)), -6.0
    n_docs, n_sent = len(label), len(doc_of)
    m1, m2, b1, b2 = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, EPOCHS + 1):
        z = _logit(sentence_of, w[feature], n_sent, b)
        rest = np.bincount(doc_of, -np.logaddexp(0.0, z), n_docs)
        p = np.clip(_noisy_or(rest), 1e-9, 1 - 1e-9)
        # derivative of the loss by log(1 - P) of the document, spread over its sentences
        by_doc = np.where(label > 0, -(1 - p) / p, 1.0) / n_docs
        err = sigmoid(z) * by_doc[doc_of]
        g = np.bincount(feature, err[sentence_of], len(used)) + 2e-5 * w
        gb = err.sum()
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        b1, b2 = 0.9 * b1 + 0.1 * gb, 0.99 * b2 + 0.01 * gb * gb
        fix1, fix2 = 1 - 0.9**t, 1 - 0.99**t
        w -= 0.1 * (m1 / fix1) / (np.sqrt(m2 / fix2) + 1e-6)
        b -= 0.02 * (b1 / fix1) / (np.sqrt(b2 / fix2) + 1e-8)
    out = np.zeros(1 << BITS)
    out[used] = w
    return out, b


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_docs: int = TRAIN_DOCS,
) -> ToxicityModel:
    """Model from at most ``train_docs`` labelled rows; labels other than 0 and 1 are left out."""
    key = F.xxhash64("doc_id", F.lit(5))
    known = (
        labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .withColumn("order", key)
        .orderBy("order", "doc_id")
        .limit(train_docs)
    )
    text = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for i, j in slices(column):
                words = words_of(column.slice(i, j - i), lower=True)
                at = sentences(words)
                sentence, feature = _distinct(words, at, np.ones(1 << BITS, bool))
                n = np.bincount(sentence, minlength=len(at) - 1)
                edge = np.searchsorted(at, words.at)
                total = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        batch.column("label").slice(i, j - i),
                        pa.ListArray.from_arrays(pa.array(total[edge], pa.int32()), pa.array(feature.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(n.astype(np.int32))),
                    ],
                    names=["doc_id", "label", "features", "sizes"],
                )

    id_type = text.schema["doc_id"].dataType.simpleString()
    # the known rows are bounded by train_docs, so their table is small enough to broadcast
    rows = (
        text.join(F.broadcast(known.select("doc_id", "label")), "doc_id")
        .select("doc_id", "label", "text")
        .mapInArrow(examples, f"doc_id {id_type}, label int, features array<int>, sizes array<int>")
        .toArrow()
        .sort_by("doc_id")
    )
    if not len(rows):
        return ToxicityModel(np.zeros(1 << BITS), -6.0)
    sizes = rows.column("sizes").combine_chunks()
    size = sizes.flatten().to_numpy()
    feature = rows.column("features").combine_chunks().flatten().to_numpy()
    doc_of = np.repeat(np.arange(len(rows), dtype=np.int32), pc.list_value_length(sizes).to_numpy())
    sentence_of = np.repeat(np.arange(len(size), dtype=np.int32), size)
    return ToxicityModel(*_train(sentence_of, feature, doc_of, rows.column("label").to_numpy()))


def scorer(docs: DataFrame, model: ToxicityModel) -> Column:
    """Function of a text column that gives the score."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights of 4 bytes

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(held.value.score(text), pa.float64())

    return score


def score_documents(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, predicted) for every row.

    Null and empty texts, and texts without words, score 0. Equal texts score alike;
    repeated rows stay, other columns and the id are never looked at, an empty table gives
    an empty one. Without labelled rows every score is near 0.
    """
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("__text"))
    scored = rows.withColumn("score", scorer(docs, model)("__text"))
    return scored.select(F.col(f"`{id_col}`"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def offending_sentences(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5
) -> DataFrame:
    """(id, start, end, p, sentence): sentences with p of ``least`` or more; bytes of the text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                raw = (text or "").encode()
                for start, end, p in held.value.spans(text, least):
                    rows.append(k)
                    out.append((start, end, p, raw[start:end].decode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows, pa.int64()))]
                + [
                    pa.array([o[c] for o in out], t)
                    for c, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.string()))
                ],
                names=["id", "start", "end", "p", "sentence"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(find, f"id {id_type}, start long, end long, p double, sentence string")
    return found.withColumnRenamed("id", id_col)
