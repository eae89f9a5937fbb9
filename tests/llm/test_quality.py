import numpy as np
import pyarrow as pa

from wayside.llm import quality
from wayside.llm.quality import classify, keep_good

GOOD = "The report was read by all of them, and it said what they knew: the river rose again in spring."
BAD = ["BUY!! NOW!! CHEAP!! LOANS!! FOR!! ALL!!", "x### $$$ y&&& %%% z*** @@@", "spam spam spam spam spam spam spam spam"]


def test_against_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = classify(docs).join(labels, "doc_id").collect()
    clean = [r.good for r in rows if r.quality == 1]
    junk = [r.good for r in rows if r.quality == 0]
    assert np.mean(clean) >= 0.98  # labels are never learnt from
    assert np.mean(junk) <= 0.10


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    n, k = 40_000, len(quality.SHAPES)
    truth = rng.random(n) < 0.8
    right = rng.uniform(0.75, 0.95, k)
    vote = np.where(rng.random((n, k)) < right, truth[:, None], ~truth[:, None]).astype(int)
    vote[rng.random((n, k)) < 0.3] = quality.ABSTAIN
    patterns, counts = np.unique(vote @ 3 ** np.arange(k - 1, -1, -1), return_counts=True)
    q, accuracies = quality.label_model(patterns, counts)
    assert np.abs(accuracies[:, 0] - right).max() < 0.03
    assert np.abs(accuracies[:, 1] - right).max() < 0.06
    share = (q * counts).sum() / n
    assert abs(share - 0.8) < 0.02


def test_shapes():
    texts = [GOOD, *BAD, None, "", "a | b | c | d", "1 22 333", " ".join(f"w{i}" for i in range(10)) * 5]
    shape, n = quality.shapes(pa.array(texts, pa.string()))
    at = {name: k for k, name in enumerate(quality.SHAPES)}
    assert n.tolist()[4:6] == [0, 0] and not shape[4:6].any()
    assert shape[1, at["upper"]] == 1 and shape[1, at["shouts"]] == 1
    assert shape[3, at["runs"]] == 7 / 8
    assert shape[6, at["bars"]] == 3 / 7
    assert shape[7, at["digits"]] == 1
    assert shape[2, at["signs"]] > 0.5
    assert ((shape >= 0) & (shape <= 1)).all()


def table(make_docs):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        words = ["word" + "abcdefghij"[rng.integers(10)] + "klmnopqrst"[rng.integers(10)] for _ in range(40)]
        rows.append((i, " ".join(words).capitalize() + ".") if i % 4 else (i, BAD[i % 3] + " " + BAD[i % 3]))
    return rows + [(None, GOOD), (900, None), (901, ""), (902, " \n"), (903, GOOD + " " + GOOD * 3000), *rows[:5]]


def test_filter_keeps_rows_and_columns(make_docs):
    rows = table(make_docs)
    docs = make_docs(rows)
    scored = classify(docs).collect()
    assert len(scored) == len(rows)
    assert all(0 <= r.score <= 1 and r.good == (r.score >= 0.5) for r in scored)
    assert {r.score for r in scored if r.doc_id in (900, 901, 902)} == {0.0}
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert all(i in ids for i in range(300) if i % 4)
    assert sum(i in ids for i in range(0, 300, 4)) <= 8
    assert None in ids and not {900, 901, 902} & set(ids)


def test_training_is_bounded_and_repeatable(make_docs):
    docs = make_docs(table(make_docs))
    one, two = (quality.fit(d, train_docs=50) for d in (docs, docs.repartition(5)))
    assert np.array_equal(one.words, two.words)
    assert np.array_equal(one.accuracies, two.accuracies)


def test_empty_table(make_docs):
    assert classify(make_docs([])).collect() == []
    assert keep_good(make_docs([])).collect() == []
