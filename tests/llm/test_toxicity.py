import zlib

import numpy as np
import pyarrow as pa

from wayside.llm import toxicity
from wayside.llm.spans import words_of
from wayside.llm.toxicity import fit, offending_sentences, score_documents, sentences


def labelled(n=1500, seed=0):
    """Documents of several sentences; toxic ones hold one with a telling word."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        said = [" ".join(f"w{rng.integers(300)}" for _ in range(8)) for _ in range(rng.integers(1, 9))]
        toxic = int(rng.random() < 0.15)
        if toxic:
            k = rng.integers(len(said))
            said[k] = said[k] + " " + ["Vile!", "rotten,", "scum"][rng.integers(3)] + " w1"
        rows.append((i, ". ".join(said) + "."))
        labels.append((i, toxic))
    return rows, labels


def make_labels(spark, labels):
    return spark.createDataFrame([(i, t, 1) for i, t in labels], "doc_id long, toxic int, n int")


def test_finds_documents_and_sentences(spark, make_docs):
    rows, labels = labelled()
    truth = dict(labels)
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    more = [(9000, None), (9001, ""), (9002, " \n"), (None, "w1 scum w2."), (9003, "w1 w2. " * 20_000), *rows[:5]]
    docs = make_docs(rows + more)
    model = fit(docs, make_labels(spark, [x for x in labels if x[0] not in held]))
    got = score_documents(docs, model).collect()
    assert len(got) == len(rows) + len(more)
    scores = {r.doc_id: r.score for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    right = [(scores[i] >= 0.5) == truth[i] for i in held]
    assert np.mean(right) >= 0.98
    assert scores[None] >= 0.5 and scores[9000] == scores[9001] == scores[9002] == 0.0
    found = offending_sentences(docs, model).collect()
    texts = dict(rows)
    hits = [r for r in found if r.doc_id in held and truth[r.doc_id]]
    assert all(texts[r.doc_id].encode()[r.start : r.end].decode() == r.sentence for r in hits)
    assert np.mean([any(w in r.sentence for w in ("Vile", "rotten", "scum")) for r in hits]) >= 0.95


def test_sentences_end_at_stops_breaks_and_texts():
    words = words_of(pa.array(["a b. c d", None, "e\nf g! h", "", "i"], pa.string()))
    assert sentences(words).tolist() == [0, 2, 4, 5, 7, 8, 9]
    assert sentences(words_of(pa.array([None], pa.string()))).tolist() == [0]


def test_score_is_the_noisy_or_of_its_sentences(spark, make_docs):
    rows, labels = labelled(400, 3)
    model = fit(make_docs(rows), make_labels(spark, labels))
    for _, text in rows[:40]:
        p = [x for *_, x in model.spans(text, -1.0)]
        (score,) = model.score(pa.array([text]))
        assert abs(score - (1 - np.prod([1 - x for x in p]))) < 1e-6


def test_gradient_lowers_the_loss_of_documents_only():
    # two documents share their sentences but one
    sentence_of, doc_of = np.array([0, 1, 2, 3, 4, 5]), np.array([0, 0, 0, 1, 1, 1])
    features = np.array([5, 6, 7, 5, 6, 8])
    rep = 10
    s = np.concatenate([sentence_of + 6 * k for k in range(rep)])
    d = np.concatenate([doc_of + 2 * k for k in range(rep)])
    w, b = toxicity._train(s, np.tile(features, rep), d, np.tile([1, 0], rep))
    assert w[7] > 2 > -0.5 > w[8] or w[7] - w[8] > 3
    assert abs(w[5]) < 0.5 and abs(w[6]) < 0.5


def test_bounded_and_repeatable(spark, make_docs):
    rows, labels = labelled(300, 2)
    docs, known = make_docs(rows), make_labels(spark, [*labels, (5, None), (None, 1), (7, 3)])
    one, two = fit(docs, known, train_docs=100), fit(docs.repartition(5), known.repartition(3), train_docs=100)
    assert np.allclose(one.weights, two.weights) and abs(one.bias - two.bias) < 1e-9


def test_empty_tables(spark, make_docs):
    rows, labels = labelled(20)
    model = fit(make_docs(rows), make_labels(spark, []))
    assert max(r.score for r in score_documents(make_docs(rows), model).collect()) < 0.1
    assert score_documents(make_docs([]), fit(make_docs([]), make_labels(spark, labels))).collect() == []


def test_on_the_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    from wayside.llm.queries import remainder

    model = fit(docs, labels.where(remainder("doc_id", 5) != 0))
    held = docs.join(labels.where(remainder("doc_id", 5) == 0), "doc_id")
    got = score_documents(held, model).join(labels, "doc_id").collect()
    toxic = [r.predicted for r in got if r.toxic]
    clean = [r.predicted for r in got if not r.toxic]
    assert np.mean(toxic) >= 0.8 and np.mean(clean) <= 0.02


def test_length_alone_is_not_toxic(spark, make_docs):
    rows, labels = labelled()
    model = fit(make_docs(rows), make_labels(spark, labels))
    neutral = "Quiet morning by the harbour. " * 20_000
    one, many = model.score(pa.array(["Quiet morning by the harbour.", neutral]))
    assert one == many == 0.0
    assert model.score(pa.array([neutral + "You are scum w1."]))[0] >= 0.5
