import math

import numpy as np
import pytest

from wayside.llm import ann
from wayside.llm.ann import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, v string, rep int, q int"


def make(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "v", 2, 3) for i, v in rows], SCHEMA)


def brute(rows, every=20, k=20):
    """For each query its (score, id) list, best first."""
    good = {
        (i, tuple(np.float32(v).astype(float)))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for i, v in good:
        if i % every == 0:
            mine = [(-(np.array(v) * np.array(w)).sum(), j) for j, w in good if j != i and len(w) == len(v)]
            out.setdefault(i, []).extend(mine)
    return {i: sorted(set(m))[:k] for i, m in out.items()}


def check(got, want, least=0.9):
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert by_query.keys() == {i for i, m in want.items() if m}
    hit = total = 0
    for i, m in want.items():
        mine = sorted(by_query.get(i, []))
        assert [r for r, *_ in mine] == list(range(1, len(mine) + 1))
        assert [(-s, j) for _, j, s in mine] == sorted((-s, j) for _, j, s in mine)
        hit += len({j for _, j in m} & {j for _, j, _ in mine})
        total += len(m)
        assert len(mine) == len(m)
    assert hit >= least * total
    return hit / max(total, 1)


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    assert check(nearest(vectors).collect(), brute(rows)) >= 0.93


@pytest.mark.parametrize("block", [8192, 100])
def test_clusters_lengths_and_copies(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 24))
    rows = [(i, centres[i % 12] * rng.uniform(0.5, 3) + 0.2 * rng.standard_normal(24)) for i in range(900)]
    rows += [(2000 + i, rows[40][1]) for i in range(300)]  # a third are equal
    rows = [(i, v.tolist()) for i, v in rows] + [rows[40][:1] + (rows[40][1].tolist(),)] * 3
    want = brute(rows)
    got = nearest(make(spark, rows)).collect()
    check(got, want)
    for i, m in want.items():  # ties go to the smaller id
        if i >= 2000:
            mine = sorted((r.rank, r.vec_id) for r in got if r.query_id == i)
            assert [j for _, j in mine] == [j for _, j in m]


def test_lone_queries_beside_tight_clusters(spark):
    """Vectors that share a long prefix with nothing but themselves still get their neighbours."""
    rng = np.random.default_rng(6)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centres = unit(rng.standard_normal((50, 32)))
    rows = [(i + 1, v.tolist()) for i, v in enumerate(unit(centres[np.arange(3000) % 50] + 0.02 * rng.standard_normal((3000, 32))))]
    rows += [(20_000 + 20 * i, v.tolist()) for i, v in enumerate(unit(rng.standard_normal((6, 32))))]
    want = brute(rows)
    assert {len(m) for m in want.values()} == {20} and len(want) == 156
    check(nearest(make(spark, rows)).collect(), want)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(100)]
    rows += [(200, None), (220, []), (240, [0.0] * 8), (260, [float("nan")] + [1.0] * 7), (280, [None] + [1.0] * 7)]
    rows += [(300, [float("inf")] * 8), (None, [1.0] * 8), (320, [1.0, 2.0]), (340, [3.0, 1.0]), (341, [-0.0, 1.0]), (360, [5.0])]
    got = nearest(make(spark, rows)).collect()
    check(got, brute(rows), 1.0)
    assert not {r.query_id for r in got} & {200, 220, 240, 260, 280, 300, 360}


def test_few_and_no_rows(spark):
    assert nearest(make(spark, [])).collect() == []
    assert nearest(make(spark, [(0, [1.0, 2.0])])).collect() == []
    assert nearest(make(spark, [(1, [1.0, 2.0]), (2, [1.0, 1.0])])).collect() == []
    (r,) = nearest(make(spark, [(0, [1.0, 2.0]), (2, [1.0, 1.0])])).collect()
    assert tuple(r) == (0, 1, 2, 3.0)


def test_strings_agree_more_for_near_vectors():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = x + 0.05 * rng.standard_normal(x.shape)
    y /= np.linalg.norm(y, axis=1)[:, None]
    a, b = ann.strings(x), ann.strings(y)
    first = lambda s: ann._prefix(s, 1)
    assert (first(a) == first(b)).mean() > 0.5 > 0.1 > (first(a) == first(np.roll(b, 1, axis=0))).mean()
    assert np.array_equal(ann.strings(x), a)


def test_many_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(ann, "_want", lambda *a: 1 << 40)  # every query is compared with all vectors
    rng = np.random.default_rng(4)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(1200), rng.choice([-1.0, 1.0], (1200, 14)), strict=True)]
    got = nearest(make(spark, rows)).collect()
    want = brute(rows)
    assert len({s for m in want.values() for s, _ in m}) < 10
    by_query = {i: sorted((r.rank, r.vec_id) for r in got if r.query_id == i) for i in want}
    assert all([j for _, j in by_query[i]] == [j for _, j in m] for i, m in want.items())


def test_best_keeps_ties_and_breaks_them_by_id():
    x = np.array([[1.0, 0.0], [0.0, 1.0]])[np.arange(3000) % 2]
    rep, h = np.random.default_rng(5).permutation(3000), np.zeros(3000, np.int64)
    row, col, score = ann._best(np.array([[1.0, 0.0], [0.0, 2.0]]), x, rep, h, 21)
    for k in (0, 1):
        assert rep[col[row == k]].tolist() == sorted(rep[k::2])[:21]
        assert (score[row == k] == k + 1).all()
