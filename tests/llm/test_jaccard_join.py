import random

import numpy as np
import pytest
from brute import brute_shingles

from wayside.llm import jaccard_join, sketch
from wayside.llm.components import components
from wayside.llm.jaccard_join import (
    _contents,
    bitmap,
    drop_near_copies,
    least_difference,
    link_documents,
    signatures,
)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 8, 16, 31, 47, 48, 63, 64, 65, 80, 85, 86, 120, 333, 900, 2500])
def test_similar_sets_share_a_signature(size):
    rng = np.random.default_rng(size)
    for _ in range(60):
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        # remove and add as many as 3/4 allow: common >= 3/4 of the union
        gone = rng.integers(0, len(a) // 4 + 1)
        common = rng.permutation(a)[: len(a) - gone]
        most = len(common) * 4 // 3 - len(a)
        new = rng.integers(0, 2**63, rng.integers(0, most + 1), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        b = np.unique(np.concatenate([common, new]))
        both = len(np.intersect1d(a, b))
        assert 4 * both >= 3 * (len(a) + len(b) - both)
        assert len(np.intersect1d(signatures(a), signatures(b)))


@pytest.mark.parametrize("size", [1, 5, 60, 1000])
def test_bitmaps_never_overstate_the_difference(size):
    rng = np.random.default_rng(size)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.concatenate([rng.permutation(a)[: rng.integers(0, len(a) + 1)], rng.integers(0, 2**63, rng.integers(1, 3 * size + 1)).astype(np.uint64)])
        b = np.unique(b)
        apart = len(np.setxor1d(a, b))
        assert least_difference(bitmap(a), bitmap(b)) <= apart
        assert least_difference(bitmap(b), bitmap(a)) == least_difference(bitmap(a), bitmap(b))
        assert least_difference(bitmap(a), bitmap(a)) == 0


def test_signatures_in_the_order_of_a_sketch_still_meet():
    """Similar sets share a signature whatever contents a sketch takes for single ones."""
    rng = np.random.default_rng(8)
    for size in (6, 40, 70, 300):
        for _ in range(100):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            b = np.unique(np.concatenate([a[: len(a) - len(a) // 8], rng.integers(0, 2**63, len(a) // 9).astype(np.uint64)]))
            both = {int(c) for x, _, _ in _contents(a) for c in x} & {int(c) for x, _, _ in _contents(b) for c in x}
            # contents of both are seen twice; of the others some by chance
            found = lambda c: np.array([(int(x) % 3 + 1) * (int(x) in both or int(x) % 10 < 1) for x in c])
            assert len(np.intersect1d(signatures(a, found), signatures(b, found)))


def test_unlike_sets_rarely_share_one():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, 200).astype(np.uint64)) for _ in range(40)]
    signs = [signatures(s) for s in sets]
    shared = sum(len(np.intersect1d(signs[i], signs[j])) > 0 for i in range(40) for j in range(i))
    assert shared == 0


def brute(rows):
    sets = [(i, brute_shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, a in sets:
        for y, b in sets:
            if x is not None and y is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = sorted((root(x), root(y)))
                parent[q] = p
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=repr)


def near_copies(seed, groups, alphabet=200):
    """Texts with copies of copies, each some words away from the one before."""
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(groups):
        text = [f"w{rng.randrange(alphabet)}" for _ in range(rng.choice([3, 5, 6, 9, 14, 30, 60, 150, 400]))]
        for _ in range(rng.randrange(1, 9)):
            rows.append((n, " ".join(text)))
            n += rng.randrange(1, 4)
            text = list(text)
            for _ in range(rng.randrange(0, max(2, len(text) // 25))):
                k = rng.randrange(len(text))
                text[k : k + rng.randrange(2)] = [f"w{rng.randrange(alphabet)}"] * rng.randrange(2)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(make_docs, seed):
    rows = near_copies(seed, 40)
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "One"), (9004, "one"), (None, rows[0][1]), (9005, "x " * 9000)]
    rows += rows[:7]
    rows += [(rows[3][0], "another text under the same id as the one before it")]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in link_documents(make_docs(rows)).collect()]
    assert sorted(got, key=repr) == brute(rows)


@pytest.mark.parametrize("block", [4096, 3])
def test_members_that_the_pivots_miss(make_docs, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(sketch, "bits_for", lambda n: sketch.PIECE_BITS)
    # no document is linked with its pivot, so all links come from within the groups
    links = jaccard_join._links
    calls = []

    def second_only(pairs, sets):
        calls.append(1)
        return links(pairs.where("false") if len(calls) == 1 else pairs, sets)

    monkeypatch.setattr(jaccard_join, "_links", second_only)
    rows = near_copies(7, 25, alphabet=40)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in link_documents(make_docs(rows)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_one_document_of_each_group_stays(make_docs):
    rows = near_copies(3, 20) + [(None, "a b c d e f"), (None, "a b c d e f")]
    kept = drop_near_copies(make_docs(rows))
    assert kept.columns == make_docs([]).columns
    low = {r for i, _, r in brute(rows) if i is not None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(low)
    assert kept.where("doc_id is null").count() == 2


def test_empty_table(make_docs):
    assert link_documents(make_docs([])).collect() == []
    assert drop_near_copies(make_docs([])).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    edges += [(100 + k, 101 + k) for k in range(25)] + [(200, 200 + k) for k in range(20)] + edges[:5]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = sorted((root(a), root(b)))
        parent[q] = p
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in linked)


def test_columns_of_any_name_stay(spark):
    text = "one two three four five six seven"
    rows = [(1, text, 5, "x"), (2, text, 6, "y"), (3, "other words that are not the same", 7, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __gone long, `a.b` string")
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
