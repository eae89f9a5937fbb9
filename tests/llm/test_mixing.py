import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from wayside.llm import mixing
from wayside.llm.mixing import mix_sources, source_targets, with_copies

WEIGHTS = (5, 2, 1)


def targets(sizes):
    """Shares by weight; what is above the bound is shared again until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(order)}
    total = 1.5 * sum(sizes.values())
    full = set()
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        share = {s: weight[s] * left / sum(weight[f] for f in free) for s in free} if free else {}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return {s: share[s] if s in share else 2.0 * sizes[s] for s in order}
        full |= above


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{rng.randrange(10**6)}": int(10 ** rng.uniform(0, 6)) for _ in range(rng.randrange(1, 30))}
    if seed % 2:
        sizes |= {None: 500, "": 3, "Z": 0, "é": 9, "🙂": 20}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df, WEIGHTS, 1.5, 2).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) <= 1e-9 * (1 + want[s]) for s in want)
    assert all(got[s] <= 2 * sizes[s] for s in sizes)


def rows(seed, n=3000):
    rng = random.Random(seed)
    out = [(k, "w " * rng.randrange(60), rng.choice(["big"] * 8 + ["a", "b", "c", None, ""])) for k in range(n)]
    return out + [(n, None, "a"), (n + 1, "", "only empty"), (None, "no id here", "b"), *out[:20]]


def draw_of(doc_id):
    return int(hashlib.md5(f"mix-1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:12], 16)


def copies_by_id(docs, goal):
    """{(id, source): copies} for rows (id, words, source): whole repeats, and one more in the
    order of draws as long as that brings the source nearer to its target."""
    out = {}
    for s in {s for *_, s in docs}:
        mine = defaultdict(int)
        for i, n, of in docs:
            if of == s:
                mine[draw_of(i), i] += n
        total, upto = sum(mine.values()), 0
        rate = goal[s] / total if total else 0.0
        more = (rate - int(rate)) * total
        for (_, i), n in sorted(mine.items(), key=lambda m: m[0][0]):
            upto += n
            out[i, s] = int(rate) + (more > 0 and upto - n / 2 <= more)
    return out


@pytest.mark.parametrize("bytes_limit", [32 << 20, 0])
def test_copies(make_docs, monkeypatch, bytes_limit):
    monkeypatch.setattr(mixing, "MAX_BROADCAST_BYTES", bytes_limit)  # by broadcast and by shuffle
    data = rows(1)
    sizes = defaultdict(int)
    for _, t, s in data:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(sizes)
    got = with_copies(make_docs(data)).collect()
    assert len(got) == len(data)
    taken = defaultdict(int)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    copies = copies_by_id([(i, count(t), s) for i, t, s in data], want)
    largest = defaultdict(int)  # words of one id, whose rows are repeated together
    for i, t, s in data:
        largest[s, i] += count(t)
    largest = {s: max(n for (of, _), n in largest.items() if of == s) for s in want}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        assert r.copies == copies[r.doc_id, r.source] <= 2
        taken[r.source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_mixture_repeats_whole_rows(make_docs):
    data = rows(2, 400)
    docs = make_docs(data)
    mixed = mix_sources(docs)
    assert mixed.columns == docs.columns
    plain = Counter((r.doc_id, r.text, r.source) for r in docs.collect())
    copies = {(r.doc_id, r.source): r.copies for r in with_copies(docs).collect()}
    want = Counter({k: n * copies[k[0], k[2]] for k, n in plain.items() if copies[k[0], k[2]]})
    got = Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    assert got == want
    assert Counter((r.doc_id, r.text, r.source) for r in mix_sources(docs.repartition(7)).collect()) == want


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_every_source_comes_near_its_target(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in with_copies(docs).collect():
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)


def test_empty_table(make_docs):
    assert with_copies(make_docs([])).collect() == []
    assert mix_sources(make_docs([])).collect() == []
