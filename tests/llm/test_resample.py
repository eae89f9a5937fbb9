import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from brute import lowered

from wayside.llm import resample as module
from wayside.llm.resample import drawn_documents, feature_buckets, resample, select_kth


def brute_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    grams = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def brute(rows, targets):
    feats = [brute_features(t) for _, t in rows]
    s = Counter(b for _, f in feats for b in f)
    t = Counter(b for x in targets for b in brute_features(x)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (ss + 10_000.0) / ((s[b] + 1.0) * (tt + 10_000.0)))) for b in s}
    out = []
    for (i, _), (n, f) in zip(rows, feats, strict=True):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    may = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], (r[0] is not None, r[0] or 0)))
    for k, r in enumerate(may[: 5 * len(may) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def targets_of(spark, texts):
    return spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "item_id long, text string, weight int")


def test_features():
    rng = random.Random(1)
    texts = ["", "a", "One two", "x-y Z9\x80Ä,ö ß", "\x00\x1f::", "9 a 9 a", "日本 語 a"]
    texts += [" ".join(rng.choice(["ab", "C", "é.f", "--"]) for _ in range(n)) for n in (3, 50, 400)]
    for t in texts:
        got = list(feature_buckets(t.encode()))
        n, want = brute_features(t)
        assert sum(g[0] for g in got) == n
        assert sorted(b for g in got for b in g[1].tolist()) == sorted(want), t


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_pieces_of_a_text(monkeypatch, piece):
    monkeypatch.setattr(module, "PIECE", piece)
    for t in ("a", "longer word", "a b c d e f g", ". .. a . b   c\nd-e f", "w" * 300 + " x " + "y" * 300 + " z"):
        assert sorted(b for _, g in feature_buckets(t.encode()) for b in g.tolist()) == sorted(brute_features(t)[1])


@pytest.mark.parametrize("n,pivots", [(1, 4), (5, 32), (500, 3), (500, 32)])
def test_selection(spark, monkeypatch, n, pivots):
    monkeypatch.setattr(module, "PIVOTS", pivots)
    rng = random.Random(n)
    rows = [(rng.randrange(-5, 5), rng.choice([None, 1, 2, 3]), k) for k in range(n)]
    keys = spark.createDataFrame(rows, "below long, doc_id long, row long")
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    for k in sorted({1, n // 3 + 1, n}):
        assert select_kth(keys, k) == order[k - 1]


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(30))
    rows = [(k, " ".join(word() for _ in range(rng.choice([0, 5, 19, 20, 60, 300])))) for k in range(n)]
    return rows, [" ".join(f"a{rng.randrange(30)}" for _ in range(40)) for _ in range(5)] + [None, ""]


def test_like_brute_force(spark, make_docs):
    rows, targets = texts(2, 300)
    rows += [(1000, None), (1001, ""), (1002, "!!"), (1003, "Long Text " * 40_000), (None, rows[5][1]), (1004, rows[5][1])]
    got = resample(make_docs(rows), targets_of(spark, targets)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, targets)


def test_equal_scores_and_repeated_rows(spark, make_docs):
    """Without target texts of their own all rows of an id tie; any of them take the ranks."""
    rows = [(k % 3, "one two three four five " * 4) for k in range(200)] + [(7, "short")]
    got = resample(make_docs(rows), targets_of(spark, ["other"])).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, ["other"])
    again = resample(make_docs(rows), targets_of(spark, ["other"])).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_nothing_to_draw(spark, make_docs):
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    empty = resample(make_docs([]), targets_of(spark, []))
    assert empty.columns == columns and empty.collect() == []
    few = resample(make_docs([(1, "word " * 30)]), targets_of(spark, []))
    assert few.columns == columns and [r["rank"] for r in few.collect()] == [None]


def test_drawn_documents_keep_their_columns(spark, make_docs):
    rows, targets = texts(4, 100)
    docs = make_docs(rows)
    kept = drawn_documents(docs, targets_of(spark, targets))
    want = {r[0] for r in brute(rows, targets) if r[4]}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want and len(want) > 1


def test_ids_that_are_texts(spark):
    docs = spark.createDataFrame([(c, "same words here " * 10) for c in "ba" * 20], "doc_id string, text string")
    got = [r.doc_id for r in resample(docs, targets_of(spark, ["x"])).collect() if r["rank"]]
    assert len(got) == 2
