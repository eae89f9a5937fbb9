import random

import numpy as np
import pytest
import xxhash
from brute import lowered, words

from wayside.llm import simhash
from wayside.llm.queries import QUERIES
from wayside.llm.simhash import fingerprint, link_documents, links

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    w = words(lowered(text))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps):
    """The lowest index of each one's component, all pairs compared."""
    fps = np.array(fps, np.uint64)
    group = np.arange(len(fps))
    for i in range(len(fps)):
        near = np.bitwise_count(fps ^ fps[i]) <= 2
        low = group[near].min()
        group[np.isin(group, group[near])] = low
    return group.tolist()


def brute(rows):
    """(id, fingerprint, component) of rows with ids."""
    rows = sorted(rows, key=lambda r: r[0])
    fps = [brute_fingerprint(t) for _, t in rows]
    return sorted((i, f"{f:016x}", rows[g][0]) for (i, _), f, g in zip(rows, fps, groups(fps), strict=True))


def test_fingerprint():
    rng = random.Random(3)
    texts = ["", " \t\n", "One", "one  TWO", "a b c", "Ünï Ä x y\x0bz", "x " * 70_000, "\x00 \x1c b"]
    texts += [" ".join(rng.choice(["A", "bb", "É", "d,"]) for _ in range(n)) for n in (3, 4, 50, 500)]
    for t in texts:
        assert fingerprint(t.encode()) == brute_fingerprint(t), t[:30]


def test_pieces_add_up(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500)).encode()
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert fingerprint(text) == whole


@pytest.mark.parametrize("crowd", [2, 32, 10_000])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(crowd)
    fps = {rng.getrandbits(64) for _ in range(40)}
    centre = rng.getrandbits(64)
    for reach in (1, 2, 3, 5, 8):
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), reach)) for _ in range(60)}
    for f in list(fps)[:20]:  # on the edge of a link
        fps |= {f ^ sum(1 << b for b in rng.sample(range(64), d)) for d in (2, 3)}
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    mask = (1 << 64) - 1
    found = [(r.x & mask, r.y & mask) for r in links(df).collect()]
    assert all((x ^ y).bit_count() <= 2 for x, y in found)
    at = {f: i for i, f in enumerate(fps)}
    group = list(range(len(fps)))
    for x, y in found:
        a, b = group[at[x]], group[at[y]]
        group = [min(a, b) if g in (a, b) else g for g in group]
    assert group == groups(fps)
    if crowd == 10_000:  # every pair was compared
        near = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2}
        assert {(min(p), max(p)) for p in found} == near


def test_like_brute_force(spark, make_docs):
    rng = random.Random(7)
    rows = []
    for k in range(40):
        text = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([1, 2, 3, 10, 300]))]
        rows.append((10 * k, " ".join(text)))
        for j in range(rng.randrange(5)):
            text = list(text)
            text[rng.randrange(len(text))] = "new"
            rows.append((10 * k + 1 + j, "  ".join(text).upper() if j % 2 else " ".join(text)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, rows[0][1]), (-5, rows[3][1]), (1004, "many words " * 30_000)]
    got = sorted(map(tuple, link_documents(make_docs(rows)).collect()))
    assert got == brute(rows)


def test_rows_without_id_repeated_rows_and_text_ids(spark, make_docs):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "only here and nowhere else"), (3, "A  b c\td"), (5, "x y z")]
    got = link_documents(make_docs(rows)).collect()
    fp = {t: f"{brute_fingerprint(t):016x}" for _, t in rows}
    want = [(5, fp["a b c d"], 3)] * 2 + [(None, fp["a b c d"], 3), (3, fp["a b c d"], 3), (5, fp["x y z"], 5)]
    want += [(None, fp["only here and nowhere else"], None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    named = spark.createDataFrame([("b", "one two"), ("a", "ONE two"), ("c", "other")], "doc_id string, text string")
    assert sorted((r.doc_id, r.component_id) for r in link_documents(named).collect()) == [("a", "a"), ("b", "a"), ("c", "c")]


def test_empty_table(make_docs):
    out = link_documents(make_docs([]))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.collect() == []


def test_query_like_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op11_simhash_near_dedup"](spark, SF).collect())) == brute(rows)
