import hashlib
import random
import re

import pytest

from wayside.llm import sketch, substring_dedup
from wayside.llm.substring_dedup import remove_repeats


def brute(rows, size):
    """(id, n_words, n_removed, sha) of each (id, text)."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - size + 1):
            if i is not None:
                key = tuple(w[k : k + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone |= set(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [50, 4, 1])
def test_like_brute_force(make_docs, size):
    rng = random.Random(size)
    passages = [[rng.choice("ab") + str(rng.randrange(50)) for _ in range(70)] for _ in range(6)]
    rows = [(None, " ".join(passages[0])), (3, None), (4, ""), (5, " \n\t"), (6, "one"), (900, "é" * 3000)]
    for i in range(60):
        text = []
        for _ in range(rng.randrange(5)):
            text += [f"w{rng.randrange(30)}" for _ in range(rng.randrange(60))] + rng.choice(passages)
        rows.append((100 + i // 2 * (i % 3), rng.choice([" ", "\n", " \t "]).join(text)))
    rows += rows[20:30]  # repeated rows
    assert got(remove_repeats(make_docs(rows), size=size)) == brute(rows, size)


def test_a_full_sketch_loses_nothing(make_docs, monkeypatch):
    monkeypatch.setattr(sketch, "bits_for", lambda n: sketch.PIECE_BITS)
    monkeypatch.setattr(substring_dedup, "DEPTH", 1)
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text), (2, "x " + text + " y"), (3, " ".join(f"v{i}" for i in range(70)))]
    assert got(remove_repeats(make_docs(rows))) == brute(rows, 50)


def test_kept_text_and_empty_table(make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    rows = {r.doc_id: r.kept for r in remove_repeats(make_docs([(1, text), (2, f"a  b {text}\nc")])).collect()}
    assert rows == {1: None, 2: "a b c"}
    assert remove_repeats(make_docs([])).collect() == []
