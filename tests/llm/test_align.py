import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wayside.llm import align
from wayside.llm.align import Aligned, align_documents, align_texts, tokenizers, units_of
from wayside.llm.queries import QUERIES
from wayside.llm.subwords import default_path

SF = "/root/testdata/sf0.001"
A, B = default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model")
ODD = [
    "word", "It's", "don't", "  two", "\n\nline ", "\ttab", "café", "naïve", "Привет", "как", "日本語", "한국어", "🙂", "a b",
    " ", "　", "x y", "<s>", "</s>", "<|endoftext|>", "<0x41>", "123", "12,345.67", "...", "--", "\u0085", "é", "é",
    "é", " ", "", "\x00", "\x7f", "​", "“quoted”", "ﬁ", "Ω", "http://a.b/c?d=e", "aaaaaaaaaaaa", "́x",
]


def brute_groups(text):
    """[(ids of A, ids of B)] of whole texts encoded at once, or None."""
    both = tokenizers(A, B)
    if not text:
        return None
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    want = (" " + text).encode()
    if b"".join(both.bytes_a[i] for i in a) != want or b"".join(both.bytes_b[i] for i in b) != want:
        return None
    out, x, y, i, j = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y and i < len(a):
            x += len(both.bytes_a[a[i]])
            out[-1][0].append(a[i])
            i += 1
        else:
            y += len(both.bytes_b[b[j]])
            out[-1][1].append(b[j])
            j += 1
        if x == y:
            out.append(([], []))
    return out[:-1]


def brute_links(groups):
    both = tokenizers(A, B)
    links = []
    for a, b in groups:
        x = np.cumsum([0] + [len(both.bytes_a[i]) for i in a])
        y = np.cumsum([0] + [len(both.bytes_b[i]) for i in b])
        links += [(i, j) for p, i in enumerate(a) for q, j in enumerate(b) if max(x[p], y[q]) < min(x[p + 1], y[q + 1])]
    return links


def brute(rows):
    found = [(i, brute_groups(t)) for i, t in rows]
    links = [brute_links(g or []) for _, g in found]
    count = Counter(p for one in links for p in set(one))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (i, g), one in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or [])
        digest = hashlib.sha256(text.encode()).hexdigest() if g else ""
        n = [sum(len(x[k]) for x in g or []) for k in (0, 1)]
        out.append((i, *n, len(g or []), len(one), sum(count[p] == best[p[0]] for p in one), sum(count[p] for p in one), digest))
    return sorted(out, key=str)


def odd_texts(seed, n):
    rng = random.Random(seed)
    return [rng.choice(["", " ", "\n"]).join(rng.choice(ODD) for _ in range(rng.randrange(30))) + rng.choice(["", " ", "  "]) for _ in range(n)]


def test_bytes_of_ids():
    both = tokenizers(A, B)
    assert both.bytes_a[220] == b" " and len(set(both.bytes_a)) == len(both.bytes_a)
    assert both.bytes_b[both.b.piece_to_id("<0x0A>")] == b"\n"
    held = np.flatnonzero(both.same >= 0)
    assert len(held) > 5000 and all(both.bytes_a[i] == both.bytes_b[both.same[i]] for i in held)
    assert both.bytes_b[both.same[220]] == b" " and not both.b.is_byte(int(both.same[220]))


def test_no_piece_joins_across_a_blank():
    both = tokenizers(A, B)
    assert not any(b" " in x.lstrip(b" ") for i, x in enumerate(both.bytes_b) if not both.b.is_control(i))


def test_units_make_up_the_texts():
    texts = odd_texts(1, 400) + ["", "a b", " a  b ", "é b", "  b", "a 　", "ж б"]
    units = units_of(pa.array(texts))
    for k, t in enumerate(texts):
        parts = [units.data[i:j].tobytes() for i, j in zip(units.starts[units.at[k] : units.at[k + 1]], units.ends[units.at[k] : units.at[k + 1]])]
        assert b"".join(parts) == (" " + t).encode() and all(p[:1] == b" " for p in parts)
    assert len(units_of(pa.array(["a b c"])).starts) == 3 and len(units_of(pa.array(["ж б"])).starts) == 2


@pytest.mark.parametrize("most", [400_000, 7])
def test_units_together_are_whole_texts(monkeypatch, most):
    monkeypatch.setattr(align, "MAX_UNITS", most)
    known = Aligned(tokenizers(A, B))
    for seed in range(3):
        texts = odd_texts(seed, 150)
        got = align_texts(pa.array(texts), known)
        for k, t in enumerate(texts):
            g = brute_groups(t)
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or [])
            assert got["groups_sha256"][k].as_py() == (hashlib.sha256(text.encode()).hexdigest() if g else ""), repr(t)
            assert got["n_links"][k].as_py() == len(brute_links(g or []))


@pytest.mark.parametrize("chunk", [1, 8 << 20])
def test_like_brute_force(spark, make_docs, monkeypatch, chunk):
    monkeypatch.setattr(align, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(align, "SLICE_BYTES", 200)
    rows = [*enumerate(odd_texts(5, 120))]
    rows += [(900, None), (901, ""), (902, "has ▁ in it"), (903, "long text, " * 20_000), (None, "the end"), (5, "the end"), (5, "the end")]
    got = align_documents(make_docs(rows), A, B).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_table(make_docs):
    out = align_documents(make_docs([]), A, B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert out.collect() == []


def test_query_like_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op13_tokenizer_alignment"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
