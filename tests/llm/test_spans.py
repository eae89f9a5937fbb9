import random

import numpy as np
import pyarrow as pa
import pytest
from brute import brute_shingles, words
from hypothesis import given, settings
from hypothesis import strategies as st

from wayside.llm import spans
from wayside.llm.spans import shingle_sets, slices, word_hashes, words_of

TEXT = st.lists(st.one_of(st.none(), st.text("aAbé \t\n\x0b\x0c\r\x1f <", max_size=40)), max_size=8)


@settings(deadline=None, max_examples=200)
@given(TEXT)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    w = words_of(column)
    raw = w.data.tobytes()
    got = [[raw[s:e].decode() for s, e in zip(w.starts[a:b], w.ends[a:b])] for a, b in zip(w.at[:-1], w.at[1:])]
    assert got == [words(t) for t in texts]


@settings(deadline=None, max_examples=100)
@given(TEXT)
def test_equal_words_have_equal_hashes(texts):
    w = words_of(pa.array(texts, pa.string()))
    every = [x for t in texts for x in words(t)]
    hashes = word_hashes(w).tolist()
    assert len(hashes) == len(every)
    assert len(set(zip(every, hashes))) == len(set(every)) == len(set(hashes))


def test_shingle_sets(monkeypatch):
    monkeypatch.setattr(spans, "SLICE_BYTES", 50)  # several pieces and slices
    rng = random.Random(1)
    texts = [None, "", " \n", "One", "a b c d", "A B C D", "a b c d e", "x" * 200]
    texts += [" ".join(rng.choice("abC") for _ in range(rng.randrange(40))) for _ in range(60)]
    sets = list(shingle_sets(pa.array(texts, pa.string())))
    brute = [brute_shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(b) for b in brute]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(sets[i], sets[j])) == len(brute[i] & brute[j])


def test_slices_cover_all_rows_once():
    column = pa.array(["a" * n for n in (0, 5, 100, 3, 0, 0, 50, 1)])
    for limit in (1, 7, 1000):
        found = list(slices(column, limit))
        assert [i for a, b in found for i in range(a, b)] == list(range(8))
    assert list(slices(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("offset", [0, 3])
def test_sliced_columns(offset):
    column = pa.array(["a b", None, "c", "d e f", ""]).slice(offset)
    assert np.diff(words_of(column).at).tolist() == [2, 0, 1, 3, 0][offset:]
