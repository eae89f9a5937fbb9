import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayside.llm import subwords, token_files
from wayside.llm.elias_fano import EliasFano
from wayside.llm.subwords import SubwordEncoder, default_path
from wayside.session import scratch_path

WHOLE = SubwordEncoder(default_path()).whole
ODD = ["<|endoftext|>", "<|ENDOFTEXT|> <|endoftext|>", "It's we'LL don't ,'s", "ΟΔΟΣ ΣΑΣ İI", "é ́x", "a b c\x85d\x1ce", "é" * 300, "🙂👍🏽", "", " \n", "x1y22z", "ǅ ﬁ Å"]


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(1, 5000), max_size=1500))
def test_elias_fano(steps):
    values = np.cumsum(steps) if steps else np.zeros(0, np.int64)
    code = EliasFano.encode(values)
    assert code.values().tolist() == values.tolist()
    for i in range(0, len(values), 97):
        assert code.select(i) == values[i]
    if len(values) > 200:
        size = 8 * (len(code.low) + len(code.high) + len(code.samples))
        assert size <= len(values) * (3 + np.log2(values[-1] / len(values) + 1)) + 64


def test_select_over_long_gaps():
    values = np.concatenate([np.arange(1, 2000), [10**8], 10**8 + np.arange(1, 600) * 3])
    code = EliasFano.encode(values)
    assert [code.select(i) for i in range(len(values))] == values.tolist()


def pieces(seed, n):
    rng = random.Random(seed)
    letters = "abTHé'<|>s 1,.\n\t́ßΣ漢"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("most", [1_500_000, 40])
def test_words_give_the_ids_of_whole_texts(monkeypatch, most):
    import pyarrow as pa

    monkeypatch.setattr(subwords, "MAX_WORDS", most)  # also one that starts anew
    sub = SubwordEncoder(default_path())
    for texts in (ODD, pieces(1, 400), pieces(2, 400), [None, "a"]):
        column = pa.array(texts, pa.string())
        ids, at = sub.encode(sub.words(column))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(t) for t in texts]


def test_other_tokenizers(spark):
    import pyarrow as pa
    from tokenizers import Tokenizer

    # one that keeps white space can't be taken word by word; a vocabulary file that drops it can
    sub = SubwordEncoder(default_path("word_bpe_49k.json"))
    assert sub.lowers and sub.plain and sub.size == 49408
    assert not Tokenizer.from_file(default_path()).encode(" ", add_special_tokens=False).ids
    assert sub.encode(sub.words(pa.array([], pa.string())))[0].tolist() == []


def expected(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())
    out, start = [], 0
    for i, text in sorted(rows, key=key):
        ids = [*ids_of(text), 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("chunk", [2_000_000, 100])
def test_files(spark, make_docs, monkeypatch, chunk):
    monkeypatch.setattr(token_files, "CHUNK_IDS", chunk)
    monkeypatch.setattr(token_files, "BYTES", 500 if chunk == 100 else 4 << 20)
    texts = ODD + pieces(3, 150) + [None, "w " * 5000]
    rng = random.Random(4)
    rows = [(rng.randrange(10_000), t) for t in texts] + [(None, "no id"), (7, "same"), (7, "ids"), (7, "same")]
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(make_docs(rows).repartition(5), path, default_path())
    got = token_files.read_index(spark, path).collect()
    key = lambda r: (r[1], r[2])
    assert sorted(map(tuple, got), key=key) == expected(rows)
    # one document by its bounds, without decoding the others
    for row in spark.read.parquet(path).toArrow().to_pylist()[:4]:
        c = token_files.Chunk(row)
        for k in range(0, row["n_docs"], 7):
            assert c.document(k)[-1] == 1
            assert (1 if k == 0 else c.ids[c.bounds(k)[0] - 1]) == 1


def test_empty_table(spark, make_docs):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(make_docs([]), path, default_path())
    assert token_files.read_index(spark, path).collect() == []
