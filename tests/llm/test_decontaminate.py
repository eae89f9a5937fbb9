import random

import pytest
from brute import brute_shingles

from wayside.llm import decontaminate
from wayside.llm.decontaminate import contained_items, drop_contaminated, sketch_size


def test_sketches_are_long_enough():
    for n in range(1, 3000):
        assert min(n, n // 4 + 1) <= sketch_size(n) <= n


def make_items(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "item_id long, text string, h long, doc_id int")


def brute(docs, items):
    merged_docs, merged_items = {}, {}
    for into, rows in ((merged_docs, docs), (merged_items, items)):
        for i, t in rows:
            if i is not None:
                into.setdefault(i, set()).update(brute_shingles(t))
    return sorted(
        (d, i, len(b), len(a & b)) for d, a in merged_docs.items() for i, b in merged_items.items() if b and 4 * len(a & b) >= 3 * len(b)
    )


def tables(seed):
    rng = random.Random(seed)
    word = lambda n=300: f"w{rng.randrange(n)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 3, 5, 6, 9, 17, 40, 80, 200])))) for k in range(40)]
    items += [(100, None), (101, ""), (102, items[0][1]), (None, items[1][1]), items[7], (103, "One Two three FOUR five six")]
    docs = [(900, None), (901, " "), (902, "one two three four five six"), (None, items[5][1]), (903, items[6][1])]
    for k in range(80):
        text = [word() for _ in range(rng.randrange(400))]
        for _ in range(rng.randrange(3)):
            part = rng.choice(items[:40])[1].split()
            for _ in range(rng.randrange(3)):
                part[rng.randrange(len(part))] = word()
            at = rng.randrange(len(text) + 1)
            text[at:at] = part
        docs.append((k, " ".join(text)))
    return docs + docs[10:14] + [(12, items[8][1])], items


@pytest.mark.parametrize("bits", [25, 4])
def test_like_brute_force(spark, make_docs, monkeypatch, bits):
    monkeypatch.setattr(decontaminate, "BITMAP_BITS", bits)  # also one that is full
    docs, items = tables(bits)
    got = contained_items(make_docs(docs), make_items(spark, items)).collect()
    assert sorted(map(tuple, got)) == brute(docs, items)


def test_drop(spark, make_docs):
    docs, items = tables(9)
    kept = drop_contaminated(make_docs(docs), make_items(spark, items))
    assert kept.columns == make_docs([]).columns
    gone = {d for d, *_ in brute(docs, items)}
    assert gone and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(
        i for i, _ in docs if i is not None and i not in gone
    )
    assert kept.where("doc_id is null").count() == 1


def test_empty_tables(spark, make_docs):
    docs, items = tables(2)
    assert contained_items(make_docs([]), make_items(spark, items)).collect() == []
    assert contained_items(make_docs(docs), make_items(spark, [])).collect() == []
    assert drop_contaminated(make_docs(docs), make_items(spark, [])).count() == len(docs)


def test_columns_of_any_name_stay(spark):
    text = "one two three four five six seven"
    rows = [(1, text, 5, "x"), (2, text, 6, "y"), (3, "other words that are not the same", 7, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __gone long, `a.b` string")
    kept = drop_contaminated(docs, make_items(spark, [(1, "one two three four five six")]))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [rows[2]]
