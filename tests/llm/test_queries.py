import zlib
from collections import Counter

import numpy as np
import pytest
from brute import brute_shingles, words

import corpus_pipeline
from gate.compare import compare, connect
from wayside.llm import quality
from wayside.llm.queries import ORACLE, QUERIES
from wayside.llm.subwords import SubwordEncoder, default_path
from wayside.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], ORACLE[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def docs_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_token_ids(spark):
    whole = SubwordEncoder(default_path()).whole
    start = 0
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_token_ids"](spark, SF).collect()}
    rows = sorted(docs_of(spark.read.parquet(f"{SF}/documents.parquet")))
    assert len(got) == len(rows)
    for i, text, _ in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_quality_query(spark):
    rows = QUERIES["op1_quality_classifier"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_against_plain_versions_of_its_stages(spark):
    """Every stage on its own input; the classifier by its own model, one text at a time."""
    import pyarrow as pa
    from test_mixing import copies_by_id, targets

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    run = lambda name, df: materialize(stages[name](spark, df, SF))

    model = quality.fit(docs)
    one = run("quality classifier", docs)
    assert one.columns == docs.columns
    assert sorted(docs_of(one)) == sorted(d for d in docs_of(docs) if model.score(pa.array([d[1]]))[0] >= 0.5)

    two = run("n-gram Jaccard join", one)
    sets = {i: brute_shingles(t) for i, t, _ in docs_of(one)}
    group = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    assert sorted(docs_of(two)) == sorted(d for d in docs_of(one) if group[d[0]] == d[0])
    assert two.columns == docs.columns

    three = run("benchmark decontamination", two)
    items = [brute_shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = lambda t: not any(i and 4 * len(i & brute_shingles(t)) >= 3 * len(i) for i in items)
    assert sorted(docs_of(three)) == sorted(d for d in docs_of(two) if clean(d[1]))
    assert three.columns == docs.columns

    four = run("mixing sources to target weights", three)
    sizes = Counter()
    for _, t, s in docs_of(three):
        sizes[s] += len(words(t))
    goal = targets(sizes)
    copies = copies_by_id([(i, len(words(t)), s) for i, t, s in docs_of(three)], goal)
    want = Counter({d: copies[d[0], d[2]] for d in docs_of(three)})
    assert Counter(docs_of(four)) == +want
    assert four.columns == docs.columns

    five = run("token-ID / binary output", four).orderBy("doc_id", "start").collect()
    whole = SubwordEncoder(default_path()).whole
    start = 0
    for r, (i, text, _) in zip(five, sorted(docs_of(four)), strict=True):
        ids = [*whole.encode(text, add_special_tokens=False).ids, 1]
        assert tuple(r) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_pipeline_runs_all_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    starts = sorted((r.start, r.n_tokens) for r in rows)
    assert starts[0][0] == 0
    assert all(a[0] + a[1] == b[0] for a, b in zip(starts, starts[1:]))
