"""Distributed order, quantiles and joins against brute force, with skewed input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gate import fixtures as fx
from gate.fixtures import SETTINGS
from tests.conftest import SF_MID, SF_SMALL
from wayside.operators import aggregates as agg
from wayside.operators import profiling as pf
from wayside.operators import scale as sc
from wayside.operators import star as st
from wayside.plans import jobs
from wayside.session import scratch_path


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        x = 1.5 if i % 3 == 0 else round(rng.gauss(0, 50), 3)
        y = None if i % 7 == 0 else float(rng.randint(-5, 5))
        rows.append((i, x, y, "hot" if i % 3 == 0 else f"k{rng.randint(0, 400)}"))
    return rows, spark.createDataFrame(rows, "i long, x double, y double, k string")


@pytest.fixture(params=[True, False], ids=["merged", "many-ranges"])
def ranges(spark, request):
    """With AQE merging small ranges into one, and without."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, str(request.param).lower())
    yield request.param
    spark.conf.set(key, before)


def test_there_are_several_ranges(skewed, ranges):
    n = sc.in_ranges(skewed[1], "x", "i").select("__range").distinct().count()
    assert n == 1 if ranges else n >= 4


@pytest.mark.parametrize("slots", [4096, 1, 2])
def test_exact_quantiles(skewed, ranges, monkeypatch, slots):
    monkeypatch.setattr(sc, "SLOTS", slots)
    rows, df = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = sc.exact_quantiles(df, ["x", "y"], probs).first()
    for c, pos in (("x", 1), ("y", 2)):
        vals = [r[pos] for r in rows if r[pos] is not None]
        for p in probs:
            assert got[sc.quantile_name(c, p)] == pytest.approx(np.quantile(vals, p), abs=1e-9)


def test_quantiles_over_many_magnitudes(spark):
    rng = random.Random(5)
    vals = [rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 300) for _ in range(2000)]
    vals += [float("inf"), float("-inf"), 0.0, 5e-324, 1.7e308, -1.7e308] + [3.25] * 500
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.2, 0.5, 0.6, 0.9, 1.0]
    got = sc.exact_quantiles(df, ["x"], probs).first()
    ordered = sorted(vals)
    for p in probs:
        k = p * (len(vals) - 1)
        lo, hi = ordered[int(np.floor(k))], ordered[int(np.ceil(k))]
        # far apart, so only the bounds are compared
        assert lo <= got[sc.quantile_name("x", p)] <= hi or lo == hi or np.isinf(hi)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert tuple(sc.exact_quantiles(df, ["a", "b"], [0.5]).first()) == (1.5, None)
    assert tuple(sc.exact_quantiles(df.where("a > 5"), ["a", "b"], [0.5]).first()) == (None, None)


def test_approximate_quantiles(skewed):
    rows, df = skewed
    got = sc.exact_quantiles(df, ["x"], [0.5], accuracy=10000).first()
    assert abs(got[0] - np.quantile([r[1] for r in rows], 0.5)) < 1


def test_running_total(skewed, ranges):
    rows, df = skewed
    weighted = df.select((-F.col("x")).alias("o"), "i", (F.col("i") % 5).alias("w"))
    got = sc.running_total(weighted, ["o", "i"], "w", "cum")
    total, want = 0, {}
    for x, i in sorted((-r[1], r[0]) for r in rows):
        total += i % 5
        want[i] = total
    assert {r["i"]: r["cum"] for r in got.collect()} == want


def test_running_total_by_group(skewed, ranges):
    rows, df = skewed
    weighted = df.withColumn("w", F.lit(1))
    got = sc.running_total(weighted, ["i"], "w", "pos", by=["k"])
    seen, want = {}, {}
    for i, _, _, k in rows:
        seen[k] = seen.get(k, 0) + 1
        want[i] = seen[k]
    assert {r["i"]: r["pos"] for r in got.collect()} == want


def test_running_total_of_fractions_is_the_same_in_any_ranges(skewed, spark):
    _, df = skewed
    key, found = "spark.sql.adaptive.coalescePartitions.enabled", []
    before = spark.conf.get(key)
    for merge in ("true", "false"):
        spark.conf.set(key, merge)
        total = sc.running_total(df.withColumn("o", F.abs("x")), ["o", "i"], "x", "cum")
        found.append({r["i"]: r["cum"] for r in total.collect()})
    spark.conf.set(key, before)
    assert found[0] == found[1]


def test_negative_zero_is_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert sc.value_counts_long(df, ["x"], "string").count() == 2


def test_surrogate_ids_follow_first_appearance(spark):
    df = spark.createDataFrame(
        [("A-3", "Fog"), ("A-1", "Rain"), ("A-2", None), ("A-10", "Rain")],
        "ID string, Weather_Condition string",
    )
    dim = {r.Weather_Condition: r.weather_id for r in st.build_dim_weather(df).collect()}
    assert dim == {"Rain": "W1", None: "W2", "Fog": "W3"}
    odd = spark.createDataFrame(
        [("B-1", "Fog"), ("A-1", "Rain"), ("abc", "Ice"), ("abb", "Hail"), ("9" * 50, "Dust")],
        "ID string, Weather_Condition string",
    )
    for part in (odd, odd.repartition(5)):
        dim = {r.weather_id: r.Weather_Condition for r in st.build_dim_weather(part).collect()}
        assert dim == {"W1": "Rain", "W2": "Fog", "W3": "Dust", "W4": "Hail", "W5": "Ice"}
    joined = {r.ID: r.weather_id for r in st.attach_weather_id(df, st.build_dim_weather(df)).collect()}
    assert joined == {"A-3": "W3", "A-1": "W1", "A-2": "W2", "A-10": "W1"}


def as_rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", ["64m", "10"])
def test_star_rollup_equals_rollup_of_the_join(spark, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    star = fx.star(spark, SF_MID)
    joined = st.with_dominant_infra(st.star_join(star, SETTINGS))
    for keys in {*agg.DASHBOARDS.values(), ("Year", "Hour", "Weather_Category", "State")}:
        got = agg.star_rollup(star, keys, SETTINGS)
        assert near_rows(got) == near_rows(agg.rollup(joined, list(keys), SETTINGS))
    for name, got in agg.star_rollups(star, settings=SETTINGS).items():
        assert near_rows(got) == near_rows(agg.rollup(joined, list(agg.DASHBOARDS[name]), SETTINGS))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def near_rows(df):
    """Sums of doubles may differ in the last digits by the order they were added in."""
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in as_rows(df)]


def test_dashboards_from_rows_and_from_the_shared_rollup_agree(spark):
    star = fx.star(spark, SF_SMALL)
    joined = st.star_join(star, SETTINGS)
    shared = jobs.build_aggregates(star, SETTINGS)
    for name, table in shared.items():
        direct = getattr(agg, name)(joined, SETTINGS)
        assert as_rows(direct) == as_rows(table)


def test_hot_location_survives(spark):
    """A third of all rows at one location: totals stay whole in every path."""
    df = fx.cleaned(spark, SF_SMALL).withColumn(
        "Street", F.when(F.col("row_seq") % 3 == 0, "Hot").otherwise(F.col("Street"))
    )
    n = df.count()
    star = jobs.build_star(df, SETTINGS)
    assert st.star_join(star, SETTINGS).count() == n
    rolled = agg.star_rollup(star, ("State", "City"), SETTINGS)
    assert rolled.agg(F.sum("n_rows")).first()[0] == n


def test_quantiles_from_brackets(spark, monkeypatch):
    """Columns long enough for a sketch, with a value that a third of the rows have."""
    monkeypatch.setattr(sc, "FEW", 100)
    rng = np.random.default_rng(9)
    x = np.where(rng.random(30_000) < 0.34, 7.5, rng.lognormal(0, 40, 30_000))
    y = rng.integers(0, 5, 30_000).astype(float)
    df = spark.createDataFrame([(float(a), float(b) if b else None) for a, b in zip(x, y)], "x double, y double")
    probs = [0.0, 0.003, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = sc.exact_quantiles(df.repartition(8), ["x", "y"], probs).first()
    for c, vals in (("x", x), ("y", y[y > 0])):
        for p in probs:
            assert got[sc.quantile_name(c, p)] == pytest.approx(np.quantile(vals, p), rel=1e-12)


def test_ids_stay_over_loads(spark):
    """A second load numbers only what is new, and a third without new texts nothing."""
    schema = "ID string, Weather_Condition string"
    first = spark.createDataFrame([("A-5", "Rain"), ("A-9", None), ("A-7", "Fog")], schema)
    one = st.build_dim_weather(first)
    second = first.where("ID != 'A-5'").union(spark.createDataFrame([("A-1", "Snow"), ("A-2", "Ice"), ("A-3", "Fog")], schema))
    two = st.build_dim_weather(second, kept=one)
    got = {r.Weather_Condition: r.weather_id for r in two.collect()}
    assert got == {"Rain": "W1", "Fog": "W2", None: "W3", "Snow": "W4", "Ice": "W5"}
    placed = second.select("*", F.lit("s").alias("Street"), F.lit("c").alias("City"), F.lit(None).cast("timestamp_ntz").alias("Start_Time"))
    three = st.build_dimensions(placed, dims=("weather",), kept_weather=two)
    assert {r.Weather_Condition: r.weather_id for r in three["dim_weather"].collect()} == got


def test_a_second_run_keeps_ids(spark):
    source, out = (scratch_path(spark, n) for n in ("raw", "etl"))
    rows = fx.incidents(spark, SF_SMALL)
    rows.where("Weather_Condition is null or Weather_Condition > 'G'").write.parquet(source)
    run = lambda: jobs.run_etl(spark, source, out, SETTINGS, fmt="parquet", with_profile=False, keep_ids=True)
    before = {r.Weather_Condition: r.weather_id for r in run().star.dim_weather.collect()}
    rows.write.mode("overwrite").parquet(source)
    done = run()
    after = {r.Weather_Condition: r.weather_id for r in done.star.dim_weather.collect()}
    assert len(after) > len(before) > 3 and before.items() <= after.items()
    assert sorted(int(i[1:]) for i in after.values()) == list(range(1, len(after) + 1))
    assert done.report.where("name = 'star' and status = 'PASS'").count() == 1


def test_duplicates_by_hashes_first(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(40), rng.choice("ab"), None if rng.random() < 0.1 else 1.5) for _ in range(300)]
    df = spark.createDataFrame(rows, "a long, b string, c double")
    assert pf.duplicate_count(df).first().duplicates == len(rows) - len(set(rows))
    once = pf.duplicate_count(df.distinct())
    assert once.first().duplicates == 0
    # nothing occurs twice, so no row is read again
    assert "Scan ExistingRDD" not in once._jdf.queryExecution().executedPlan().toString()
    assert pf.duplicate_count(df.where("a < 0")).first().duplicates == 0
