"""Sums of doubles against exact rational arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from wayside.operators import aggregates as agg
from wayside.operators import exact
from wayside.operators import scale as sc


def nearest(values):
    total = sum(map(Fraction, values), Fraction(0))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def close(got, want):
    """The same double, or its neighbour."""
    return got == want or abs(got - want) <= max(math.ulp(want), math.ulp(0.0))


def frame(spark, values, parts=1):
    rows = [(i, i % 3, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i long, g long, x double").repartition(parts)


SETS = {
    "similar": lambda r: r.uniform(-1000, 1000),
    "tiny": lambda r: r.uniform(0, 9) * 1e-7,
    "huge": lambda r: r.uniform(-9, 9) * 1e33,
    "mixed": lambda r: r.choice([-1, 1]) * 10 ** r.uniform(-300, 300),
    "denormal": lambda r: r.randrange(-50, 50) * 5e-324,
    "whole range": lambda r: r.choice([5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, 0.0]),
    "powers": lambda r: r.choice([-1, 1]) * 2.0 ** r.randrange(-60, 60),
}


@pytest.mark.parametrize("kind", sorted(SETS))
@pytest.mark.parametrize("parts", [1, 7])
def test_sums(spark, kind, parts):
    rng = random.Random(kind)
    values = [SETS[kind](rng) for _ in range(300)]
    got = {r.g: r.s for r in exact.sum_by(frame(spark, values, parts), ["g"], "x", "s").collect()}
    for g in range(3):
        assert close(got[g], nearest(values[g::3]))


def test_order_does_not_matter(spark):
    rng = random.Random(1)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-20, 20) for _ in range(500)]
    found = set()
    for k in range(3):
        rng.shuffle(values)
        found.add(exact.sum_by(frame(spark, values, 1 + 3 * k), [], "x", "s").first().s)
    assert len(found) == 1 and close(found.pop(), nearest(values))


@pytest.mark.parametrize("kind", ["similar", "huge", "denormal", "powers"])
def test_few_limbs_are_put_together_without_arrays(spark, kind, monkeypatch):
    rng = random.Random(kind)
    df = frame(spark, [*[SETS[kind](rng) for _ in range(300)], None, 0.0])
    found = []
    for most in (exact.PLAIN, 0):
        monkeypatch.setattr(exact, "PLAIN", most)
        sums = exact.sum_by(df, ["i"], "x", "s").union(exact.sum_by(df, ["g"], "x", "s"))
        plan = sums._jdf.queryExecution().optimizedPlan().toString()
        assert ("lambda" in plan) == (most == 0)
        found.append(sorted((r.i, repr(r.s)) for r in sums.collect()))
    assert found[0] == found[1]


def test_what_cancels_is_gone(spark):
    values = [1e300, 1.0, -1e300, 1e-300, -1.0]
    assert exact.sum_by(frame(spark, values), [], "x", "s").first().s == 1e-300
    assert exact.sum_by(frame(spark, [0.1] * 10 + [-1.0]), [], "x", "s").first().s == nearest([0.1] * 10 + [-1.0])


@settings(max_examples=12, deadline=None)
@given(hs.lists(hs.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=12))
def test_any_doubles(spark, values):
    assert close(exact.sum_by(frame(spark, values), [], "x", "s").first().s, nearest(values))


@pytest.mark.parametrize(
    "values,want",
    [([1.0, math.inf], math.inf), ([-math.inf, 5.0], -math.inf), ([math.inf, -math.inf], math.nan), ([math.nan, 1.0], math.nan),
     ([None, None], None), ([None, 2.5], 2.5), ([], None), ([0.0, -0.0], 0.0), ([1.7e308, 1.7e308], math.inf)],
)
def test_special_values(spark, values, want):
    got = exact.sum_by(frame(spark, values), [], "x", "s").first().s
    assert got == want or (want is not None and math.isnan(want) and math.isnan(got))


@pytest.mark.parametrize("kind", ["similar", "mixed", "tiny"])
def test_running_totals(spark, kind):
    rng = random.Random(kind)
    values = [None if k % 9 == 0 else SETS[kind](rng) for k in range(400)]
    key, found = "spark.sql.adaptive.coalescePartitions.enabled", []
    before = spark.conf.get(key)
    for merge in ("true", "false"):
        spark.conf.set(key, merge)
        got = sc.running_total(frame(spark, values, 5), ["i"], "x", "cum", by=["g"])
        assert got.columns == ["i", "g", "x", "cum"]
        found.append({r.i: r.cum for r in got.collect()})
    spark.conf.set(key, before)
    assert found[0] == found[1]
    for i, got in found[0].items():
        upto = [v for k, v in enumerate(values) if k % 3 == i % 3 and k <= i and v is not None]
        assert got is None if not upto else close(got, nearest(upto))


@pytest.mark.parametrize("unit", [1e-7, 1e33, 1e-300, 0.1])
def test_pareto_of_fractions(spark, unit):
    values = [(f"g{k:02d}", unit * (1 + k % 7)) for k in range(20)]
    rows = agg.pareto(spark.createDataFrame(values, "g string, v double"), "g", "v").collect()
    total = nearest([v for _, v in values])
    order = sorted(values, key=lambda r: (-r[1], r[0]))
    assert {r.g: r.v for r in rows} == dict(values)
    for k, (g, v) in enumerate(order):
        row = next(r for r in rows if r.g == g)
        upto = nearest([x for _, x in order[: k + 1]])
        assert row.Percentage == pytest.approx(100 * v / total, rel=1e-12)
        assert row.Cumulative_Percentage == pytest.approx(100 * upto / total, rel=1e-12)
        assert row.Pareto_Group == ("Top_80%" if row.Cumulative_Percentage <= 80 else "Bottom_20%")


def test_shares_of_all_magnitudes_at_once(spark):
    values = [("a", 1e33), ("b", 1e-7), ("c", 2e-7), ("d", 3e33)]
    df = spark.createDataFrame(values, "g string, v double")
    for part in (df, df.repartition(4)):
        rows = {r.g: r for r in agg.running_share(part, "v", "g", "share", "running").collect()}
        assert rows["d"].share == 75.0 and rows["a"].running == 100.0
        assert rows["b"].share == pytest.approx(2.5e-39, rel=1e-12) and rows["c"].share == pytest.approx(5e-39, rel=1e-12)


def test_whole_numbers_stay(spark):
    df = spark.createDataFrame([("a", 3), ("a", 4), ("b", 1)], "g string, v long")
    assert sorted(map(tuple, exact.sum_by(df, ["g"], "v", "v").collect())) == [("a", 7), ("b", 1)]
    assert dict(agg.pareto(df, "g", "v").dtypes)["v"] == "bigint"
    floats = df.select("g", (F.col("v") / 10).cast("float").alias("v"))
    assert dict(agg.pareto(floats, "g", "v").dtypes)["v"] == "double"
