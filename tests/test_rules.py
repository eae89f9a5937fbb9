"""Rule engine, assertions, reconciliation and the whole job."""

import dataclasses
import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from gate import fixtures as fx
from gate.fixtures import SETTINGS
from tests.conftest import SF_MID, SF_SMALL
from wayside import config as cfg
from wayside.operators import aggregates as agg
from wayside.operators import cleaning as cl
from wayside.operators import profiling as pf
from wayside.operators import reconcile as rc
from wayside.operators import rules as ru
from wayside.operators import star as st
from wayside.plans import jobs
from wayside.session import scratch_path, shared_dir
from wayside.sources import tables as io


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, 10.0, "a", None), (2, 20.0, "b", None), (2, None, "c", None)],
        "k int, x double, s string, nothing double",
    )


def verdicts(df):
    return {(r["column"], r["check"]): (r["passed"], r["actual"]) for r in df.collect()}


def test_every_check(table):
    rules = {
        "k": {"unique": True, "min": 1, "max": 2, "null_pct_max": 0},
        "x": {"min": 11, "null_pct_max": 0.4},
        "s": {"values": ["a", "b"]},
        "nothing": {"min": 0, "max": 1, "unique": True, "null_pct_max": 0.5},
        "absent": {"min": 0},
    }
    got = verdicts(ru.check_rules(table, "t", rules))
    assert got == {
        ("k", "unique"): (False, "2/3"),
        ("k", "min"): (True, "1.0"),
        ("k", "max"): (True, "2.0"),
        ("k", "null_pct"): (True, "0.0%"),
        ("x", "min"): (False, "10.0"),
        ("x", "null_pct"): (True, "33.3%"),
        ("s", "values"): (False, "1"),
        # no value at all fails a bound, but is no duplicate
        ("nothing", "min"): (False, "null"),
        ("nothing", "max"): (False, "null"),
        ("nothing", "unique"): (True, "0/0"),
        ("nothing", "null_pct"): (False, "100.0%"),
        ("absent", "exists"): (False, "missing"),
    }


def test_raise_on_fail_carries_only_failures(table):
    with pytest.raises(ru.ValidationError) as e:
        ru.check_rules(table, "t", {"x": {"min": 11, "max": 99}}, raise_on_fail=True)
    assert [r["check"] for r in e.value.failed] == ["min"]
    ru.check_rules(table, "t", {"x": {"max": 99}}, raise_on_fail=True)


def test_assert_range(table):
    ru.assert_range(table, "x", 0, 100)
    ru.assert_range(table, "absent", 0, 1)
    with pytest.raises(AssertionError):
        ru.assert_range(table, "x", hi=15)


def test_percentages(spark):
    df = spark.createDataFrame(
        [("a", 60.0), ("a", 40.0), ("b", 50.0), ("b", 20.0)], "g string, p double"
    )
    got = verdicts(ru.check_percentages(df, "p", True, "g"))
    assert got[("p", "sums_to_100")] == (False, "1")
    fine = df.where(F.col("g") == "a")
    ru.assert_percentages(ru.check_percentages(fine, "p", True, "g"))
    ru.assert_percentages(ru.check_percentages(fine, "p", True))
    with pytest.raises(AssertionError):
        ru.assert_percentages(ru.check_percentages(df.withColumn("p", F.col("p") * 2), "p"))


def test_null_keys_of_orphans(spark):
    fact = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "fk string")
    dim = spark.createDataFrame([("a",)], "pk string")
    both = spark.createDataFrame([("a",), (None,)], "pk string")
    assert tuple(st.orphan_count(fact, dim, "fk", "pk").first()) == (2, 2)
    assert tuple(st.orphan_count(fact, dim, "fk", "pk", skip_null=True).first()) == (1, 1)
    assert tuple(st.orphan_count(fact, both, "fk", "pk").first()) == (1, 1)
    assert sorted(r.fk or "" for r in st.orphans(fact, dim, "fk", "pk").collect()) == ["", "z"]


def test_cap_column_needs_its_column(table):
    with pytest.raises(ValueError):
        cl.cap_column(table, "Duration_min")


def test_optional_columns_may_be_absent(spark):
    df = spark.createDataFrame(
        [("A-1", 2, "2020-01-01 10:00:00", "2020-01-01 10:30:00", "S", "C"),
         ("A-2", 9, "2020-01-01 10:00:00", "2020-01-01 10:30:00", "S", None)],
        "ID string, Severity int, Start_Time string, End_Time string, Street string, City string",
    )
    got = jobs.clean(cl.filter_years(df, 2019, 2022)).collect()
    assert len(got) == 1
    assert got[0]["Duration_min"] == 30.0 and got[0]["Infra_Score"] == 0
    assert got[0]["Location_id"] == "S_C" and "Weather_Category" not in got[0].asDict()


def test_first_place_name_skips_nulls(spark):
    rows = [
        ("A-2", "S", "C", None, "T2", True), ("A-1", "S", "C", "OH", None, False),
        ("A-3", "S", "C", "IN", "T3", True),
    ]
    df = spark.createDataFrame(
        rows, "ID string, Street string, City string, State string, Timezone string, Stop boolean"
    )
    dim = st.build_dim_location(df).first()
    assert (dim["Location_id"], dim["State"], dim["Timezone"], dim["Stop"]) == ("S_C", "OH", "T2", 2)


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame(
        [("1", "OH", "C", "Stop"), ("2", "OH", "C", "Amenity"), ("3", "OH", "D", "Stop")],
        "ID string, State string, City string, dominant_infra string",
    ).withColumns({"Severity": F.lit(2), "Duration_min": F.lit(5.0)})
    got = {r.City: r.dominant_infra for r in agg.agg_city_by_state(df).collect()}
    assert got == {"C": "Amenity", "D": "Stop"}


def test_single_row_year_has_z_zero(spark):
    df = spark.createDataFrame([("1", "OH", "C", 2020)], "ID string, State string, City string, Year int")
    df = df.withColumns({"Severity": F.lit(4), "Duration_min": F.lit(5.0)})
    row = agg.agg_state_anomaly(df).first()
    assert row["national_std_severity"] is None
    assert row["severity_zscore"] == 0.0 and row["anomaly_category"] == "Normal"


def test_pareto_line(spark):
    df = spark.createDataFrame([("a", 80), ("b", 15), ("c", 5), (None, 50)], "g string, v int")
    got = {r.g: r.Pareto_Group for r in agg.pareto(df, "g", "v").collect()}
    assert got == {"a": "Top_80%", "b": "Bottom_20%", "c": "Bottom_20%"}
    crossing = spark.createDataFrame([("a", 81), ("b", 19)], "g string, v int")
    assert {r.Pareto_Group for r in agg.pareto(crossing, "g", "v").collect()} == {"Bottom_20%"}


def city_findings(spark, settings):
    df = jobs.clean(fx.filtered(spark, SF_MID), settings)
    known = df.where(F.col("State").isNotNull())
    star = jobs.build_star(known, settings)
    aggs = jobs.build_aggregates(star, settings)
    return rc.reconcile_city(aggs["agg_city_by_state"], known, settings=settings)


def test_two_part_key_moves_states_and_three_part_key_does_not(spark):
    short = city_findings(spark, SETTINGS)
    assert short.where(~F.col("passed")).count() > 0
    full = dataclasses.replace(SETTINGS, location_cols=("State", "City", "Street"))
    assert city_findings(spark, full).where(~F.col("passed")).count() == 0


def test_exploratory_fills(spark):
    df = spark.createDataFrame(
        [(10.0, None, None, None, "a"), (None, 5.0, "NE", 2.0, None), (30.0, 7.0, None, None, "b")],
        "`Temperature(F)` double, `Wind_Chill(F)` double, Wind_Direction string,"
        " `Precipitation(in)` double, Weather_Condition string",
    )
    got = sorted(tuple(r) for r in cl.impute_exploratory(df).collect())
    assert got == [
        (10.0, 10.0, "Unknown", 0.0, "a"),
        (20.0, 5.0, "NE", 2.0, "Unknown"),
        (30.0, 7.0, "Unknown", 0.0, "b"),
    ]


def test_wind_directions(spark):
    df = spark.createDataFrame([("N",), ("Calm",), ("north",), (None,)], "Wind_Direction string")
    bad = cl.rows_outside_domain(df, "Wind_Direction", cfg.WIND_DIRECTIONS)
    assert sorted(r[0] or "" for r in bad.collect()) == ["", "north"]


def test_sample_validation(spark):
    df = fx.cleaned(spark, SF_SMALL)
    aggs = jobs.build_aggregates(jobs.build_star(df, SETTINGS), SETTINGS)
    every = jobs.validate_outputs(df, aggs, SETTINGS)
    some = jobs.validate_outputs(df, aggs, SETTINGS, [("CHINA", "BUILDING")], ["CHINA"])
    assert 0 < some.count() < every.count()
    assert set(some.select("stage").distinct().toPandas()["stage"]) == set(
        every.select("stage").distinct().toPandas()["stage"]
    )


def test_reconcile_samples(spark):
    base = spark.createDataFrame(
        [("1", "CA", "Los Angeles", 3), ("2", "CA", "Los Angeles", 1), ("3", "CA", "Fresno", 1)],
        "ID string, State string, City string, Severity int",
    ).withColumns({"Weather_Condition": F.lit("Fair"), "Duration_min": F.lit(1.0)})
    right = base.withColumn("dominant_infra", F.lit("None"))
    cities = agg.agg_city_by_state(right)
    found = rc.reconcile_city(cities, base, cfg.SAMPLE_CITIES, cfg.SAMPLE_STATES)
    rows = found.collect()
    # samples without rows are skipped
    assert {r["column"] for r in rows} == {"CA / Los Angeles", "CA", "pct_of_state"}
    assert all(r["passed"] for r in rows)
    wrong = cities.withColumn("total_accidents", F.col("total_accidents") + 1)
    bad = rc.reconcile_city(wrong, base).where(~F.col("passed"))
    assert {r["check"] for r in bad.collect()} == {"total_accidents", "sum_of_cities"}


def test_quality_report(spark):
    found = spark.createDataFrame(
        [(True, "a"), (True, "a"), (True, "b"), (False, "b")], "passed boolean, stage string"
    )
    got = {r["name"]: r["status"] for r in rc.quality_report(found).collect()}
    assert got == {"a": "PASS", "b": "FAIL", "OVERALL": "FAIL"}


def test_totals_add_up(spark):
    """Sums over the groups of an aggregate and over the rows are the same."""
    df = fx.cleaned(spark, SF_SMALL)
    star = jobs.build_star(df, SETTINGS)
    aggs = jobs.build_aggregates(star, SETTINGS)
    n = df.count()
    for name in ("agg_federal", "agg_time_pattern"):
        assert aggs[name].agg(F.sum("total_accidents")).first()[0] == n
    shares = aggs["agg_city_by_state"].groupBy("State").agg(F.sum("pct_of_state").alias("s"))
    assert shares.where(~F.col("s").between(99.9, 100.1)).count() == 0
    ru.assert_range(aggs["agg_weather_by_state"], "severity_increase_pct", lo=0)
    ru.assert_range(star.accident_detail, "Duration_min", 0, 1440)


def test_whole_job_from_parquet(spark):
    source, out = scratch_path(spark, "raw"), scratch_path(spark, "etl")
    fx.incidents(spark, SF_SMALL).write.parquet(source)
    done = jobs.run_etl(spark, source, out, SETTINGS, fmt="parquet")
    assert done.cleaned.count() == fx.cleaned(spark, SF_SMALL).count()
    assert set(done.aggregates) == {
        "agg_federal", "agg_state_anomaly", "agg_city_by_state", "agg_weather_by_state",
        "agg_time_pattern",
    }
    assert spark.read.parquet(f"{out}/profile/top_states").count() == 10
    assert done.report.where(F.col("name") == "star").first()["status"] == "PASS"
    assert io.read_star(spark, out).dim_weather.count() == 9


def test_the_source_is_parsed_once_and_scratch_tables_go(spark):
    source, out = scratch_path(spark, "raw"), scratch_path(spark, "etl")
    io.write_table(fx.incidents(spark, SF_SMALL), source, "csv")
    shared = pathlib.Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    reads = []
    read = io.read_incidents
    jobs.read_incidents = lambda *a, **k: reads.append(a) or read(*a, **k)
    try:
        done = jobs.run_etl(spark, source, out, SETTINGS)
    finally:
        jobs.read_incidents = read
    assert len(reads) == 1
    assert {p.name.rpartition("-")[0] for p in set(shared.iterdir()) - before} <= {"etl"}
    assert spark.read.parquet(f"{out}/profile/bad_records").first().n_bad == 0
    assert done.report.where("status = 'FAIL'").count() >= 0


def test_a_failing_check_leaves_the_old_table(spark):
    out = scratch_path(spark, "etl")
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    fx.incidents(spark, SF_SMALL).write.parquet(good)
    untimed = F.lit(None).cast("timestamp_ntz")
    fx.incidents(spark, SF_SMALL).withColumn("End_Time", untimed).write.parquet(bad)
    n = jobs.run_etl(spark, good, out, SETTINGS, fmt="parquet", with_profile=False).cleaned.count()
    with pytest.raises(ru.ValidationError):
        jobs.run_etl(spark, bad, out, SETTINGS, fmt="parquet", with_profile=False)
    left = spark.read.parquet(f"{out}/cleaned")
    assert left.count() == n == left.where("Duration_min is not null").count()


def test_bad_stars_and_aggregates_raise(spark):
    star = jobs.build_star(fx.cleaned(spark, SF_SMALL), SETTINGS)
    twice = dataclasses.replace(star, dim_weather=star.dim_weather.union(star.dim_weather))
    with pytest.raises(ru.ValidationError, match="weather_id"):
        jobs.verify_star(twice, SETTINGS)
    lost = dataclasses.replace(star, dim_location=star.dim_location.limit(3))
    with pytest.raises(ru.ValidationError, match="Location_id"):
        jobs.verify_star(lost, SETTINGS)
    aggs = jobs.build_aggregates(star, SETTINGS)
    jobs.verify_aggregates(aggs)
    weather = aggs["agg_weather_by_state"].withColumn("severity_increase_pct", F.lit(1.0))
    with pytest.raises(ru.ValidationError, match="severity_increase_pct"):
        jobs.verify_aggregates(aggs | {"agg_weather_by_state": weather})
    cities = aggs["agg_city_by_state"].withColumn("pct_of_state", F.lit(101.0))
    with pytest.raises(ru.ValidationError, match="pct_of_state"):
        jobs.verify_aggregates(aggs | {"agg_city_by_state": cities})


def test_rules_compare_by_type(spark):
    df = spark.createDataFrame(
        [(True, 1.0, 1, "2020-01-01"), (False, 2.0, 2, "2021-01-01")], "b boolean, x double, n int, s string"
    ).withColumns({"d": F.col("x").cast("decimal(8,2)"), "t": F.col("s").cast("timestamp_ntz")})
    rules = {
        "b": {"values": {True, False}}, "x": {"values": {1, 2}}, "d": {"values": {1, 2}}, "n": {"values": {1, 2.0}},
        "t": {"min": "2020-01-01", "max": dt.datetime(2022, 1, 1)}, "s": {"values": {"2020-01-01", "2021-01-01"}},
    }
    assert ru.check_rules(df, "s", rules).where(~F.col("passed")).collect() == []
    wrong = {"b": {"values": {True}}, "x": {"values": {1}}, "t": {"min": 3, "max": "2020-06-01"}, "s": {"max": 4}}
    found = {(r["column"], r["check"]): r["passed"] for r in ru.check_rules(df, "s", wrong).collect()}
    assert found == {k: False for k in (("b", "values"), ("x", "values"), ("t", "min"), ("t", "max"), ("s", "max"))}


def test_absent_percentages_are_skipped(spark):
    df = spark.createDataFrame([(50.0,), (50.0,)], "p double")
    for total in (False, True):
        assert ru.check_percentages(df, "absent", sum_to_100=total).collect() == []
        assert ru.check_percentages(df, "p", sum_to_100=total).where(~F.col("passed")).collect() == []


def test_profile_of_any_table(spark):
    df = spark.createDataFrame([("b", 2), ("a", None)], "lat string, n int")
    got = {r["column"]: (r.type, r.non_null, r["sample"], r.is_location) for r in pf.column_profile(df).collect()}
    assert got == {"lat": ("string", 2, "a", True), "n": ("int", 1, "2", False)}


def test_duplicates_are_compared_in_full(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (None, "a"), (1, None), (2, "b")], "n int, s string")
    assert pf.duplicate_count(df).first()[0] == 2
    assert pf.duplicate_count(df, ["n"]).first()[0] == 3
    monkeypatch.setattr(pf.F, "xxhash64", lambda *c: F.lit(1).cast("long"))  # all hashes collide
    assert pf.duplicate_count(df).first()[0] == 2


def test_narrow_types(spark):
    df = spark.createDataFrame(
        [(1, 300, 70000, 2**40, 1.5, None), (-128, -300, 0, 0, 2.5, None)],
        "a long, b long, c long, d long, x double, e int",
    )
    assert dict(cl.narrow_types(df).dtypes) == {
        "a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "x": "double", "e": "int",
    }
    assert dict(cl.narrow_types(df, floats=True).dtypes)["x"] == "float"
