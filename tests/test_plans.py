"""The physical plans: pushed filters, pruned columns, no Python, no cross join."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from gate import fixtures as fx
from gate.fixtures import SETTINGS
from gate.queries import QUERIES
from tests.conftest import SF_SMALL
from wayside.operators import aggregates as agg
from wayside.operators import cleaning as cl
from wayside.operators import scale as sc
from wayside.operators import star as st
from wayside.plans import jobs
from wayside.session import scratch_path
from wayside.sources import tables as io


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "stored-incidents")
    fx.incidents(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_year_filter_reaches_the_scan(stored):
    text = plan(cl.filter_years(stored, 1996, 1999).select("ID", "Year"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(Start_Time" in pushed and "LessThan(Start_Time" in pushed
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert schema == "ID:string,Start_Time:timestamp_ntz"


def test_aggregate_reads_only_its_columns(stored):
    df = jobs.clean(cl.filter_years(stored, 1996, 1999), SETTINGS)
    text = plan(agg.count_by(df, ["State"]))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "Temperature" not in schema and "Description" not in schema


def jobs_started(spark, make):
    """Spark jobs that ``make()`` starts."""
    group = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = make()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unused_medians_cost_nothing(spark, stored):
    df, n = jobs_started(spark, lambda: cl.impute_median(stored))
    assert n == 0
    assert "Subquery" in plan(df)
    assert "Subquery" not in plan(df.select("ID"))


def test_cleaning_starts_no_job(spark, stored):
    _, n = jobs_started(spark, lambda: jobs.clean(cl.filter_years(stored, 1996, 1999), SETTINGS))
    assert n == 0


def test_small_dimensions_are_broadcast(spark):
    star = fx.star(spark, SF_SMALL)
    text = plan(st.star_join(star, SETTINGS))
    assert "SortMergeJoin" not in text


def test_large_dimensions_are_not(spark):
    star = fx.star(spark, SF_SMALL)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        df = agg.star_rollup(star, ("State", "Weather_Category"), SETTINGS)
        assert plan(df).count("SortMergeJoin") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_dashboards_read_rows_once(spark, stored):
    """A2-A4 called on rows write their roll-up first and read that twice."""
    star = fx.star(spark, SF_SMALL)
    joined = st.star_join(star, SETTINGS)
    for f in (agg.agg_state_anomaly, agg.agg_city_by_state, agg.agg_weather_by_state):
        text = plan(f(joined, SETTINGS))
        assert "full_date" not in text and "Start_Time" not in text


LAZY = sorted(QUERIES)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval"):
        assert bad not in text


def test_rows_are_never_ordered_in_one_task(spark):
    """Windows without a partition key appear only above an aggregate or a written table."""
    for name in ("a1_agg_federal", "w1_yoy_change", "a15_pareto", "w4_surrogate_id"):
        text = plan(QUERIES[name](spark, SF_SMALL))
        at = text.find("Window [")
        if at >= 0:
            assert "HashAggregate" in text[at:] or "/part-" in text[at:]


def test_hot_key_is_counted_before_it_is_shuffled(stored):
    text = plan(st.orphan_count(stored, stored.where(F.col("Severity") == 1), "City", "City"))
    assert "partial_count" in text


@pytest.mark.parametrize("name", ["p4_impute_median", "p13_cap_iqr", "p14_drop_iqr_outliers", "q6_box_summary", "a13_urban_rural"])
def test_quantiles_are_planned_once(spark, name):
    """However often a quantile is used, its plan is there once, and rows are sketched once."""
    text = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    used = re.findall(r"scalar-subquery#(\d+)", text)
    assert len(set(used)) == 1


def test_only_values_near_a_quantile_are_shuffled(spark, stored):
    df = sc.exact_quantiles(stored, ["Temperature(F)"], [0.5])
    assert "kll_sketch" in plan(df).lower()


def test_a_bracket_that_misses_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(sc, "FEW", 10)
    monkeypatch.setattr(sc, "SKETCH", 8)
    monkeypatch.setattr(sc, "MARGIN", 1e-9)
    df = spark.range(50_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("x"))
    with pytest.raises(Exception, match="outside its bracket"):
        sc.exact_quantiles(df, ["x"], [0.1, 0.3, 0.5, 0.7, 0.9]).collect()


def test_a_bucketed_star_joins_without_moving_the_fact(spark):
    star = fx.star(spark, SF_SMALL)
    prefix = f"star_{uuid.uuid4().hex}"
    io.write_bucketed_star(star, scratch_path(spark, "bucketed"), prefix, 4)
    stored = io.read_bucketed_star(spark, prefix)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        joined = stored.accident_detail.join(stored.dim_location, "Location_id")
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        lost = stored.accident_detail.join(stored.dim_location, "Location_id", "left_anti")
        assert "Exchange" not in plan(lost) and lost.count() == 0
        plain = star.accident_detail.join(star.dim_location, "Location_id")
        assert "Exchange" in plan(plain)
        assert joined.count() == plain.count() == star.accident_detail.count()
        assert st.star_join(stored, SETTINGS).count() == joined.count()
    finally:
        spark.conf.set(key, before)
        for name in star.tables():
            spark.sql(f"DROP TABLE {prefix}_{name}")
