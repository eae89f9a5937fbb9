"""Every registered query against its SQL on the given tables."""

import pytest

from gate.compare import compare, connect
from gate.queries import ORACLE, QUERIES
from tests.conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def small():
    return connect(SF_SMALL)


@pytest.fixture(scope="module")
def mid():
    return connect(SF_MID)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_small(spark, small, name):
    assert compare(spark, small, SF_SMALL, QUERIES[name], ORACLE.get(name)) == []


# keys that span several states exist only from this size on
@pytest.mark.parametrize(
    "name",
    ["a2_agg_state_anomaly", "a3_agg_city_by_state", "a6_build_dim_location", "q17_quality_report"],
)
def test_mid(spark, mid, name):
    assert compare(spark, mid, SF_MID, QUERIES[name], ORACLE[name]) == []


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


def test_sample_head(spark):
    from gate.fixtures import incidents
    from wayside.operators.aggregates import sample_head

    assert sample_head(incidents(spark, SF_SMALL), 100).count() == 100
