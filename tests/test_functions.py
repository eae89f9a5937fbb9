"""Edge values of the Column expressions."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayside import config as cfg
from wayside.functions import numeric as num
from wayside.functions import temporal as tm
from wayside.functions import text as tx


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def one(spark, schema, rows):
    return spark.createDataFrame(rows, schema).coalesce(1)


def test_round_even_is_numpy_round(spark):
    xs = [0.5, 1.5, 2.5, -0.5, 2.675, 1.005, 0.125, 0.375, 1e6 + 0.005, -3.145, None]
    df = one(spark, "x double", [(x,) for x in xs])
    for d in (0, 1, 2, 3):
        got = values(df, num.round_even("x", d))
        want = [None if x is None else float(np.round(x, d)) for x in xs]
        assert got == want


def test_division_by_zero_is_null_not_an_error(spark):
    df = one(spark, "a double, b double", [(1.0, 0.0), (1.0, None), (None, 2.0), (3.0, 2.0)])
    assert values(df, num.pct_change("a", "b")) == [None, None, None, 50.0]
    assert values(df, num.impact_pct("a", "b")) == [0.0, 0.0, None, 50.0]
    assert values(df, num.z_score("a", F.lit(1.0), "b")) == [0.0, 0.0, 0.0, 1.0]


def test_clip_keeps_null(spark):
    df = one(spark, "x double", [(None,), (-30.0,), (5.0,), (200.0,)])
    assert values(df, num.clip_to("x", F.lit(-20.0), F.lit(120.0))) == [None, -20.0, 5.0, 120.0]


def test_flags_give_zero_for_null(spark):
    df = one(spark, "s int, v double, w string", [(None, None, None), (3, 0.5, "ICE pellets")])
    assert values(df, num.high_severity_flag("s")) == [0, 1]
    assert values(df, num.low_visibility_flag("v")) == [0, 1]
    assert values(df, tx.keyword_flag("w", cfg.SNOW_WORDS)) == [0, 1]


def test_weather_rule_order_decides(spark):
    texts = [("Patches of Fog / Rain",), ("Cloudy / Windy",), ("Fair",), ("Sunny",), (None,)]
    df = one(spark, "w string", texts)
    assert values(df, tx.categorize_text("w", cfg.WEATHER_RULES_AGGREGATE)) == [
        "Foggy", "Windy", "Clear", "Clear", "Clear",
    ]
    assert values(df, tx.categorize_text("w", cfg.WEATHER_RULES_CLEANING)) == [
        "Rainy", "Cloudy", "Clear", "Clear", "Clear",
    ]
    assert values(df, tx.categorize_text("w", cfg.WEATHER_RULES_CHECKING)) == [
        "Fog", "Cloudy", "Clear", "Clear", "Clear",
    ]
    assert values(df, tx.categorize_text("w", cfg.WEATHER_RULES_BROAD, "Other", "Clear")) == [
        "Rain", "Cloudy", "Clear", "Other", "Clear",
    ]


@pytest.mark.parametrize(
    "scheme, at",
    [
        (cfg.HOURS_CLEANING, {5: "Night", 6: "Morning_Rush", 9: "Late_Morning", 12: "Lunch",
                                14: "Afternoon", 17: "Evening_Rush", 20: "Night"}),
        (cfg.HOURS_DASHBOARD, {9: "Morning", 13: "Lunch", 20: "Night"}),
        (cfg.HOURS_BROAD, {0: "Night", 12: "Afternoon", 15: "Evening_Rush", 18: "Evening",
                           21: "Late_Night"}),
        (cfg.HOURS_EXPLORATORY, {6: "Morning_Rush", 9: "Day", 16: "Day", 17: "Evening_Rush",
                              20: "Night"}),
    ],
)
def test_hour_schemes(spark, scheme, at):
    df = one(spark, "h int", [(h,) for h in at])
    assert values(df, tm.hour_bucket("h", scheme)) == list(at.values())


def test_dominant_feature_ties_and_zero(spark):
    df = one(
        spark,
        "Junction long, Traffic_Signal long, Crossing long, Stop long, Amenity long",
        [(1, 1, 0, 0, 0), (0, 0, 0, 2, 2), (0, 0, 0, 0, 0), (None, None, None, None, 4)],
    )
    assert values(df, num.dominant_feature()) == ["Junction", "Stop", "None", "Amenity"]
    assert values(df, num.weighted_infra_score()) == [5, 4, 0, 4]


def test_risk_score_and_labels(spark):
    rows = [
        ("Foggy", 20.0, 40.0), ("Snowy", 11.0, 16.0), ("Rainy", 5.0, 15.0),
        ("Clear", None, None), ("Storm", 6.0, 31.0),
    ]
    df = one(spark, "c string, s double, d double", rows)
    assert values(df, num.weather_risk_score("c", "s", "d")) == [10, 7, 3, 0, 4]
    assert values(df, num.weather_risk_score("c", "s", "d", 0)) == [10, 7, 3, 0, 3]
    scores = one(spark, "x int", [(8,), (7,), (6,), (4,), (3,), (None,)])
    assert values(scores, num.risk_category("x")) == [
        "Extreme", "High", "High", "Moderate", "Low", "Low",
    ]
    zs = one(spark, "z double", [(2.1,), (2.0,), (1.0,), (0.0,), (None,)])
    assert values(zs, num.anomaly_category("z")) == [
        "Critical", "High", "Elevated", "Normal", "Normal",
    ]


def test_severity_label(spark):
    df = one(spark, "s int", [(1,), (2,), (3,), (4,), (5,), (None,)])
    assert values(df, num.severity_label("s")) == [
        "Minor", "Moderate", "Serious", "Severe", "Unknown", "Unknown",
    ]


def test_bins_are_left_closed(spark):
    df = one(spark, "t double", [(-100.0,), (0.0,), (31.99,), (199.0,), (200.0,), (None,)])
    got = values(df, num.bin_label("t", cfg.TEMP_EDGES, cfg.TEMP_LABELS))
    labels = cfg.TEMP_LABELS
    assert got == [labels[0], labels[1], labels[1], labels[5], None, None]
    with pytest.raises(ValueError):
        num.bin_label("t", [0, 1], [])


def test_day_names_agree(spark):
    days = [(dt.datetime(2021, 3, d),) for d in range(1, 15)]
    df = one(spark, "t timestamp_ntz", days)
    assert values(df, tm.day_name("t")) == values(
        df, tm.day_name_from_index(tm.day_of_week("t"))
    )
    assert values(df, tm.day_of_week("t")) == [d[0].weekday() for d in days]


def test_minutes_ignore_the_session_zone(spark):
    rows = [
        (dt.datetime(2021, 3, 14, 1, 30), dt.datetime(2021, 3, 14, 3, 30)),
        (dt.datetime(2021, 3, 14, 2, 30), dt.datetime(2021, 3, 14, 2, 45, 30)),
        (dt.datetime(2021, 3, 15), dt.datetime(2021, 3, 14)),
        (dt.datetime(2021, 3, 15), None),
    ]
    df = one(spark, "s timestamp_ntz, e timestamp_ntz", rows)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(df, tm.minutes_between("s", "e")) == [120.0, 15.5, -1440.0, None]
        assert values(df, tm.duration_minutes("s", "e")) == [120.0, 15.5, 0.0, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_repaired_text(spark):
    rows = [
        ("2021-01-02 03:04:05.000000000", dt.datetime(2021, 1, 2, 3, 4, 5)),
        ("2021-01-02 03:04:05.000000", dt.datetime(2021, 1, 2, 3, 4, 5)),
        ("  2021-01-02 03:04:05 ", dt.datetime(2021, 1, 2, 3, 4, 5)),
        ("2021-01-02 03:04:05Z", dt.datetime(2021, 1, 2, 3, 4, 5)),
        ("2021-01-02 03:04:05.250", dt.datetime(2021, 1, 2, 3, 4, 5, 250000)),
        ("n/a", None),
        (None, None),
    ]
    df = one(spark, "t string, want timestamp_ntz", rows)
    got = values(df, tm.parse_timestamp(tm.repaired_text("t")))
    assert got == [r[1] for r in rows]


def test_location_key(spark):
    df = one(
        spark, "Street string, City string, State string", [("A", "B", "C"), (None, None, None)]
    )
    assert values(df, tx.location_key()) == ["A_B", "Unknown_Unknown"]
    assert values(df, tx.location_key(("State", "City", "Street"), "")) == [
        "CBA", "UnknownUnknownUnknown",
    ]
