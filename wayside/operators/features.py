"""Derived columns of the cleaned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.config import (
    DEFAULT,
    FOG_WORDS,
    HOURS_CLEANING,
    INFRA_COLS,
    RAIN_WORDS,
    SNOW_WORDS,
    HourScheme,
    Settings,
)
from wayside.functions.numeric import high_severity_flag, infra_score, low_visibility_flag
from wayside.functions.temporal import (
    day_name,
    day_name_from_index,
    day_of_week,
    hour_bucket,
    is_rush_hour,
    is_weekend,
)
from wayside.functions.text import category_of, flag_of, location_key, lowered
from wayside.operators.cleaning import present
from wayside.operators.scale import SCALARS, exact_quantiles, quantile_name, scalar, with_scalars


def add_time_features(
    df: DataFrame, ts: str = "Start_Time", scheme: HourScheme = HOURS_CLEANING
) -> DataFrame:
    # labels come in a second step, so that hour and weekday are computed once per row
    parts = df.withColumns(
        {
            "Year": F.year(ts),
            "Month": F.month(ts),
            "Day": F.dayofmonth(ts),
            "Hour": F.hour(ts),
            "DayOfWeek": day_of_week(ts),
            "Quarter": F.quarter(ts),
        }
    )
    return parts.withColumns(
        {
            "DayName": day_name_from_index("DayOfWeek"),
            "Time_Period": hour_bucket("Hour", scheme),
            "Is_Rush_Hour": is_rush_hour("Hour"),
            "Is_Weekend": is_weekend("DayOfWeek"),
        }
    )


def add_weather_features(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    new: dict[str, Column] = {}
    if "Weather_Condition" in df.columns:
        # the text is lowered once for all lookups
        df = df.withColumn("__low", lowered("Weather_Condition"))
        low = F.col("__low")
        new["Weather_Category"] = category_of(low, settings.weather_rules_clean, "Clear")
        new["Is_Rain"] = flag_of(low, RAIN_WORDS)
        new["Is_Snow"] = flag_of(low, SNOW_WORDS)
        new["Is_Fog"] = flag_of(low, FOG_WORDS)
    if "Visibility(mi)" in df.columns:
        new["Low_Visibility"] = low_visibility_flag("Visibility(mi)", settings.low_visibility)
    return df.withColumns(new).drop("__low") if new else df


def add_infra_score(
    df: DataFrame, cols: Sequence[str] = INFRA_COLS, out: str = "Infra_Score"
) -> DataFrame:
    return df.withColumn(out, infra_score(present(df, cols)))


def add_high_severity(
    df: DataFrame, settings: Settings = DEFAULT, out: str = "Is_High_Severity"
) -> DataFrame:
    return df.withColumn(out, high_severity_flag("Severity", settings.high_severity))


def add_location_key(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return df.withColumn("Location_id", location_key(settings.location_cols, settings.location_sep))


def urban_rural(
    df: DataFrame, score: str = "Infra_Score", out: str = "Urban_Rural", accuracy: int | None = None
) -> DataFrame:
    """'Urban' from the median score upwards, else 'Rural'."""
    if score not in df.columns:
        df = add_infra_score(df, out=score)
    urban = F.col(score) >= scalar(quantile_name(score, 0.5))
    marked = with_scalars(df, exact_quantiles(df, [score], [0.5], accuracy))
    return marked.withColumn(out, F.when(urban, "Urban").otherwise("Rural")).drop(SCALARS)


def date_dimension(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day from ``start`` to ``end`` of a one-row frame."""
    days = bounds.select(
        F.explode(
            F.sequence(
                F.col(start).cast("date"), F.col(end).cast("date"), F.expr("interval 1 day")
            )
        ).alias("Date")
    )
    return days.select(
        "Date",
        F.year("Date").alias("Year"),
        F.quarter("Date").alias("Quarter"),
        F.month("Date").alias("Month"),
        F.date_format("Date", "MMMM").alias("Month_Name"),
        F.weekofyear("Date").alias("Week"),
        F.dayofmonth("Date").alias("Day"),
        day_of_week("Date").alias("DayOfWeek"),
        day_name("Date").alias("DayOfWeek_Name"),
        is_weekend(day_of_week("Date")).alias("Is_Weekend"),
        F.lit(0).alias("Is_Holiday"),
    )
