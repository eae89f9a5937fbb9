"""Star schema: three dimensions, the fact table, and their joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.config import DEFAULT, INFRA_COLS, INFRA_WEIGHTS, PLACE_COLS, Settings
from wayside.functions.numeric import dominant_feature, weighted_infra_score
from wayside.functions.temporal import day_of_week
from wayside.functions.text import categorize_text, location_key
from wayside.operators.cleaning import add_duration, present, select_available, with_timestamps
from wayside.operators.scale import by_sets, running_total
from wayside.session import materialize

# The columns of the fact table, in their order.
FACT_COLS = (
    "ID",
    "Location_id",
    "weather_id",
    "full_date",
    "Start_Time",
    "End_Time",
    "Severity",
    "Duration_min",
    "Description",
)


DIMENSIONS = ("time", "location", "weather")


@dataclass(frozen=True)
class Star:
    """Fact and dimensions; a dimension nobody asked for is None."""

    accident_detail: DataFrame
    dim_time: DataFrame | None = None
    dim_location: DataFrame | None = None
    dim_weather: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        named = {
            "dim_time": self.dim_time,
            "dim_location": self.dim_location,
            "dim_weather": self.dim_weather,
            "accident_detail": self.accident_detail,
        }
        return {name: df for name, df in named.items() if df is not None}


def row_order(df: DataFrame) -> Column:
    """What 'first' means, for every row: its place among all rows.

    ``row_seq`` if there is one (unique; a null comes last). Else the number at the end of
    the ID, then the ID itself; IDs without a number come after all others.
    """
    if "row_seq" in df.columns:
        return F.coalesce(F.col("row_seq").cast("long"), F.lit(2**63 - 1))
    if "ID" not in df.columns:
        raise ValueError("the order of rows needs a column row_seq or ID")
    # 38 digits; a longer number counts as none, and the text decides
    number = F.regexp_extract("ID", r"(\d+)$", 1).try_cast("decimal(38,0)")
    return F.struct(number.isNull().alias("no_number"), number.alias("number"), F.coalesce("ID", F.lit("")).alias("id"))


def surrogate_id(df: DataFrame, first_seen: str, key: str, prefix: str, out: str) -> DataFrame:
    """``prefix`` + position by first appearance, on rows with distinct ``key``."""
    numbered = running_total(df.withColumn("__one", F.lit(1)), [first_seen, key], "__one", "__pos")
    return numbered.withColumn(
        out, F.concat(F.lit(prefix), F.col("__pos").cast("string"))
    ).drop("__one", "__pos")


def kept_ids(
    df: DataFrame, first_seen: str, key: str, prefix: str, out: str, kept: DataFrame | None
) -> DataFrame:
    """(key, out): the ids of ``surrogate_id``, except that those of ``kept`` stay.

    ``kept`` is the (key, out) of an earlier load. Its keys keep their ids, whether or not
    they occur again; keys it lacks are numbered from its highest id on, by first appearance.
    A null key matches a null key.
    """
    if kept is None:
        return surrogate_id(df, first_seen, key, prefix, out).select(key, out)
    old = kept.select(F.col(key).alias("__key"), F.col(out).alias("__id"))
    new = df.join(old, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    numbers = old.select(F.substring("__id", len(prefix) + 1, 20).cast("long").alias("n"))
    highest = F.coalesce(numbers.agg(F.max("n")).scalar(), F.lit(0))
    numbered = running_total(new.withColumn("__one", F.lit(1)), [first_seen, key], "__one", "__pos")
    named = F.concat(F.lit(prefix), (highest + F.col("__pos")).cast("string"))
    return old.toDF(key, out).union(numbered.select(key, named.alias(out)))


# ---------------------------------------------------------------- dimensions


def build_dim_time(df: DataFrame, ts: str = "Start_Time") -> DataFrame:
    days = with_timestamps(df, [ts]).select(F.to_date(ts).alias("Date")).distinct()
    return _dim_time(days)


def build_dim_location(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row per location: the first place names seen and the feature counts.

    Rows are first counted per distinct combination of names, which is a plain
    hash aggregate and leaves little to shuffle; 'first non-null' is then
    picked among those combinations.
    """
    places = present(df, PLACE_COLS)
    rows = _keyed(df, settings)
    return _dim_location(rows.groupBy("Location_id", *places).agg(*_seen(rows)), places)


def build_dim_weather(df: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """One row per weather text; the ids of an earlier dimension ``kept`` stay."""
    seen = df.groupBy("Weather_Condition").agg(F.min(row_order(df)).alias("__seq"))
    return _dim_weather(seen, kept)


def build_dimensions(
    df: DataFrame,
    settings: Settings = DEFAULT,
    dims: Sequence[str] = DIMENSIONS,
    kept_weather: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The wanted dimensions by table name, from one pass over the rows.

    Days and locations are their own keys; the ids of an earlier weather dimension stay.
    """
    places = present(df, PLACE_COLS)
    sets = {
        "dim_time": ("Date",),
        "dim_location": ("Location_id", *places),
        "dim_weather": ("Weather_Condition",),
    }
    sets = {name: keys for name, keys in sets.items() if name.removeprefix("dim_") in dims}
    if not sets:
        return {}
    rows = _keyed(with_timestamps(df), settings)
    seen = by_sets(rows, sets, _seen(rows))
    make = {
        "dim_time": lambda days: _dim_time(days.select("Date")),
        "dim_location": lambda combos: materialize(_dim_location(combos, places)),
        "dim_weather": lambda texts: _dim_weather(texts.select("Weather_Condition", "__seq"), kept_weather),
    }
    return {name: make[name](found) for name, found in seen.items()}


def _keyed(df: DataFrame, settings: Settings) -> DataFrame:
    return df.withColumns(
        {
            "Location_id": location_key(settings.location_cols, settings.location_sep),
            "Date": F.to_date("Start_Time" if "Start_Time" in df.columns else F.lit(None)),
            "__seq": row_order(df),
        }
    )


def _seen(df: DataFrame) -> list[Column]:
    flags = present(df, INFRA_COLS)
    return [F.min("__seq").alias("__seq"), *[F.count_if(F.col(c)).alias(c) for c in flags]]


def _dim_time(days: DataFrame) -> DataFrame:
    return days.select(
        "Date",
        F.dayofmonth("Date").alias("Day"),
        F.month("Date").alias("Month"),
        F.quarter("Date").alias("Quarter"),
        F.year("Date").alias("Year"),
    )


def _dim_location(combos: DataFrame, places: Sequence[str]) -> DataFrame:
    flags = present(combos, INFRA_COLS)
    return combos.groupBy("Location_id").agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("__seq"))).alias(c) for c in places],
        *[F.sum(c).alias(c) for c in flags],
    )


def _dim_weather(seen: DataFrame, kept: DataFrame | None) -> DataFrame:
    ids = kept_ids(seen, "__seq", "Weather_Condition", "W", "weather_id", kept)
    return ids.select("weather_id", "Weather_Condition")


# ---------------------------------------------------------------- fact


def attach_weather_id(df: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Left join on the weather text; a null text matches a null entry."""
    dim = dim_weather.select(
        "weather_id", F.col("Weather_Condition").alias("__text")
    )
    return df.join(dim, F.col("Weather_Condition").eqNullSafe(F.col("__text")), "left").drop(
        "__text"
    )


def build_fact(
    df: DataFrame, dim_weather: DataFrame | None, settings: Settings = DEFAULT
) -> DataFrame:
    """The fact rows; without a weather dimension they have no ``weather_id``."""
    timed = with_timestamps(df)
    keyed = timed if dim_weather is None else attach_weather_id(timed, dim_weather)
    fact = keyed.withColumns(
        {
            "Location_id": location_key(settings.location_cols, settings.location_sep),
            "full_date": F.to_date("Start_Time"),
        }
    )
    return select_available(add_duration(fact, hi=settings.duration_max_min), FACT_COLS)


# ---------------------------------------------------------------- joins


def star_join(star: Star, settings: Settings = DEFAULT) -> DataFrame:
    """Every fact row with its dimensions and the derived columns of the aggregates.

    Spark broadcasts a dimension whose bytes are below its limit, so the fact is not
    shuffled. Beyond that AQE splits a location that holds a large part of the fact.
    """
    # one row per calendar day, so the size is bounded by the calendar
    days = F.broadcast(star.dim_time)
    joined = (
        star.accident_detail.join(days, F.col("full_date") == F.col("Date"), "left")
        .join(star.dim_location, "Location_id", "left")
        .join(star.dim_weather, "weather_id", "left")
    )
    return joined.withColumns(
        {
            "Hour": F.hour("Start_Time"),
            "DayOfWeek": day_of_week("Start_Time"),
            "Weather_Category": categorize_text(
                "Weather_Condition", settings.weather_rules_agg
            ),
            "Infra_Score": weighted_infra_score(
                [(c, w) for c, w in INFRA_WEIGHTS if c in joined.columns]
            ),
        }
    )


def national_avg_severity(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("Severity").alias("national_avg_severity"))


def with_dominant_infra(df: DataFrame) -> DataFrame:
    return df.withColumn("dominant_infra", dominant_feature(present(df, INFRA_COLS)))


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Fact rows whose key is not in the dimension; a null key needs a null entry."""
    keys = dim.select(F.col(pk).alias("__pk")).distinct()
    return fact.join(keys, F.col(fk).eqNullSafe(F.col("__pk")), "left_anti")


def orphan_count(
    fact: DataFrame, dim: DataFrame, fk: str, pk: str, skip_null: bool = False
) -> DataFrame:
    """One row: orphan rows and orphan keys.

    The fact is counted per key before the join, so a frequent key is one row.
    """
    counted = fact.groupBy(F.col(fk).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    if skip_null:
        counted = counted.where(F.col("__fk").isNotNull())
    return orphan_totals(counted, dim, "__fk", pk, "__n")


def orphan_totals(
    counted: DataFrame, dim: DataFrame, fk: str, pk: str, n: str
) -> DataFrame:
    """``orphan_count`` of a fact that is already counted per key."""
    return orphans(counted, dim, fk, pk).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"),
    )


def key_difference(left: DataFrame, right: DataFrame, lk: str, rk: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(F.col(lk).alias("key")).subtract(right.select(F.col(rk).alias("key")))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()
