"""Dashboard aggregates, shares, running shares and counts.

All five dashboards add up the same few measures: counts and sums per group that
can be added up again. Rows are added up before they are shuffled, which leaves
one row per group and task however many incidents a location, state or weather has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayside.config import DEFAULT, HOURS_DASHBOARD, INFRA_WEIGHTS, WEATHER_ORDER, Settings
from wayside.functions.numeric import (
    anomaly_category,
    ladder,
    pct_change,
    percent,
    ratio,
    risk_category,
    round_even,
    weather_risk_score,
    z_score,
)
from wayside.functions.temporal import (
    day_name_from_index,
    day_of_week,
    hour_bucket,
    is_rush_hour,
    is_weekend,
)
from wayside.functions.text import categorize_text
from wayside.operators.cleaning import present
from wayside.operators.exact import sum_by
from wayside.operators.scale import by_sets, running_total
from wayside.operators.star import Star, row_order, with_dominant_infra
from wayside.session import materialize

MEASURES = ("n_rows", "n_id", "n_high", "n_sev", "sum_sev", "sumsq_sev", "n_dur", "sum_dur")
LOCATION_KEYS = ("State", "City", "dominant_infra")

# The groups each dashboard is made from.
DASHBOARDS = {
    "agg_federal": ("Year", "State", "City"),
    "agg_state_anomaly": ("Year", "State", "City"),
    "agg_city_by_state": ("State", "City", "dominant_infra"),
    "agg_weather_by_state": ("State", "Weather_Category"),
    "agg_time_pattern": ("Hour", "DayOfWeek"),
}


# ---------------------------------------------------------------- roll-up


def _measures(df: DataFrame, settings: Settings) -> list[Column]:
    """Addable measures of incident rows, or the sums of those of a roll-up."""
    if "n_rows" in df.columns:
        return [F.sum(m).alias(m) for m in MEASURES]
    sev = F.col("Severity").cast("double")
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count("ID").alias("n_id"),
        F.count_if(F.col("Severity") >= settings.high_severity).alias("n_high"),
        F.count("Severity").alias("n_sev"),
        F.sum(sev).alias("sum_sev"),
        F.sum(sev * sev).alias("sumsq_sev"),
        F.count("Duration_min").alias("n_dur"),
        F.sum("Duration_min").alias("sum_dur"),
    ]


def rollup(df: DataFrame, keys: Sequence[str], settings: Settings = DEFAULT) -> DataFrame:
    """Addable measures per group, from incident rows or from a finer roll-up."""
    return df.groupBy(*keys).agg(*_measures(df, settings))


def rolled_up(df: DataFrame, keys: Sequence[str], settings: Settings = DEFAULT) -> DataFrame:
    """``rollup`` for a caller that uses it twice: rows are read once.

    The groups of incident rows are written first, since the two uses would filter and
    prune the scan differently. A roll-up of ``star_rollups`` is written already.
    """
    rolled = rollup(df, keys, settings)
    return rolled if "n_rows" in df.columns else materialize(rolled)


def _with_dimensions(star: Star, keys: Sequence[str], settings: Settings) -> DataFrame:
    """The fact with the columns of ``keys``; Spark chooses the joins by bytes."""
    fact = star.accident_detail
    own = [k for k in ("Hour", "DayOfWeek") if k in keys]
    fact = fact.withColumns({"Hour": F.hour("Start_Time"), "DayOfWeek": day_of_week("Start_Time")})
    if "Year" in keys:
        # one row per calendar day, so the size is bounded by the calendar
        days = F.broadcast(star.dim_time.select("Date", "Year"))
        fact = fact.join(days, F.col("full_date") == F.col("Date"), "left")
        own.append("Year")
    dims: dict[str, DataFrame] = {}
    places = [k for k in LOCATION_KEYS if k in keys]
    if places:
        dim = with_dominant_infra(star.dim_location).select("Location_id", *places)
        dims["Location_id"] = dim
    if "Weather_Category" in keys:
        category = categorize_text("Weather_Condition", settings.weather_rules_agg)
        dims["weather_id"] = star.dim_weather.select(
            "weather_id", category.alias("Weather_Category")
        )
    for fk, dim in dims.items():
        fact = fact.join(dim, fk, "left")
    if "Weather_Category" in keys:
        # a fact without an entry has no text, which counts as clear
        no_text = categorize_text(F.lit(None).cast("string"), settings.weather_rules_agg)
        fact = fact.withColumn("Weather_Category", F.coalesce("Weather_Category", no_text))
    return fact


def star_rollup(star: Star, keys: Sequence[str], settings: Settings = DEFAULT) -> DataFrame:
    """Roll-up of the star, equal to ``rollup(star_join(star), keys)``.

    Only the dimensions that ``keys`` need are joined.
    """
    return rollup(_with_dimensions(star, keys, settings), keys, settings)


def star_rollups(
    star: Star,
    sets: Mapping[str, Sequence[str]] = DASHBOARDS,
    settings: Settings = DEFAULT,
) -> dict[str, DataFrame]:
    """A roll-up per entry of ``sets``, all from one pass over the fact."""
    keys = list(dict.fromkeys(c for cols in sets.values() for c in cols))
    rows = _with_dimensions(star, keys, settings)
    return by_sets(rows, sets, _measures(rows, settings))


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups without a null key."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def _std_sample() -> Column:
    n = F.col("n_sev").cast("double")
    spread = F.col("sumsq_sev") - F.col("sum_sev") * F.col("sum_sev") / n
    return F.when(F.col("n_sev") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)))


def _basics() -> list[Column]:
    return [
        F.col("n_id").alias("total_accidents"),
        F.col("n_high").alias("total_high_severity"),
        ratio("sum_sev", "n_sev").alias("avg_severity"),
        ratio("sum_dur", "n_dur").alias("avg_duration_min"),
    ]


def _rounded(df: DataFrame, digits: int, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: round_even(c, digits) for c in cols})


# ---------------------------------------------------------------- dashboards


def agg_federal(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Per year: totals, means, distinct places, change to the previous year."""
    fine = _known(rollup(df, ["Year", "State", "City"], settings), ["Year"])
    yearly = fine.groupBy("Year").agg(
        *[F.sum(m).alias(m) for m in MEASURES],
        F.count_distinct("State").alias("total_states"),
        F.count_distinct("City").alias("total_cities"),
    )
    out = yearly.select("Year", *_basics(), "total_states", "total_cities")
    out = yoy_change(out, "Year", "total_accidents", "yoy_change_pct").withColumn(
        "high_severity_pct", percent("total_high_severity", "total_accidents")
    )
    return _rounded(
        out, 2, ["avg_severity", "avg_duration_min", "yoy_change_pct", "high_severity_pct"]
    )


def agg_state_anomaly(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Per state and year: how far the mean severity lies from the nation's."""
    fine = rolled_up(df, ["Year", "State", "City"], settings)
    by_state = _known(fine, ["State", "Year"]).groupBy("State", "Year").agg(
        *[F.sum(m).alias(m) for m in MEASURES],
        # groups of the fine roll-up are distinct cities
        F.count("City").alias("total_cities"),
    )
    national = (
        rollup(fine, ["Year"])
        .select(
            F.col("Year").alias("__year"),
            ratio("sum_sev", "n_sev").alias("national_avg_severity"),
            _std_sample().alias("national_std_severity"),
            F.col("n_id").alias("national_total"),
        )
        .where(F.col("__year").isNotNull())
    )
    out = (
        attach_group_stats(
            by_state.select("State", "Year", *_basics(), "total_cities"), national, "Year", "__year"
        )
        .withColumn(
            "severity_zscore",
            z_score("avg_severity", "national_avg_severity", "national_std_severity"),
        )
        .withColumn(
            "pct_of_national", round_even(percent("total_accidents", "national_total"), 2)
        )
        .withColumn("anomaly_category", anomaly_category("severity_zscore", settings.z_thresholds))
    )
    return _rounded(
        out,
        3,
        [
            "avg_severity",
            "avg_duration_min",
            "national_avg_severity",
            "national_std_severity",
            "severity_zscore",
            "pct_of_national",
        ],
    )


def agg_city_by_state(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Per state and city: totals, the usual dominant feature, comparison with the state."""
    if "dominant_infra" not in df.columns:
        df = with_dominant_infra(df)
    fine = _known(rolled_up(df, ["State", "City", "dominant_infra"], settings), ["State"])
    # the most frequent feature; on a tie the first in alphabetical order
    usual = F.min_by("dominant_infra", F.struct(-F.col("n_rows"), F.col("dominant_infra")))
    cities = _known(fine, ["City"]).groupBy("State", "City").agg(
        *[F.sum(m).alias(m) for m in MEASURES], usual.alias("dominant_infra")
    )
    states = rollup(fine, ["State"]).select(
        F.col("State").alias("__state"),
        F.col("n_id").alias("state_total"),
        ratio("sum_sev", "n_sev").alias("state_avg_severity"),
        ratio("sum_dur", "n_dur").alias("state_avg_duration"),
    )
    out = attach_group_stats(
        cities.select("State", "City", *_basics(), "dominant_infra"), states, "State", "__state"
    ).withColumns(
        {
            "pct_of_state": percent("total_accidents", "state_total"),
            "high_severity_pct": percent("total_high_severity", "total_accidents"),
            "severity_vs_state": pct_change("avg_severity", "state_avg_severity"),
        }
    )
    return _rounded(
        out,
        2,
        [
            "avg_severity",
            "avg_duration_min",
            "state_avg_severity",
            "state_avg_duration",
            "pct_of_state",
            "high_severity_pct",
            "severity_vs_state",
        ],
    )


def agg_weather_by_state(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Per state and weather: increase over clear weather of the same state, and risk."""
    fine = _known(
        rolled_up(df, ["State", "Weather_Category"], settings), ["State", "Weather_Category"]
    )
    clear = F.col("Weather_Category") == "Clear"
    # clear weather of the state, else the whole state
    mean_sev, mean_dur = ratio("sum_sev", "n_sev"), ratio("sum_dur", "n_dur")
    baseline = fine.groupBy(F.col("State").alias("__state")).agg(
        F.coalesce(
            F.max(F.when(clear, mean_sev)), ratio(F.sum("sum_sev"), F.sum("n_sev"))
        ).alias("clear_severity"),
        F.coalesce(
            F.max(F.when(clear, mean_dur)), ratio(F.sum("sum_dur"), F.sum("n_dur"))
        ).alias("clear_duration"),
    )

    def increase(value: str, base: str) -> Column:
        change = pct_change(value, base)
        return F.when(clear, F.lit(0.0)).otherwise(
            F.when(change < 0, F.lit(0.0)).otherwise(change)
        )

    out = (
        attach_group_stats(
            fine.select("State", "Weather_Category", *_basics()), baseline, "State", "__state"
        )
        .withColumn("severity_increase_pct", increase("avg_severity", "clear_severity"))
        .withColumn("duration_increase_pct", increase("avg_duration_min", "clear_duration"))
        .withColumn(
            "risk_score",
            weather_risk_score(
                "Weather_Category", "severity_increase_pct", "duration_increase_pct"
            ),
        )
        .withColumn("risk_category", risk_category("risk_score", settings.risk_thresholds))
        .withColumn("high_severity_pct", percent("total_high_severity", "total_accidents"))
    )
    return _rounded(
        out,
        2,
        [
            "avg_severity",
            "avg_duration_min",
            "clear_severity",
            "clear_duration",
            "severity_increase_pct",
            "duration_increase_pct",
            "high_severity_pct",
        ],
    )


def agg_time_pattern(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Per hour and weekday: totals, calendar labels, share of the busiest slot times 10."""
    slots = _known(rollup(df, ["Hour", "DayOfWeek"], settings), ["Hour", "DayOfWeek"])
    out = slots.select(
        "Hour",
        "DayOfWeek",
        F.col("n_id").alias("total_accidents"),
        ratio("sum_sev", "n_sev").alias("avg_severity"),
        ratio("sum_dur", "n_dur").alias("avg_duration_min"),
        day_name_from_index("DayOfWeek").alias("DayName"),
        is_rush_hour("Hour").alias("is_rush_hour"),
        is_weekend("DayOfWeek").alias("is_weekend"),
        hour_bucket("Hour", HOURS_DASHBOARD).alias("time_period"),
    )
    # at most 24 x 7 rows
    out = share_of_max(out, "total_accidents", "hotspot_score", 10)
    return _rounded(_rounded(out, 2, ["avg_severity", "avg_duration_min"]), 1, ["hotspot_score"])


# ---------------------------------------------------------------- joins and shares


def attach_group_stats(
    agg: DataFrame, stats: DataFrame, key: str, stats_key: str
) -> DataFrame:
    """Left join of an aggregate with the statistics of a coarser group."""
    return agg.join(stats, F.col(key) == F.col(stats_key), "left").drop(stats_key)


def share_of_total(
    df: DataFrame, value: str, out: str, by: Sequence[str] = (), scale: float = 100
) -> DataFrame:
    """Value in percent of the sum of its group, or of the whole table."""
    if not by:
        total = df.agg(F.sum(value)).scalar()
        return df.withColumn(out, ratio(F.col(value), total) * scale)
    totals = df.groupBy(*[F.col(b).alias(f"__{b}") for b in by]).agg(
        F.sum(value).alias("__total")
    )
    on = [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by]
    joined = df.join(totals, on, "left").withColumn(out, ratio(value, "__total") * scale)
    return joined.drop("__total", *[f"__{b}" for b in by])


def share_of_max(df: DataFrame, value: str, out: str, scale: float = 10) -> DataFrame:
    top = df.agg(F.max(value)).scalar()
    return df.withColumn(out, ratio(F.col(value), top) * scale)


def yoy_change(
    df: DataFrame,
    year_col: str,
    value_col: str,
    out: str = "YoY_Change",
    by: Sequence[str] = (),
) -> DataFrame:
    """Change to the previous row in percent; ``df`` has one row per year (and group)."""
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(year_col)
    return df.withColumn(out, pct_change(F.col(value_col), F.lag(value_col, 1).over(w)))


def running_share(
    df: DataFrame, value: str, key: str, share: str, out: str
) -> DataFrame:
    """Share of the total and its running sum, largest value first, key as tie break.

    Fractions of any size are added up exactly, so the shares do not depend on how the
    rows are dealt out.
    """
    ordered = df.withColumn("__desc", -F.col(value))
    summed = running_total(ordered, ["__desc", key], value, "__cum")
    total = sum_by(summed, [], value, "total").scalar()
    return summed.withColumns(
        {
            share: ratio(F.col(value), total) * 100,
            out: ratio(F.col("__cum"), total) * 100,
        }
    ).drop("__desc", "__cum")


def pareto(
    df: DataFrame, group: str, value: str, threshold: float = DEFAULT.pareto_threshold
) -> DataFrame:
    """Groups by descending sum; the group that crosses the line is already 'Bottom'."""
    known = df.where(F.col(group).isNotNull())
    sums = sum_by(known, [group], value, value)
    shares = running_share(sums, value, group, "Percentage", "Cumulative_Percentage")
    return shares.withColumn(
        "Pareto_Group",
        F.when(F.col("Cumulative_Percentage") <= threshold * 100, "Top_80%").otherwise(
            "Bottom_20%"
        ),
    )


# ---------------------------------------------------------------- counts


def count_by(df: DataFrame, cols: Sequence[str], out: str = "count") -> DataFrame:
    """Value counts; groups with a null are left out."""
    return _known(df, cols).groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def top_n(df: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """The n most frequent groups, in key order on ties."""
    return count_by(df, by).orderBy(F.col("count").desc(), *[F.col(b).asc() for b in by]).limit(n)


def sample_head(df: DataFrame, n: int = 1000) -> DataFrame:
    """The first n rows in the order of rows."""
    return df.orderBy(row_order(df)).limit(n)


def severity_stats(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("Severity").isNotNull())
        .groupBy("Severity")
        .agg(F.count("ID").alias("count"), F.avg("Duration_min").alias("avg_duration_min"))
    )


def summary(df: DataFrame) -> DataFrame:
    """One row: rows, first and last start, distinct states and cities."""
    places = df.groupBy("State", "City").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("Start_Time").alias("lo"),
        F.max("Start_Time").alias("hi"),
    )
    return places.agg(
        F.sum("n").alias("total_records"),
        F.min("lo").alias("min_start"),
        F.max("hi").alias("max_start"),
        F.count_distinct("State").alias("states"),
        F.count_distinct("City").alias("cities"),
    )


def flag_rate(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Mean of each 0/1 flag in percent, from one pass."""
    one = df.agg(*[(F.avg(f) * 100).alias(f) for f in flags])
    rows = [F.struct(F.lit(f).alias("flag"), F.col(f).alias("pct")) for f in flags]
    return one.select(F.inline(F.array(*rows)))


def infra_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group: incidents and how many of them have each feature."""
    flags = present(df, [c for c, _ in INFRA_WEIGHTS])
    return _known(df, keys).groupBy(*keys).agg(
        F.count("ID").alias("total_accidents"),
        *[F.count_if(F.col(c)).alias(f"total_{c.lower()}") for c in flags],
    )


def infra_risk_score(totals: DataFrame, out: str = "Infra_Risk_Score") -> DataFrame:
    """Weighted feature totals per incident, two decimals; undivided without a total."""
    score = F.lit(0.0)
    for c, w in INFRA_WEIGHTS:
        if f"total_{c.lower()}" in totals.columns:
            score = score + F.col(f"total_{c.lower()}") * w
    if "total_accidents" in totals.columns:
        score = round_even(ratio(score, "total_accidents"), 2)
    return totals.withColumn(out, score)


# ---------------------------------------------------------------- output order


def category_rank(c: str, order: Sequence[str]) -> Column:
    return ladder(((F.col(c) == v, F.lit(i)) for i, v in enumerate(order)), len(order))


def sort_output(name: str, df: DataFrame) -> DataFrame:
    """The row order in which a table is written."""
    # fixed values
    orders = {
        "dim_time": ["Date"],
        "dim_location": ["State", "City", "Location_id"],
        "dim_weather": [F.length("weather_id"), F.col("weather_id")],
        "agg_federal": ["Year"],
        "agg_state_anomaly": ["State", "Year"],
        "agg_city_by_state": [F.col("State"), F.col("total_accidents").desc(), F.col("City")],
        "agg_weather_by_state": [
            F.col("State"),
            category_rank("Weather_Category", WEATHER_ORDER),
        ],
        "agg_time_pattern": ["Hour", "DayOfWeek"],
    }
    return df.orderBy(*orders[name]) if name in orders else df
