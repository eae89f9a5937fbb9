"""Aggregates recomputed from the cleaned rows and compared, group by group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.config import DEFAULT, INCREASE_TOLERANCE, RISK_LABELS, SHARE_TOLERANCE, Settings
from wayside.functions.numeric import pct_change, percent, ratio
from wayside.functions.text import categorize_text
from wayside.operators.profiling import q
from wayside.operators.rules import check_percentages, finding
from wayside.operators.scale import by_sets


def _number(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _one(df: DataFrame, *found: Column) -> DataFrame:
    return df.select(F.inline(F.array(*found)))


COUNTS = {"city": ("State", "City"), "weather": ("State", "Weather_Condition")}


def recount(
    base: DataFrame,
    settings: Settings = DEFAULT,
    wanted: Sequence[str] = tuple(COUNTS),
    more: Sequence[Column] = (),
) -> dict[str, DataFrame]:
    """Counts per state and city and per state and weather, from the rows and nothing else.

    ``more`` are counts of all rows, taken in the same pass, as the one row ``all``.
    """
    high = F.col("Severity") >= settings.high_severity
    sets = {name: COUNTS[name] for name in wanted} | ({"all": ()} if more else {})
    found = by_sets(
        base,
        sets,
        [
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(high).alias("n_high"),
            F.count("Severity").alias("n_sev"),
            F.sum(F.col("Severity").cast("double")).alias("sum_sev"),
            *more,
        ],
    )
    if more:
        # a table without rows has no group, not even that of all rows
        names = base.agg(*more).columns
        found["all"] = found["all"].agg(*[F.coalesce(F.sum(q(n)), F.lit(0)).alias(n) for n in names])
    if "weather" in found:
        # texts are few, so they are categorised after the rows are counted
        category = categorize_text("Weather_Condition", settings.weather_rules_agg)
        found["weather"] = found["weather"].withColumn("Weather_Category", category)
    return found


def _counts(base: DataFrame, name: str, settings: Settings) -> DataFrame:
    return base if "n_rows" in base.columns else recount(base, settings, [name])[name]


def reconcile_city(
    agg: DataFrame,
    base: DataFrame,
    pairs: Sequence[tuple[str, str]] | None = None,
    states: Sequence[str] | None = None,
    settings: Settings = DEFAULT,
) -> DataFrame:
    """City aggregate against the rows: totals, high severity, share; and per state.

    All groups by default; ``pairs`` and ``states`` narrow it to samples.
    ``base`` is the cleaned rows or ``recount(...)["city"]``.
    """
    stage = "city_by_state"
    known = _counts(base, "city", settings).where(F.col("State").isNotNull())
    counted = known.groupBy("State", "City").agg(
        F.sum("n_rows").alias("n"), F.sum("n_high").alias("n_high")
    )
    whole = counted.groupBy(F.col("State").alias("s")).agg(F.sum("n").alias("n_state"))
    manual = counted.join(whole, F.col("State") == F.col("s")).select(
        F.col("State").alias("m_state"),
        F.col("City").alias("m_city"),
        "n",
        "n_high",
        percent("n", "n_state").alias("pct"),
    ).where(F.col("City").isNotNull())
    own = agg.select("State", "City", "total_accidents", "total_high_severity", "pct_of_state")
    if pairs is not None:
        wanted = reduce(
            lambda a, b: a | b,
            [(F.col("m_state") == s) & (F.col("m_city") == c) for s, c in pairs],
        )
        # a sample without rows is skipped
        both = manual.where(wanted).join(
            own, (F.col("m_state") == F.col("State")) & (F.col("m_city") == F.col("City")), "left"
        )
    else:
        both = manual.join(
            own, (F.col("m_state") == F.col("State")) & (F.col("m_city") == F.col("City")), "full"
        )
    name = F.concat_ws(
        " / ", F.coalesce("m_state", "State"), F.coalesce("m_city", "City")
    )
    near = F.abs(F.col("pct") - F.col("pct_of_state")) < SHARE_TOLERANCE
    groups = _one(
        both,
        finding(
            stage, name, "total_accidents", _same(F.col("n"), F.col("total_accidents")),
            _number(F.col("n")), _number(F.col("total_accidents")), "aggregate says",
        ),
        finding(
            stage, name, "total_high_severity",
            _same(F.col("n_high"), F.col("total_high_severity")),
            _number(F.col("n_high")), _number(F.col("total_high_severity")), "aggregate says",
        ),
        finding(
            stage, name, "pct_of_state", near,
            _number(F.rint(F.col("pct") * 100) / 100), _number(F.col("pct_of_state")),
            "aggregate says",
        ),
    )
    negative = _one(
        agg.agg(F.count_if(F.col("pct_of_state") < 0).alias("n")),
        finding(
            stage, "pct_of_state", "not_negative", F.col("n") == 0,
            "0", F.col("n").cast("string"), "negative rows:",
        ),
    )
    summed = agg.groupBy("State").agg(F.sum("total_accidents").alias("n_agg"))
    sums = whole.join(summed, F.col("s") == F.col("State"), "full")
    if states is not None:
        sums = sums.where(F.coalesce("s", "State").isin(*states))
    per_state = _one(
        sums,
        finding(
            stage, F.coalesce("s", "State"), "sum_of_cities",
            F.coalesce("n_state", F.lit(0)) == F.coalesce("n_agg", F.lit(0)),
            _number(F.col("n_state")), _number(F.col("n_agg")), "aggregate says",
        ),
    )
    return groups.unionByName(negative).unionByName(per_state)


def reconcile_weather(
    agg: DataFrame,
    base: DataFrame,
    states: Sequence[str] | None = None,
    settings: Settings = DEFAULT,
) -> DataFrame:
    """Weather aggregate against the rows: baseline, sign, increases, risk labels.

    The rows are categorised with the rule set of the aggregate, so every
    category is compared; states without clear weather are skipped.
    ``base`` is the cleaned rows or ``recount(...)["weather"]``.
    """
    stage = "weather_by_state"
    clear = F.col("Weather_Category") == "Clear"
    signs = _one(
        agg.agg(
            F.count_if(clear & (F.col("severity_increase_pct") != 0)).alias("off"),
            F.count_if(F.col("severity_increase_pct") < 0).alias("negative"),
            F.count_if(
                ~F.coalesce(F.col("risk_category").isin(*RISK_LABELS), F.lit(False))
            ).alias("foreign"),
        ),
        finding(
            stage, "severity_increase_pct", "clear_is_zero", F.col("off") == 0,
            "0", F.col("off").cast("string"), "rows:",
        ),
        finding(
            stage, "severity_increase_pct", "not_negative", F.col("negative") == 0,
            "0", F.col("negative").cast("string"), "rows:",
        ),
        finding(
            stage, "risk_category", "values", F.col("foreign") == 0,
            "0", F.col("foreign").cast("string"), "rows:",
        ),
    )
    known = _counts(base, "weather", settings).where(F.col("State").isNotNull())
    if states is not None:
        known = known.where(F.col("State").isin(*states))
    means = known.groupBy(
        F.col("State").alias("m_state"), F.col("Weather_Category").alias("m_category")
    ).agg(ratio(F.sum("sum_sev"), F.sum("n_sev")).alias("mean"))
    baseline = means.where(F.col("m_category") == "Clear").select(
        F.col("m_state").alias("c_state"), F.col("mean").alias("clear_mean")
    )
    change = pct_change("mean", "clear_mean")
    manual = (
        means.where(F.col("m_category") != "Clear")
        .join(baseline, F.col("m_state") == F.col("c_state"))
        .select(
            "m_state", "m_category", F.when(change < 0, F.lit(0.0)).otherwise(change).alias("inc")
        )
    )
    # a group the aggregate does not have is skipped
    both = manual.join(
        agg.select("State", "Weather_Category", "severity_increase_pct"),
        (F.col("m_state") == F.col("State")) & (F.col("m_category") == F.col("Weather_Category")),
    )
    increases = _one(
        both,
        finding(
            stage, F.concat_ws(" / ", "State", "Weather_Category"), "severity_increase_pct",
            F.abs(F.col("inc") - F.col("severity_increase_pct")) < INCREASE_TOLERANCE,
            _number(F.rint(F.col("inc") * 100) / 100),
            _number(F.col("severity_increase_pct")), "aggregate says",
        ),
    )
    return signs.unionByName(increases)


def reconcile_totals(aggs: Mapping[str, DataFrame], base: DataFrame) -> DataFrame:
    """The totals of each aggregate add up to the number of rows.

    ``base`` is the cleaned rows or one of the tables of ``recount``.
    """
    counted = F.sum("n_rows") if "n_rows" in base.columns else F.count(F.lit(1))
    rows = base.agg(counted.alias("n")).scalar()
    checks = [
        _one(
            agg.agg(F.sum("total_accidents").alias("total")).withColumn("n", rows),
            finding(
                "totals", name, "sum_of_total_accidents", F.col("total") == F.col("n"),
                F.col("n").cast("string"), _number(F.col("total")), "aggregate says",
            ),
        )
        for name, agg in aggs.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def quality_report(findings: DataFrame) -> DataFrame:
    """PASS or FAIL per stage, and overall."""
    per_stage = findings.groupBy("stage").agg(
        F.bool_and("passed").alias("passed"),
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failed"),
    )
    overall = per_stage.agg(
        F.lit("OVERALL").alias("stage"),
        F.bool_and("passed").alias("passed"),
        F.sum("n_checks").alias("n_checks"),
        F.sum("n_failed").alias("n_failed"),
    )
    return per_stage.unionByName(overall).select(
        F.col("stage").alias("name"),
        F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("status"),
        "n_checks",
        "n_failed",
    )



def check_aggregates(aggs: Mapping[str, DataFrame]) -> DataFrame:
    """Shares lie in 0..100, and clear weather has no increase over itself."""
    cities, weather = aggs["agg_city_by_state"], aggs["agg_weather_by_state"]
    parts = [
        check_percentages(df, c, stage=name)
        for name, df, c in (
            ("agg_federal", aggs["agg_federal"], "high_severity_pct"),
            ("agg_city_by_state", cities, "pct_of_state"),
            ("agg_city_by_state", cities, "high_severity_pct"),
            ("agg_weather_by_state", weather, "high_severity_pct"),
        )
    ]
    off = weather.agg(
        F.count_if(
            (F.col("severity_increase_pct") < 0)
            | ((F.col("Weather_Category") == "Clear") & (F.col("severity_increase_pct") != 0))
        ).alias("n")
    )
    verdict = finding(
        "agg_weather_by_state", "severity_increase_pct", "clear_is_zero",
        F.col("n") == 0, "0", F.col("n").cast("string"), "rows:",
    )
    return reduce(DataFrame.unionByName, [*parts, off.select(F.inline(F.array(verdict)))])
