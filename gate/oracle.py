"""Pieces of DuckDB SQL that the expected results are put together from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from gate.fixtures import INCIDENTS_SQL, RAW_TIMES_SQL, SETTINGS
from wayside.config import (
    FOG_WORDS,
    HOURS_DASHBOARD,
    HOURS_CLEANING,
    INFRA_WEIGHTS,
    RAIN_WORDS,
    RUSH_HOURS,
    SNOW_WORDS,
    WEATHER_BASE_RISK,
    WEATHER_RULES_AGGREGATE,
    WEATHER_RULES_CLEANING,
    HourScheme,
)

RAW_COLS = [
    "ID", "row_seq", "Severity", "Start_Time", "End_Time", "City", "Street", "County", "State",
    "Timezone", "Temperature(F)", "Visibility(mi)", "Precipitation(in)", "Weather_Condition",
    "Amenity", "Crossing", "Junction", "Railway", "Station", "Stop", "Traffic_Signal",
    "Description",
]


def ident(c: str) -> str:
    return f'"{c}"'


def lit(v: Any) -> str:
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def any_word(c: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"lower({c}) LIKE '%{w}%'" for w in words) + ")"


def category(c: str, rules, default: str = "Clear", null_as: str | None = None) -> str:
    head = f"WHEN {c} IS NULL THEN {lit(null_as)} " if null_as else ""
    body = " ".join(f"WHEN {any_word(c, words)} THEN {lit(name)}" for name, words in rules)
    return f"CASE {head}{body} ELSE {lit(default)} END"


def hours(h: str, scheme: HourScheme) -> str:
    body = " ".join(f"WHEN {h} >= {a} AND {h} < {b} THEN {lit(s)}" for a, b, s in scheme.ranges)
    return f"CASE {body} ELSE {lit(scheme.otherwise)} END"


def clip(c: str, lo, hi) -> str:
    return f"CASE WHEN {c} < {lo} THEN {lo} WHEN {c} > {hi} THEN {hi} ELSE {c} END"


def flag(condition: str) -> str:
    return f"CAST(coalesce(CAST({condition} AS INT), 0) AS INT)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif({b}, 0))"


def pct(a: str, b: str) -> str:
    return f"({ratio(a, b)} * 100)"


def r(c: str, d: int = 2) -> str:
    return f"round_even({c}, {d})"


def minutes(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / 6e7)"


RUSH = ", ".join(str(h) for h in RUSH_HOURS)
WEEKDAY = 'CAST(isodow("Start_Time") - 1 AS INT)'
HOUR = 'CAST(hour("Start_Time") AS INT)'
INFRA_SUM = " + ".join(f'coalesce(CAST("{c}" AS INT), 0)' for c, _ in INFRA_WEIGHTS)
WEIGHTED = " + ".join(f'coalesce("{c}", 0) * {w}' for c, w in INFRA_WEIGHTS)


def dominant(table_cols: Sequence[str] = tuple(c for c, _ in INFRA_WEIGHTS)) -> str:
    top = "greatest(" + ", ".join(f'coalesce("{c}", 0)' for c in table_cols) + ")"
    body = " ".join(f"WHEN coalesce(\"{c}\", 0) = {top} THEN '{c}'" for c in table_cols)
    return f"CASE WHEN {top} = 0 THEN 'None' {body} END"


RISK_BASE = "CASE {c} " + " ".join(f"WHEN {lit(n)} THEN {v}" for n, v in WEATHER_BASE_RISK) + (
    " ELSE {other} END"
)


def risk_score(c: str, sev: str, dur: str, other: int = 1) -> str:
    base = RISK_BASE.format(c=c, other=other)
    return (
        f"CAST(least({base}"
        f" + CASE WHEN {sev} > 15 THEN 3 WHEN {sev} > 10 THEN 2 WHEN {sev} > 5 THEN 1 ELSE 0 END"
        f" + CASE WHEN {dur} > 30 THEN 2 WHEN {dur} > 15 THEN 1 ELSE 0 END, 10) AS INT)"
    )


def risk_label(s: str) -> str:
    return (
        f"CASE WHEN {s} >= 8 THEN 'Extreme' WHEN {s} >= 6 THEN 'High'"
        f" WHEN {s} >= 4 THEN 'Moderate' ELSE 'Low' END"
    )


def anomaly(z: str) -> str:
    return (
        f"CASE WHEN {z} > 2 THEN 'Critical' WHEN {z} > 1 THEN 'High'"
        f" WHEN {z} > 0 THEN 'Elevated' ELSE 'Normal' END"
    )


_Y0, _Y1 = SETTINGS.start_year, SETTINGS.end_year

CTES: dict[str, str] = {}
CTES["incidents"] = INCIDENTS_SQL.format(
    orders="orders", customer="customer", nation="nation", region="region"
)
CTES["raw_times"] = RAW_TIMES_SQL.format(incidents="incidents")
CTES["filtered"] = f"""
SELECT *, CAST(year("Start_Time") AS INT) AS "Year" FROM incidents
WHERE year("Start_Time") BETWEEN {_Y0} AND {_Y1}"""
CTES["med"] = """
SELECT median("Temperature(F)") AS t, median("Visibility(mi)") AS v,
 median("Precipitation(in)") AS p FROM filtered"""


def _cleaned() -> str:
    same = [
        "ID", "row_seq", "Severity", "Start_Time", "End_Time", "State", "Timezone", "Description",
        "Year",
    ]
    temp = clip('coalesce("Temperature(F)", t)', -20.0, 120.0)
    vis = clip('coalesce("Visibility(mi)", v)', 0.0, 10.0)
    filled = [f'coalesce("{c}", \'Unknown\') AS "{c}"' for c in ("City", "Street", "County")]
    flags = [
        f'coalesce("{c}", false) AS "{c}"'
        for c in (
            "Amenity", "Crossing", "Junction", "Railway", "Station", "Stop", "Traffic_Signal"
        )
    ]
    inner = ", ".join(
        [ident(c) for c in same]
        + filled
        + flags
        + [
            f'{temp} AS "Temperature(F)"',
            f'{vis} AS "Visibility(mi)"',
            'coalesce("Precipitation(in)", p) AS "Precipitation(in)"',
            'coalesce("Weather_Condition", \'Clear\') AS "Weather_Condition"',
        ]
    )
    w = '"Weather_Condition"'
    return f"""
SELECT *, {clip(minutes('"Start_Time"', '"End_Time"'), 0.0, 1440.0)} AS "Duration_min",
 CAST(month("Start_Time") AS INT) AS "Month", CAST(day("Start_Time") AS INT) AS "Day",
 {HOUR} AS "Hour", {WEEKDAY} AS "DayOfWeek", dayname("Start_Time") AS "DayName",
 CAST(quarter("Start_Time") AS INT) AS "Quarter",
 {hours('hour("Start_Time")', HOURS_CLEANING)} AS "Time_Period",
 {flag(f'hour("Start_Time") IN ({RUSH})')} AS "Is_Rush_Hour",
 {flag('isodow("Start_Time") >= 6')} AS "Is_Weekend",
 {category(w, WEATHER_RULES_CLEANING)} AS "Weather_Category",
 {flag(any_word(w, RAIN_WORDS))} AS "Is_Rain", {flag(any_word(w, SNOW_WORDS))} AS "Is_Snow",
 {flag(any_word(w, FOG_WORDS))} AS "Is_Fog",
 {flag('"Visibility(mi)" < 1')} AS "Low_Visibility",
 CAST({INFRA_SUM} AS INT) AS "Infra_Score", {flag('"Severity" >= 3')} AS "Is_High_Severity",
 "Street" || '_' || "City" AS "Location_id"
FROM (SELECT {inner} FROM filtered, med WHERE "Severity" IN (1, 2, 3, 4)) k"""


CTES["cleaned"] = _cleaned()
CTES["dim_time"] = """
SELECT DISTINCT CAST("Start_Time" AS DATE) AS "Date", "Day", "Month", "Quarter", "Year"
FROM cleaned"""
CTES["dim_location"] = (
    'SELECT "Location_id", '
    + ", ".join(
        f'arg_min("{c}", row_seq) FILTER (WHERE "{c}" IS NOT NULL) AS "{c}"'
        for c in ("Street", "City", "County", "State", "Timezone")
    )
    + ", "
    + ", ".join(f'CAST(count(*) FILTER (WHERE "{c}") AS BIGINT) AS "{c}"' for c, _ in INFRA_WEIGHTS)
    + ' FROM cleaned GROUP BY "Location_id"'
)
CTES["dim_weather"] = """
SELECT 'W' || CAST(row_number() OVER (ORDER BY first_seen) AS VARCHAR) AS weather_id,
 "Weather_Condition"
FROM (SELECT "Weather_Condition", min(row_seq) AS first_seen FROM cleaned GROUP BY 1) d"""
CTES["fact"] = """
SELECT "ID", "Location_id", weather_id, CAST("Start_Time" AS DATE) AS full_date, "Start_Time",
 "End_Time", "Severity", "Duration_min", "Description"
FROM cleaned c LEFT JOIN dim_weather w
 ON c."Weather_Condition" IS NOT DISTINCT FROM w."Weather_Condition\""""
CTES["joined"] = f"""
SELECT f.*, t."Date", t."Day", t."Month", t."Quarter", t."Year",
 l."Street", l."City", l."County", l."State", l."Timezone",
 l."Junction", l."Traffic_Signal", l."Crossing", l."Stop", l."Amenity", w."Weather_Condition",
 {HOUR} AS "Hour", {WEEKDAY} AS "DayOfWeek",
 {category('"Weather_Condition"', WEATHER_RULES_AGGREGATE)} AS "Weather_Category",
 CAST({WEIGHTED} AS BIGINT) AS "Infra_Score", {dominant()} AS dominant_infra
FROM fact f LEFT JOIN dim_time t ON f.full_date = t."Date"
 LEFT JOIN dim_location l ON f."Location_id" = l."Location_id"
 LEFT JOIN dim_weather w ON f.weather_id = w.weather_id"""

_BASICS = """CAST(count("ID") AS BIGINT) AS total_accidents,
 CAST(count(*) FILTER (WHERE "Severity" >= 3) AS BIGINT) AS total_high_severity,
 avg("Severity") AS avg_severity, avg("Duration_min") AS avg_duration_min"""

CTES["agg_federal"] = f"""
SELECT "Year", total_accidents, total_high_severity, {r('avg_severity')} AS avg_severity,
 {r('avg_duration_min')} AS avg_duration_min, total_states, total_cities,
 {r(pct('total_accidents - lag(total_accidents) OVER (ORDER BY "Year")',
        'lag(total_accidents) OVER (ORDER BY "Year")'))} AS yoy_change_pct,
 {r(pct('total_high_severity', 'total_accidents'))} AS high_severity_pct
FROM (SELECT "Year", {_BASICS}, count(DISTINCT "State") AS total_states,
  count(DISTINCT "City") AS total_cities FROM joined WHERE "Year" IS NOT NULL GROUP BY 1) a"""
CTES["state_raw"] = f"""
SELECT a.*, national_avg_severity, national_std_severity, national_total,
 coalesce((avg_severity - national_avg_severity) / nullif(national_std_severity, 0), 0) AS z
FROM (SELECT "State", "Year", {_BASICS}, count(DISTINCT "City") AS total_cities FROM joined
  WHERE "State" IS NOT NULL AND "Year" IS NOT NULL GROUP BY 1, 2) a
JOIN (SELECT "Year", avg("Severity") AS national_avg_severity,
  stddev_samp("Severity") AS national_std_severity, CAST(count("ID") AS BIGINT) AS national_total
  FROM joined GROUP BY 1) y ON a."Year" = y."Year\""""
CTES["agg_state_anomaly"] = f"""
SELECT "State", "Year", total_accidents, total_high_severity,
 {r('avg_severity', 3)} AS avg_severity, {r('avg_duration_min', 3)} AS avg_duration_min,
 total_cities, {r('national_avg_severity', 3)} AS national_avg_severity,
 {r('national_std_severity', 3)} AS national_std_severity, national_total,
 {r('z', 3)} AS severity_zscore,
 {r(r(pct('total_accidents', 'national_total')), 3)} AS pct_of_national,
 {anomaly('z')} AS anomaly_category
FROM state_raw"""
CTES["city_raw"] = f"""
SELECT a.*, m.dominant_infra, state_total, state_avg_severity, state_avg_duration
FROM (SELECT "State", "City", {_BASICS} FROM joined
  WHERE "State" IS NOT NULL AND "City" IS NOT NULL GROUP BY 1, 2) a
JOIN (SELECT "State", "City", dominant_infra FROM
  (SELECT "State", "City", dominant_infra,
    row_number() OVER (PARTITION BY "State", "City" ORDER BY count(*) DESC, dominant_infra) AS n
   FROM joined GROUP BY 1, 2, 3) k WHERE n = 1) m
 ON a."State" = m."State" AND a."City" = m."City"
JOIN (SELECT "State", CAST(count("ID") AS BIGINT) AS state_total,
  avg("Severity") AS state_avg_severity, avg("Duration_min") AS state_avg_duration
  FROM joined GROUP BY 1) s ON a."State" = s."State\""""
CTES["agg_city_by_state"] = f"""
SELECT "State", "City", total_accidents, total_high_severity, {r('avg_severity')} AS avg_severity,
 {r('avg_duration_min')} AS avg_duration_min, dominant_infra, state_total,
 {r('state_avg_severity')} AS state_avg_severity, {r('state_avg_duration')} AS state_avg_duration,
 {r(pct('total_accidents', 'state_total'))} AS pct_of_state,
 {r(pct('total_high_severity', 'total_accidents'))} AS high_severity_pct,
 {r('(avg_severity - state_avg_severity) / nullif(state_avg_severity, 0) * 100')}
   AS severity_vs_state
FROM city_raw"""
CTES["weather_raw"] = f"""
SELECT *,
 CASE WHEN "Weather_Category" = 'Clear' THEN 0.0::DOUBLE WHEN sev < 0 THEN 0.0 ELSE sev END AS si,
 CASE WHEN "Weather_Category" = 'Clear' THEN 0.0::DOUBLE WHEN dur < 0 THEN 0.0 ELSE dur END AS di
FROM (SELECT *, (avg_severity - clear_severity) / nullif(clear_severity, 0) * 100 AS sev,
  (avg_duration_min - clear_duration) / nullif(clear_duration, 0) * 100 AS dur
 FROM (SELECT a.*, coalesce(c.avg_severity, s.sv) AS clear_severity,
   coalesce(c.avg_duration_min, s.du) AS clear_duration
  FROM (SELECT "State", "Weather_Category", {_BASICS} FROM joined
    WHERE "State" IS NOT NULL GROUP BY 1, 2) a
  LEFT JOIN (SELECT "State", avg("Severity") AS avg_severity,
     avg("Duration_min") AS avg_duration_min
    FROM joined WHERE "Weather_Category" = 'Clear' GROUP BY 1) c ON a."State" = c."State"
  LEFT JOIN (SELECT "State", avg("Severity") AS sv, avg("Duration_min") AS du
    FROM joined GROUP BY 1) s ON a."State" = s."State") x) y"""
CTES["agg_weather_by_state"] = f"""
SELECT "State", "Weather_Category", total_accidents, total_high_severity,
 {r('avg_severity')} AS avg_severity, {r('avg_duration_min')} AS avg_duration_min,
 {r('clear_severity')} AS clear_severity, {r('clear_duration')} AS clear_duration,
 {r('si')} AS severity_increase_pct, {r('di')} AS duration_increase_pct, risk_score,
 {risk_label('risk_score')} AS risk_category,
 {r(pct('total_high_severity', 'total_accidents'))} AS high_severity_pct
FROM (SELECT *, {risk_score('"Weather_Category"', 'si', 'di')} AS risk_score FROM weather_raw) z"""
CTES["agg_time_pattern"] = f"""
SELECT "Hour", "DayOfWeek", total_accidents, {r('avg_severity')} AS avg_severity,
 {r('avg_duration_min')} AS avg_duration_min,
 ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']["DayOfWeek" + 1]
   AS "DayName",
 {flag(f'"Hour" IN ({RUSH})')} AS is_rush_hour, {flag('"DayOfWeek" >= 5')} AS is_weekend,
 {hours('"Hour"', HOURS_DASHBOARD)} AS time_period,
 {r('total_accidents::DOUBLE / max(total_accidents) OVER () * 10', 1)} AS hotspot_score
FROM (SELECT "Hour", "DayOfWeek", {_BASICS} FROM joined GROUP BY 1, 2) a"""


def query(body: str) -> str:
    """The statement with the CTEs in front; those it does not use cost nothing."""
    with_list = ",\n".join(f"{name} AS ({text})" for name, text in CTES.items())
    return f"WITH {with_list}\n{body}"


# ---------------------------------------------------------------- findings


def finding(
    stage: str, column: str, check: str, passed: str, expected: str, actual: str, why: str,
    source: str,
) -> str:
    """One SELECT of a finding; column, expected and actual are SQL expressions."""
    return (
        f"SELECT coalesce({passed}, false) AS passed, '{stage}' AS stage, {column} AS \"column\","
        f" '{check}' AS \"check\", {expected} AS expected, {actual} AS actual,"
        f" CASE WHEN coalesce({passed}, false) THEN 'OK'"
        f" ELSE '{why} ' || {actual} END AS message FROM {source}"
    )


def text(c: str) -> str:
    return f"coalesce(CAST(CAST({c} AS DOUBLE) AS VARCHAR), 'null')"


def rules_sql(table: str, stage: str, rules: Mapping[str, Mapping[str, Any]], cols=None) -> str:
    """The findings of a rule set on a table, one SELECT per check."""
    parts = []
    for c, rule in rules.items():
        i, name = ident(c), lit(c)
        if cols is not None and c not in cols:
            parts.append(
                finding(
                    stage, name, "exists", "false", "'present'", "'missing'", "column is",
                    "(SELECT 1) x",
                )
            )
            continue
        if "null_pct_max" in rule:
            share = "(count(*) FILTER (WHERE %s IS NULL))::DOUBLE / nullif(count(*), 0)" % i
            most = float(rule["null_pct_max"])
            parts.append(
                finding(
                    stage, name, "null_pct", f"s <= {most}", f"'<= {round(most * 100, 1)}%'",
                    "coalesce(CAST(round_even(s * 100, 1) AS VARCHAR) || '%', 'null')", "nulls:",
                    f"(SELECT {share} AS s FROM {table}) x",
                )
            )
        for key, op, why in (("min", ">=", "smallest value:"), ("max", "<=", "largest value:")):
            if key in rule:
                parts.append(
                    finding(
                        stage, name, key, f"v {op} {rule[key]}", f"'{op} {float(rule[key])}'",
                        text("v"), why, f"(SELECT {key}({i}) AS v FROM {table}) x",
                    )
                )
        if rule.get("unique"):
            parts.append(
                finding(
                    stage, name, "unique", "d = n", "'all distinct'",
                    "CAST(d AS VARCHAR) || '/' || CAST(n AS VARCHAR)", "distinct values:",
                    f"(SELECT count(DISTINCT {i}) AS d, count({i}) AS n FROM {table}) x",
                )
            )
        if "values" in rule:
            inside = ", ".join(lit(v) for v in rule["values"])
            parts.append(
                finding(
                    stage, name, "values", "n = 0", "'0 other values'", "CAST(n AS VARCHAR)",
                    "values not allowed:",
                    f"(SELECT count(DISTINCT {i}) FILTER (WHERE {i} NOT IN ({inside})) AS n"
                    f" FROM {table}) x",
                )
            )
    return "\nUNION ALL\n".join(parts)
