"""Data-quality rules compiled to one aggregate, and checks on keys and shares.

A check gives findings: a frame with the columns passed, stage, column, check,
expected, actual, message. Only ``assert_*`` and ``raise_on_fail`` bring the
(few) failing findings to the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayside.config import DEFAULT, SHARES_TOTAL, Settings
from wayside.functions.numeric import ratio, round_even
from wayside.operators.profiling import q
from wayside.operators.scale import by_sets, scalar_struct, value_counts_long
from wayside.operators.star import Star, orphan_count, orphan_totals

FINDING_COLS = ("passed", "stage", "column", "check", "expected", "actual", "message")


class ValidationError(Exception):
    """Raised with the failing findings."""

    def __init__(self, failed: Sequence[Any]):
        self.failed = list(failed)
        lines = [f"  - {r['column']}: {r['message']}" for r in self.failed]
        super().__init__("validation failed:\n" + "\n".join(lines))


def _comparable_limit(df: DataFrame, c: str, limit: Any) -> Column | None:
    """The limit in the column's type, or None if the two cannot be compared."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.NumericType):
        fits = isinstance(limit, (int, float, Decimal)) and not isinstance(limit, bool)
        return F.lit(limit) if fits else None
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        fits = isinstance(limit, (str, dt.date))
        return F.lit(limit).try_cast(kind) if fits else None
    return F.lit(limit) if isinstance(kind, T.StringType) and isinstance(limit, str) else None


def _allowed_texts(df: DataFrame, c: str, allowed: Sequence[Any]) -> Column:
    """The allowed values as the texts that values of the column's type have."""
    kind = df.schema[c].dataType
    typed = [F.lit(v).try_cast(kind) for v in allowed]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        typed = [t + F.lit(0.0) for t in typed]
    return F.array_compact(F.array(*[t.cast("string") for t in typed]))


def _edge_text(df: DataFrame, c: str, value: Column) -> Column:
    if isinstance(df.schema[c].dataType, T.NumericType):
        return text_of(value)
    return F.coalesce(value.cast("string"), F.lit("null"))


def text_of(c: Column) -> Column:
    """A number as text, 'null' without a value."""
    return F.coalesce(c.cast("double").cast("string"), F.lit("null"))


def finding(
    stage: str, column: Column | str, check: str, passed: Column, expected, actual: Column, why: str
) -> Column:
    """One finding as a struct; a null verdict counts as failed."""
    ok = F.coalesce(passed, F.lit(False))
    name = F.lit(column) if isinstance(column, str) else column
    want = expected if isinstance(expected, Column) else F.lit(str(expected))
    return F.struct(
        ok.alias("passed"),
        F.lit(stage).alias("stage"),
        name.alias("column"),
        F.lit(check).alias("check"),
        want.alias("expected"),
        actual.alias("actual"),
        F.when(ok, F.lit("OK")).otherwise(F.concat(F.lit(why + " "), actual)).alias("message"),
    )


def _limit(value: Any) -> str:
    return str(float(value)) if isinstance(value, (int, float, Decimal)) else str(value)


def _pct(value: Column) -> Column:
    return F.coalesce(
        F.concat(round_even(value * 100, 1).cast("string"), F.lit("%")), F.lit("null")
    )


def rule_measures(df: DataFrame, rules: Mapping[str, Mapping[str, Any]]) -> list[Column]:
    """The null counts and extremes that the rules need, as aggregates of plain columns."""
    parts = [F.count(F.lit(1)).alias("rows")]
    for c in rules:
        if c not in df.columns:
            continue
        if "null_pct_max" in rules[c]:
            parts.append(F.count_if(q(c).isNull()).alias(f"nulls|{c}"))
        if "min" in rules[c]:
            parts.append(F.min(q(c)).alias(f"min|{c}"))
        if "max" in rules[c]:
            parts.append(F.max(q(c)).alias(f"max|{c}"))
    return parts


def check_rules(
    df: DataFrame,
    stage: str,
    rules: Mapping[str, Mapping[str, Any]],
    raise_on_fail: bool = False,
    measured: DataFrame | None = None,
) -> DataFrame:
    """One finding per column and check.

    Checks: exists, null_pct_max, min, max, unique, values. All null shares and
    extremes come from one aggregate; uniqueness and allowed values from one
    count of distinct values over all columns that need it. ``measured`` is the row of
    ``rule_measures`` if it was taken elsewhere, such as while ``df`` was written.
    """
    here = [c for c in rules if c in df.columns]
    keyed = [c for c in here if rules[c].get("unique")]
    listed = [c for c in here if "values" in rules[c]]
    stats = df.agg(*rule_measures(df, rules)) if measured is None else measured

    if keyed or listed:
        counts = value_counts_long(df, list(dict.fromkeys(keyed + listed)), "string")
        of = {c: F.col("name") == c for c in keyed + listed}
        extra = counts.agg(
            *[F.count_if(of[c]).alias(f"distinct|{c}") for c in keyed],
            *[
                F.coalesce(F.sum(F.when(of[c], F.col("n"))), F.lit(0)).alias(f"present|{c}")
                for c in keyed
            ],
            *[
                F.count_if(
                    of[c] & ~F.array_contains(_allowed_texts(df, c, rules[c]["values"]), F.col("value"))
                ).alias(f"foreign|{c}")
                for c in listed
            ],
        )
        more = scalar_struct(extra)
        stats = stats.withColumns({name: more.getField(name) for name in extra.columns})

    found: list[Column] = []
    for c, rule in rules.items():
        if c not in here:
            found.append(
                finding(stage, c, "exists", F.lit(False), "present", F.lit("missing"), "column is")
            )
            continue
        if "null_pct_max" in rule:
            # without rows there is no share, and the check fails
            share = ratio(q(f"nulls|{c}"), "rows")
            most = float(rule["null_pct_max"])
            found.append(
                finding(
                    stage, c, "null_pct", share <= most,
                    f"<= {round(most * 100, 1)}%", _pct(share), "nulls:",
                )
            )
        for edge, sign, why in (("min", ">=", "smallest value:"), ("max", "<=", "largest value:")):
            if edge not in rule:
                continue
            limit, value = _comparable_limit(df, c, rule[edge]), q(f"{edge}|{c}")
            if limit is None:
                # a number is no limit for a time, nor a text for a number
                found.append(
                    finding(
                        stage, c, edge, F.lit(False), f"{sign} {_limit(rule[edge])}",
                        F.lit(df.schema[c].dataType.simpleString()), "not comparable:",
                    )
                )
                continue
            found.append(
                finding(
                    stage, c, edge, value >= limit if edge == "min" else value <= limit,
                    f"{sign} {_limit(rule[edge])}", _edge_text(df, c, value), why,
                )
            )
        if rule.get("unique"):
            n, total = q(f"distinct|{c}"), q(f"present|{c}")
            actual = F.concat(n.cast("string"), F.lit("/"), total.cast("string"))
            found.append(
                finding(stage, c, "unique", n == total, "all distinct", actual, "distinct values:")
            )
        if "values" in rule:
            n = q(f"foreign|{c}")
            found.append(
                finding(
                    stage, c, "values", n == 0,
                    "0 other values", n.cast("string"), "values not allowed:",
                )
            )
    out = stats.select(F.inline(F.array(*found)))
    if raise_on_fail:
        raise_failures(out)
    return out


def raise_failures(findings: DataFrame, shown: int = 1000) -> None:
    """Raise if any finding failed, naming the first ``shown`` of them."""
    failed = findings.where(~F.col("passed")).limit(shown).collect()
    if failed:
        raise ValidationError(failed)


def values_not_allowed(df: DataFrame, c: str, allowed: Sequence[Any]) -> DataFrame:
    """Distinct non-null values outside the allowed set."""
    return df.select(F.col(c).alias("value")).distinct().where(~F.col("value").isin(*allowed))


# ---------------------------------------------------------------- ranges and shares


def range_findings(
    df: DataFrame, c: str, lo: float | None, hi: float | None, stage: str = ""
) -> DataFrame:
    rule = {k: v for k, v in (("min", lo), ("max", hi)) if v is not None}
    return check_rules(df, stage, {c: rule})


def assert_range(
    df: DataFrame, c: str, lo: float | None = None, hi: float | None = None, stage: str = ""
) -> None:
    """Raise AssertionError on a value outside; an absent column is skipped."""
    if c not in df.columns or (lo is None and hi is None):
        return
    try:
        raise_failures(range_findings(df, c, lo, hi, stage))
    except ValidationError as e:
        raise AssertionError(f"[{stage}] {e}") from e


def check_percentages(
    df: DataFrame, c: str, sum_to_100: bool = False, group: str | None = None, stage: str = ""
) -> DataFrame:
    """0..100, and on request a total (per group) within 99..101.

    An absent column is skipped: there are no findings.
    """
    if c not in df.columns:
        nothing = finding(stage, c, "min", F.lit(True), "", F.lit(""), "")
        return df.where(F.lit(False)).select(F.inline(F.array(nothing)))
    found = check_rules(df, stage, {c: {"min": 0, "max": 100}})
    if not sum_to_100:
        return found
    grouped = group is not None and group in df.columns
    keys = [F.col(group)] if grouped else []
    rows = df.where(F.col(group).isNotNull()) if grouped else df
    totals = rows.groupBy(*keys).agg(F.sum(c).alias("__total"))
    # a group without any value sums to 0, as an empty sum does
    off = totals.agg(
        F.count_if(~F.coalesce(F.col("__total"), F.lit(0.0)).between(*SHARES_TOTAL)).alias("n")
    )
    verdict = off.select(
        F.inline(
            F.array(
                finding(
                    stage, c, "sums_to_100", F.col("n") == 0,
                    "0 groups outside 99..101", F.col("n").cast("string"), "groups outside:",
                )
            )
        )
    )
    return found.unionByName(verdict)


def assert_percentages(findings: DataFrame) -> None:
    try:
        raise_failures(findings)
    except ValidationError as e:
        raise AssertionError(str(e)) from e


# ---------------------------------------------------------------- keys


def check_keys(star: Star) -> DataFrame:
    """One finding per dimension that the star has: its key occurs once."""
    keys = (("dim_time", "Date"), ("dim_location", "Location_id"), ("dim_weather", "weather_id"))
    found = []
    for name, key in keys:
        dim = star.tables().get(name)
        if dim is None:
            continue
        n = check_unique(dim, key).agg(F.count(F.lit(1)).alias("n"))
        verdict = finding(
            "star", key, "unique", F.col("n") == 0, "0", F.col("n").cast("string"), f"repeated keys in {name}:"
        )
        found.append(n.select(F.inline(F.array(verdict))))
    return reduce(DataFrame.unionByName, found)


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def referential_integrity(
    fact: DataFrame, dim: DataFrame, fk: str, pk: str, name: str = ""
) -> DataFrame:
    """One finding: no non-null key of the fact is missing in the dimension."""
    lost = orphan_count(fact, dim, fk, pk, skip_null=True)
    return lost.select(
        F.inline(
            F.array(
                finding(
                    "schema", f"{fk} -> {pk}", "referential_integrity",
                    F.col("orphan_keys") == 0, "0 orphans",
                    F.concat(F.col("orphan_keys").cast("string"), F.lit(" orphans")),
                    name or "lost keys:",
                )
            )
        )
    )


def check_star(star: Star, settings: Settings = DEFAULT) -> DataFrame:
    """Orphans on the three keys (distinct days, else rows), and the duration cap.

    The fact is counted per key, for all keys in one pass, before it meets a dimension.
    """
    keys = (
        (star.dim_time, "full_date", "Date", "orphan_keys"),
        (star.dim_location, "Location_id", "Location_id", "orphan_rows"),
        (star.dim_weather, "weather_id", "weather_id", "orphan_rows"),
    )
    seen = by_sets(
        star.accident_detail,
        {fk: (fk,) for _, fk, _, _ in keys},
        [F.count(F.lit(1)).alias("n"), F.max("Duration_min").alias("longest")],
    )
    found = [
        orphan_totals(seen[fk], dim, fk, pk, "n").select(
            F.inline(
                F.array(
                    finding(
                        "star", fk, "orphans", F.col(counted) == 0,
                        "0", F.col(counted).cast("string"), "orphans:",
                    )
                )
            )
        )
        for dim, fk, pk, counted in keys
    ]
    # no duration at all is no duration above the cap
    capped = F.coalesce(F.col("m") <= settings.duration_max_min, F.lit(True))
    found.append(
        seen["full_date"].agg(F.max("longest").alias("m")).select(
            F.inline(
                F.array(
                    finding(
                        "star", "Duration_min", "max", capped,
                        f"<= {_limit(settings.duration_max_min)}", text_of(F.col("m")),
                        "largest value:",
                    )
                )
            )
        )
    )
    return reduce(DataFrame.unionByName, found)


def _quality_checks(base: DataFrame) -> list[tuple[str, str, str]]:
    """(column, check, measure) of what ``check_quality`` looks at."""
    checks = [("Severity", "domain", "bad_severity")]
    if "Duration_min" in base.columns:
        checks.append(("Duration_min", "not_negative", "negative"))
    return checks + [
        (c, "not_null", f"nulls|{c}") for c in ("ID", "Severity", "State", "City") if c in base.columns
    ]


def quality_measures(base: DataFrame, settings: Settings = DEFAULT) -> list[Column]:
    """Rows that fail each check of ``check_quality``, as aggregates of plain columns."""
    bad = {
        "bad_severity": ~F.coalesce(F.col("Severity").isin(*settings.severities), F.lit(False)),
        "negative": F.col("Duration_min") < 0,
    }
    return [
        F.count_if(bad[n] if n in bad else F.col(c).isNull()).alias(n)
        for c, _, n in _quality_checks(base)
    ]


def check_quality(
    base: DataFrame, settings: Settings = DEFAULT, measured: DataFrame | None = None
) -> DataFrame:
    """Severity in its domain, no negative duration, key columns filled: one aggregate.

    ``measured`` is the row of ``quality_measures`` if it was taken elsewhere.
    """
    stats = base.agg(*quality_measures(base, settings)) if measured is None else measured
    found = [
        finding("data_quality", c, check, q(n) == 0, "0", q(n).cast("string"), "rows:")
        for c, check, n in _quality_checks(base)
    ]
    return stats.select(F.inline(F.array(*found)))


# ---------------------------------------------------------------- while rows pass


def watch(df: DataFrame, measures: Sequence[Column]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``df`` with aggregates taken as its rows pass, and their one row.

    The rows must first be written or counted, once and all of them; then the row is at
    hand without another pass. Measures of the same name are taken once.
    """
    schema = df.agg(*measures).schema
    named = dict(zip(schema.names, measures, strict=True))
    fields = [schema.fields[schema.names.index(n)] for n in named]
    seen = Observation()

    def row() -> DataFrame:
        return df.sparkSession.createDataFrame([tuple(seen.get[n] for n in named)], T.StructType(fields))

    return df.observe(seen, *named.values()), row


def guard_range(
    df: DataFrame, c: str, lo: float | None = None, hi: float | None = None, stage: str = ""
) -> DataFrame:
    """The rows as they are; the job that reads them fails on a value outside ``lo..hi``.

    The check is part of the plan, so nothing is read for it, and a plan that does not use
    the column does not check it. An absent column is skipped.
    """
    if c not in df.columns:
        return df
    bounds = [F.lit(False)]
    if lo is not None:
        bounds.append(q(c) < lo)
    if hi is not None:
        bounds.append(q(c) > hi)
    outside = F.coalesce(reduce(Column.__or__, bounds), F.lit(False))
    text = F.concat(F.lit(f"[{stage}] {c} outside {lo}..{hi}: "), q(c).cast("string"))
    return df.withColumn(c, F.when(outside, F.raise_error(text).cast(df.schema[c].dataType)).otherwise(q(c)))
