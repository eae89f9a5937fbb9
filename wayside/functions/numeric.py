"""Scores, labels, rounding and guarded division as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayside.config import (
    DEFAULT,
    INFRA_COLS,
    INFRA_WEIGHTS,
    RISK_MOST,
    RISK_STEPS_DURATION,
    RISK_STEPS_SEVERITY,
    SEVERITY_LABELS,
    WEATHER_BASE_RISK,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ladder(steps: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """First true condition wins."""
    chain = None
    for condition, value in steps:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return F.lit(otherwise) if chain is None else chain.otherwise(otherwise)


def round_even(c: Column | str, digits: int) -> Column:
    """Half-to-even rounding of a double (Spark's own ``round`` is half-up)."""
    scale = F.lit(float(10**digits))
    return F.rint(_col(c).cast("double") * scale) / scale


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double, null where b is 0 or null."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def percent(a: Column | str, b: Column | str) -> Column:
    return ratio(a, b) * 100


def pct_change(current: Column | str, previous: Column | str) -> Column:
    """(current - previous) / previous in percent, null without a previous value."""
    return percent(_col(current) - _col(previous), previous)


def impact_pct(value: Column | str, baseline: Column | str) -> Column:
    """As ``pct_change``, but 0 where the baseline is 0 or null."""
    base = _col(baseline)
    return F.when(base.isNull() | (base == 0), F.lit(0.0)).otherwise(pct_change(value, base))


def z_score(value: Column | str, mean: Column | str, std: Column | str) -> Column:
    return F.coalesce(ratio(_col(value) - _col(mean), std), F.lit(0.0))


def clip_to(c: Column | str, lo, hi) -> Column:
    """Cap to bounds; null stays null. Bounds are numbers or Columns."""
    c = _col(c)
    return F.when(c < lo, lo).when(c > hi, hi).otherwise(c)


def high_severity_flag(sev: Column | str, threshold: int = DEFAULT.high_severity) -> Column:
    return F.coalesce((_col(sev) >= threshold).cast("int"), F.lit(0))


def low_visibility_flag(vis: Column | str, limit: float = DEFAULT.low_visibility) -> Column:
    return F.coalesce((_col(vis) < limit).cast("int"), F.lit(0))


def severity_label(sev: Column | str) -> Column:
    c = _col(sev)
    return ladder(((c == value, label) for value, label in SEVERITY_LABELS), "Unknown")


def infra_score(cols: Sequence[str] = INFRA_COLS) -> Column:
    """How many of the flags are set; 0 without any flag column."""
    flags = [F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in cols]
    return reduce(lambda a, b: a + b, flags, F.lit(0))


def weighted_infra_score(weights: Sequence[tuple[str, int]] = INFRA_WEIGHTS) -> Column:
    """Weighted sum of the per-location feature counts."""
    parts = [F.coalesce(F.col(c).cast("long"), F.lit(0)) * w for c, w in weights]
    return reduce(lambda a, b: a + b, parts, F.lit(0).cast("long"))


def dominant_feature(cols: Sequence[str] = INFRA_COLS) -> Column:
    """Name of the largest column, the first one on ties, 'None' if all are 0."""
    if not cols:
        return F.lit("None")
    values = [F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in cols]
    top = values[0] if len(values) == 1 else F.greatest(*values)
    named = ladder((v == top, name) for v, name in zip(values, cols))
    all_zero = reduce(lambda a, b: a & b, [v == 0 for v in values])
    return F.when(all_zero, F.lit("None")).otherwise(named)


def weather_risk_score(
    category: Column | str,
    severity_pct: Column | str,
    duration_pct: Column | str,
    unknown_base: int = 1,
) -> Column:
    """Base risk of the category plus 0-3 for severity and 0-2 for duration, at most 10."""
    cat, sev, dur = _col(category), _col(severity_pct), _col(duration_pct)
    base = ladder(((cat == name, F.lit(risk)) for name, risk in WEATHER_BASE_RISK), unknown_base)
    for_severity = ladder(((sev > above, F.lit(n)) for above, n in RISK_STEPS_SEVERITY), 0)
    for_duration = ladder(((dur > above, F.lit(n)) for above, n in RISK_STEPS_DURATION), 0)
    return F.least(base + for_severity + for_duration, F.lit(RISK_MOST))


def risk_category(
    score: Column | str, thresholds: tuple[int, int, int] = DEFAULT.risk_thresholds
) -> Column:
    s = _col(score)
    extreme, high, moderate = thresholds
    return ladder(
        ((s >= extreme, "Extreme"), (s >= high, "High"), (s >= moderate, "Moderate")), "Low"
    )


def anomaly_category(
    z: Column | str, thresholds: tuple[float, float, float] = DEFAULT.z_thresholds
) -> Column:
    z = _col(z)
    critical, high, elevated = thresholds
    return ladder(
        ((z > critical, "Critical"), (z > high, "High"), (z > elevated, "Elevated")), "Normal"
    )


def bin_label(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the left-closed bin; null outside all bins."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    c = _col(c)
    return ladder(
        ((c >= lo) & (c < hi), label) for lo, hi, label in zip(edges, edges[1:], labels)
    )
