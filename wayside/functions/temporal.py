"""Timestamp repair, calendar parts and durations as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayside.config import DAY_NAMES, RUSH_HOURS, HourScheme
from wayside.functions.numeric import _col, clip_to

# Fixed value: the only text format that counts as well formed.
DATETIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def parse_timestamp(c: Column | str) -> Column:
    """Zone-free timestamp, null where the text is no timestamp."""
    return _col(c).try_cast("timestamp_ntz")


def repaired_text(c: Column | str) -> Column:
    """Trim, drop an all-zero fraction, then drop characters foreign to a timestamp."""
    no_fraction = F.regexp_replace(F.trim(_col(c)), r"\.(0{9}|0{6})$", "")
    return F.trim(F.regexp_replace(no_fraction, r"[^0-9\-: .]", ""))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from start to end as double, whatever the zone of the session."""
    span = (_col(end) - _col(start)).cast("interval second")
    return span.cast("decimal(20,6)").cast("double") / 60


def duration_minutes(
    start: Column | str, end: Column | str, lo: float = 0.0, hi: float = 1440.0
) -> Column:
    """Minutes from start to end, capped to [lo, hi]; null stays null."""
    return clip_to(minutes_between(start, end), F.lit(float(lo)), F.lit(float(hi)))


def day_of_week(c: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(_col(c))


def day_name(c: Column | str) -> Column:
    return F.date_format(_col(c), "EEEE")


def day_name_from_index(i: Column | str) -> Column:
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.get(names, _col(i).cast("int"))


def hour_bucket(hour: Column | str, scheme: HourScheme) -> Column:
    """Label of the hour: one lookup in a constant array of 24 labels."""
    by_hour = [
        next((label for lo, hi, label in scheme.ranges if lo <= h < hi), scheme.otherwise)
        for h in range(24)
    ]
    labels = F.array(*[F.lit(label) for label in by_hour])
    return F.coalesce(F.get(labels, _col(hour).cast("int")), F.lit(scheme.otherwise))


def is_rush_hour(hour: Column | str) -> Column:
    return F.coalesce(_col(hour).isin(*RUSH_HOURS).cast("int"), F.lit(0))


def is_weekend(weekday: Column | str) -> Column:
    return F.coalesce((_col(weekday) >= 5).cast("int"), F.lit(0))
