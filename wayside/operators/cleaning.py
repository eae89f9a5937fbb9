"""Filters, imputation, capping, binning and datetime repair on incident rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayside.config import (
    DEFAULT,
    EXPLORATORY_FILLS,
    EXPLORATORY_MEDIANS,
    EXPLORATORY_SIBLINGS,
    SENSOR_COLS,
)
from wayside.functions.numeric import bin_label, clip_to, percent
from wayside.functions.temporal import (
    DATETIME_PATTERN,
    minutes_between,
    parse_timestamp,
    repaired_text,
)
from wayside.operators.scale import SCALARS, exact_quantiles, quantile_name, scalar, with_scalars


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def _is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


# ---------------------------------------------------------------- filters


def with_timestamps(df: DataFrame, cols: Sequence[str] = ("Start_Time", "End_Time")) -> DataFrame:
    """Text columns become zone-free timestamps, null where they do not parse."""
    texts = [c for c in present(df, cols) if _is_text(df, c)]
    return df.withColumns({c: parse_timestamp(c) for c in texts}) if texts else df


def filter_years(df: DataFrame, start: int, end: int, ts: str = "Start_Time") -> DataFrame:
    """Rows that start in ``start..end`` (inclusive), with their Year.

    The filter is a range on the timestamp itself, so a columnar scan can skip
    row groups; rows without a timestamp drop out.
    """
    parsed = with_timestamps(df, [ts, "End_Time"])
    lower = F.lit(f"{start:04d}-01-01 00:00:00").cast("timestamp_ntz")
    upper = F.lit(f"{end + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    kept = parsed.where((F.col(ts) >= lower) & (F.col(ts) < upper))
    return kept.withColumn("Year", F.year(ts))


def drop_outside_domain(df: DataFrame, c: str, values: Sequence[Any]) -> DataFrame:
    """Keep rows whose value is allowed; a null value is not."""
    return df.where(F.col(c).isin(*values))


def rows_outside_domain(df: DataFrame, c: str, values: Sequence[Any]) -> DataFrame:
    """Rows whose value is not allowed, null included."""
    return df.where(~F.coalesce(F.col(c).isin(*values), F.lit(False)))


def select_available(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in present(df, cols)])


# ---------------------------------------------------------------- imputation


def medians(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """One row with the median of each column."""
    found = exact_quantiles(df, cols, [0.5], accuracy)
    return found.select(*[F.col(f"`{quantile_name(c, 0.5)}`").alias(c) for c in cols])


def impute_median(
    df: DataFrame,
    cols: Sequence[str] = SENSOR_COLS,
    accuracy: int | None = None,
) -> DataFrame:
    """Fill nulls with the median of the column as it is in ``df``."""
    cols = present(df, cols)
    if not cols:
        return df
    filled = with_scalars(df, medians(df, cols, accuracy))
    return filled.withColumns({c: F.coalesce(F.col(c), scalar(c)) for c in cols}).drop(SCALARS)


def impute_constant(df: DataFrame, fills: Mapping[str, Any]) -> DataFrame:
    wanted = {c: v for c, v in fills.items() if c in df.columns}
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in wanted.items()}
    ) if wanted else df


def impute_from_column(df: DataFrame, target: str, source: str) -> DataFrame:
    return df.withColumn(
        target, F.coalesce(F.col(target), F.col(source).cast(df.schema[target].dataType))
    )


def impute_exploratory(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """The exploratory variant: medians, constants, then sibling columns."""
    filled = impute_constant(impute_median(df, EXPLORATORY_MEDIANS, accuracy), EXPLORATORY_FILLS)
    for target, source in EXPLORATORY_SIBLINGS:
        if target in filled.columns and source in filled.columns:
            filled = impute_from_column(filled, target, source)
    return filled


# ---------------------------------------------------------------- capping


def clip(df: DataFrame, c: str, lo: float, hi: float) -> DataFrame:
    return df.withColumn(c, clip_to(c, F.lit(float(lo)), F.lit(float(hi))))


def cap_column(
    df: DataFrame,
    c: str = "Duration_min",
    lo: float = 0.0,
    hi: float = DEFAULT.duration_max_min,
) -> DataFrame:
    if c not in df.columns:
        raise ValueError(f"no column {c}; derive it with add_duration")
    return clip(df, c, lo, hi)


def add_duration(
    df: DataFrame,
    start: str = "Start_Time",
    end: str = "End_Time",
    out: str = "Duration_min",
    hi: float = DEFAULT.duration_max_min,
) -> DataFrame:
    # in two steps, so that the difference is computed once per row
    timed = with_timestamps(df, [start, end]).withColumn(out, minutes_between(start, end))
    return clip(timed, out, 0.0, hi)


def cap_count(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """One row per column: how many values lie below and above its bounds."""
    cols = present(df, list(bounds))
    one = df.agg(
        *[F.count_if(F.col(c) < bounds[c][0]).alias(f"low|{c}") for c in cols],
        *[F.count_if(F.col(c) > bounds[c][1]).alias(f"high|{c}") for c in cols],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"`low|{c}`").alias("n_low"),
            F.col(f"`high|{c}`").alias("n_high"),
        )
        for c in cols
    ]
    return one.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- outliers


def sigma_bounds(df: DataFrame, c: str, k: float = 3.0) -> DataFrame:
    """One row (lo, hi): mean -/+ k population standard deviations."""
    stats = df.agg(F.avg(c).alias("m"), F.stddev_pop(c).alias("s"))
    return stats.select(
        (F.col("m") - k * F.col("s")).alias("lo"), (F.col("m") + k * F.col("s")).alias("hi")
    )


def iqr_bounds(df: DataFrame, c: str, m: float = 1.5, accuracy: int | None = None) -> DataFrame:
    """One row (lo, hi): quartiles -/+ m interquartile ranges."""
    q = exact_quantiles(df, [c], [0.25, 0.75], accuracy)
    q1, q3 = (F.col(f"`{quantile_name(c, p)}`") for p in (0.25, 0.75))
    return q.select((q1 - m * (q3 - q1)).alias("lo"), (q3 + m * (q3 - q1)).alias("hi"))


def _capped(df: DataFrame, c: str, bounds: DataFrame) -> DataFrame:
    kept = clip_to(F.col(c).cast("double"), scalar("lo"), scalar("hi"))
    return with_scalars(df, bounds).withColumn(c, kept).drop(SCALARS)


def _inside(c: str) -> Column:
    return (F.col(c) >= scalar("lo")) & (F.col(c) <= scalar("hi"))


def _outside(c: str) -> Column:
    return (F.col(c) < scalar("lo")) | (F.col(c) > scalar("hi"))


def _kept(df: DataFrame, condition: Column, bounds: DataFrame) -> DataFrame:
    return with_scalars(df, bounds).where(condition).drop(SCALARS)


def cap_sigma(df: DataFrame, c: str, k: float = 3.0) -> DataFrame:
    return _capped(df, c, sigma_bounds(df, c, k))


def drop_sigma_outliers(df: DataFrame, c: str, k: float = 3.0) -> DataFrame:
    """Rows inside the bounds; a null value is outside."""
    return _kept(df, _inside(c), sigma_bounds(df, c, k))


def sigma_outliers(df: DataFrame, c: str, k: float = 3.0) -> DataFrame:
    return _kept(df, _outside(c), sigma_bounds(df, c, k))


def cap_iqr(df: DataFrame, c: str, m: float = 1.5, accuracy: int | None = None) -> DataFrame:
    return _capped(df, c, iqr_bounds(df, c, m, accuracy))


def drop_iqr_outliers(
    df: DataFrame, c: str, m: float = 1.5, accuracy: int | None = None
) -> DataFrame:
    return _kept(df, _inside(c), iqr_bounds(df, c, m, accuracy))


def iqr_outliers(df: DataFrame, c: str, m: float = 1.5, accuracy: int | None = None) -> DataFrame:
    return _kept(df, _outside(c), iqr_bounds(df, c, m, accuracy))


def outlier_summary(df: DataFrame, c: str, bounds: DataFrame) -> DataFrame:
    """One row: bounds, rows, outliers, outliers in percent of rows, rows kept."""
    counted = with_scalars(df, bounds).agg(
        F.first(SCALARS).alias(SCALARS),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(_outside(c)).alias("n_outliers"),
        F.count_if(_inside(c)).alias("n_kept"),
    )
    return counted.select(
        scalar("lo").alias("lo"),
        scalar("hi").alias("hi"),
        "n_rows",
        "n_outliers",
        percent("n_outliers", "n_rows").alias("outlier_pct"),
        "n_kept",
    )


def bin_numeric(
    df: DataFrame, c: str, edges: Sequence[float], labels: Sequence[str], out: str
) -> DataFrame:
    return df.withColumn(out, bin_label(c, edges, labels))


# ---------------------------------------------------------------- types and texts


def narrow_types(df: DataFrame, floats: bool = False) -> DataFrame:
    """Cast whole-number columns to the smallest type that holds their values.

    One aggregate finds all ranges; a single row reaches the driver. With
    ``floats`` doubles become single precision, which loses digits.
    """
    sizes = (
        (T.ByteType(), -(2**7), 2**7 - 1),
        (T.ShortType(), -(2**15), 2**15 - 1),
        (T.IntegerType(), -(2**31), 2**31 - 1),
    )
    whole = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    casts: dict[str, Column] = {}
    if whole:
        row = df.agg(
            *[F.min(F.col(f"`{c}`")).cast("long").alias(f"lo|{c}") for c in whole],
            *[F.max(F.col(f"`{c}`")).cast("long").alias(f"hi|{c}") for c in whole],
        ).head()
        for c in whole:
            lo, hi = row[f"lo|{c}"], row[f"hi|{c}"]
            fits = [t for t, a, b in sizes if lo is not None and a <= lo and hi <= b]
            if fits:
                casts[c] = F.col(f"`{c}`").cast(fits[0])
    if floats:
        for f in df.schema:
            if isinstance(f.dataType, T.DoubleType):
                casts[f.name] = F.col(f"`{f.name}`").cast("float")
    return df.withColumns(casts) if casts else df


def repair_datetime(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """Clean the text of a timestamp and parse it; what still fails is null."""
    return df.withColumn(out or c, parse_timestamp(repaired_text(c)))


def bad_datetime_rows(df: DataFrame, c: str) -> DataFrame:
    """Rows whose text is not in the plain format or does not parse, saying which."""
    checked = df.withColumns(
        {
            "well_formed": F.coalesce(F.col(c).rlike(DATETIME_PATTERN), F.lit(False)),
            "parses": parse_timestamp(c).isNotNull(),
        }
    )
    return checked.where(~F.col("well_formed") | ~F.col("parses"))


def bad_datetime_values(df: DataFrame, c: str) -> DataFrame:
    """Distinct non-null bad values with their counts."""
    return (
        bad_datetime_rows(df.where(F.col(c).isNotNull()), c)
        .groupBy(c, "well_formed", "parses")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bad_datetime_count(df: DataFrame, c: str) -> DataFrame:
    """One row: rows, rows not in the plain format, rows that do not parse."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.coalesce(F.col(c).rlike(DATETIME_PATTERN), F.lit(False))).alias(
            "n_bad_format"
        ),
        F.count_if(parse_timestamp(c).isNull()).alias("n_unparsed"),
    )
