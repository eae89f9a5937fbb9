"""Column profiles: missing values, duplicates, distinct values, ranges, boxes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayside.config import SANITY_COLS
from wayside.functions.numeric import percent
from wayside.operators.scale import (
    SCALARS,
    exact_quantiles,
    quantile_name,
    scalar,
    value_counts_long,
    with_scalars,
)
from wayside.operators.star import row_order
from wayside.session import materialize


def q(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{name}`")


def unpivot_stats(one_row: DataFrame, cols: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """One row per column from a one-row frame with columns ``<field>|<column>``."""
    rows = [
        F.struct(
            F.lit(c).alias("column"), *[q(f"{f}|{c}").alias(alias) for f, alias in fields.items()]
        )
        for c in cols
    ]
    return one_row.select(F.inline(F.array(*rows)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values: how many, and in percent of the rows."""
    cols = list(cols or df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(q(c).isNull()).alias(f"missing|{c}") for c in cols],
    )
    one = one.withColumns({f"pct|{c}": percent(q(f"missing|{c}"), "n") for c in cols})
    long = unpivot_stats(one, cols, {"missing": "missing", "pct": "missing_pct"})
    return long.where(F.col("missing") > 0)


def top_missing(df: DataFrame, n: int = 10) -> DataFrame:
    return null_profile(df).orderBy(F.col("missing").desc(), F.col("column")).limit(n)


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: rows beyond the first of their key, or of the whole row.

    Two 64-bit hashes of a row cross the network instead of the row. Those that occur twice
    are written first; without any, no row is read again. Rows that agree on both hashes are
    compared in full, and only they are shuffled if Spark broadcasts the written hashes.
    """
    cols = [q(c) for c in (keys or df.columns)]
    if len(cols) == 1:
        groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
        return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"))
    marked = df.select(F.xxhash64(*cols).alias("__h1"), F.xxhash64(F.lit(1), *cols).alias("__h2"), *cols)
    often = marked.groupBy("__h1", "__h2").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    often = materialize(often)
    if often.isEmpty():
        return often.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("duplicates"))
    same = marked.join(often.select("__h1", "__h2"), ["__h1", "__h2"], "left_semi")
    groups = same.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"))


def distinct_profile(
    df: DataFrame, cols: Sequence[str] | None = None, rsd: float | None = None
) -> DataFrame:
    """Distinct non-null values per column; with ``rsd`` estimated in one pass.

    Columns of one type are counted together, as values of that type.
    """
    cols = list(cols or df.columns)
    if rsd is not None:
        one = df.agg(*[F.approx_count_distinct(q(c), rsd).alias(f"n|{c}") for c in cols])
        return unpivot_stats(one, cols, {"n": "n_distinct"})
    by_type: dict[str, list[str]] = {}
    for c in cols:
        kind = df.schema[c].dataType
        plain = isinstance(kind, T.AtomicType)
        by_type.setdefault(kind.simpleString() if plain else "string", []).append(c)
    counted = [
        value_counts_long(df, some, kind, keep_null=True)
        .groupBy(F.col("name").alias("column"))
        .agg(F.count("value").alias("n_distinct"))
        for kind, some in by_type.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def range_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Minimum, maximum and share of nulls per numeric column."""
    cols = [c for c in (cols or numeric_columns(df)) if c in df.columns]
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(q(c)).cast("double").alias(f"min|{c}") for c in cols],
        *[F.max(q(c)).cast("double").alias(f"max|{c}") for c in cols],
        *[F.count_if(q(c).isNull()).alias(f"nulls|{c}") for c in cols],
    )
    one = one.withColumns({f"null_pct|{c}": percent(q(f"nulls|{c}"), "n") for c in cols})
    return unpivot_stats(one, cols, {"min": "min", "max": "max", "null_pct": "null_pct"})


def sanity_check(df: DataFrame) -> DataFrame:
    """The range profile of the columns that tend to go wrong, as far as present."""
    return range_profile(df, SANITY_COLS)


def column_profile(df: DataFrame) -> DataFrame:
    """Position, type, non-null values and the first value seen, per column.

    ``is_location`` marks names that speak of coordinates. In a table without row_seq and
    ID no row is first, and the sample is the smallest value as text.
    """
    cols = df.columns
    ordered = "row_seq" in cols or "ID" in cols

    def sample(c: str) -> Column:
        text = q(c).cast("string")
        return F.min_by(text, F.when(q(c).isNotNull(), row_order(df))) if ordered else F.min(text)

    one = df.agg(
        *[F.count(q(c)).alias(f"non_null|{c}") for c in cols],
        *[sample(c).alias(f"sample|{c}") for c in cols],
    )
    long = unpivot_stats(one, cols, {"non_null": "non_null", "sample": "sample"})
    place = F.create_map(
        *[x for i, c in enumerate(cols, 1) for x in (F.lit(c), F.lit(i))]
    )
    kind = F.create_map(
        *[x for f in df.schema for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))]
    )
    return long.select(
        place[F.col("column")].alias("position"),
        "column",
        kind[F.col("column")].alias("type"),
        "non_null",
        "sample",
        F.lower("column").rlike("lat|lng|lon|coord").alias("is_location"),
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")
    )


def box_summary(
    df: DataFrame, cols: Sequence[str], m: float = 1.5, accuracy: int | None = None
) -> DataFrame:
    """Quartiles, whisker ends and outlier count: the numbers of a box plot."""
    probs = (0.25, 0.5, 0.75)
    cols = [c for c in cols if c in df.columns]
    quarts = exact_quantiles(df, cols, probs, accuracy)

    def at(c: str, p: float) -> Column:
        return scalar(quantile_name(c, p))

    parts = []
    for c in cols:
        span = at(c, 0.75) - at(c, 0.25)
        lo, hi = at(c, 0.25) - m * span, at(c, 0.75) + m * span
        parts += [
            F.min(F.when(q(c) >= lo, q(c))).cast("double").alias(f"low|{c}"),
            F.max(F.when(q(c) <= hi, q(c))).cast("double").alias(f"high|{c}"),
            F.count_if((q(c) < lo) | (q(c) > hi)).alias(f"out|{c}"),
        ]
    one = with_scalars(df, quarts).agg(F.first(SCALARS).alias(SCALARS), *parts)
    one = one.withColumns({f"q{int(p * 100)}|{c}": at(c, p) for c in cols for p in probs})
    return unpivot_stats(
        one,
        cols,
        {
            "q25": "q1",
            "q50": "median",
            "q75": "q3",
            "low": "whisker_low",
            "high": "whisker_high",
            "out": "n_outliers",
        },
    )
