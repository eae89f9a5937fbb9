"""Building blocks for steps that would otherwise end in one task.

A running total or an exact quantile needs a global order. A window without a
partition key sends all rows to one task, and ``percentile`` keeps all distinct
values of a column in one buffer. Both are done the same way at every size: a running
total range-partitions the rows, writes them with their range number (so the ranges
cannot move), sums every range on its own, and takes each range's offset from the range
totals. A quantile is bracketed by a mergeable sketch; one more pass counts the values in
the bracket, a histogram of bounded size narrows the wanted rank to a slot of it, and only
that slot is ordered; nothing runs before the result is used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayside.operators import exact
from wayside.session import materialize

#: Size of the sketch that brackets a quantile, and the share of the rows on either side of it
#: that the bracket holds: four times the error that the sketch keeps to 99 times in 100.
SKETCH = 2000
MARGIN = 0.01
#: Up to so many values a column is bracketed by its ends.
FEW = 10_000
#: Parts of a bracket, and slots of equal width in each.
CUTS = 32
SLOTS = 4096

def scalar_struct(one_row: DataFrame) -> Column:
    """All columns of a one-row frame as one struct Column (a scalar subquery).

    Each use of the Column copies the plan of the frame; see ``with_scalars``.
    """
    return one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns])).scalar()


#: Column in which ``with_scalars`` puts the one row.
SCALARS = "__scalars"


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` with the one row as a struct column, whose plan is there once however often
    it is used, and not at all if it is not used."""
    return df.withColumn(SCALARS, scalar_struct(one_row))


def scalar(name: str) -> Column:
    return F.col(SCALARS).getField(name)


def by_sets(
    df: DataFrame, sets: Mapping[str, Sequence[str]], measures: Sequence[Column]
) -> dict[str, DataFrame]:
    """Several groupings of the same rows from one pass and one shuffle, computed once.

    Each row is added up in every grouping before the shuffle, which then moves
    only as many rows as there are groups, not their combinations.
    """
    cols = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    distinct = list(dict.fromkeys(tuple(keys) for keys in sets.values()))
    grouped = df.groupingSets([[F.col(c) for c in keys] for keys in distinct], *cols).agg(
        F.grouping_id(*cols).alias("__set"), *measures
    )
    once = materialize(grouped)

    def number(keys: Sequence[str]) -> int:
        # a bit per column, first column highest, set where the column is left out
        return int("".join("0" if c in keys else "1" for c in cols), 2)

    return {
        name: once.where(F.col("__set") == number(keys)).drop(
            "__set", *[c for c in cols if c not in keys]
        )
        for name, keys in sets.items()
    }


def in_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """The rows with ``__range``, the number of their range in ascending key order."""
    return materialize(df.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()))


def _starts(ranged: DataFrame, weights: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Per group and range: the sum of each weight over the ranges before it."""
    sums = [F.sum(w).alias(w) for w in weights]
    totals = ranged.groupBy(*by, "__range").agg(*sums)
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__range")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *[F.col(b).alias(f"__by_{b}") for b in by],
        F.col("__range").alias("__at"),
        *[F.sum(w).over(before).alias(f"{w}_start") for w in weights],
    )


def running_total(
    df: DataFrame, key: Sequence[str], weight: str, out: str, by: Sequence[str] = ()
) -> DataFrame:
    """Inclusive running sum of ``weight`` in ascending ``key`` order.

    ``key`` must be unique (within a group of ``by``). The sum of fractions is a double,
    added up exactly (see ``exact``) and rounded once. Null until a weight is not null.
    """
    by = list(by)
    ranged = in_ranges(df, *by, *key)
    parts, limbs = [F.col(f"`{weight}`")], None
    if exact.is_fraction(df, weight):
        limbs = exact.limbs_for(ranged, weight)
        parts = exact.split(F.col(f"`{weight}`"), limbs)
    names = [f"__weight{i}" for i in range(len(parts))]
    ranged = ranged.withColumns(dict(zip(names, parts, strict=True)))
    on = [F.col("__range") == F.col("__at")]
    on += [F.col(b).eqNullSafe(F.col(f"__by_{b}")) for b in by]
    inside = (
        Window.partitionBy(*by, "__range")
        .orderBy(*key)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = ranged.select(*df.columns, "__range", *[F.sum(n).over(inside).alias(n) for n in names])
    summed = summed.join(_starts(ranged, names, by), on, "left")
    totals = [
        F.coalesce(F.col(f"{n}_start") + F.col(n), F.col(f"{n}_start"), F.col(n)) for n in names
    ]
    return summed.select(
        *[F.col(f"`{c}`") for c in df.columns if c != out],
        (exact.joined(totals, limbs) if limbs else totals[0]).alias(out),
    )


def value_counts_long(
    df: DataFrame, cols: Sequence[str], as_type: str, keep_null: bool = False
) -> DataFrame:
    """(name, value, n): how often each value of each column occurs.

    One shuffle for all columns, of counted values instead of rows.
    """
    pairs = [
        F.struct(F.lit(c).alias("name"), _comparable(df, c).cast(as_type).alias("value"))
        for c in cols
    ]
    long = df.select(F.inline(F.array(*pairs)))
    if not keep_null:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def _comparable(df: DataFrame, c: str) -> Column:
    # -0.0 and 0.0 are one value, also once they are text
    floating = df.schema[c].dataType.typeName() in ("double", "float")
    return F.col(f"`{c}`") + F.lit(0.0) if floating else F.col(f"`{c}`")


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int | None = None
) -> DataFrame:
    """One row with column ``<col>|<p>`` per column and probability, interpolated linearly.

    Exact by default: a sketch of each column brackets every probability, one pass counts
    the values in a bracket and those below it, each wanted rank is narrowed to a thin slot
    of the bracket, and the slot is ordered. With ``accuracy`` the result is
    ``approx_percentile`` with that accuracy, in one pass. NaN counts as missing.
    """
    if accuracy is not None:
        return df.agg(
            *[
                F.approx_percentile(F.col(f"`{c}`"), float(p), accuracy).cast("double")
                .alias(quantile_name(c, p))
                for c in cols
                for p in probs
            ]
        )
    values = df.select(
        *[F.nanvl(_comparable(df, c).cast("double"), F.lit(None)).alias(f"c{i}") for i, c in enumerate(cols)]
    )
    wanted = [(i, float(p)) for i in range(len(cols)) for p in probs]
    names = [quantile_name(c, p) for c in cols for p in probs]
    sketches = ", ".join(
        f"kll_sketch_agg_double(c{i}, {SKETCH}) AS s{i}, count(c{i}) AS n{i}, min(c{i}) AS least{i}, max(c{i}) AS most{i}"
        for i in range(len(cols))
    )
    brackets = ", ".join(
        f"struct({k} AS pick, {i} AS of, {p!r}D AS p, n{i} AS total, CASE WHEN n{i} > {FEW}"
        f" THEN kll_sketch_get_quantile_double(s{i}, {_ranks_near(p)}) ELSE array(least{i}, most{i}) END AS edges)"
        for k, (i, p) in enumerate(wanted)
    )
    rows = ", ".join(f"struct({i} AS of, c{i} AS x)" for i in range(len(cols)))
    out = ", ".join(
        f"max(value) FILTER (WHERE pick = {k} AND rank = low) + (max(value) FILTER (WHERE pick = {k} AND rank = high)"
        f" - max(value) FILTER (WHERE pick = {k} AND rank = low)) * max(at - low) FILTER (WHERE pick = {k}) AS q{k}"
        for k in range(len(wanted))
    )
    found = df.sparkSession.sql(
        _QUANTILES.replace("SKETCHES", sketches)
        .replace("BRACKETS", brackets)
        .replace("COLUMNS", rows)
        .replace("PIECES", str(SLOTS))
        .replace("RESULTS", out),
        rows=values,
    )
    return found.toDF(*names)


def _ranks_near(p: float) -> str:
    """Ranks around a probability, as shares of the rows, at which a bracket is cut."""
    shares = [p + MARGIN * (2 * k / CUTS - 1) for k in range(CUTS + 1)]
    return "array(" + ", ".join(f"{min(1.0, max(0.0, r))!r}D" for r in shares) + ")"


# A pick is a column and a probability. Its bracket is cut at the edges, which the sketch
# spaces by rank, and between two edges into slots of equal width; slot -1 is what lies below.
# Slots do not decrease with the value, so the rows before a slot can be added up.
_QUANTILES = """
WITH sketched AS (SELECT SKETCHES FROM {rows}),
brackets AS (SELECT *, edges[0] AS lo, edges[size(edges) - 1] AS hi FROM (SELECT inline(array(BRACKETS)) FROM sketched)),
near AS (
  SELECT /*+ BROADCAST(b) */ pick, total, p, edges, x,
    CASE WHEN x >= lo THEN size(filter(edges, e -> e <= x)) - 1 ELSE -1 END AS j
  FROM (SELECT inline(array(COLUMNS)) FROM {rows}) v JOIN brackets b ON v.of = b.of AND x <= hi),
placed AS (
  SELECT pick, total, p, CASE WHEN j >= 0 THEN x END AS value, CASE WHEN j < 0 THEN -1
    WHEN j >= size(edges) - 1 THEN j * PIECES
    ELSE j * PIECES + floor(least(greatest(nanvl(coalesce(
      try_divide(x / 2 - edges[j] / 2, edges[j + 1] / 2 - edges[j] / 2), 0D), 0D) * PIECES, 0D), PIECES - 1D)) END AS slot
  FROM near),
counted AS (SELECT pick, total, p, slot, value, count(*) AS n FROM placed GROUP BY pick, total, p, slot, value),
slots AS (SELECT pick, total, p, slot, sum(n) AS n FROM counted GROUP BY pick, total, p, slot),
summed AS (
  SELECT pick, slot, p * (total - 1) AS at, n, sum(n) OVER (PARTITION BY pick ORDER BY slot) AS stop,
    sum(n) OVER (PARTITION BY pick) AS found FROM slots),
ranked AS (
  SELECT pick, slot, at, floor(at) AS low, ceil(at) AS high, stop - n AS before, stop, found,
    explode(array_distinct(array(floor(at), ceil(at)))) AS rank FROM summed),
held AS (
  SELECT pick, slot, at, low, high, before, CASE WHEN slot >= 0 AND rank < found THEN rank
    ELSE CAST(raise_error('a quantile lies outside its bracket; raise MARGIN') AS BIGINT) END AS rank
  FROM ranked WHERE before <= rank AND rank < stop OR rank >= found),
ordered AS (
  SELECT /*+ BROADCAST(h) */ h.pick, at, low, high, rank, value, n,
    before + sum(n) OVER (PARTITION BY h.pick, rank ORDER BY value) AS stop
  FROM counted c JOIN held h ON c.pick = h.pick AND c.slot = h.slot)
SELECT RESULTS FROM ordered WHERE stop - n <= rank AND rank < stop
"""


def quantile_name(c: str, p: float) -> str:
    return f"{c}|{p:g}"
