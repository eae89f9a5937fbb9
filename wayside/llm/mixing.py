"""Repetition of documents so that sources come to target weights.

Only DataFrame functions: sizes are added up per source, the targets are found among the
sources, and each document is repeated floor(rate) times plus once more with a
probability of the fraction, decided by a hash of its id and a seed. The draws of a source
are not independent: its documents are repeated in the order of their hashes until the words
reach the target, so that small sources come near it as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayside.llm.spans import WORD
from wayside.operators.scale import running_total
from wayside.session import materialize

#: Weights by rank of the source's name, repeating; share of all sizes; most repeats.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
#: The table of sources is broadcast up to this size, counted from its names.
MAX_BROADCAST_BYTES = 32 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    A target is weight * level, or ``most`` times the source's size if that is less; the
    level is the one at which the targets add up to ``share`` of all sizes. This is where
    sharing the excess again by weight ends. Sources in ascending order of bound per
    weight reach their bound first, so the level follows from running sums over sources.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    sources = sizes.withColumn("w", weight.cast("long")).withColumn("bound", most * F.col("source_size"))
    up = Window.orderBy((F.col("bound") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    step = sources.select(
        "*",
        F.coalesce(F.sum("bound").over(before), F.lit(0)).alias("full"),
        F.sum("w").over(after).alias("open"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("all"),
    ).withColumn("level_full", F.col("all") - F.col("full"))
    # the first source whose bound is not reached by the level of those from it on
    ends = F.col("w") * F.col("level_full") / F.col("open") <= F.col("bound")
    step = step.withColumn("ends", F.when(ends, F.struct("level_full", "open")))
    first = F.first("ends", ignorenulls=True).over(
        up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    level = F.col("w") * F.col("at.level_full") / F.col("at.open")
    return step.withColumn("at", first).select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("bound").cast("double"), level), F.col("bound").cast("double")).alias("target"),
    )


def _draw(doc_id: Column, seed: str) -> Column:
    """A whole number below 2**48 from the hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("long")


def _rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))


def _by_source(rows: DataFrame, table: DataFrame, source: str) -> DataFrame:
    """``rows`` with the columns of a table of one row per source (``__of``)."""
    held = table.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("__of"), F.lit(0)) + 64), F.lit(0))).first()[0]
    if held <= MAX_BROADCAST_BYTES:
        table = F.broadcast(table)
    return rows.join(table, rows[f"`{source}`"].eqNullSafe(F.col("__of"))).drop("__of")


def _with_targets(rows: DataFrame, sized: DataFrame, source: str, how: tuple, seed: str) -> DataFrame:
    """``rows`` with their source's size, target and cut, from the sized rows.

    The cut is the last draw, in ascending order, up to which a source's documents are
    repeated once more: as many as bring its words nearest to the target.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, *how).withColumnRenamed("source", "__of"))
    draws = sized.groupBy("source", _draw(F.col("doc_id"), seed).alias("draw")).agg(F.sum("size").alias("size"))
    upto = running_total(draws, ["draw"], "size", "upto", by=["source"])
    more = (_rate() - F.floor(_rate())) * F.col("source_size")
    some = _by_source(upto, targets, "source").where((more > 0) & (F.col("upto") - F.col("size") / 2.0 <= more))
    cuts = some.groupBy(F.col("source").alias("__source")).agg(F.max("draw").alias("cut"))
    held = targets.join(cuts, F.col("__of").eqNullSafe(F.col("__source")), "left").drop("__source")
    return _by_source(rows, materialize(held), source)


def _copies(doc_id: Column, seed: str) -> Column:
    """Whole repeats of the rate, and one more if the draw of the id is not beyond the cut."""
    once_more = F.coalesce(_draw(doc_id, seed) <= F.col("cut"), F.lit(False))
    return (F.floor(_rate()) + once_more.cast("long")).cast("long")


def _sized(docs: DataFrame, text_col: str, source_col: str, *more: Column) -> DataFrame:
    size = word_count(F.col(f"`{text_col}`")).alias("size")
    return materialize(docs.select(*more, F.col(f"`{source_col}`").alias("source"), size))


def with_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """(id, source, size, source_size, target, copies) for every row of ``docs``.

    Sizes are words; a null text has size 0, a null source is a source of its own, ranked
    last. A source of size 0 has target 0 and its documents no copies. Repeated rows of an
    id, and rows without one (as of an empty id), are decided by the same draw. Other
    columns are ignored; an empty table gives an empty one.
    """
    sized = _sized(docs, text_col, source_col, F.col(f"`{id_col}`").alias("doc_id"))
    mixed = _with_targets(sized, sized, "source", (weights, share, most), seed)
    return mixed.select(
        F.col("doc_id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        _copies(F.col("doc_id"), seed).alias("copies"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """The mixture: the rows of ``docs`` with their columns, each as often as ``with_copies`` says."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*names.values())
    sized = _sized(docs, text_col, source_col, F.col(f"`{id_col}`").alias("doc_id"))
    mixed = _with_targets(rows, sized, names[source_col], (weights, share, most), seed)
    times = _copies(F.col(names[id_col]), seed).cast("int")
    return (
        mixed.withColumn("times", times)
        .where("times > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(*[F.col(n).alias(c) for c, n in names.items()])
    )
