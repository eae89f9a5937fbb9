"""Text classification and keys as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayside.functions.numeric import _col, ladder


def lowered(c: Column | str) -> Column:
    """Lower-cased text, empty for null: what keywords are looked up in."""
    return F.coalesce(F.lower(_col(c)), F.lit(""))


def _contains_any(low: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [low.contains(w.lower()) for w in words])


def category_of(low: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """First rule with a keyword in an already lowered text."""
    return ladder(((_contains_any(low, words), name) for name, words in rules), default)


def flag_of(low: Column, words: Sequence[str]) -> Column:
    return _contains_any(low, words).cast("int")


def categorize_text(
    c: Column | str,
    rules: Sequence[tuple[str, Sequence[str]]],
    default: str = "Clear",
    null_as: str | None = None,
) -> Column:
    """First rule with a keyword in the lower-cased text wins.

    A null text gets ``null_as``, or ``default`` when that is not given.
    """
    found = category_of(lowered(c), rules, default)
    if null_as is None or null_as == default:
        return found
    return F.when(_col(c).isNull(), F.lit(null_as)).otherwise(found)


def keyword_flag(c: Column | str, words: Sequence[str]) -> Column:
    """1 where any of the words occurs, ignoring case; null counts as 0."""
    return flag_of(lowered(c), words)


def location_key(
    cols: Sequence[str] = ("Street", "City"), sep: str = "_", null_as: str = "Unknown"
) -> Column:
    return F.concat_ws(sep, *[F.coalesce(F.col(c), F.lit(null_as)) for c in cols])
