"""Sums of doubles that do not depend on the order in which rows are added up.

A double is a whole number of units of a power of two, so it can be cut, without loss, into
signed limbs of ``LIMB`` bits whose units are ``LIMB`` exponents apart. Limbs are added up as
whole numbers, in any order and in any number of steps, and only the end result is rounded.
How many limbs a column needs follows from its smallest and its largest magnitude: about
four for values of similar size, 89 for all that a double can hold.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a limb. A sum of limbs fits a long for up to 2**39 rows.
LIMB = 24
_DIGIT = 1 << LIMB
#: Up to so many limbs are put together by one compiled expression, whose size grows with
#: their square; more, as only values of very different sizes need, by functions on arrays.
PLAIN = 8


class Limbs(NamedTuple):
    """Exponent of the lowest limb's unit, number of limbs, and whether all values are finite."""

    low: int
    n: int
    finite: bool

    def units(self, more: int = 0) -> list[float]:
        at = range(self.low, self.low + LIMB * (self.n + more), LIMB)
        return [math.ldexp(1.0, e) if e < 1024 else math.inf for e in at]


def is_fraction(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != float("inf"))


def limbs_for(df: DataFrame, c: str) -> Limbs:
    """The limbs that hold every value of a column; one pass over it."""
    x = F.col(f"`{c}`").cast("double")
    size = F.when(_finite(x) & (x != 0), F.abs(x))
    least, most, odd = df.agg(F.min(size), F.max(size), F.count_if(x.isNotNull() & ~_finite(x))).first()
    if least is None:
        return Limbs(0, 1, not odd)
    low = max(math.frexp(least)[1] - 53, -1074)
    high = math.frexp(most)[1]
    n = max(0, -(-(high - low - (LIMB - 1)) // LIMB)) + 1
    # the topmost unit must itself be a double
    return Limbs(low, n - (low + LIMB * (n - 1) > 1023), not odd)


def split(x: Column, limbs: Limbs) -> list[Column]:
    """The limbs of a value, lowest first, and last the value itself if it is not finite."""
    x = x.cast("double")
    whole = x if limbs.finite else F.when(x.isNull() | _finite(x), x).otherwise(0.0)
    units = limbs.units()
    # in whole units of a limb, rounded; what the next limb up takes is left out
    rounded = [F.rint(whole / unit) for unit in units]
    out = []
    for i, unit in enumerate(units):
        limb = rounded[i]
        if i + 1 < limbs.n:
            limb = limb - rounded[i + 1] * float(_DIGIT)
            # a double has 53 bits; one this large has none so far down
            most = unit * 2.0**78
            if not math.isinf(most):
                limb = F.when(F.abs(whole) < most, limb).when(whole.isNotNull(), 0.0)
        out.append(limb.cast("long"))
    if not limbs.finite:
        out.append(F.when(x.isNotNull(), F.when(_finite(x), 0.0).otherwise(x)))
    return out


def _digits(sums: Column) -> Column:
    """carry and digits (all from 0 to 2**LIMB - 1, lowest first) of an array of sums of limbs."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("digits"))

    def step(done: Column, s: Column) -> Column:
        v = done["carry"] + s
        return F.struct(
            F.shiftright(v, LIMB).alias("carry"),
            F.concat(done["digits"], F.array(v.bitwiseAND(F.lit(_DIGIT - 1)))).alias("digits"),
        )

    return F.aggregate(sums, start, step)


def _plain(sums: Sequence[Column], units: Sequence[float], sign: int) -> tuple[Column, Column]:
    """What ``_digits`` carries over, and the double made of the digits, for ``sign`` times the
    sums; without arrays, so that Spark compiles it."""
    total, carry = F.lit(0.0), None
    for s, unit in zip([*sums, None], units, strict=True):
        if s is None:
            digit = carry
        else:
            s = s if sign > 0 else -s
            v = s if carry is None else carry + s
            digit, carry = v.bitwiseAND(F.lit(_DIGIT - 1)), F.shiftright(v, LIMB)
        term = digit * F.lit(unit)
        # nothing times a unit that is no double is nothing
        total = total + (F.when(digit == 0, 0.0).otherwise(term) if math.isinf(unit) else term)
    return carry, total


def joined(sums: Sequence[Column], limbs: Limbs) -> Column:
    """The double nearest to a sum, from the sums of what ``split`` made; null if they are."""
    limb_sums, units = sums[: limbs.n], limbs.units(1)
    # the digits of a negative number are those of its opposite
    if limbs.n <= PLAIN:
        carry, total = _plain(limb_sums, units, 1)
        total = F.when(carry < 0, -_plain(limb_sums, units, -1)[1]).otherwise(total)
    else:
        parts = F.array(*limb_sums)
        sign = F.when(_digits(parts)["carry"] < 0, -1).otherwise(1).cast("long")
        found = _digits(F.transform(parts, lambda s: s * sign))
        digits = F.concat(found["digits"], F.array(found["carry"]))
        terms = F.zip_with(
            digits, F.array(*[F.lit(u) for u in units]), lambda d, u: F.when(d == 0, 0.0).otherwise(d * u)
        )
        total = sign * F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    if not limbs.finite:
        total = F.when(sums[limbs.n] == 0, total).otherwise(sums[limbs.n])
    return F.when(sums[0].isNotNull(), total)


def sum_by(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """The sum of ``value`` per group, or of all rows; fractions are added up exactly."""
    if not is_fraction(df, value):
        return df.groupBy(*by).agg(F.sum(value).alias(out))
    limbs = limbs_for(df, value)
    parts = split(F.col(f"`{value}`"), limbs)
    sums = [F.sum(p).alias(f"__limb{i}") for i, p in enumerate(parts)]
    total = joined([F.col(f"__limb{i}") for i in range(len(parts))], limbs)
    return df.groupBy(*by).agg(*sums).select(*by, total.alias(out))
