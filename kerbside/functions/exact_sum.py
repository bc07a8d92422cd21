"""Sums of doubles that do not depend on the order of the rows, correctly rounded, in built-in expressions.

A double is a whole number of at most 53 bits times a power of two. Cut into digits to the base 2 ** 24 at places that are
multiples of 24 bits, it fills at most four neighbouring digits; digits of values of about the same size (the same ``scale``)
are whole numbers that add up exactly. So the state of a sum is one row of four whole numbers for each scale that occurs, it
merges by plain addition, and only ``total`` carries the digits over and rounds once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGIT_BITS, DIGITS = 24, 4
_BASE = float(1 << DIGIT_BITS)


def _power_of_two(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def _times_power_of_two(value: Column, exponent: Column) -> Column:
    """In two steps, as the whole power may lie beyond the doubles."""
    half = F.floor(exponent / 2)
    return value * _power_of_two(half) * _power_of_two(exponent - half)


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def scale_of(value: Column) -> Column:
    """The place of the leading digit; null for zero, null, NaN and infinities, which have no digits."""
    return F.when(is_finite(value) & (value != 0), F.floor(F.log2(F.abs(value)) / DIGIT_BITS).cast("int"))


def digits_of(value: Column) -> list[Column]:
    """The four digits from the leading place on down, with the sign of the value; null where there is no scale.

    Every step is exact: powers of two only move the exponent, and what is subtracted are the leading bits.
    """
    rest = _times_power_of_two(F.abs(value), DIGIT_BITS * (DIGITS - 1) - scale_of(value) * DIGIT_BITS)
    sign, digits = F.when(value < 0, -1).otherwise(1).cast("bigint"), []
    for place in range(DIGITS - 1, -1, -1):
        unit = _BASE**place
        digit = F.floor(rest / unit)
        digits.append(digit * sign)
        rest = rest - digit.cast("double") * unit
    return digits


def _carried(sums: Column) -> Column:
    """(carry, digits) with every digit within the base, the lowest first; a negative total leaves a carry of -1."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def step(done: Column, own: Column) -> Column:
        whole = own + done["carry"]
        digit = whole.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1).cast("bigint"))
        return F.struct(
            F.shiftright(whole, DIGIT_BITS).alias("carry"), F.concat(done["digits"], F.array(digit)).alias("digits")
        )

    return F.aggregate(sums, start, step)


def _let(value: Column, body) -> Column:
    """``body`` of the value, which is worked out once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(states: Column) -> Column:
    """The nearest double to the sum of ``states``, an array of (scale, d3, d2, d1, d0); 0 for an empty array.

    Half-way cases go to the even double, as ``math.fsum`` does it. Sums below the normal doubles may be rounded twice.
    """
    return _let(F.filter(states, lambda s: s["scale"].isNotNull()), _total_of)


def _total_of(states: Column) -> Column:
    scales = F.transform(states, lambda s: s["scale"])

    def at(place: Column) -> Column:
        def add(done: Column, s: Column) -> Column:
            below = s["scale"] - place
            own = F.when(below == 0, s["d3"]).when(below == 1, s["d2"]).when(below == 2, s["d1"]).when(below == 3, s["d0"])
            return done + F.coalesce(own, F.lit(0).cast("bigint"))

        return F.aggregate(states, F.lit(0).cast("bigint"), add)

    def signed(sums: Column) -> Column:
        turned = _carried(F.transform(sums, lambda s: -s))["digits"]
        return _let(
            _carried(sums),
            lambda up: F.struct(
                (up["carry"] < 0).alias("negative"), F.when(up["carry"] < 0, turned).otherwise(up["digits"]).alias("digits")
            ),
        )

    # Three places more than the highest scale hold the carries of 2 ** 39 values.
    lowest = F.array_min(scales) - (DIGITS - 1)
    sums = F.transform(F.sequence(lowest, F.array_max(scales) + 3), at)
    rounded = _let(_let(sums, signed), lambda whole: _rounded(whole, lowest))
    return F.when(F.size(states) == 0, F.lit(0.0)).otherwise(rounded)


def _rounded(whole: Column, lowest: Column) -> Column:
    digits = whole["digits"]

    def nearest(top: Column) -> Column:
        # Five digits hold 97 bits or more; a one at their end stands for whatever lies below them.
        below = F.exists(F.slice(digits, F.lit(1), F.greatest(top - 5, F.lit(0))), lambda d: d != 0)
        leading = None
        for place in range(4, -1, -1):
            digit = F.coalesce(F.get(digits, top - 5 + place), F.lit(0).cast("bigint"))
            if place == 0:
                digit = digit.bitwiseOR(F.when(below, 1).otherwise(0).cast("bigint"))
            part = digit.cast("decimal(8,0)") * F.lit(Decimal(1 << DIGIT_BITS * place)).cast("decimal(30,0)")
            leading = part if leading is None else leading + part
        value = _let((lowest + top - 5) * DIGIT_BITS, lambda e: _times_power_of_two(leading.cast("double"), e))
        return F.coalesce(F.when(whole["negative"], -value).otherwise(value), F.lit(0.0))

    return _let(F.array_max(F.filter(F.sequence(F.lit(1), F.size(digits)), lambda i: F.element_at(digits, i) != 0)), nearest)
