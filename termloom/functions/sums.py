"""Sums of doubles that do not depend on the order of adding.

A double is cut into digits of 30 bits at fixed places, which are whole numbers with a sign; Spark adds the digits of all values,
in any order and over any number of partial sums, without rounding. The total of the digits is rounded to a double once,
to the nearest, ties to even. So equal inputs give equal bits, whatever the partitions, and sums of parts merge.

Finite values have to be less than 2**90 in size, which is checked; values are rounded to whole units of 2**-120,
which concerns those under 2**-67 only. A group may hold 2**33 values. Infinite values and NaN make the sum what adding doubles makes it; nulls
are left out, and a group of nothing else has none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 30
# Places of the digits: a digit at place k counts 2 ** (BITS * k).
HIGH, LOW = 2, -4
# Digits, from the first that is not zero, that decide the rounded value beside "something follows".
_WINDOW = 4


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def _digit(value: Column, place: int) -> Column:
    """From -2**29 to 2**29, the highest one from -2**30 to 2**30: what rounding to whole units of this place leaves of
    that to units of the next. Scaling by powers of two, rounding and this difference are exact on doubles."""
    units = F.rint(value * F.lit(2.0 ** (-BITS * place)))
    if place < HIGH:
        units = units - F.rint(value * F.lit(2.0 ** (-BITS * (place + 1)))) * F.lit(2.0**BITS)
    return units.cast("bigint")


def exact_parts(value: Column) -> Column:
    """Aggregate: digit sums, highest place first, and the plain sum of values that are not finite."""
    value = value.cast("double")
    whole = F.when(_finite(value), value).otherwise(F.lit(0.0))
    large = F.raise_error(F.lit(f"a value of 2**{BITS * (HIGH + 1)} or more in an exact sum")).cast("double")
    checked = F.when(F.abs(whole) < F.lit(2.0 ** (BITS * (HIGH + 1))), whole).otherwise(large)
    digits = [F.sum(F.when(value.isNotNull(), _digit(checked, k))) for k in range(HIGH, LOW - 1, -1)]
    rest = F.sum(F.when(value.isNotNull() & ~_finite(value), value).when(value.isNotNull(), F.lit(0.0)))
    return F.struct(F.array(*digits).alias("digits"), rest.alias("rest"))


def merged_parts(parts: Column) -> Column:
    """Aggregate: the parts of several sums as those of one."""
    digits = F.array(*[F.sum(parts["digits"][i]) for i in range(HIGH - LOW + 1)])
    return F.struct(digits.alias("digits"), F.sum(parts["rest"]).alias("rest"))


def _carried(digits: Column) -> Column:
    """Digits from 0 to 2 ** BITS - 1, highest first; the first takes what is left of the carries, and the sign."""

    def step(state: Column, digit: Column) -> Column:
        total = state["carry"] + digit
        return F.struct(
            F.shiftright(total, BITS).alias("carry"),
            F.concat(F.array(total.bitwiseAND((1 << BITS) - 1)), state["done"]).alias("done"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("done"))
    return F.aggregate(F.reverse(digits), start, step, lambda s: F.concat(F.array(s["carry"]), s["done"]))


def exact_value(parts: Column) -> Column:
    """The double nearest to the total of ``parts``."""

    def rounded(digits: Column) -> Column:
        """Of digits that are not negative."""
        first = F.coalesce(F.array_position(F.transform(digits, lambda d: d != 0), True), F.lit(0))
        padded = F.concat(digits, F.array(*[F.lit(0).cast("bigint")] * _WINDOW))
        window = F.slice(padded, F.greatest(first, F.lit(1)), _WINDOW)
        rest = F.slice(padded, F.greatest(first, F.lit(1)) + _WINDOW, HIGH - LOW + 2)
        number = reduce(
            lambda a, b: a + b,
            [F.get(window, i).cast("decimal(38,0)") * F.lit(str(2 ** (BITS * (_WINDOW - 1 - i)))).cast("decimal(38,0)") for i in range(_WINDOW)],
        ).cast("decimal(38,0)")
        # Whatever follows lies below the last bit kept: an odd number is no tie between two doubles.
        odd = number + F.when(F.exists(rest, lambda d: d != 0) & (number % 2 == 0), 1).otherwise(0)
        # The first digit of all stands one place above HIGH.
        place = HIGH + 2 - F.greatest(first, F.lit(1)) - (_WINDOW - 1)
        return odd.cast("double") * F.pow(F.lit(2.0), place * BITS)

    negative = F.transform(F.array(_carried(parts["digits"])), lambda d: d[0] < 0)[0]
    sign = F.when(negative, F.lit(-1)).otherwise(F.lit(1))
    # One array of one element stands for "let".
    sized = F.transform(parts["digits"], lambda d: d * sign)
    total = F.transform(F.array(_carried(sized)), rounded)[0] * sign
    return F.when(_finite(parts["rest"]), total).otherwise(parts["rest"])


def exact_sum(value: Column) -> Column:
    """Aggregate: the sum of a column of doubles, rounded once."""
    return exact_value(exact_parts(value))
