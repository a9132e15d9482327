"""Sums, averages and rounding that do not depend on row order.

A sum of doubles changes in its last bits with the order in which tasks
finish. Here values are summed as the decimal numbers they are written as, which
makes reruns, backfills and other engines agree.

Nearly all measures are whole numbers of millionths. Those are summed as integers
in two parts of 64 bits, so no part overflows and no row needs decimal arithmetic.
Any other value, with more digits or too large, is added as a decimal of
``PLACES`` places, whatever is left of it beyond that place being rounded. Values
from 1e20 on do not fit and end the job with Spark's overflow error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 1_000_000
LOW_BITS = 20
PLACES = 16

# Up to here a double tells neighbouring millionths apart.
MOST_IN_UNITS = 2.0**53 / UNITS

TOTAL = f"decimal(37,{PLACES})"


def exact_units(value: Column) -> Column:
    """The sum as a decimal; such sums can be summed again. NULL over no values."""
    units = F.when(
        F.abs(value) < F.lit(MOST_IN_UNITS),
        F.rint(value * F.lit(float(UNITS))).cast("long"),
    )
    is_whole = units.cast("double") / F.lit(float(UNITS)) == value
    whole = F.when(is_whole, units)
    high = F.sum(F.shiftright(whole, LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(whole.bitwiseAND(F.lit(2**LOW_BITS - 1))).cast("decimal(20,0)")
    total = high * F.lit(2**LOW_BITS).cast("decimal(7,0)") + low
    total = (total * F.lit("0.000001").cast("decimal(6,6)")).cast(TOTAL)
    others = F.when(is_whole, None).otherwise(value.cast(f"decimal(36,{PLACES})"))
    rest = F.sum(others).cast(TOTAL)
    return F.coalesce(total + rest, total, rest)


def from_units(total: Column) -> Column:
    return total.cast("double")


def exact_sum(value: Column) -> Column:
    return from_units(exact_units(value))


def exact_avg(value: Column) -> Column:
    """Mean over the non-NULL values, NULL when there are none."""
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))


def round_half_up(value: Column, places: int) -> Column:
    """Round a non-negative double half up, equally in every engine."""
    factor = float(10**places)
    return F.floor(value * F.lit(factor) + F.lit(0.5)) / F.lit(factor)


def percent(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0)) * F.lit(100.0)
