"""Exact money arithmetic in whole cents.

Amounts are decimals in every table; inside a computation they are long cents, which stay in generated code
and in fixed-width aggregation buffers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.schemas import MONEY

# A double holds every cent below this amount exactly; a long holds the product of two such cent values.
_DOUBLE_SAFE = 10**13
_PRODUCT_SAFE = 2 * 10**9
_BASE_SAFE = 10**15


def cents(amount: Column) -> Column:
    """A money column as long cents."""
    quick = F.rint(amount.cast("double") * 100).cast("long")
    exact = (amount.cast(MONEY) * 100).cast("long")
    return F.when(F.abs(amount) < _DOUBLE_SAFE, quick).otherwise(exact)


def from_cents(value: Column) -> Column:
    return (value.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)


def prorate(total: Column, base: Column, part: Column, scale: int = 2) -> Column:
    """``total / base * part`` in long cents, rounded half up to ``scale`` digits (0, 1 or 2); zero when
    ``base`` is zero. All arguments are long cents.

    The quotient is taken in whole numbers, so neither a binary fraction nor an intermediate rounding can
    tip a tie. Values too large for long products take the decimal branch.
    """
    unit = 10 ** (2 - scale)
    in_range = (
        total.between(0, _PRODUCT_SAFE) & part.between(0, _PRODUCT_SAFE) & base.between(1, _BASE_SAFE)
    )
    quick = F.call_function("div", 2 * total * part + base * unit, 2 * base * unit)

    wide = lambda value: value.cast("decimal(18,0)")
    doubled = wide(total) * wide(part) * F.lit(2).cast("decimal(1,0)")
    divisor = F.abs(wide(base)) * F.lit(unit).cast("decimal(3,0)")
    # ``div`` cuts towards zero, so round the magnitude and put the sign back.
    magnitude = F.call_function("div", F.abs(doubled) + divisor, divisor * F.lit(2).cast("decimal(1,0)"))
    exact = F.when((doubled < 0) != (base < 0), -magnitude).otherwise(magnitude)

    return F.when(in_range, quick).when(base == 0, F.lit(0).cast("long")).otherwise(exact) * unit
