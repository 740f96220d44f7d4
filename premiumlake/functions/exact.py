"""Exact decimal arithmetic as Column expressions.

Money stays DECIMAL end to end. Ratios are never rounded twice: ``round_ratio`` computes
round-half-away-from-zero of ``num / den`` as an exact floor division on decimals
((a − a mod b) / b divides exactly), so the result is the exact rounding whatever the
magnitudes, with no long overflow. Everything is a built-in expression inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_IN = "decimal(18,2)"  # ledger figures, monthly premiums
# Amounts of the raw feed keep six places: what lies between zero and a cent is positive, and sums
# are rounded once, in the marts. Six is also the scale that Spark keeps in long products.
AMOUNT = "decimal(22,6)"
# Sums and ratios use precision 28 (Spark's own sum type for decimal(18,2)), never 38: Spark
# compares decimals in their wider common type, capped at 38 digits by dropping *scale*, so a
# decimal(38,2) compared with a 4-place value is rounded to 2 places first (0.01 < 0.0149 is
# false). Ten digits of headroom keep every comparison and product in this library exact.
MONEY = "decimal(28,2)"  # sums of money
DAILY = "decimal(18,6)"  # per-day premium


def dec(scale: int) -> str:
    return f"decimal(28,{scale})"



def int_div(a: Column, b: Column) -> Column:
    """SQL ``a div b``: exact truncating integral division, NULL when either side is NULL."""
    return F.call_function("div", a, b)


def round_ratio(num: Column, den: Column, scale: int, shift: int = 0) -> Column:
    """round(num / den * 10^shift, scale), half away from zero, exact; NULL when den is 0 or NULL.

    ``num`` and ``den`` must be exact (decimal or integral). This is PostgreSQL's
    ``round((num / nullif(den, 0) * 10^shift)::numeric, scale)`` without its intermediate
    rounding of the quotient.
    """
    den_nz = F.when(den != 0, den)
    factor = F.lit(Decimal(10) ** (scale + shift))
    quotient = floor_div_nonneg(F.lit(2) * F.abs(num) * factor + F.abs(den_nz), F.lit(2) * F.abs(den_nz))
    negative = (num < 0) != (den_nz < 0)
    signed = F.when(negative, -quotient).otherwise(quotient)
    unit = F.lit(Decimal(1).scaleb(-scale))
    return (signed * unit).cast(dec(scale))


def floor_div_nonneg(a: Column, b: Column) -> Column:
    """floor(a / b) for non-negative exact a, b > 0, as an integral decimal: a − (a mod b) is a
    multiple of b, so the division is exact. Unlike ``div`` (a long) it cannot overflow for
    large quotients."""
    return ((a - a % b) / b).cast("decimal(38,0)")


def round_money(c: Column, scale: int = 2) -> Column:
    """Round a decimal half away from zero (Spark's ``round`` on decimals is HALF_UP)."""
    return F.round(c, scale).cast(dec(scale))
