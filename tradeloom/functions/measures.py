"""Measures as column expressions.

Quantities have four decimals and amounts two, so both are summed as whole
numbers of their smallest unit: long sums are exact, several times faster than
decimal ones, and raise an error rather than wrap around.  Pieces are divided
by the pieces-per-case factor once per group, after summing, so a quotient is
rounded as few times as possible.  Decimal widths are chosen so that Spark
keeps 12 decimals in every quotient.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tax rules of the claim reports.
TAX_RATE = Decimal("0.15")
NET_RATE = Decimal("0.85")
BUDGET_PER_CASE = Decimal("8.695652")  # 10.00 / 1.15 to six decimals
BONUS_PER_CASE = Decimal("10.00")
UNTAXED_CLAIM = "AC"

PIECES = "decimal(26,4)"
FACTOR = "decimal(18,4)"
MONEY = "decimal(32,2)"
RATE = "decimal(32,4)"
QUOTIENT = "decimal(38,12)"
#: sums of quotients settle here before the last rounding, so that a total
#: which is exactly half a unit is seen as such
SETTLED = "decimal(38,6)"


def units(pieces: Column) -> Column:
    """A quantity in ten-thousandths of a piece."""
    return (pieces * F.lit(10_000)).cast("bigint")


def pieces(units: Column) -> Column:
    """Ten-thousandths back in pieces."""
    return (units.cast("decimal(20,0)") * F.lit(Decimal("0.0001"))).cast(PIECES)


def cents(amount: Column) -> Column:
    return (amount * F.lit(100)).cast("bigint")


def money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def zero() -> Column:
    return F.lit(Decimal("0.0000")).cast(FACTOR)


def has_factor(factor: Column) -> Column:
    return F.coalesce(factor, zero()) != 0


def pieces_per_case(factor: Column) -> Column:
    """The factor, where a zero or missing one means one piece per case."""
    return F.when(has_factor(factor), factor).otherwise(F.lit(Decimal("1.0000")).cast(FACTOR))


def cases(units: Column, factor: Column) -> Column:
    """Summed units in cases; without a factor a piece counts as a case."""
    return pieces(units) / pieces_per_case(factor)


def cases_or_none(units: Column, factor: Column) -> Column:
    """Summed units in cases; without a factor nothing is counted."""
    return F.when(has_factor(factor), cases(units, factor)).otherwise(F.lit(0).cast(QUOTIENT))


def piece_rate(case_rate: Column, factor: Column) -> Column:
    """A rate per case as a rate per piece; without a factor it is one already."""
    return case_rate.cast(PIECES) / pieces_per_case(factor)


def value_in_cases(value: Column, factor: Column) -> Column:
    """Pieces times a price, divided by the pieces per case."""
    return value.cast("decimal(30,8)") / pieces_per_case(factor)


def value_at_piece_rate(value: Column, factor: Column) -> Column:
    """Pieces times a case rate, divided twice: by case and to a piece rate."""
    per_case = pieces_per_case(factor)
    return value.cast("decimal(26,8)") / (per_case * per_case).cast("decimal(18,8)")


def grossed_up(amount: Column, claim_type: Column) -> Column:
    """The amount before tax; admin claims are not taxed."""
    taxed = amount.cast("decimal(26,8)") / F.lit(NET_RATE)
    return F.when(claim_type == UNTAXED_CLAIM, amount.cast(MONEY)).otherwise(taxed.cast(MONEY))


def tax_on(amount: Column, claim_type: Column) -> Column:
    """The tax part of the grossed-up amount."""
    tax = amount.cast("decimal(26,8)") / F.lit(NET_RATE) * F.lit(TAX_RATE)
    return F.when(claim_type == UNTAXED_CLAIM, F.lit(0).cast(MONEY)).otherwise(tax.cast(MONEY))


def whole(total: Column) -> Column:
    """A dashboard figure: no decimals, halves away from zero."""
    return total.cast(SETTLED).cast("decimal(32,0)")


def percent_of(part: Column, base: Column) -> Column:
    """100 x part / base, NULL when the base is zero."""
    top = (part.cast(SETTLED).cast("decimal(24,6)") * 100).cast("decimal(26,6)")
    bottom = base.cast(SETTLED).cast("decimal(26,6)")
    return top / F.when(bottom != 0, bottom)
