"""Exact money arithmetic and rounding that every engine agrees on.

Amounts are summed as whole cents in 64-bit integers. A sum of doubles depends on the order
in which tasks finish; a sum of cents does not, keeps fixed-width aggregation buffers, and
raises on overflow (above 9 x 10^16 in money) instead of going wrong. A cast of every row to
a decimal would be exact as well, but costs about a microsecond per row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CENTS = 100.0
# Shares are exact up to nine places.
SHARE_STEPS = 1e9
MONEY = "decimal(18,2)"
WIDE = "decimal(19,0)"
SHARES = "decimal(11,0)"


def _whole(column: str | Column, steps: float) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.floor(value * steps + 0.5)


def cents(amount: str | Column) -> Column:
    return _whole(amount, CENTS)


def cents_sum(amount: str | Column) -> Column:
    """Sum of amounts in cents; can be summed further."""
    return F.sum(cents(amount))


def amount(cents_value: str | Column) -> Column:
    """Cents as an amount, a double."""
    value = F.col(cents_value) if isinstance(cents_value, str) else cents_value
    return value.cast("double") / CENTS


def money_sum(value: str | Column) -> Column:
    """Exact sum of amounts, as a double."""
    return amount(cents_sum(value))


def weighted_steps(cents_value: Column, share: str) -> Column:
    """Sum of cents x share in billionths of a cent; rows without a share are skipped.

    The products outgrow 64 bits, so they are made and added as wide decimals.
    """
    return F.sum(cents_value.cast(WIDE) * _whole(share, SHARE_STEPS).cast(SHARES))


def weighted_amount(steps: str | Column) -> Column:
    value = F.col(steps) if isinstance(steps, str) else steps
    return (value / F.lit(CENTS * SHARE_STEPS).cast(WIDE)).cast("double")


def weighted_sum(value: str, share: str) -> Column:
    """Exact sum of amount x share, as a double."""
    return weighted_amount(weighted_steps(cents(value), share))


def half_up(value: Column, places: int) -> Column:
    """Round a double half up, by plain IEEE steps."""
    scale = float(10**places)
    return F.floor(value * scale + 0.5) / scale


def gross_revenue(price: str = "price", freight: str = "freight_value") -> Column:
    return F.col(price) + F.col(freight)


def allocated_payment(payment_total: str, price: str, order_total: str) -> Column:
    """The item's share of its order's payments, by price; NULL when the order costs nothing."""
    share = F.col(payment_total) * F.col(price) / F.col(order_total)
    return F.when(F.col(order_total) > 0, share)
