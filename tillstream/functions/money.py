"""Column expressions for amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstream.schemas import MONEY_TYPE, RATE_TYPE


def line_amount(price: Column, quantity: Column) -> Column:
    """Price times quantity, not rounded."""
    return price * quantity


def unit_price(price: Column) -> Column:
    return F.round(price, 2)


def converted(amount: Column, rate: Column) -> Column:
    """Amount at a rate, in double; no rate means 1."""
    return amount * F.coalesce(rate, F.lit(1.0))


def stored_rate(rate: Column) -> Column:
    """The rate as a table keeps it; null when it does not fit."""
    return rate.try_cast(RATE_TYPE)


def exact(amount: Column) -> Column:
    return amount.cast(MONEY_TYPE)


def exact_sum(amount: Column) -> Column:
    """A sum that does not depend on the order of rows, so batch, stream and replay agree."""
    return F.sum(exact(amount))


def fits_money(amount: Column) -> Column:
    """True for amounts an exact sum can hold (not NaN, infinite or out of range)."""
    return amount.try_cast(MONEY_TYPE).isNotNull()
