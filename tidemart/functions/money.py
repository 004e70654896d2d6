"""Signed sales amounts, summed exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def exact(price: str | Column) -> Column:
    """A float price as a decimal: float sums depend on row order, decimal sums do not.

    Ten decimals, and 22 digits before them, are more than a double has at either end of any price.
    """
    return _col(price).cast("decimal(32,10)")


def signed_amount(price: str | Column, returned_at: str | Column) -> Column:
    """The price, negated once the item was returned."""
    return F.when(_col(returned_at).isNotNull(), -_col(price)).otherwise(_col(price))


def signed_total(price: str | Column, returned_at: str | Column) -> Column:
    """The sum of signed amounts, exact for decimal prices: a decimal. For floats pass ``exact(price)``."""
    return F.sum(signed_amount(price, returned_at))
