"""Price, revenue and profit as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_price(sales: Column, quantity: Column, discount: Column) -> Column:
    """Unit price before discount; null where quantity is 0 or the discount is 1."""
    unit = F.try_divide(sales, quantity)
    return F.try_divide(unit, F.lit(1) - discount)


def revenue(price: Column, quantity: Column) -> Column:
    """Turnover before discount."""
    return price * quantity


def profit(price: Column, quantity: Column, discount: Column) -> Column:
    """Turnover after discount; no cost is involved."""
    return price * quantity * (F.lit(1) - discount)
