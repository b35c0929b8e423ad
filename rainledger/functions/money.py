"""Exact money: DECIMAL all the way, so a sum does not depend on the order of its rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scale of a total that is divided: wide enough for sums of line totals, and leaves 18 decimals to the quotient.
TOTAL = "decimal(28,8)"


def line_amount(total: Column, quantity: Column, price: Column, discount: Column) -> Column:
    """The stored line total, else quantity x price less discount (no discount when NULL).

    Every value keeps the scale of its source, and the product its exact scale: nothing is rounded here.
    """
    rebate = F.coalesce(discount, F.lit(0).cast("decimal(1,0)"))
    return F.coalesce(total, price * (F.lit(1).cast("decimal(1,0)") - rebate) * quantity)


def rounded_mean(total: Column, count: Column, scale: int = 2) -> Column:
    """``total / count`` rounded half up once, from an exact decimal total."""
    return F.round(total.cast(TOTAL) / F.nullif(count, F.lit(0)), scale)


def exact_mean(value: Column) -> Column:
    """AVG as DOUBLE from an exact decimal sum: one rounding, whatever the row order.

    The sum holds 14 digits before and 12 after the point; a larger value raises an error.
    """
    exact = value.cast("decimal(26,12)")
    return F.sum(exact).cast("double") / F.nullif(F.count(exact), F.lit(0))


def margin_percent(price: Column, cost: Column, *, guard: bool = True) -> Column:
    """Margin in percent of the price; ``guard`` gives NULL instead of an error at price 0."""
    base = F.nullif(price, F.lit(0).cast("decimal(1,0)")) if guard else price
    return F.round((price - cost) / base * F.lit(100).cast("decimal(3,0)"), 2)
