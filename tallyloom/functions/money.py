"""Exact decimal arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY, RATE = "decimal(18,2)", "decimal(9,4)"


def exact(x: Column, scale: int = 6) -> Column:
    """A number as a decimal, read from its shortest decimal text; null is 0."""
    return F.coalesce(F.expr("null").cast(f"decimal(24,{scale})") if x is None else x.cast("string").try_cast(f"decimal(24,{scale})"), F.lit(0).cast(f"decimal(24,{scale})"))


def half_up(x: Column, places: int = 2) -> Column:
    return F.round(x, places).cast(f"decimal(18,{places})")


def half_even(x: Column, places: int = 2) -> Column:
    return F.bround(x, places).cast(f"decimal(18,{places})")


def convert(amount: Column, rate: Column) -> Column:
    """Currency conversion, rounded once."""
    return half_up(amount * rate)


def line_total(price: Column, quantity: Column, discount: Column) -> Column:
    return half_up(price * quantity * (F.lit(1).cast("decimal(5,2)") - discount))


def tender(total: Column, step: Column) -> Column:
    """The next multiple of step that covers the total."""
    return (F.ceil(total / step) * step).cast(MONEY)
