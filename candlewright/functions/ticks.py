"""Rounding prices to an instrument's tick."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def tick_decimals(tick: str) -> int:
    """Decimals of the tick written as a float: 0.05 has two, 1 is 1.0 and has one."""
    return -Decimal(repr(float(tick))).as_tuple().exponent


def round_to_tick(price: Column, tick: str, mode: str | None = None, compat: bool = False) -> Column:
    """Price on the tick grid: nearest (half up), or 'floor' or 'ceil'.

    A price already on the grid stays under 'ceil'; ``compat=True`` moves it one tick up.
    """
    exact = price.cast("decimal(24,8)")
    step = F.lit(tick).cast("decimal(12,8)")
    rest = F.pmod(exact, step)
    down = exact - rest
    if mode == "floor":
        rounded = down
    elif mode == "ceil":
        rounded = down + step if compat else F.when(rest == 0, down).otherwise(down + step)
    else:
        rounded = F.when(rest * 2 >= step, down + step).otherwise(down)
    return F.bround(rounded, tick_decimals(tick))
