"""Small column-expression helpers shared by operators (all JVM-side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieout.sources.schemas import MONEY, MONEY_SUM, QTY, RATE


def money(c: Column | str) -> Column:
    """Cast to decimal(18,2); a cast to scale 2 rounds half away from zero."""
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def money_sum(c: Column | str) -> Column:
    return F.col(c).cast(MONEY_SUM) if isinstance(c, str) else c.cast(MONEY_SUM)


def rate(c: Column | str) -> Column:
    return F.col(c).cast(RATE) if isinstance(c, str) else c.cast(RATE)


def qty(c: Column | str) -> Column:
    return F.col(c).cast(QTY) if isinstance(c, str) else c.cast(QTY)


def to_usd(amount: Column, fx: Column) -> Column:
    """round(amount x rate, 2): decimal multiply, then a rounding cast to scale 2."""
    return (amount * fx).cast(MONEY)


def pick(index: Column, values: Sequence[str], base: int = 0) -> Column:
    """values[index - base] as a CASE expression (stays inside codegen)."""
    expr = None
    for i, v in enumerate(values):
        cond = index == F.lit(i + base)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def mint_id(prefix: str | Column, number: Column, width: int = 9) -> Column:
    """prefix + '-' + zero-padded number; never truncates a number wider than width."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    pre = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(pre, F.lit("-"), padded)


def add_days(d: Column, n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.date_add(d, n.cast("int"))


def days_between(later: Column, earlier: Column) -> Column:
    """later - earlier in whole days as INT (Spark's date - date is an interval)."""
    return F.datediff(later, earlier)


def clamp_date(d: Column, period_end: Column | str) -> Column:
    """Event date capped at the period end."""
    end = F.lit(period_end).cast("date") if isinstance(period_end, str) else period_end
    return F.least(d, end)
