"""Column expressions: stock status, customer segment, elapsed days, exact decimal rounding, time cuts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.schemas import MONEY, PRICE

DAY_MICROS = 86_400_000_000


def at(moment: datetime | str) -> Column:
    """A zone-free timestamp literal; every "now" in the library is such a parameter."""
    text = moment.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(moment, datetime) else str(moment)
    return F.lit(text).cast("timestamp_ntz")


def on(day) -> Column:
    """A date literal from a date, a datetime or ISO text."""
    return F.lit(str(day)[:10]).cast("date")


def cut(unit: str, ts: Column) -> Column:
    """``date_trunc`` that keeps the zone-free type."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def before(moment: datetime | str, interval: str) -> Column:
    """``moment`` minus an interval such as ``7 DAYS``."""
    return at(moment) - F.expr(f"INTERVAL {interval}")


def elapsed_days(now: Column, then: Column) -> Column:
    """Whole days elapsed, rounded down (negative for a later ``then``); not a calendar-day difference."""
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(then.cast("timestamp"))
    return ((micros - F.pmod(micros, F.lit(DAY_MICROS))) / DAY_MICROS).cast("int")


def exact_mean(total: Column, count: Column, scale: int) -> Column:
    """``ROUND(AVG(x), scale)`` of a decimal, half away from zero, without Spark's six-digit intermediate."""
    return F.round(total.cast("decimal(38,12)") / F.nullif(count, F.lit(0)), scale)


def mean_price(amount: str = "amount") -> Column:
    """Average of a money column rounded to cents."""
    return exact_mean(F.sum(amount), F.count(amount), 2).cast(PRICE)


def money_sum(amount: str = "amount") -> Column:
    return F.sum(amount).cast(MONEY)


def exact_ratio(num: Column, den: Column, scale: int = 4) -> Column:
    """``num / den`` of non-negative integers rounded half up, in decimal arithmetic (no double near-ties)."""
    ten = F.lit(10**scale).cast(f"decimal({scale + 1},0)")
    two = F.lit(2).cast("decimal(1,0)")
    n, d = num.cast("decimal(24,0)"), den.cast("decimal(24,0)")
    quotient = F.call_function("div", two * ten * n + d, two * d)
    return quotient.cast("decimal(18,0)") * F.lit(f"1e-{scale}").cast(f"decimal({scale + 1},{scale})")


def stock_status(stock: Column, threshold: Column) -> Column:
    return F.when(stock == 0, "CRITICAL").when(stock <= threshold, "LOW").otherwise("OK")


def status_priority(status: Column) -> Column:
    """Sort position of a stock status: empty shelves first."""
    return F.when(status == "CRITICAL", 1).when(status == "LOW", 2).otherwise(3)


def rfm_segment(recency_days: Column, frequency: Column) -> Column:
    """Champions / Loyal / At Risk / Lost; an unknown recency is Lost."""
    return (
        F.when((recency_days <= 7) & (frequency >= 5), "Champions")
        .when(recency_days <= 14, "Loyal")
        .when(recency_days <= 30, "At Risk")
        .otherwise("Lost")
    )


def depleted(stock: Column, sold: Column) -> Column:
    """Stock after a sale, never below zero."""
    return F.greatest(stock - sold, F.lit(0))
