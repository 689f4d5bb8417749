"""Column expressions shared by reports and operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: Column | str, precision: int = 12, scale: int = 2) -> Column:
    """Cast a money input to decimal before arithmetic so sums are exact in every engine."""
    return _c(col).cast(f"decimal({precision},{scale})")


def net_price(price: Column | str = "l_extendedprice", discount: Column | str = "l_discount") -> Column:
    """``price * (1 - discount)`` in exact decimal."""
    return money(price) * (F.lit(1) - money(discount))


def cents(col: Column | str) -> Column:
    """A 2-decimal money value as exact integer hundredths (decimal(12,2) × 100 → bigint)."""
    return (money(col) * F.lit(100)).cast("bigint")


def net_price_units(price: Column | str = "l_extendedprice", discount: Column | str = "l_discount") -> Column:
    """``price * (1 - discount)`` as an exact bigint in units of 1e-4: long arithmetic (fast,
    codegen-friendly) with the same value as the decimal product."""
    return cents(price) * (F.lit(100) - cents(discount))


def units_total(units: Column, scale: int = 4) -> Column:
    """Sum of 1e-4 units as a double; the running total is decimal(38,0), so no overflow."""
    return (F.sum(units.cast("decimal(38,0)")) / F.lit(10 ** scale)).cast("double")


def mask_secret(col: Column | str) -> Column:
    """NULL or empty → ``''``; up to 8 chars → ``****``; else first 4 + ``****`` + last 4."""
    c = _c(col)
    n = F.char_length(c)
    return (
        F.when(c.isNull() | (n == 0), F.lit(""))
        .when(n <= 8, F.lit("****"))
        .otherwise(F.concat(F.substring(c, 1, 4), F.lit("****"), F.substring(c, -4, 4)))
    )


def month_diff(start: Column | str, end: Column | str) -> Column:
    """Month boundaries crossed between two dates (``date_diff('month', a, b)`` semantics)."""
    s, e = _c(start), _c(end)
    return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("bigint")


def ntz_month(col: Column | str) -> Column:
    """First instant of the month as TIMESTAMP_NTZ (``date_trunc`` returns a zoned timestamp)."""
    return F.date_trunc("month", _c(col)).cast("timestamp_ntz")


def iso_dow(col: Column | str) -> Column:
    """Day of week with Sunday = 0 (Spark's ``dayofweek`` has Sunday = 1)."""
    return (F.dayofweek(_c(col)) - 1).cast("bigint")
