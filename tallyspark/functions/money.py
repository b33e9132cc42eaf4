"""Exact money arithmetic.

Source columns are doubles carrying two decimals.  Casting to DECIMAL before summing
makes sums exact and independent of row order (no floating drift between partitions),
and the final cast back to DOUBLE is correctly rounded in every engine.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"


def money(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def rate(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(RATE)


def as_double(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def cents(c) -> Column:
    """A 2-decimal money value as exact integer cents (BIGINT).  Summing longs uses
    Spark's fast fixed-width aggregation buffers; DECIMAL sums wider than 18 digits fall
    back to object arithmetic.  Overflow raises under ANSI mode."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 100).cast("bigint")


def from_cents(c, scale: int = 2) -> Column:
    """Integer units of 10^-scale back to an exact DECIMAL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))


def money_sum(c) -> Column:
    """SUM over a money column, exact (integer cents), returned as DOUBLE."""
    return from_cents(F.sum(cents(c))).cast("double")


def net_price(ext, disc) -> Column:
    """extendedprice * (1 - discount), exact decimal."""
    return money(ext) * (F.lit(1) - rate(disc))


def line_profit(ext, disc, qty, unit_cost) -> Column:
    """Net line revenue minus quantity times the list price, exact decimal."""
    return net_price(ext, disc) - money(qty) * money(unit_cost)


def profit_units(ext, disc, qty, unit_cost) -> Column:
    """Line profit in exact BIGINT units of 1e-4: with every input carrying two decimals,
    ext*(1-disc) - qty*cost = (E*(100-D) - Q*C) / 10^4 for the integer hundredths E, D,
    Q, C.  Same value as ``line_profit`` without 38-digit decimal arithmetic per row."""
    return cents(ext) * (F.lit(100) - cents(disc)) - cents(qty) * cents(unit_cost)


def mean_of(sum_col: Column, count_col: Column) -> Column:
    """Average as DOUBLE from an exact sum and a count (no decimal-scale surprises)."""
    return sum_col.cast("double") / count_col.cast("double")
