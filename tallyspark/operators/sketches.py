"""Stored, mergeable sketches: approximate distinct counts and quantiles of any range of days.

One pass writes a row a day (HyperLogLog for distinct values, KLL for quantiles; built-in
aggregates, combined map-side, a few KB each whatever the rows).  Any range is then answered by
merging its days' rows: the fact isn't read again.

Bounds: the relative error of a distinct count has a standard deviation of ``distinct_error`` (four
of them are promised here), the rank of a quantile is off by less than RANK_ERROR of the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_REGISTERS = 12
KLL_SIZE = 200
RANK_ERROR = 0.0265          # fixed value: twice the published rank error at a size of 200


def distinct_error(deviations: float = 4.0) -> float:
    return deviations * 1.04 / math.sqrt(1 << LG_REGISTERS)


def sketched(rows: DataFrame, day: Column, distinct: dict[str, Column], quantiles: dict[str, Column]) -> DataFrame:
    """One row a day: day, n_rows and a sketch column for each name."""
    return rows.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.hll_sketch_agg(c, LG_REGISTERS).alias(n) for n, c in distinct.items()],
        *[F.kll_sketch_agg_double(c.cast("double"), KLL_SIZE).alias(n) for n, c in quantiles.items()])


def merged(sketches: DataFrame, by: list[Column], distinct: list[str], quantiles: dict[str, list[float]]) -> DataFrame:
    """The stored days merged by ``by`` (nothing: one row): n_rows, the estimated distinct counts and, for each
    quantile column, an array of the wanted quantiles."""
    one = sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), *[F.hll_union_agg(n).alias(n) for n in distinct],
        *[F.kll_merge_agg_double(n).alias(n) for n in quantiles])
    out = {n: F.hll_sketch_estimate(n) for n in distinct}
    out |= {n: F.array(*[F.kll_sketch_get_quantile_double(n, F.lit(q)) for q in qs]) for n, qs in quantiles.items()}
    return one.withColumns(out)


def within(estimate: Column, exact: Column) -> Column:
    """Whether an estimated distinct count keeps its bound."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * distinct_error())


def rank_within(below: Column, up_to: Column, n: Column, q: float) -> Column:
    """Whether a quantile keeps its bound, from the rows below it, those up to it, and all."""
    slack = F.greatest(F.lit(1.0), n * RANK_ERROR)
    return (below <= n * q + slack) & (up_to >= n * q - slack)
