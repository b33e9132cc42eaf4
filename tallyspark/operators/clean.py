"""Cleaning: type coercion, imputation and de-duplication.

Imputation statistics are computed in one aggregate and attached as a broadcast one-row
frame (``crossJoin`` of exactly one row), so the fill stays inside a single lazy plan
with no driver round trip.  Skew: every statistic is a partial (map-side) aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.profile import INTEGRAL, bracketed_quantiles, column_mean, is_numeric, top_values


def coerce_numeric(df: DataFrame, cols, to: str = "double") -> DataFrame:
    """pandas ``to_numeric(errors='coerce')``: unparseable text becomes NULL."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {to})") for c in cols})


def parse_dates(df: DataFrame, cols, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """String -> DATE; malformed values become NULL instead of failing the job."""
    return df.withColumns({c: F.try_to_date(F.col(c), fmt) for c in cols})


def _mean_expr(c: str, dtype: str, decimals: int, int_mode: str, scale: int | None) -> Column:
    """Column mean rounded half-up to ``decimals``, summed by the column's own type.  Integer
    columns: ``half_up`` rounds to a whole number; ``truncate`` keeps the rounded mean and
    drops the fraction, as filling an int column with a float does."""
    mean = column_mean(F.col(c), dtype, scale)
    whole = dtype in INTEGRAL and int_mode == "half_up"
    return F.round(mean, 0 if whole else decimals).cast(dtype)


def column_means(df: DataFrame, cols, decimals: int = 2, int_mode: str = "half_up",
                 scales: dict[str, int] | None = None) -> DataFrame:
    types = dict(df.dtypes)
    return df.agg(*[_mean_expr(c, types[c], decimals, int_mode, (scales or {}).get(c))
                    .alias(f"__fill_{c}") for c in cols])


def _fill_from(df: DataFrame, stats: DataFrame, cols) -> DataFrame:
    joined = df.crossJoin(F.broadcast(stats))
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"__fill_{c}")) for c in cols}) \
        .drop(*[f"__fill_{c}" for c in cols])


def impute_mean(df: DataFrame, cols, decimals: int = 2, int_mode: str = "half_up",
                scales: dict[str, int] | None = None) -> DataFrame:
    """Fill NULLs with the column mean: decimals rounded half-up, integer columns rounded
    half-up (``int_mode='truncate'`` reproduces filling an int column with a float).
    ``scales`` declares DOUBLE columns with a fixed number of decimals (exact sums)."""
    return _fill_from(df, column_means(df, cols, decimals, int_mode, scales), cols)


def impute_median(df: DataFrame, cols, int_mode: str = "widen") -> DataFrame:
    """Fill NULLs with the exact (interpolated) median in the column's own type: DECIMAL medians are
    DECIMAL arithmetic.  Integer columns become DOUBLE, since a median may lie between two
    values; ``int_mode='truncate'`` keeps their type and drops the fraction."""
    types = dict(df.dtypes)
    fills = {c: v for (c, _), v in bracketed_quantiles(df, cols).items()}
    if int_mode == "widen":
        df = df.withColumns({c: F.col(c).cast("double") for c in cols if types[c] in INTEGRAL})
    now = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), fills[c].cast(now[c])) for c in cols})


def impute_approx_median(df: DataFrame, cols, accuracy: int = 1_000_000) -> DataFrame:
    """Fill NULLs with ``percentile_approx(c, 0.5, accuracy)`` (an existing value)."""
    types = dict(df.dtypes)
    stats = df.agg(*[F.percentile_approx(F.col(c), 0.5, accuracy).cast(types[c]).alias(f"__fill_{c}")
                     for c in cols])
    return _fill_from(df, stats, cols)


def impute_mode(df: DataFrame, cols) -> DataFrame:
    """Fill NULLs with the most frequent value (ties -> smallest value); all columns from
    one stacked value count, one row of typed fill values."""
    stats = top_values(df, cols).select(*[F.col(c).alias(f"__fill_{c}") for c in cols])
    return _fill_from(df, stats, cols)


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    """DEFAULT / fillna with constants per column."""
    return df.fillna(values)


def impute_by_dtype(df: DataFrame, exclude=(), text_fill: str = "Unknown",
                    decimals: int = 2, int_mode: str = "truncate",
                    scales: dict[str, int] | None = None) -> DataFrame:
    """Numeric columns (DECIMAL too) -> mean (all in ONE aggregate), string columns -> a
    constant.  Key columns listed in ``exclude`` are left alone."""
    types = dict(df.dtypes)
    nums = [c for c in df.columns if is_numeric(types[c]) and c not in exclude]
    texts = [c for c in df.columns if types[c] == "string" and c not in exclude]
    out = _fill_from(df, column_means(df, nums, decimals, int_mode, scales), nums) if nums else df
    return out.fillna({c: text_fill for c in texts}) if texts else out


def drop_null_rows(df: DataFrame, cols=None) -> DataFrame:
    return df.dropna(how="any", subset=cols)


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (hash aggregate with map-side combine: a row repeated
    in a third of the data collapses before the shuffle)."""
    return df.dropDuplicates()


def dedup_keep_first(df: DataFrame, subset, order_col: str) -> DataFrame:
    """Keep, per ``subset`` value, the row with the smallest ``order_col``.

    Expressed as ``min_by`` aggregation instead of ROW_NUMBER over a window, so a hot
    group is reduced map-side rather than sorted in a single task."""
    rest = [c for c in df.columns if c not in subset]
    picked = df.groupBy(*subset).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(order_col)).alias("__keep"))
    return picked.select(*subset, *[F.col(f"__keep.{c}").alias(c) for c in rest]) \
        .select(*df.columns)


def dense_row_id(df: DataFrame, order_keys, name: str = "row_id") -> DataFrame:
    """reset_index(drop=True): a dense 0-based row id in a total order, distributed."""
    from tallyspark.operators.ranking import global_order
    g = global_order(df, order_keys)
    return g.withColumn(name, F.col("_g_rn") - 1).drop("_g_rn")
