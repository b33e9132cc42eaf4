"""Join helpers that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_outer_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``, skew-tolerant.

    A plain outer join cannot split a hot key that lives on the non-preserved side (the
    preserved row must be emitted exactly once), so one task would receive every
    matching row.  Here the matches come from an INNER join, which adaptive execution
    may split on both sides, and the unmatched preserved rows from a LEFT ANTI join
    against the *distinct* right keys (a hot key collapses map-side)."""
    if not set(left.columns) & set(right.columns):
        matched = left.join(right, left[left_key] == right[right_key], "inner")
    elif set(left.columns) & set(right.columns) == {left_key} and left_key == right_key:
        matched = left.join(right, left_key, "inner")
    else:
        raise ValueError(f"both sides have {sorted(set(left.columns) & set(right.columns))}: "
                         "rename all but a join key of the same name")
    keys = right.select(F.col(right_key).alias("__rk")).distinct()
    unmatched = left.join(keys, left[left_key] == keys["__rk"], "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
