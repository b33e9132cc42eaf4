"""Dimension history: conflicting attributes of a key become versions with validity dates.

A fact repeats its dimension's attributes on every row.  The state of a key on a date is the one
that most rows of that date show (ties: the smallest).  Neighbouring dates with the same state
are one version (gaps and islands); a version is valid until the next one begins.

Windows run over distinct (key, date) rows, combined map-side before, so a key that holds a
third of all rows has no more rows there than it has dates.  A fact row finds its version by
its (key, date), an equi-join that splits on hot keys, never by a range join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _states(rows: DataFrame, key: str, attributes: list[str], day: str) -> DataFrame:
    """(key, day, state): the state that most rows of the day show."""
    counted = rows.groupBy(key, day, F.struct(*attributes).alias("state")).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(key, day).agg(
        F.min_by("state", F.struct((-F.col("n")).alias("n"), F.col("state").alias("s"))).alias("state"))


def _numbered(rows: DataFrame, key: str, attributes: list[str], day: str) -> DataFrame:
    """(key, day, state, version): versions are numbered from 1 by key."""
    order = Window.partitionBy(key).orderBy(day)
    states = _states(rows, key, attributes, day)
    fresh = ~F.col("state").eqNullSafe(F.lag("state").over(order)) | (F.row_number().over(order) == 1)
    return (states.withColumn("_fresh", fresh.cast("int"))
            .withColumn("version", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .drop("_fresh"))


def versions(rows: DataFrame, key: str, attributes: list[str], day: str) -> DataFrame:
    """(key, version, attributes, valid_from, valid_to, is_current): ``valid_to`` is the day the next version
    begins, NULL for the current one."""
    per = _numbered(rows, key, attributes, day).groupBy(key, "version").agg(
        F.min(day).alias("valid_from"), F.first("state").alias("state"))
    nxt = F.lead("valid_from").over(Window.partitionBy(key).orderBy("version"))
    return per.withColumn("valid_to", nxt).select(
        key, F.col("version").cast("int").alias("version"), *[F.col("state")[a].alias(a) for a in attributes],
        "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def current(rows: DataFrame, key: str, attributes: list[str], day: str) -> DataFrame:
    """One row a key: the state of its last day, as one aggregate."""
    last = _states(rows, key, attributes, day).groupBy(key).agg(F.max_by("state", day).alias("state"))
    return last.select(key, *[F.col("state")[a].alias(a) for a in attributes])


def as_of(rows: DataFrame, key: str, attributes: list[str], day: str, history: DataFrame | None = None,
          names: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with the attributes of the version that is valid on their day, under ``names`` (default:
    ``valid_`` + attribute)."""
    names = names or {a: f"valid_{a}" for a in attributes}
    at = _numbered(rows, key, attributes, day) if history is None else history
    found = at.select(F.col(key).alias("_k"), F.col(day).alias("_d"), "version",
                      *[F.col("state")[a].alias(n) for a, n in names.items()])
    return rows.join(found, (rows[key] == found["_k"]) & (rows[day] == found["_d"])).drop("_k", "_d")
