"""Where two datasets differ, without moving equal rows: digests of key ranges and bisection.

The digest of a range is its row count and two sums of 64-bit row hashes: it doesn't depend on the
order of rows, and a row that is there twice doesn't cancel.  Both sides are aggregated by range
(map-side combined: a row a range and task is all that moves).  Ranges with equal digests are
proven equal; of the others each is split into FAN parts, reading those ranges alone, until few
rows are left, and only these are compared row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.materialize import materialize_observed

FAN = 64                # parts of a range
LEAF_ROWS = 4096        # rows of a range that are compared row by row
MOST_RANGES = 256       # differing ranges that go into a pushed filter; more are joined


def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of the whole row; NULLs count by their place."""
    cols = [F.col(c) for c in columns]
    nulls = [c.isNull() for c in cols]
    return tuple(F.xxhash64(F.lit(seed), *cols, *nulls).cast("decimal(20,0)") for seed in (1, 2))


def _digests(rows: DataFrame, columns: list[str], part: Column, side: int) -> DataFrame:
    one, two = row_hashes(columns)
    return rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("one"), F.sum(two).alias("two")) \
        .select("part", F.lit(side).alias("side"), "n", "one", "two")


def unequal_parts(a: DataFrame, b: DataFrame, part: Column) -> DataFrame:
    """(part, n_a, n_b) of the parts whose digests differ."""
    columns = a.columns
    both = _digests(a, columns, part, 0).unionByName(_digests(b, columns, part, 1))

    def of(side: int, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))
    joined = both.groupBy("part").agg(*[of(s, c).alias(f"{c}_{x}") for s, x in ((0, "a"), (1, "b")) for c in ("n", "one", "two")])
    same = F.lit(True)
    for c in ("n", "one", "two"):
        same = same & F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b"))
    return joined.filter(~same).select("part", F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"))


@dataclass(frozen=True)
class Damage:
    """``ranges``: (low, high, n_a, n_b) that differ, NULL keys under a NULL low; ``rows``: the differing
    rows with how often each side has them; ``compared``: rows compared one by one."""
    ranges: DataFrame
    rows: DataFrame
    compared: int


def find_damage(a: DataFrame, b: DataFrame, key: str, fan: int = FAN, leaf_rows: int = LEAF_ROWS) -> Damage:
    """``key`` is a whole-number column; ``b`` has the columns of ``a``."""
    spark, columns = a.sparkSession, a.columns
    b = b.select(*columns)
    ends = [df.agg(F.min(key).alias("low"), F.max(key).alias("high")).first() for df in (a, b)]
    low = min((r["low"] for r in ends if r["low"] is not None), default=0)
    high = max((r["high"] for r in ends if r["high"] is not None), default=0)
    k = F.col(key).cast("bigint")
    width = high - low + 1
    left, right = a, b
    while True:
        width = max(1, -(-width // fan))
        # NULL keys are one range of their own
        part = F.coalesce(F.floor((k - F.lit(low)) / F.lit(width)).cast("bigint"), F.lit(-1).cast("bigint")) if width > 1 \
            else F.coalesce(k - F.lit(low), F.lit(-1).cast("bigint"))
        parts, seen = materialize_observed(unequal_parts(left, right, part), F.max(F.col("n_a") + F.col("n_b")).alias("most"))
        left, right = _only(a, k, part, parts, seen["n"], low, width), _only(b, k, part, parts, seen["n"], low, width)
        if not seen["n"] or seen["most"] <= leaf_rows or width == 1:
            break
    at = F.when(F.col("part") >= 0, F.col("part"))
    ranges = parts.select((at * width + low).alias("low"), (at * width + (low + width - 1)).alias("high"), "n_a", "n_b")
    signed = left.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(
        right.withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1)))
    rows = signed.groupBy(*[f"`{c}`" for c in columns]).agg(F.sum("_a").alias("in_source"), F.sum("_b").alias("in_copy")) \
        .filter(F.col("in_source") != F.col("in_copy"))
    compared = parts.agg(F.coalesce(F.sum(F.col("n_a") + F.col("n_b")), F.lit(0)).alias("n")).first()["n"]
    return Damage(ranges, rows, int(compared))


def _only(rows: DataFrame, k: Column, part: Column, parts: DataFrame, n: int, low: int, width: int) -> DataFrame:
    """The rows of the given parts: by ranges that the scan can prune by while they are few."""
    if n > MOST_RANGES:
        return rows.withColumn("part", part).join(parts.select("part"), "part", "left_semi").drop("part")
    keep = F.lit(False)
    for r in parts.select("part").collect():
        if r["part"] < 0:
            keep = keep | k.isNull()
        else:
            start = low + r["part"] * width
            keep = keep | k.between(F.lit(start), F.lit(start + width - 1))
    return rows.filter(keep)
