"""File layouts that spare work later: co-bucketed tables and rows clustered by several columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANGES_BITS = 4          # a column is cut into 2 ** RANGES_BITS ranges of about equal row counts
ACCURACY = 10_000


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int, split: int = 1) -> None:
    """A named table at ``path`` whose rows are dealt to ``buckets`` files by ``keys`` and sorted in
    them, so that joins and groupings of tables bucketed alike need no exchange.  ``split`` writer
    tasks share a bucket (it then has as many files): for keys that hold a large share of the rows."""
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))       # as the writer numbers buckets
    deal = [bucket] if split == 1 else [bucket, F.pmod(F.xxhash64(*df.columns), F.lit(split))]
    (df.repartition(buckets * split, *deal).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def range_bounds(df: DataFrame, columns: list[str], bits: int = RANGES_BITS) -> dict[str, list]:
    """The inner bounds of each column's ranges (at most 2 ** bits - 1 values), in one pass."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(c, shares, ACCURACY).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(row[f"b{i}"] or [])) for i, c in enumerate(columns)}


def interleaved(bounds: dict[str, list], bits: int = RANGES_BITS) -> Column:
    """The columns' range numbers with their binary digits interleaved: rows near each other in all
    columns are near each other in this number."""
    ranks = []
    for c, values in bounds.items():
        rank = F.lit(0)
        for v in values:
            rank = rank + F.coalesce((F.col(c) >= F.lit(v)).cast("int"), F.lit(0))
        ranks.append(rank)
    out = F.lit(0)
    for digit in range(bits):
        for i, rank in enumerate(ranks):
            out = out + F.shiftright(rank, digit).bitwiseAND(F.lit(1)) * (1 << (digit * len(ranks) + i))
    return out


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int, equal: dict[str, int] | None = None) -> None:
    """Parquet files of neighbouring rows by all of ``columns``, so that a range on any of them leaves most
    files unread.  ``equal`` names columns for lookups by value with their number of different
    values: their row groups get Bloom filters.  A cell with many rows spreads over files by row hash."""
    place = interleaved(range_bounds(df, columns))
    rows = df.withColumn("_z", place)
    rows = rows.repartitionByRange(files, F.col("_z"), F.xxhash64(*df.columns)).sortWithinPartitions("_z", *columns).drop("_z")
    w = rows.write.mode("overwrite")
    for c, n in (equal or {}).items():
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", str(n))
        # the filter of a column whose pages all use a dictionary is left out of the file
        w = w.option(f"parquet.enable.dictionary#{c}", "false")
    w.parquet(path)


def drop_database(spark: SparkSession, name: str) -> None:
    """Forget a database and its tables; files at their own paths stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
