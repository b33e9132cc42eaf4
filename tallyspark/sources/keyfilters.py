"""Bloom filters of stored keys, one for each published version of a table.

A filter is a table (version, bucket, bitmap): HASHES positions a key in about BITS_PER_KEY bits a key,
built by the built-in bitmap aggregate and kept in pieces of 4 KB, so neither building nor asking
needs the whole filter in one place.  A batch asks only versions whose key range overlaps its own;
a version that admits none of its keys isn't read, and what is admitted is verified on the
version's rows, so a false positive costs a read and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HASHES = 7
BITS_PER_KEY = 12
PIECE_BITS = 32_768          # fixed value: bits of the built-in bitmap aggregate
SCHEMA = "version string, bucket bigint, bitmap binary"


@dataclass(frozen=True)
class KeyFilter:
    """What a commit says about the keys of a version; ``low`` and ``high`` as text."""
    column: str
    version: str
    folder: str
    bits: int
    low: str | None
    high: str | None

    def as_json(self) -> dict:
        return dict(self.__dict__)


def positions(key: Column, bits: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), key), bits) for i in range(HASHES)])


def pieces(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, bitmap) of the non-NULL keys."""
    at = rows.filter(F.col(key).isNotNull()).select(F.explode(positions(F.col(key), F.lit(bits).cast("long"))).alias("at"))
    return at.groupBy(F.floor(F.col("at") / PIECE_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("at") % PIECE_BITS).alias("bitmap"))


def write_filter(rows: DataFrame, key: str, folder: str, version: str) -> KeyFilter:
    """Build the filter of the rows of a version into ``folder``, beside those of other versions."""
    seen = rows.agg(F.count(key).alias("n"), F.min(key).cast("string").alias("low"),
                    F.max(key).cast("string").alias("high")).first()
    bits = max(1, -(-seen["n"] * BITS_PER_KEY // PIECE_BITS)) * PIECE_BITS
    pieces(rows, key, bits).write.parquet(f"{folder}/version={version}")
    return KeyFilter(key, version, folder, bits, seen["low"], seen["high"])


def admitted(spark: SparkSession, keys: DataFrame, key: str, filters: list[KeyFilter]) -> DataFrame:
    """(version, key) that a version may hold: every key that it holds, and few others."""
    kind = keys.schema[key].dataType.simpleString()
    known = spark.createDataFrame([(f.version, f.bits, f.low, f.high) for f in filters],
                                  "version string, bits long, low string, high string")
    known = known.select("version", "bits", F.col("low").cast(kind).alias("low"), F.col("high").cast(kind).alias("high"))
    asked = keys.select(F.col(key).alias("asked")).distinct()
    # a row for each version of the manifest
    probes = (asked.join(F.broadcast(known), (F.col("asked") >= F.col("low")) & (F.col("asked") <= F.col("high")))
              .select("version", "asked", F.explode(positions(F.col("asked"), F.col("bits"))).alias("at"))
              .select("version", "asked", F.floor(F.col("at") / PIECE_BITS).alias("bucket"),
                      (F.col("at") % PIECE_BITS).cast("int").alias("bit")))
    folders = sorted({f.folder for f in filters})
    stored = spark.read.schema(SCHEMA).parquet(*folders).filter(F.col("version").isin([f.version for f in filters]))
    byte = F.expr("CAST(conv(hex(substring(bitmap, CAST(bit DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    is_set = byte.bitwiseAND(F.expr("shiftleft(1, bit % 8)")) != 0
    return (probes.join(stored, ["version", "bucket"]).filter(is_set)
            .groupBy("version", "asked").count().filter(F.col("count") == HASHES)
            .select("version", F.col("asked").alias(key)))


def prune(spark: SparkSession, keys: DataFrame, key: str, filters: list[KeyFilter]) -> set[str]:
    """The versions that may hold one of the keys (as many names as the manifest has versions)."""
    if not filters:
        return set()
    return {r["version"] for r in admitted(spark, keys, key, filters).select("version").distinct().collect()}
