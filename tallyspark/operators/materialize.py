"""Cut lineage by writing a table into the shared checkpoint folder.

Used where one intermediate result is read by several jobs.  A written Parquet table
survives executor loss, unlike cached blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyspark.session import delete_path, scratch_root


def materialize(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_root(spark)
    df.write.mode("overwrite").parquet(path)
    return _read(df, path)


def _read(df: DataFrame, path: str) -> DataFrame:
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no later plan reads: what follows them has been written too."""
    for t in tables:
        delete_path(t.sparkSession, t._written_to)


def materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Write ``df`` and read it back; the row count is observed during the write (an
    accumulator-backed metric, no second pass over the data)."""
    out, metrics = materialize_observed(df)
    return out, int(metrics["n"])


def materialize_observed(df: DataFrame, *metrics) -> tuple[DataFrame, dict]:
    """Write ``df`` and read it back, with aggregate ``metrics`` (named Columns) and the
    row count ``n`` observed during the write."""
    spark = df.sparkSession
    path = scratch_root(spark)
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("n"), *metrics).write.mode("overwrite").parquet(path)
    return _read(df, path), dict(obs.get)
