"""File sources and sinks: CSV / Parquet read and write, partitioned layout, file
metadata, guarded copies with metrics, named tables.

Paths are URIs on the cluster's shared file system; nothing here touches a
machine-local folder except through the Spark writers/readers themselves.
"""

from __future__ import annotations

import datetime as dt
import os
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_RECORDS_PER_FILE = 5_000_000

# One set of options for both directions.  Text with quotes, commas, backslashes and line breaks
# comes back as it was; blanks at the ends are kept.
CSV = {"header": True, "quote": '"', "escape": '"', "lineSep": "\n", "encoding": "UTF-8",
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# How NULL is written where the empty string has to stay different from it: a character of the
# private use area, which text to be exchanged doesn't hold.
NULL_TEXT = "\ue000"


def write_csv(df: DataFrame, path: str, single_file: bool = False, null_value: str = "") -> None:
    """Header row, overwrite.  ``single_file`` gives exactly one file, only for small (aggregated)
    results.  With the default ``null_value`` an empty string reads back as NULL; use NULL_TEXT on
    both sides to keep them apart."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite").options(**CSV).option("nullValue", null_value) \
        .option("emptyValue", "" if null_value == "" else '""')
    if not single_file:
        w = w.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    w.csv(path)


def csv_reader(spark: SparkSession, null_value: str = "", mode: str = "PERMISSIVE", multi_line: bool = True):
    """With ``multi_line`` values may hold line breaks and a file is read by one task; without, files are
    split."""
    return spark.read.options(**CSV).option("nullValue", null_value).option("emptyValue", "") \
        .option("mode", mode).option("multiLine", multi_line)


def line_break_files(spark: SparkSession, path: str) -> dict[str, bool]:
    """For every file under ``path``: whether a value may hold a line break.  A record that goes on in the
    next line leaves an odd number of quotes in the line that it begins in (a quote inside a value
    is doubled), so a file whose lines all have an even number has none.  One pass over text splits."""
    lines = spark.read.option("lineSep", CSV["lineSep"]).text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(CSV["quote"]), F.lit("")))
    per_file = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max(quotes % 2).alias("odd"))
    return {unquote(r["file"]): r["odd"] == 1 for r in per_file.collect()}      # a row a file


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False,
             null_value: str = "", mode: str = "PERMISSIVE", multi_line: bool | None = None) -> DataFrame:
    """Files without line breaks inside values are read in splits, the others whole; ``multi_line`` says so
    for all files and spares the pass that finds out."""
    def read(whole: bool, paths) -> DataFrame:
        r = csv_reader(spark, null_value, mode, whole)
        if schema is not None:
            r = r.schema(schema)
        elif infer:
            r = r.option("inferSchema", True)
        if paths != [path] and file_system(spark, path)[0].getFileStatus(file_system(spark, path)[1]).isDirectory():
            r = r.option("basePath", path)
        return r.csv(paths)

    if multi_line is not None:
        return read(multi_line, [path])
    broken = line_break_files(spark, path)
    if not any(broken.values()) or all(broken.values()):
        return read(any(broken.values()), [path])
    if schema is None:      # one inference over all files
        return read(True, [path])
    return read(False, sorted(f for f, b in broken.items() if not b)).unionByName(
        read(True, sorted(f for f, b in broken.items() if b)))


def write_parquet(df: DataFrame, path: str, partition_by=None) -> None:
    """Overwrite a Parquet dataset.  With ``partition_by`` rows are first range-partitioned
    on (partition columns, row hash): the sampled ranges give a partition value as many
    writer tasks as its share of the rows (a value holding a third of the data is split
    over a third of the tasks), while small values share a task and stay one file each.
    The hash is a pure function of the row, so a retried task writes the same rows."""
    w = df
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
        w = df.repartitionByRange(*[F.col(c) for c in cols], row_hash)
        w.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE) \
            .partitionBy(*cols).parquet(path)
        return
    w.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)


def file_stats(df: DataFrame) -> DataFrame:
    """(rows, files, bytes) of a file-based DataFrame from the hidden ``_metadata`` column;
    reads no data columns."""
    per_file = df.select("_metadata.file_path", "_metadata.file_size") \
        .groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                        F.count(F.lit(1)).alias("files"),
                        F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"))


METADATA_SCHEMA = T.StructType([
    T.StructField("item_name", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("size", T.LongType()), T.StructField("exists", T.BooleanType()),
    T.StructField("last_modified", T.TimestampType()), T.StructField("is_folder", T.BooleanType()),
    T.StructField("n_files", T.LongType())])


def file_system(spark: SparkSession, path: str):
    """(file system, Hadoop path) of a URI."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def file_metadata(spark: SparkSession, paths) -> DataFrame:
    """Get-metadata probe: one row per path, whether a file or a folder (nested or empty): name,
    bytes and files in it, existence, last change.  Only the file system's listing is read."""
    rows = []
    for path in paths:
        fs, p = file_system(spark, path)
        name = os.path.basename(path.rstrip("/"))
        if not fs.exists(p):
            rows.append((name, path, None, False, None, None, None))
            continue
        status, content = fs.getFileStatus(p), fs.getContentSummary(p)
        changed = dt.datetime.fromtimestamp(status.getModificationTime() / 1000, dt.UTC)
        rows.append((name, path, content.getLength(), True, changed, status.isDirectory(),
                     content.getFileCount()))
    return spark.createDataFrame(rows, METADATA_SCHEMA)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


REPORT_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("sink", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("rows_read", T.LongType()),
    T.StructField("rows_copied", T.LongType()), T.StructField("rows_skipped", T.LongType()),
    T.StructField("files_read", T.LongType()), T.StructField("files_written", T.LongType()),
    T.StructField("bytes_read", T.LongType()), T.StructField("bytes_written", T.LongType())])


def guarded_copy(spark: SparkSession, src: str, dst: str, fmt: str = "parquet",
                 schema: T.StructType | None = None) -> dict:
    """metadata -> if exists -> copy; a missing source ends with status 'skipped'.
    Row counts come from an ``Observation`` on the copy itself (no extra pass over the
    data); byte and file counts from ``_metadata`` of source and sink."""
    if not path_exists(spark, src):
        return {"source": src, "sink": dst, "status": "skipped", "rows_read": 0, "rows_copied": 0,
                "rows_skipped": 0, "files_read": 0, "files_written": 0, "bytes_read": 0,
                "bytes_written": 0}
    if fmt == "csv":
        # a field of this name takes the text of records that don't fit
        with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())]) if schema else None
        data = read_csv(spark, src, with_bad)
    else:
        data = spark.read.parquet(src)
    obs = Observation("copy")
    bad = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in data.columns else F.lit(False)
    observed = data.observe(obs, F.count(F.lit(1)).alias("rows_read"),
                            F.count_if(bad).alias("rows_skipped"))
    if "_corrupt_record" in data.columns:
        observed = observed.filter(~bad).drop("_corrupt_record")
    if fmt == "csv":
        write_csv(observed, dst)
    else:
        write_parquet(observed, dst)
    m = obs.get
    read, written = (r.asDict() for r in file_metadata(spark, [src, dst]).collect())
    return {"source": src, "sink": dst, "status": "copied", "rows_read": int(m["rows_read"]),
            "rows_copied": int(m["rows_read"]) - int(m["rows_skipped"]),
            "rows_skipped": int(m["rows_skipped"]), "files_read": read["n_files"],
            "files_written": written["n_files"], "bytes_read": read["size"],
            "bytes_written": written["size"]}


def copy_report(spark: SparkSession, report: dict) -> DataFrame:
    return spark.createDataFrame([tuple(report[f.name] for f in REPORT_SCHEMA.fields)], REPORT_SCHEMA)


# --- named tables ---------------------------------------------------------------------

def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str,
                 replace: bool = False) -> None:
    """CREATE TABLE with declared columns over Parquet files at ``path``; with ``replace`` a table
    of that name is dropped first, without it an existing one is an error."""
    if replace:
        drop_table(spark, name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")


def insert_rows(df: DataFrame, name: str) -> None:
    """INSERT INTO ... SELECT, columns by position as declared."""
    df.write.insertInto(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """DROP TABLE IF EXISTS; the files of the table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
