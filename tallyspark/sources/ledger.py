"""Copy by ledger: a rerun copies new and changed files only, and a broken run goes on where it stopped.

The ledger says for every source file its size, its time of change and the folder that holds its
copy.  Files are copied in batches of bounded bytes; a batch's ledger entry is one numbered commit
(``versions``), made after its rows are written, so a killed run leaves folders that no entry names
and nothing twice.  A changed file gets a new folder, a source file that is gone leaves the copy.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.sources.files import file_system
from tallyspark.sources.versions import create_once

LEDGER = "_ledger"
BATCH_BYTES = 64 << 30       # source bytes of a batch
FOLD_AFTER = 64              # commits after which an entry file holds the whole ledger again
SCHEMA = "commit bigint, source string, size bigint, changed bigint, folder string"


@dataclass(frozen=True)
class Entry:
    size: int
    changed: int
    folder: str | None       # None: the source file is gone


def source_files(spark: SparkSession, src: str) -> dict[str, tuple[int, int]]:
    """(bytes, time of change) of every data file under ``src``, by the listing."""
    fs, p = file_system(spark, src)
    out, found = {}, fs.listFiles(p, True)
    while found.hasNext():
        f = found.next()
        if f.getPath().getName()[0] not in "_.":
            out[f.getPath().toString()] = (f.getLen(), f.getModificationTime())
    return out


def read_ledger(spark: SparkSession, dst: str) -> tuple[int, dict[str, Entry]]:
    """(number of the last commit, entries by source file)."""
    fs, folder = file_system(spark, f"{dst}/{LEDGER}")
    if not fs.exists(folder):
        return 0, {}
    numbers = [int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()]
    if not numbers:
        return 0, {}
    start = max((n for n in numbers if n % FOLD_AFTER == 0), default=min(numbers))
    rows = spark.read.schema(SCHEMA).json([f"{dst}/{LEDGER}/{n}" for n in numbers if n >= start]).collect()
    entries = {}
    for r in sorted(rows, key=lambda r: r["commit"]):
        entries[r["source"]] = Entry(r["size"], r["changed"], r["folder"])
    return max(numbers), entries


def _batches(files: dict[str, tuple[int, int]], most: int) -> list[dict[str, tuple[int, int]]]:
    out, room = [], 0
    for path in sorted(files):
        if not out or files[path][0] > room:
            out.append({})
            room = most
        out[-1][path] = files[path]
        room -= files[path][0]
    return out


def sync(spark: SparkSession, src: str, dst: str, schema: T.StructType, batch_bytes: int = BATCH_BYTES,
         after_batch=None) -> dict:
    """Bring the copy of the Parquet files under ``src`` up to date; returns the files that were copied, left
    alone and taken out.  ``after_batch(number)`` is called after each commit."""
    now = source_files(spark, src)
    last, known = read_ledger(spark, dst)
    fresh = {p: f for p, f in now.items() if p not in known or (known[p].size, known[p].changed) != f or known[p].folder is None}
    gone = [p for p, e in known.items() if p not in now and e.folder is not None]
    copied = 0
    for batch in _batches(fresh, batch_bytes):
        folder = f"{dst}/data/{uuid.uuid4().hex}"
        ids = {p: i for i, p in enumerate(sorted(batch))}
        rows = spark.read.schema(schema).parquet(*sorted(batch)).withColumn("_file", F.col("_metadata.file_path"))
        names = _names(rows, ids)
        # a row for each file of the batch
        rows = rows.join(F.broadcast(names), "_file").drop("_file")
        rows.write.partitionBy("file_no").parquet(folder)
        last += 1
        _enter(spark, dst, last, known, {p: Entry(*f, f"{folder}/file_no={ids[p]}") for p, f in batch.items()})
        copied += len(batch)
        if after_batch is not None:
            after_batch(last)
    if gone:
        _enter(spark, dst, last + 1, known, {p: Entry(0, 0, None) for p in gone})
    return {"files_copied": copied, "files_left": len(now) - len(fresh), "files_gone": len(gone)}


def _enter(spark: SparkSession, dst: str, number: int, known: dict[str, Entry], new: dict[str, Entry]) -> None:
    """Commit ``number``: the new entries, or the whole ledger where it is folded; ``known`` takes them in."""
    known.update(new)
    rows = known if number % FOLD_AFTER == 0 else new
    create_once(spark, f"{dst}/{LEDGER}", str(number), "".join(
        json.dumps({"commit": number, "source": p, "size": e.size, "changed": e.changed, "folder": e.folder}) + "\n"
        for p, e in rows.items() if e.folder is not None or p in new))


def _names(rows: DataFrame, ids: dict[str, int]) -> DataFrame:
    """(_file as the scan spells it, file_no)."""
    spark = rows.sparkSession
    found = [r["_file"] for r in rows.select("_file").distinct().collect()]      # no column is read for it
    spelled = [(f, ids[file_system(spark, unquote(f))[1].toString()]) for f in found]
    return spark.createDataFrame(spelled, "_file string, file_no int")


def read_copy(spark: SparkSession, dst: str, schema: T.StructType) -> DataFrame:
    """The copied rows that the ledger vouches for."""
    fs = file_system(spark, dst)[0]
    folders = sorted(e.folder for e in read_ledger(spark, dst)[1].values() if e.folder is not None)
    folders = [f for f in folders if fs.exists(file_system(spark, f)[1])]     # a file without rows has none
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
