"""Versioned, all-or-nothing publish of several tables.

A table's content is a list of folders and files, less files that an update has replaced.  One
numbered commit file makes a batch visible: its content is written under another name first and
then gets the number in one step, which fails where another writer has taken it.  On HDFS that
step is a rename without overwrite, on a POSIX file system a hard link; object stores without
either need a committer of their own.

A commit may append a version, replace the content, or replace single files (copy on write).
Versions may carry a filter of their keys (``keyfilters``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.sources import keyfilters as K
from tallyspark.sources.files import file_system, write_parquet

MANIFEST = "_manifest"
KEYS = "_keys"
FOLD_AFTER = 64      # commits after which the manifest starts from one file again
MANIFEST_SCHEMA = ("commit bigint, table_name string, path string, replaces boolean, drops array<string>, "
                   "table_schema string, key_filter struct<column:string,version:string,folder:string,bits:bigint,"
                   "low:string,high:string>")


class Conflict(RuntimeError):
    """Another batch was published since this one read the tables."""


@dataclass
class Content:
    """What a table consists of."""
    paths: list[str] = field(default_factory=list)
    dropped: set[str] = field(default_factory=set)
    keys: dict[str, K.KeyFilter] = field(default_factory=dict)      # by path
    schema: T.StructType | None = None


@dataclass(frozen=True)
class Change:
    """What a commit does to a table: a new path, in place of everything or of single files."""
    path: str | None
    replaces: bool = False
    drops: tuple[str, ...] = ()
    keys: K.KeyFilter | None = None
    schema: T.StructType | None = None


@dataclass(frozen=True)
class Rewrite:
    """New rows for some files of a table."""
    rows: DataFrame
    drops: tuple[str, ...]


def qualified(spark: SparkSession, path: str) -> str:
    """One spelling of a path, as the file system gives it."""
    fs, p = file_system(spark, path)
    return fs.makeQualified(p).toString()


def manifest(spark: SparkSession, root: str) -> tuple[int, dict[str, Content]]:
    """(number of the last commit, content of each table).  A commit is one file named by its number;
    a folded commit holds the whole state, so at most FOLD_AFTER are read."""
    fs, folder = file_system(spark, f"{root}/{MANIFEST}")
    if not fs.exists(folder):
        return 0, {}
    numbers = sorted(int(f.getPath().getName()) for f in fs.listStatus(folder)
                     if f.getPath().getName().isdigit())
    if not numbers:
        return 0, {}
    last = numbers[-1]
    start = max((n for n in numbers if n % FOLD_AFTER == 0), default=numbers[0])
    state: dict[str, Content] = {}
    rows = spark.read.schema(MANIFEST_SCHEMA).json([f"{root}/{MANIFEST}/{n}" for n in numbers if n >= start])
    for r in sorted(rows.collect(), key=lambda r: (r["commit"], not r["replaces"])):
        old = state.get(r["table_name"], Content())
        now = Content(schema=old.schema) if r["replaces"] else old
        if r["path"]:
            now.paths.append(r["path"])
            if r["key_filter"]:
                now.keys[r["path"]] = K.KeyFilter(**r["key_filter"].asDict())
        now.dropped.update(r["drops"] or [])
        if r["table_schema"]:
            now.schema = T.StructType.fromJson(json.loads(r["table_schema"]))
        state[r["table_name"]] = now
    return last, state


def _row(number: int, name: str, change: Change) -> str:
    return json.dumps({"commit": number, "table_name": name, "path": change.path, "replaces": change.replaces,
                       "drops": list(change.drops), "key_filter": change.keys.as_json() if change.keys else None,
                       "table_schema": change.schema.json() if change.schema else None}) + "\n"


def _folded(content: Content) -> list[Change]:
    """Changes that give ``content`` from nothing."""
    return [Change(p, i == 0, tuple(sorted(content.dropped)) if i == 0 else (), content.keys.get(p),
                   content.schema if i == 0 else None) for i, p in enumerate(content.paths)]


def commit(spark: SparkSession, root: str, after: int, state: dict[str, Content], added: dict[str, Change]) -> int:
    """Create commit ``after + 1`` with all its rows in one step; ``Conflict`` if another writer has it."""
    number = after + 1
    rows = [_row(number, n, c) for n, c in added.items()]
    if number % FOLD_AFTER == 0:     # the whole state: later readers start here
        rows = [_row(number, n, c) for n, content in state.items() if n not in added or not added[n].replaces
                for c in _folded(content)] + rows
    create_once(spark, f"{root}/{MANIFEST}", str(number), "".join(rows))
    return number


def create_once(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A file with ``text``, which nobody sees before all of it is written; ``Conflict`` if it exists."""
    jvm = spark.sparkContext._jvm
    draft, path = f"{folder}/_draft-{uuid.uuid4().hex}", f"{folder}/{name}"
    fs, p = file_system(spark, draft)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()
    to = jvm.org.apache.hadoop.fs.Path(path)
    try:
        if fs.makeQualified(p).toUri().getScheme() == "file":
            nio = jvm.java.nio.file
            nio.Files.createLink(_local(jvm, fs, to), _local(jvm, fs, p))
        else:
            kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            options = spark.sparkContext._gateway.new_array(kinds, 1)
            options[0] = kinds.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(p, to, options)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            raise Conflict(f"{path} exists") from e
        raise
    finally:
        fs.delete(p, False)


def _local(jvm, fs, path):
    return jvm.java.io.File(fs.makeQualified(path).toUri().getPath()).toPath()


def register_base(spark: SparkSession, root: str, name: str, path: str, schema: T.StructType | None = None) -> None:
    """Make an existing dataset the first version of ``name`` by reference (no copy).  Registering
    the same path again changes nothing.  With ``schema`` no footer is opened to find it."""
    last, state = manifest(spark, root)
    if path not in state.get(name, Content()).paths:
        commit(spark, root, last, state, {name: Change(path, schema=schema)})


def files_of(spark: SparkSession, content: Content) -> list[str]:
    """The files that the table consists of, by the file system's listing."""
    out = []
    for path in content.paths:
        fs, p = file_system(spark, path)
        found = fs.listFiles(p, True)
        while found.hasNext():
            f = found.next().getPath()
            if f.getName()[0] not in "_." and f.toString() not in content.dropped:
                out.append(f.toString())
    return out


def read_content(spark: SparkSession, content: Content) -> DataFrame:
    reader = spark.read if content.schema is None else spark.read.schema(content.schema)
    paths = files_of(spark, content) if content.dropped else content.paths
    return reader.parquet(*paths) if paths else spark.createDataFrame([], content.schema)


def resolve(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current content of ``name``."""
    content = manifest(spark, root)[1].get(name)
    if content is None:
        raise FileNotFoundError(f"no published version of {name} under {root}")
    return read_content(spark, content)


def publish(spark: SparkSession, root: str, appends: dict, checks: Callable | None = None,
            replaces: dict | None = None, rewrites: dict[str, Rewrite | None] | None = None,
            keys: dict[str, str] | None = None) -> dict:
    """Append rows to several tables, replace the content or some files of others, all-or-nothing.

    Each table's new rows are staged into their own version folder; ``checks(current, batch)``
    receives, per table, the would-be content (read lazily) and the staged rows alone, and returns
    rows with a ``violations`` column.  Only with zero violations is the commit created, after all
    data is in place; readers resolve through the commits, so they see the whole batch or none of
    it.  The commit takes the number after the last one that this batch has read.  ``keys``
    names the key column of tables whose appended versions get a key filter."""
    last, state = manifest(spark, root)
    version = uuid.uuid4().hex
    staged, current, added = {}, {}, {}
    rewrites = {n: r for n, r in (rewrites or {}).items() if r is not None}
    given = {**appends, **(replaces or {}), **{n: r.rows for n, r in rewrites.items()}}
    for name, df in given.items():
        path = f"{root}/{name}/v_{version}"
        old = state.get(name, Content())
        if old.schema is not None and [(f.name, f.dataType) for f in old.schema] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"{name}: columns differ from the published ones")
        write_parquet(df, path)
        staged[name] = spark.read.schema(df.schema).parquet(path)
        fresh = name in (replaces or {})
        drops = rewrites[name].drops if name in rewrites else ()
        if fresh or not old.paths:
            current[name] = staged[name]
        else:
            kept = Content(old.paths, old.dropped | set(drops), schema=old.schema)
            current[name] = read_content(spark, kept).unionByName(staged[name])
        found = K.write_filter(staged[name], keys[name], f"{root}/{KEYS}/{name}", version) \
            if name in (keys or {}) and name in appends else None
        added[name] = Change(path, fresh, tuple(drops), found, df.schema)
    violations = 0
    if checks is not None:
        total = checks(current, staged).agg(F.coalesce(F.sum("violations"), F.lit(0)).alias("v")).collect()[0]
        violations = int(total["v"])
    if violations:
        return {"version": version, "published": False, "violations": violations}
    if added:
        commit(spark, root, last, state, added)
    return {"version": version, "published": True, "violations": 0}


# --- work in proportion to the batch ----------------------------------------------------------

def in_range(rows: DataFrame, key: str, asked: DataFrame, asked_key: str) -> DataFrame:
    """``rows`` whose key lies between the smallest and the largest of ``asked``: bounds that the scan
    prunes files and row groups by."""
    low, high = asked.agg(F.min(asked_key), F.max(asked_key)).first()
    if low is None:
        return rows.filter(F.lit(False))
    return rows.filter((F.col(key) >= F.lit(low)) & (F.col(key) <= F.lit(high)))


def versions_to_read(spark: SparkSession, content: Content, keys: DataFrame, key: str) -> Content:
    """``content`` less the versions whose filters rule all of the keys out."""
    filters = [f for f in content.keys.values() if f.column == key]
    ruled_out = {f.version for f in filters} - K.prune(spark, keys, key, filters)
    paths = [p for p in content.paths if p not in content.keys or content.keys[p].version not in ruled_out]
    return Content(paths, content.dropped, content.keys, content.schema)


def stored_keys(spark: SparkSession, root: str, name: str, keys: DataFrame, key: str) -> DataFrame:
    """The different ``keys`` (a frame with the column ``key``) that ``name`` holds, verified on the rows of
    the versions that may hold them."""
    content = manifest(spark, root)[1].get(name)
    asked = keys.select(key).distinct()
    if content is None:
        return asked.limit(0)
    content = versions_to_read(spark, content, asked, key)
    if not content.paths:
        return asked.limit(0)
    rows = in_range(read_content(spark, content).select(F.col(key).alias("_held")), "_held", asked, key)
    return rows.join(asked, rows["_held"] == asked[key], "left_semi").select(F.col("_held").alias(key)).distinct()


def holders(spark: SparkSession, root: str, name: str, keys: DataFrame, key: str) -> DataFrame:
    """(version, key) of the ``keys`` that a version holds, verified on its rows; versions that the
    filters rule out aren't read.  A version without a filter goes by its path."""
    content = manifest(spark, root)[1][name]
    asked = keys.select(key).distinct()
    out = spark.createDataFrame([], T.StructType([T.StructField("version", T.StringType()), keys.schema[key]]))
    for path in versions_to_read(spark, content, asked, key).paths:      # as many as the manifest has versions
        version = content.keys[path].version if path in content.keys else path
        one = Content([path], content.dropped, schema=content.schema)
        rows = in_range(read_content(spark, one).select(F.col(key).alias("_held")), "_held", asked, key)
        held = rows.join(asked, rows["_held"] == asked[key], "left_semi").distinct()
        out = out.unionByName(held.select(F.lit(version).alias("version"), F.col("_held").alias(key)))
    return out


def touched_files(rows: DataFrame, key: str, changes: DataFrame) -> list[str]:
    """The files of ``rows`` that hold a key of ``changes`` (at most the files of the table)."""
    held = in_range(rows.select(F.col(key).alias("_held"), F.col("_metadata.file_path").alias("_file")), "_held",
                    changes, key)
    hit = held.join(changes.select(key), held["_held"] == changes[key], "left_semi").select("_file").distinct()
    return sorted(unquote(r["_file"]) for r in hit.collect())


def update_touched(spark: SparkSession, root: str, name: str, changes: DataFrame, key: str,
                   assign: dict[str, Column]) -> Rewrite | None:
    """UPDATE ... SET as copy on write: only the files that hold a key of ``changes`` are read whole and
    written anew, the others stay as they are.  ``changes`` has one row a key; ``assign`` gives
    columns by expressions over the table's columns and those of ``changes`` (named ``new_...``
    there).  None if no row has such a key."""
    content = manifest(spark, root)[1][name]
    content = versions_to_read(spark, content, changes.select(key), key)
    if not content.paths:
        return None
    files = touched_files(read_content(spark, content), key, changes)
    if not files:
        return None
    reader = spark.read if content.schema is None else spark.read.schema(content.schema)
    old = reader.parquet(*files)
    new = changes.withColumnsRenamed({c: f"new_{c}" for c in changes.columns}).withColumn("_changed", F.lit(True))
    both = old.join(new, old[key] == new[f"new_{key}"], "left")
    rows = both.select(*[F.when(F.col("_changed"), assign[c]).otherwise(F.col(c)).cast(old.schema[c].dataType).alias(c)
                         if c in assign else F.col(c) for c in old.columns])
    return Rewrite(rows, tuple(qualified(spark, f) for f in files))
