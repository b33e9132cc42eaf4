"""Session construction and the shared scratch location.

Intermediate tables live under the shared folder named by ``spark.checkpoint.dir``.  Only a
``local`` master may run without that setting (one machine is the whole cluster); anywhere
else its absence is an error, never a silent machine-local folder.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What results depend on; every entry point sets these.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Defaults of sessions built here; a session handed in by the user keeps its own tuning.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

TABLES_FOLDER = "tallyspark-tables"
_written: dict[str, list[str]] = {}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "tallyspark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = SCALE_CONF | RESULT_CONF
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_scale_conf(spark: SparkSession) -> None:
    """Set what results depend on; tuning (broadcast threshold, AQE, partitions) stays the
    session's own."""
    for k, v in RESULT_CONF.items():
        spark.conf.set(k, v)


def plan_text(df, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as text: simple, extended, codegen, cost or formatted."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, as configured (with its scheme)."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local") \
                or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a "
                               "folder that the driver and every executor share")
        current = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_root(spark: SparkSession) -> str:
    """A new folder (URI) for one written table; removed by ``drop_scratch`` or at exit."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{TABLES_FOLDER}/{uuid.uuid4().hex}"
    app = spark.sparkContext.applicationId
    if app not in _written:
        _written[app] = []
        atexit.register(_drop_at_exit, app)
    _written[app].append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system of its scheme."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate tables this application has written (from the ``since``-th
    on); returns how many.  Frames that read them can't be evaluated afterwards."""
    paths = _written.get(spark.sparkContext.applicationId, [])
    gone = paths[since:]
    for path in gone:
        delete_path(spark, path)
    del paths[since:]
    return len(gone)


def _drop_at_exit(app: str) -> None:
    spark = SparkSession.getActiveSession()
    try:
        if spark is not None and spark.sparkContext.applicationId == app:
            drop_scratch(spark)
    except Exception:  # noqa: BLE001 - the JVM may already be gone
        return


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables written inside the block are deleted when it ends."""
    before = len(_written.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        drop_scratch(spark, before)
