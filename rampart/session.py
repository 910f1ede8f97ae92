"""Session construction and the shared scratch location.

Intermediate tables (staged snapshots, key tables, query scratch) go to the
folder the cluster names in ``spark.checkpoint.dir``; only a local master
may leave it unset, and then gets a temporary folder.  ``scratch_scope``
deletes what a job wrote there once the job is over; what a returned
DataFrame still reads goes when the driver ends.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults for the batch jobs (AQE on, session zone UTC).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Plans are built from many Column calls; per-call stack capture for
    # error context costs more than the build itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "rampart", conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (a local master may go without one)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="rampart-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder for one run."""
    path = f"{shared_dir(spark)}/rampart/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append((spark, path))
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to a scratch folder and read back: one
    evaluation, whatever reads it, and its size is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """The planner's estimate of the bytes of ``df``; of a written table, its files' bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _release(entries: list[tuple[SparkSession, str]]) -> None:
    for spark, path in entries:
        fs, p = hadoop_fs(spark, path)
        fs.delete(p, True)


@contextmanager
def scratch_scope():
    """Delete the scratch folders of the enclosed job when it is over; nothing
    that it returns may still read them."""
    mark = len(_SCRATCH)
    try:
        yield
    finally:
        _release(_SCRATCH[mark:])
        del _SCRATCH[mark:]


@atexit.register
def _release_all() -> None:
    try:
        _release(_SCRATCH)
    except Exception:  # the session ended before the interpreter
        pass


def plain_path(uri: str) -> str:
    """One spelling per file: URL escapes decoded, ``file:///x`` as ``file:/x``."""
    path = unquote(uri)
    return "file:/" + path[len("file:///"):] if path.startswith("file:///") else path


def plain_path_col(uri: Column) -> Column:
    """``plain_path`` of a ``_metadata.file_path`` column. It is evaluated for every row, so
    only paths with escapes are decoded."""
    short = F.when(uri.startswith("file:///"), F.concat(F.lit("file:/"), uri.substr(9, 1 << 30))).otherwise(uri)
    decoded = F.url_decode(F.regexp_replace(short, r"\+", "%2B"))  # a plus is a plus in a path
    return F.when(uri.contains("%"), decoded).otherwise(short)


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def ensure_parent(path: str) -> None:
    parent = os.path.dirname(local_path(path))
    if parent:
        os.makedirs(parent, exist_ok=True)
