"""Session helpers: runtime settings every flow relies on, and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


#: Bytes, as stored, of a task's share of files and shuffles.
SPLIT_BYTES = "16m"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the flows assume (all are session-level, safe to re-apply).

    * UTC session zone: naive timestamps are read as UTC, offsets are converted to UTC.
    * AQE with skew-join splitting: hot keys (one process/tag holding a third of the rows)
      are split at run time instead of landing in one task.
    * Splits of files and of shuffles are small, as a task sorts what it writes by partition
      and what it consolidates by key, and rows take many times their compressed bytes there.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", SPLIT_BYTES)
    return spark


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings that hold for some jobs, as they were before afterwards."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read here; without it
    there is no folder that all executors share, so that is an error. A session on a local
    master (unit tests, the benchmark) gets a private folder instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="telemetra-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the checkpoint root for files a flow writes."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/telemetra-{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few driver-side filesystem listings we do in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


def builder(master: str | None = None, app: str = "telemetra") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    return (b.config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.driver.memory", os.environ.get("TELEMETRA_DRIVER_MEM", "16g")))


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` as a parquet table in the shared checkpoint folder and
    reading it back.

    Used instead of ``Dataset.checkpoint()`` for iterative plans: the plan runs once (a
    reliable RDD checkpoint of an unpersisted plan computes it twice), the files are
    columnar and compressed, and the stage survives the loss of any executor because it
    lives on the shared storage named by ``spark.checkpoint.dir``.
    """
    path = scratch_dir(df.sparkSession, name)
    try:
        df.write.mode("overwrite").parquet(path)
    except Exception:
        _delete(df.sparkSession, path)
        raise
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stage_path = path  # the frame itself knows its files, see release
    return out


def _delete(spark, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def observed(seen, name: str) -> int:
    """A count that ``DataFrame.observe`` made while its frame was written. Of a frame that the
    optimizer finds to be empty the count goes with it: zero."""
    try:
        return seen.get[name] or 0
    except (Py4JJavaError, KeyError):
        return 0


def release(*frames) -> None:
    """Delete the staged tables behind frames returned by ``materialize`` once nothing reads
    them any more (e.g. the previous round of an iterative plan after the next round was
    staged). Frames that are not stages are ignored."""
    for df in frames:
        path = getattr(df, "_stage_path", None)
        if path is not None:
            _delete(df.sparkSession, path)
