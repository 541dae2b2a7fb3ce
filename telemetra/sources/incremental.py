"""Incremental batch import bookkeeping.

The ledger is the source of truth for "already processed": pending files are the listing
minus the ledger (left anti-join on the file's path relative to the dump folder). File
contents are never read to list them (binary-file source with the content column pruned),
and only pending files are read at all, in batches bounded by bytes.

A ledger is a folder of Parquet files to which entries are only ever added; of a file's
entries the last one counts. Nothing rewrites it in place, so no crash can empty it.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.operators.ledger import IMPORT_LEDGER
from telemetra.sources import commits

#: Bytes and files of a batch (compressed, as listed).
BATCH_BYTES, BATCH_FILES = 64 << 30, 10_000
#: Ledger files above which the ledger is folded into one.
LEDGER_FILES = 64
LISTING = "path STRING, file STRING, length BIGINT, modified TIMESTAMP"
FAILURES = "file STRING, error STRING"


def norm_path(c) -> "F.Column":
    """Comparable form of a path: the ``file:`` scheme and extra leading slashes removed."""
    return F.regexp_replace(c, r"^file:/+", "/")


def plain_path(c) -> "F.Column":
    """A path as readers report it in ``_metadata`` (URL-encoded) in the form of listings."""
    return norm_path(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))))


def qualified(root: str) -> str:
    """``root`` with the scheme and host Spark's readers report, ``file:`` removed."""
    spark = SparkSession.active()
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub(r"^file:/+", "/", full).rstrip("/")


def relative_to(root: str, c) -> "F.Column":
    """Path relative to ``root`` (the whole path when it lies outside), on any file system."""
    p = norm_path(c)
    rel = F.regexp_extract(p, "^" + re.escape(qualified(root)) + "/(.*)$", 1)
    return F.when(rel == "", p).otherwise(rel)


def list_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """``path`` (absolute), ``file`` (relative to ``root``), ``length`` and ``modified`` of every matching file."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                    .option("pathGlobFilter", glob).load(root).select("path", "length", F.col("modificationTime").alias("modified")))
    return listing.select("path", relative_to(root, F.col("path")).alias("file"), "length", "modified")


# --- ledgers -----------------------------------------------------------------------------

def _entries(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(T.StructType([*schema.fields, T.StructField("seq", T.LongType())])).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_ledger(spark: SparkSession, path: str, schema=IMPORT_LEDGER) -> DataFrame:
    """The last entry of each file, none when there is no ledger yet. Any other failure
    to read it is an error: an empty ledger would import everything again."""
    entries = _entries(spark, path, schema)
    if entries is None:
        return spark.createDataFrame([], schema)
    cols = [f.name for f in schema.fields]
    last = entries.groupBy("file").agg(F.max_by(F.struct(*[c for c in cols if c != "file"]), F.coalesce("seq", F.lit(0))).alias("e"))
    return last.select("file", "e.*").select(*cols)


def ledger_rows(entries: DataFrame, schema=IMPORT_LEDGER) -> DataFrame:
    """``entries`` as they are stored: columns that they lack are null, ``seq`` is the time
    of writing in nanoseconds."""
    cols = [(F.col(f.name) if f.name in entries.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return entries.select(*cols, F.lit(time.time_ns()).cast("long").alias("seq")).coalesce(1)


def append_ledger(spark: SparkSession, path: str, entries: DataFrame, schema=IMPORT_LEDGER) -> None:
    """Add entries; one of a file that the ledger has replaces the older one."""
    commits.transact(spark, f"{path}_tx", f"entries-{time.time_ns()}", lambda stage: ledger_rows(entries, schema).write.parquet(f"{stage}/ledger"), {"ledger": path})
    fold_ledger(spark, path, schema)


def fold_ledger(spark: SparkSession, path: str, schema=IMPORT_LEDGER, above: int = LEDGER_FILES) -> bool:
    """Rewrite a ledger of many small files as one. The folded file is there before the old
    ones go, and the last entry of a file is the same in both."""
    old = commits.Files(spark, path).below(path)
    if len(old) <= above:
        return False

    def write(stage: str) -> list[str]:
        entries = _entries(spark, path, schema)
        last = entries.groupBy("file").agg(F.max_by(F.struct("*"), F.coalesce("seq", F.lit(0))).alias("e")).select("e.*")
        last.coalesce(1).write.parquet(f"{stage}/ledger")
        return [f"{path}/{name}" for name in old]
    return commits.transact(spark, f"{path}_tx", f"fold-{time.time_ns()}", write, {"ledger": path})


def next_run(spark: SparkSession, runs_path: str) -> int:
    """The number of a new run, one more than any before it on this table. Two runs that
    start at once get two numbers."""
    return commits.claim(spark, runs_path)


def json_seq(run: int, batch: int = 0):
    """``ingest_seq`` of typed-JSON rows, the same for batch and stream: run first."""
    return F.struct(F.lit(run).cast("long").alias("run"), F.lit(batch).cast("long").alias("batch"), F.col("file"), F.col("pos"))


# --- pending files -----------------------------------------------------------------------

def pending_files(listing: DataFrame, ledger: DataFrame, again_if_changed: bool = False) -> DataFrame:
    """Files not yet in the ledger. With ``again_if_changed`` also those whose length
    or modification time is another than when they were imported."""
    if not again_if_changed:
        return listing.join(ledger.select("file"), "file", "left_anti")
    known = ledger.select("file", "length", "modified")
    same = (listing["file"] == known["file"]) & listing["length"].eqNullSafe(known["length"]) & listing["modified"].eqNullSafe(known["modified"])
    return listing.join(known, same, "left_anti")


def batches(pending: DataFrame, max_bytes: int = BATCH_BYTES, max_files: int = BATCH_FILES) -> Iterator[list[Row]]:
    """Pending files in path order, in batches of at most ``max_bytes`` (or one file) and
    ``max_files``. The driver holds the names of a batch and of a partition of the list."""
    batch, size = [], 0
    for row in pending.select("path", "file", "length", "modified").orderBy("file").toLocalIterator():
        if batch and (size + row["length"] > max_bytes or len(batch) >= max_files):
            yield batch
            batch, size = [], 0
        batch.append(row)
        size += row["length"]
    if batch:
        yield batch


def file_fault(spark: SparkSession, error: Exception) -> bool:
    """Whether a failed read may be the files' fault (not the program's or the session's)."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return False
    if isinstance(error, AnalysisException):
        return error.getCondition() == "PATH_NOT_FOUND"
    return isinstance(error, (PySparkException, Py4JError))


def said(error: Exception) -> str:
    causes = re.findall(r"Caused by: ([^\n]+)", str(error))
    return (causes[-1] if causes else str(error).strip().split("\n")[0])[:500]


def stage_readable(spark: SparkSession, files: list[Row], stage: Callable[[list[Row]], DataFrame]) -> tuple[list[DataFrame], list[Row], list[tuple[str, str]]]:
    """``(staged frames, files read, (file, error) of files that can't be read)``.

    ``stage`` reads some files into a table. A batch that fails is halved until the bad file
    is alone, so one bad file among n costs about 2 log2(n) further jobs and no other file
    is lost with it.
    """
    try:
        return [stage(files)], files, []
    except Exception as error:  # noqa: BLE001 — sorted out below
        if not file_fault(spark, error):
            raise
        if len(files) == 1:
            return [], [], [(files[0]["file"], said(error))]
    half = len(files) // 2
    a, b = (stage_readable(spark, part, stage) for part in (files[:half], files[half:]))
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def failed_files(per_row: DataFrame) -> DataFrame:
    """``(file, error)`` of files with a timestamp that does not parse, a header without
    a column or bytes that are not UTF-8: they fail as a whole, are not inserted nor recorded
    as done, and stay pending for the next run."""
    bad_ts = F.when(F.col("ts").isNull() & F.col("ts_text").isNotNull(), F.concat(F.lit("bad timestamp: "), F.left(F.col("ts_text"), F.lit(100))))
    error = F.coalesce(F.col("fault"), bad_ts) if "fault" in per_row.columns else bad_ts
    return per_row.withColumn("error", error).where("error IS NOT NULL").groupBy("file").agg(F.min("error").alias("error"))


def archive_files(spark: SparkSession, paths: list[str], src_root: str, dst_root: str) -> list[str]:
    """Move processed files from the dump folder to the done folder, keeping their path
    relative to the dump folder. A file outside the dump folder is left where it is (it
    was loaded from an explicit path). File-system metadata operations only (renames),
    as a Spark user does with the Hadoop FileSystem API. Returns the new locations."""
    fs, src = commits.Files(spark, dst_root), qualified(src_root)
    moved = []
    for p in paths:
        local = re.sub(r"^file:/+", "/", p)
        if not local.startswith(src + "/"):
            continue
        target = dst_root.rstrip("/") + "/" + local[len(src) + 1:]
        fs.folder(target.rpartition("/")[0])
        if fs.move(p, target):
            moved.append(target)
    return moved
