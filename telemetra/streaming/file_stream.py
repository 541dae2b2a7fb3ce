"""Streaming import of typed-JSON export files.

The stream is one of file names: Structured Streaming lists the dump folder, admits new
files by bytes (or number) a trigger and remembers them in its checkpoint, so a re-run
handles only files not seen before (``trigger(availableNow=True)`` processes what is pending
and stops). The content column of the binary-file source is never read; ``foreachBatch``
loads the admitted files with the same job as the batch import: one scan, faults by file.

Each epoch is one transaction, named after the query and the epoch: an epoch that failed at
any point and is tried again leaves each row once. Ledger entries are added, not rewritten,
and folded once a run. Replaying a file (new checkpoint) leaves the consolidated table
unchanged (T4).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra import session
from telemetra.plans import flows
from telemetra.sources import commits
from telemetra.sources import incremental as inc

#: The binary-file source's own columns.
BINARY_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
TRIGGER_BYTES = 1 << 30


def batch_writer(job: flows.JsonJob, checkpoint: str, run: int):
    """The function of ``foreachBatch``: an epoch's files as one transaction."""
    query: list[str] = []

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if not query:  # the id that the checkpoint keeps over restarts
            query.append(json.loads(commits.Files(spark, checkpoint).read_text(f"{checkpoint}/metadata"))["id"])
        files = batch.withColumn("file", inc.relative_to(job.dump_dir, F.col("path"))).collect()  # names of one trigger
        job.load(spark, flows._Run(), files, inc.json_seq(run, epoch_id), f"{query[0]}-{epoch_id}", again=True)
        mine = f"{query[0]}-"  # only the last epoch can be tried again
        commits.forget(spark, f"{job.table_path}_tx", lambda tx: not tx.startswith(mine) or int(tx[len(mine):]) >= epoch_id)
    return write


def stream_import(spark: SparkSession, dump_dir: str, table_path: str, ledger_path: str,
                  touched_path: str, checkpoint: str, default_company: str,
                  flow: str = "projections", overrides=None, max_files_per_trigger: int | None = None,
                  archive_dir: str | None = None, max_bytes_per_trigger: int = TRIGGER_BYTES):
    """Start an ``availableNow`` file stream over ``dump_dir`` and return the query.

    Every call is a run with a number greater than all before it on this table (recorded
    beside it), and ``ingest_seq`` starts with that number: a file imported later wins over
    an earlier one, also with a new checkpoint. The ledger has one entry a file; lines that
    can never become rows go to ``<table>_quarantine``; files that can't be read go to
    ``<ledger>_failed``, and as the ledger lacks them, a batch import finds them pending.
    The touched partitions are added to ``touched_path``.

    ``archive_dir`` turns on ``cleanSource=archive`` (files are moved after commit; the move
    lags one batch and is cosmetic — checkpoint and ledger are the truth).
    """
    session.configure(spark)
    commits.recover(spark, f"{table_path}_tx")
    inc.fold_ledger(spark, ledger_path)
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILES)
                   .option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true"))
    reader = (reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger
              else reader.option("maxBytesPerTrigger", max_bytes_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    stream = flows.not_manifest(reader.load(dump_dir).select("path", "length", F.col("modificationTime").alias("modified")))
    job = flows.JsonJob(dump_dir, table_path, ledger_path, touched_path, flow, default_company, overrides)
    return (stream.writeStream.foreachBatch(batch_writer(job, checkpoint, inc.next_run(spark, f"{table_path}_runs")))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_stream_import(spark: SparkSession, dump_dir: str, table_path: str, ledger_path: str, checkpoint: str,
                      default_company: str, flow: str = "projections", overrides=None, **options) -> None:
    """T1 with what follows it: import what is pending, then consolidate the partitions it
    touched (A9; A13 for predictions) and fold the ledger. A consolidation that fails is
    repeated by the next call, as its list is kept."""
    touched = f"{table_path}_touched"
    stream_import(spark, dump_dir, table_path, ledger_path, touched, checkpoint, default_company, flow, overrides, **options).awaitTermination()
    flows.JsonJob(dump_dir, table_path, ledger_path, touched, flow, default_company, overrides).consolidate(spark)
    inc.fold_ledger(spark, ledger_path)
