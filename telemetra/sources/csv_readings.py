"""Interchange CSV readings (S3 scan, S8 month/process sink).

Files hold ``ts, tag_id, value`` with a header; ``ts`` carries an offset (``+00:00``) and
is converted to UTC; naive text is taken as UTC (documented deviation: the original fails
the file). ``value`` is read as text and coerced by P3, so text values are ``bad_value``.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterator
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.functions.numbers import decimal_double, is_finite
from telemetra.functions.text import parent_dir, parse_csv_name_part, parse_csv_name_process
from telemetra.functions.timefmt import parse_utc
from telemetra.session import materialize, release, scratch_dir, settings
from telemetra.sources import commits
from telemetra.sources.incremental import BATCH_FILES, list_files, plain_path
from telemetra.sources.typed_json_files import escaped

COLUMNS = ("ts", "tag_id", "value")
MISSING, NOT_UTF8 = "missing column", "not UTF-8"
#: For reading a batch of listed files: small ones share a task, few tasks list them again, and
#: the driver does not keep the listing.
SMALL_FILES = {"spark.sql.files.openCostInBytes": "64k", "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
               "spark.sql.hive.filesourcePartitionFileCacheSize": "0"}
#: A quoted cell (a doubled quote is a quote) or a bare one, up to the next comma.
CELL = r'("[^"]*+(?:""[^"]*+)*+"?|[^,]*)(?:,|$)'


def cells_of(line: Column) -> Column:
    """The cells of a CSV line, however many; quoted cells may hold commas and quotes."""
    quoted = F.transform(F.regexp_extract_all(line, F.lit(CELL), 1), lambda c: F.when(
        c.startswith('"'), F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ",", -1))


def read_cells(spark: SparkSession, paths) -> DataFrame:
    """``file, block, pos, cells, utf8`` of every line of the CSV files under ``paths`` that is
    not blank. ``pos`` grows with the lines of a file; ``block`` is where the line's split
    begins, 0 for a file's first. ``utf8``: the line is valid text."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(paths)
    raw = raw.select(plain_path(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    line = F.regexp_replace("value", "^﻿|\r$", "")
    # the one-row generator keeps the optimizer from splitting a line once for each cell
    rows = raw.select("file", "block", F.is_valid_utf8("value").alias("utf8"), F.inline(F.array(F.struct(cells_of(line).alias("cells"), (F.trim(line) == "").alias("blank")))))
    return rows.where("NOT blank").select("file", "block", F.monotonically_increasing_id().alias("pos"), "cells", "utf8")


def file_heads(cells: DataFrame) -> DataFrame:
    """``(file, head_pos, utf8, head)``, a row a file: its header line, and whether all its lines
    are valid text. Positions are added up first, so that no line but a header is moved."""
    first = cells.groupBy("file").agg(F.min(F.when(F.col("block") == 0, F.col("pos"))).alias("head_pos"), F.bool_and("utf8").alias("utf8"))
    at = F.broadcast(first.select(F.col("file").alias("_file"), "head_pos"))  # a row a file of a batch
    heads = cells.where("block = 0").join(at, (F.col("file") == F.col("_file")) & (F.col("pos") == F.col("head_pos")))
    return first.join(F.broadcast(heads.select("file", F.transform("cells", F.trim).alias("head"))), "file", "left")


def readings_of(cells: DataFrame, keep_text: bool = False, name: Callable[[Column], Column] = lambda file: file) -> DataFrame:
    """S3 on lines that are split already: the first line of each file is its header, and
    the three columns are found by the names in it, whatever their place and number. What
    depends on the file alone is worked out once a file; ``name`` makes the ``file`` given on."""
    f = F.col("file")
    hive_pid = F.nullif(F.regexp_extract(f, r"/process_id=([^/]+)/", 1), F.lit(""))
    hive_month = F.nullif(F.regexp_extract(f, r"/(?:month|label)=([^/]+)/", 1), F.lit(""))
    has_all = F.lit(True)
    for c in COLUMNS:
        has_all = has_all & F.coalesce(F.array_contains("head", c), F.lit(False))
    heads = file_heads(cells).select(
        F.col("file").alias("_file"), "head_pos", name(f).alias("name"), has_all.alias("has_all"),
        F.coalesce(hive_pid, parse_csv_name_process(f)).alias("file_process"),
        F.coalesce(hive_month, parent_dir(f)).alias("file_month"), parse_csv_name_part(f).alias("file_part"),
        *[F.expr(f"cast(nullif(array_position(head, '{c}'), 0) AS INT)").alias(f"_{c}_at") for c in COLUMNS])
    rows = cells.join(F.broadcast(heads), F.col("file") == F.col("_file")).where(~F.coalesce(F.col("pos") == F.col("head_pos"), F.lit(False)))
    rows = rows.select(F.col("name").alias("file"), "pos", "file_process", "file_month", "file_part", "has_all", "utf8",
                       *[F.expr(f"try_element_at(cells, _{c}_at)").alias(f"_{c}") for c in COLUMNS])
    text = F.when(~F.col("has_all"), MISSING).otherwise(F.nullif("_ts", F.lit("")))
    out = rows.select("file", "pos", "file_process", "file_month", "file_part",
                      F.when(F.col("has_all"), parse_utc("_ts")).alias("ts"), text.alias("ts_text"), F.nullif("_tag_id", F.lit("")).alias("tag_id"),
                      decimal_double("_value").alias("_number"),
                      F.nullif("_value", F.lit("")).alias("value_text"),
                      F.when(~F.col("utf8"), NOT_UTF8).when(~F.col("has_all"), MISSING).alias("fault"))
    out = out.select("file", "pos", "file_process", "file_month", "file_part", "ts", "ts_text", "tag_id",
                     F.when(is_finite("_number"), F.col("_number")).alias("value"), "value_text", "fault")
    return out if keep_text else out.drop("value_text")


def file_faults(cells: DataFrame) -> DataFrame:
    """``(file, error)`` of files whose header lacks a column or that hold bytes that are no text."""
    missing = F.array_join(F.array_except(F.array(*map(F.lit, COLUMNS)), "head"), ", ")
    error = F.when(~F.col("utf8"), NOT_UTF8).when(missing != "", F.concat(F.lit(f"{MISSING}: "), missing))
    return file_heads(cells).select("file", error.alias("error")).where("error IS NOT NULL")


def scan_readings_csv(spark: SparkSession, paths, keep_text: bool = False) -> DataFrame:
    """S3: all ``*.csv`` under ``paths`` (recursive) → ``file, ts, ts_text, tag_id, value``
    (+ sort keys and ``fault``).

    The text is read once: lines go to a staged table, as a file's splits need the header
    that only its first split holds. The rows of a file whose header lacks a column have no
    ``ts`` and a ``ts_text`` that is no timestamp, so the file fails as a whole (E1);
    ``fault`` names that, and lines that are not UTF-8. ``pos`` grows with the rows of a file.
    Of very many files ``BATCH_FILES`` are read at a time, so that what the driver lists, plans
    and broadcasts does not grow with their number.

    ``value`` is DOUBLE where the text is a finite decimal number, else NULL — which P4 then
    rejects as ``bad_value``; with ``keep_text`` the raw text is kept as ``value_text``.
    The process id comes from a ``process_id=`` folder when present, else from the
    ``processo_<id>[-parteN].csv`` name (F3); the month from the parent folder (F4).
    """
    batches = _batches(spark, paths)
    first = list(islice(batches, 2))
    if len(first) < 2:
        return readings_of(materialize(read_cells(spark, paths), "cells"), keep_text)
    out, schema = scratch_dir(spark, "readings"), None
    with settings(spark, SMALL_FILES):
        for files in chain(first, batches):
            cells = materialize(read_cells(spark, [escaped(f) for f in files]), "cells")
            rows = readings_of(cells, keep_text)
            rows.write.mode("append").parquet(out)
            release(cells)
            schema = rows.schema
    return spark.read.schema(schema).parquet(out)


def _batches(spark: SparkSession, paths, glob: str = "*.csv") -> Iterator[list[str]]:
    """The files under ``paths``, as many at a time as ``BATCH_FILES``; none for a path that is
    no folder (a pattern, say): Spark is to read that at once."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    if not all(commits.Files(spark, r).is_folder(r) for r in roots):
        return
    found = chain.from_iterable(commits.Files(spark, r).listed(r, glob) for r in roots)
    while files := list(islice(found, BATCH_FILES)):
        yield files


def _write_files(folder: str, header: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the lines of a task, sorted by place, to ``folder/<of the task>/<place>``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, now, out, n = f"{folder}/{uuid.uuid4().hex}", None, None, 0
        try:
            for b in batches:
                for place, rows in groupby(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), lambda r: r[0]):
                    if place != now:
                        if out:
                            out.close()
                        os.makedirs(os.path.dirname(f"{mine}/{place}"), exist_ok=True)
                        now, out, n = place, open(f"{mine}/{place}", "w", encoding="utf-8", newline=""), n + 1
                        out.write(header)
                    out.writelines(line + "\n" for _, line in rows)
        finally:
            if out:
                out.close()
        yield pa.RecordBatch.from_arrays([pa.array([mine]), pa.array([n], pa.int64())], ["folder", "files"])
    return run


def sink_month_process_csv(readings: DataFrame, path: str) -> None:
    """``<label>/processo_<id>.csv``, or ``processo_<id>-parte<n>.csv`` where a process has
    several parts in a month, with the columns ``ts, tag_id, value``.

    ``readings`` has ``label`` (yyyy-MM of the *unshifted* query month), the name of the file
    (``file_name``, see ``operators.extract.number_parts``) and the three data columns. A file
    is written by one task, in time order: parts are chunks under the row cap (T5). Files are
    dealt over a fixed number of tasks, as small ones cost time and no bytes. All
    files appear by renames after all are written, and a lost driver's renames are finished
    by ``commits.recover``: a month of a process is never there in part for good. ts is
    written with its ``+00:00`` offset.
    """
    spark = readings.sparkSession
    data = [F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS'+00:00'").alias("ts"), F.col("tag_id"), F.col("value").cast("string").alias("value")]
    out = readings.select(F.concat_ws("/", "label", "file_name").alias("place"), *data)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    out = out.repartition(tasks, "place").sortWithinPartitions("place", "ts", "tag_id")
    shared = commits.Files(spark, path).posix(path)

    def write(stage: str) -> None:
        # the transaction is the commit: tasks may put their files into the stage directly
        if shared is None:
            (out.write.option("header", "true").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
                .partitionBy("place").csv(f"{stage}/files"))
            return
        # a mounted folder: opened as plain files, as Hadoop's local file system starts a process to set each file's rights
        lines = out.select("place", F.to_csv(F.struct("ts", "tag_id", "value")).alias("line"))
        folder = commits.Files(spark, stage).posix(f"{stage}/files")
        written = lines.mapInArrow(_write_files(folder, "ts,tag_id,value\n"), "folder string, files long")
        used = [r["folder"] for r in written.where("files > 0").collect()]  # a folder a task: those of lost attempts are left out
        commits.Files(spark, stage).write_text(f"{stage}/{commits.FOLDERS}", "\n".join(os.path.basename(f) for f in used))
    commits.transact(spark, f"{path}_tx", f"files-{time.time_ns()}", write, {"files": path}, named="files")


def exported_pairs(spark: SparkSession, *roots: str) -> DataFrame:
    """``(process_id, label)`` that have a file in one of the folders (dump, done), from
    the listing alone. A folder that does not exist holds none."""
    found = spark.createDataFrame([], "process_id string, label string")
    for root in roots:
        if commits.Files(spark, root).exists(root):
            batches = _batches(spark, root, "processo_*.csv")
            first = list(islice(batches, 2))
            if len(first) < 2:
                files = list_files(spark, root, "processo_*.csv")
            else:
                staged = scratch_dir(spark, "listing")
                for paths in chain(first, batches):
                    spark.createDataFrame(pa.table({"path": paths})).coalesce(1).write.mode("append").parquet(staged)
                files = spark.read.schema("path string").parquet(staged)
            found = found.union(files.select(parse_csv_name_process("path"), parent_dir("path")))
    return found.distinct()
