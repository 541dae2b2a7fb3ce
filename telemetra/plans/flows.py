"""End-to-end flows a user runs (the entry points of the original tooling).

* ``import_readings_csv``  — interchange CSVs → rules → readings table (+ ledger, audit,
  touched-partition consolidation). Batch, incremental by ledger.
* ``import_typed_json``    — typed-JSON exports → projections / variables / predictions.
* ``export_wide``          — slice of readings → wide pivot CSV (+ export ledger).
* ``extract_readings``     — source table → month/process CSV files, resumable.
* ``backfill_units``       — model configs → root unit of their process → change set.

Imports list first, subtract the ledger and read only what is pending, in batches bounded by
bytes. A batch's source text is read by one job, into a staged table; a file that can't be
read is found by halving and left out (E1). Rows, rejected lines, touched partitions, ledger
entries and failures of a batch are one transaction (``sources.commits``): a lost driver
leaves all of them or none, and the next run finishes what was recorded.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from telemetra.session import materialize

from telemetra import session
from telemetra.constants import DAYS_BACK, EXPORT_TS_COLUMN, MANIFEST_PREFIX, MAX_PAST_HOURS, READINGS_COLUMNS, SOURCE_ROW_CAP
from telemetra.functions.text import base_name, export_file_name, period_label
from telemetra.functions.timefmt import parse_period_bound, period_error
from telemetra.operators import dedup, hierarchy, reshape, typed_json, validate
from telemetra.operators import extract as ex
from telemetra.operators.ledger import EXPORT_LEDGER, IMPORT_LEDGER, run_totals, running_total
from telemetra.sources import commits
from telemetra.sources import incremental as inc
from telemetra.sources.csv_readings import exported_pairs, file_faults, read_cells, readings_of, sink_month_process_csv
from telemetra.sources.tables import csv_cell, scan_active_configs, scan_readings_slice, sink_append, sink_lines
from telemetra.sources.typed_json_files import escaped, limit_per_file, read_lines

READINGS_TABLE_SCHEMA = ("company_id STRING, tag_id STRING, value DOUBLE, ts TIMESTAMP_NTZ, "
                         "ingest_seq STRUCT<run: BIGINT, process: STRING, month: STRING, part: INT, pos: BIGINT>, "
                         "month STRING")
TOUCHED = "company_id STRING, month STRING"
AUDIT = "company_id STRING, tag_id STRING, value DOUBLE, ts TIMESTAMP_NTZ, reason STRING, file STRING"


def read_table(spark: SparkSession, path: str, schema: str = READINGS_TABLE_SCHEMA) -> DataFrame:
    """Read a stored table with its declared schema (partition values stay strings)."""
    return spark.read.schema(schema).parquet(path)


@dataclass
class ImportResult:
    ledger: DataFrame        # per-file entries of this run (file, read, inserted, discarded, elapsed)
    failed: DataFrame        # files that failed (stay pending), with their error
    totals: DataFrame        # A16
    touched: DataFrame       # A6
    audit: DataFrame         # A12 input: rejected rows with reason

    def progress(self) -> DataFrame:
        """W4 + F19: the entries in file order with the running total of inserted rows and the
        rows a second up to there."""
        return running_total(self.ledger, "file", "inserted", seconds_col="elapsed")


@dataclass
class _Run:
    """What the batches of a run have left so far; names and numbers only, one a file or batch."""
    entries: list[tuple] = field(default_factory=list)
    failed: list[tuple[str, str]] = field(default_factory=list)
    transactions: list[str] = field(default_factory=list)


def _staged(spark: SparkSession, files: list[Row], stage) -> tuple[DataFrame | None, list[Row], list[tuple[str, str]]]:
    """The staged rows of the files that can be read, those files, and the others with their error."""
    frames, read, failed = inc.stage_readable(spark, files, stage)
    rows = reduce(DataFrame.unionByName, frames) if frames else None
    if rows is not None:
        rows._stages = frames
    return rows, read, failed


def _without(rows: DataFrame, failed: list[tuple[str, str]]) -> DataFrame:
    """``rows`` without those of failed files."""
    if not failed:
        return rows
    names = rows.sparkSession.createDataFrame([(f,) for f, _ in failed], "file string")
    return rows.join(names, "file", "left_anti")


def _entries(files: list[Row], counts: DataFrame, seconds: float) -> list[tuple]:
    """Ledger entries of a batch, zeros for files without rows. ``elapsed`` is a file's share,
    by bytes, of the seconds measured for its batch."""
    found = {r["file"]: (r["read"], r["inserted"], r["discarded"]) for r in counts.collect()}  # one row a file of the batch
    size = sum(f["length"] for f in files) or 1
    return [(f["file"], *found.get(f["file"], (0, 0, 0)), round(seconds * (f["length"] or 1) / size, 6), f["length"], f["modified"]) for f in files]


def _publish(spark: SparkSession, run: _Run, tx: str, table_path: str, ledger_path: str | None, files: list[Row], failed, t0: float,
             write, counts: DataFrame, moves: dict[str, str], again: bool = False) -> None:
    """A batch's rows (``write(stage)``), entries and failures as one transaction."""
    entries = []

    def stage(folder: str) -> None:
        write(folder)
        entries.extend(_entries(files, counts, time.time() - t0))
        if ledger_path and entries:
            inc.ledger_rows(spark.createDataFrame(entries, IMPORT_LEDGER)).write.parquet(f"{folder}/ledger")
        if ledger_path and failed:
            spark.createDataFrame(failed, inc.FAILURES).withColumn("seen", F.current_timestamp()).coalesce(1).write.parquet(f"{folder}/failed")

    places = moves | ({"ledger": ledger_path, "failed": f"{ledger_path}_failed"} if ledger_path else {})
    commits.transact(spark, f"{table_path}_tx", tx, stage, places, again)
    run.entries += entries
    run.failed += failed
    run.transactions.append(tx)


def consolidate(spark: SparkSession, table_path: str, touched_path: str, key: list[str]) -> bool:
    """A9 on the partitions that imports have touched since they were last consolidated.

    The list is kept at ``touched_path`` until that has succeeded; a failure is a warning, as
    the rows are stored, and the next call does it. Returns whether nothing is left to do.
    """
    fs = commits.Files(spark, touched_path)
    listed = [f"{touched_path}/{name}" for name in fs.below(touched_path)]
    if not listed:
        return True
    touched = spark.read.schema(TOUCHED).parquet(*listed).distinct()
    try:
        if not touched.isEmpty():
            dedup.compact_touched(spark, table_path, touched, key)
    except Exception as exc:  # noqa: BLE001 — the rows are stored and the list is kept
        print(f"warning: consolidation failed ({exc}); rows are stored, the next run does it")
        return False
    for path in listed:
        fs.delete(path)
    return True


def import_readings_csv(spark: SparkSession, dump_dir: str, table_path: str, ledger_path: str,
                        now, company_id: str, max_past_hours: int = MAX_PAST_HOURS,
                        compact: bool = True, run_id: int | None = None, archive_dir: str | None = None,
                        batch_bytes: int = inc.BATCH_BYTES, again_if_changed: bool = False) -> ImportResult:
    """Interchange CSV import.

    Pending files = listing − ledger, read in batches of ``batch_bytes``. A file that can't be
    read, is not UTF-8, lacks a column or has a timestamp that does not parse fails as a whole
    (nothing of it is written; its error is added to ``<ledger>_failed``; it is tried again
    next run). Valid rows are appended with an ``ingest_seq`` (run, file order, row order), so
    consolidation keeps the last write; rejected rows go to ``<table>_rejected`` with their
    reason; the (month, company) partitions touched are then consolidated. With
    ``archive_dir`` the files recorded in the ledger are moved there (sub-path kept); the
    ledger stays the record of what is done, so a failed move only leaves a file in place.
    """
    session.configure(spark)
    touched_path = f"{table_path}_touched"
    commits.recover(spark, f"{table_path}_tx")
    run_id = inc.next_run(spark, f"{table_path}_runs") if run_id is None else run_id
    old = inc.read_ledger(spark, ledger_path)
    pend = inc.pending_files(inc.list_files(spark, dump_dir, "*.csv"), old, again_if_changed)
    run, touched, audit = _Run(), [], []
    for n, files in enumerate(inc.batches(pend, batch_bytes)):
        t0 = time.time()
        cells, read, failed = _staged(spark, files, lambda part: materialize(read_cells(spark, [escaped(f["path"]) for f in part]), "cells"))
        if cells is None:
            run.failed += failed
            if failed:
                commits.transact(spark, f"{table_path}_tx", f"{run_id}-{n}-failed-{time.time_ns()}", lambda stage, failed=failed: spark.createDataFrame(
                    failed, inc.FAILURES).withColumn("seen", F.current_timestamp()).coalesce(1).write.parquet(f"{stage}/failed"), {"failed": f"{ledger_path}_failed"})
            continue
        marked = materialize(validate.annotate(readings_of(cells, name=lambda f: inc.relative_to(dump_dir, f)), now, max_past_hours), "marked")
        bad = file_faults(cells).withColumn("file", inc.relative_to(dump_dir, F.col("file"))).union(inc.failed_files(marked)).groupBy("file").agg(F.min("error").alias("error"))
        failed = failed + [tuple(r) for r in bad.collect()]  # failed files of one batch
        session.release(*cells._stages)
        names = {f for f, _ in failed}
        good = _without(marked, failed)
        valid = (good.where(F.col("reason").isNull())
                     .withColumn("company_id", F.lit(company_id))
                     .withColumn("ingest_seq", F.struct(F.lit(run_id).cast("long").alias("run"),
                                                        F.col("file_process").alias("process"),
                                                        F.col("file_month").alias("month"),
                                                        F.col("file_part").alias("part"),
                                                        F.col("pos").alias("pos")))
                     .select(*READINGS_COLUMNS, "ingest_seq"))
        rejected = good.where(F.col("reason").isNotNull()).withColumn("company_id", F.lit(company_id)) \
                       .select("company_id", "tag_id", "value", "ts", "reason", "file")
        counts = good.groupBy("file").agg(F.count(F.lit(1)).alias("read"), F.count_if(F.col("reason").isNull()).alias("inserted"),
                                          F.count_if(F.col("reason").isNotNull()).alias("discarded"))

        def write(stage, valid=valid, rejected=rejected):
            sink_append(valid, f"{stage}/rows")
            rejected.withColumn("run", F.lit(run_id).cast("long")).write.parquet(f"{stage}/rejected")
            spark.read.schema(TOUCHED).parquet(f"{stage}/rows").distinct().coalesce(1).write.parquet(f"{stage}/touched")

        touched.append(materialize(dedup.touched_partitions(valid), "touched"))
        audit.append(materialize(rejected, "audit"))
        _publish(spark, run, f"{run_id}-{n}-{time.time_ns()}", table_path, ledger_path, [f for f in read if f["file"] not in names], failed, t0, write, counts,
                 {"rows": table_path, "rejected": f"{table_path}_rejected", "touched": touched_path})
        session.release(marked)
        if archive_dir:
            inc.archive_files(spark, [f["path"] for f in read if f["file"] not in names], dump_dir, archive_dir)
    if compact:
        consolidate(spark, table_path, touched_path, dedup.READINGS_KEY)
    inc.fold_ledger(spark, ledger_path)
    entries = spark.createDataFrame(run.entries, IMPORT_LEDGER)
    failures = spark.createDataFrame(run.failed, inc.FAILURES)
    union = lambda frames, schema: reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)
    return ImportResult(entries, failures, run_totals(entries, failures), union(touched, TOUCHED).distinct(), union(audit, AUDIT))


def parsed_items(lines: DataFrame, flow: str, default_company: str) -> DataFrame:
    """Items of one of the three typed-JSON flows, parsed once for rows, counts and quarantine."""
    if flow == "predictions":
        return typed_json.prediction_items(lines, default_company)
    return typed_json.item_rows(typed_json.parse_items(lines), default_company, dispatch=(flow == "projections"))


def item_table(items: DataFrame, flow: str, default_company: str, overrides, seq) -> DataFrame:
    """The rows of parsed items with their ``ingest_seq``."""
    if flow == "predictions":
        rows = typed_json.prediction_rows(items, overrides, keep_source=True)
    elif flow == "projections":
        rows = typed_json.projection_rows(items, overrides, keep_source=True)
    else:
        rows = typed_json.variable_rows(items, default_company, overrides, keep_source=True)
    return rows.withColumn("ingest_seq", seq).drop("file", "pos")


@dataclass
class JsonJob:
    """Where and how typed-JSON files are imported; batch and stream share it."""
    dump_dir: str
    table_path: str
    ledger_path: str | None
    touched_path: str
    flow: str
    default_company: str
    overrides: object = None
    limit_per_file: int | None = None

    @property
    def partitioned(self) -> bool:
        return self.flow != "predictions"

    def lines(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        lines = read_lines(spark, paths).withColumn("file", inc.relative_to(self.dump_dir, inc.plain_path(F.col("file"))))
        if self.limit_per_file is not None:
            lines = limit_per_file(lines, self.limit_per_file).drop("line_no")
        # a gzip file is one task's to read, whatever its size: its lines are parsed by all
        return lines.drop("block").repartition("pos")

    def load(self, spark: SparkSession, run: _Run, files: list[Row], seq, tx: str, again: bool = False) -> None:
        """Import one batch of files (listing rows) as the transaction ``tx``."""
        t0 = time.time()

        def stage(part):
            items = parsed_items(self.lines(spark, [f["path"] for f in part]), self.flow, self.default_company)
            return materialize(items.withColumn("utf8", F.is_valid_utf8("value")), "items")
        items, read, failed = _staged(spark, files, stage)
        if items is None:
            items = parsed_items(spark.createDataFrame([], "file string, value string, pos long"), self.flow, self.default_company).withColumn("utf8", F.lit(True))
            items._stages = []
        undecoded = items.where("NOT utf8").select("file").distinct().collect()  # names of one batch
        failed = failed + [(r["file"], "not UTF-8") for r in undecoded]
        names = {f for f, _ in failed}
        good = _without(items, failed)
        rows = item_table(good, self.flow, self.default_company, self.overrides, seq)

        def write(folder):
            sink_append(rows, f"{folder}/rows", partitioned=self.partitioned)
            typed_json.quarantine(good).write.parquet(f"{folder}/quarantine")
            if self.partitioned:
                spark.read.schema(TOUCHED).parquet(f"{folder}/rows").distinct().coalesce(1).write.parquet(f"{folder}/touched")
        counts = typed_json.per_file_stats(good, rows_mode=self.partitioned).withColumnRenamed("accepted", "inserted")
        moves = {"rows": self.table_path, "quarantine": f"{self.table_path}_quarantine"} | ({"touched": self.touched_path} if self.partitioned else {})
        _publish(spark, run, tx, self.table_path, self.ledger_path, [f for f in read if f["file"] not in names], failed, t0, write, counts, moves, again)
        session.release(*items._stages)

    def consolidate(self, spark: SparkSession) -> bool:
        """A9, or A13 for predictions, whose table has no partitions."""
        if self.partitioned:
            return consolidate(spark, self.table_path, self.touched_path, dedup.PROJECTIONS_KEY if self.flow == "projections" else dedup.READINGS_KEY)
        if commits.Files(spark, self.table_path).below(self.table_path):
            dedup.compact_table(spark, self.table_path, dedup.PREDICTIONS_KEY)
        return True


def not_manifest(files: DataFrame) -> DataFrame:
    return files.where(~base_name(F.col("path")).startswith(MANIFEST_PREFIX))


def import_typed_json(spark: SparkSession, dump_dir: str, table_path: str | None, flow: str,
                      default_company: str, overrides=None, limit_per_file: int | None = None,
                      dry_run: bool = False, ledger_path: str | None = None, compact: bool = True,
                      batch_bytes: int = inc.BATCH_BYTES, again_if_changed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Typed-JSON batch import (S1, S2, S12, P1…P18, R1, W3, A2, E1, S9, S13, A9, A13): returns
    (rows of this run as stored, per-file counts of this run).

    The folder is listed, the ledger subtracted, and only pending files are opened, in
    batches of ``batch_bytes``; without ``ledger_path`` every file is pending. A file that
    can't be read or is not UTF-8 fails alone: its error goes to ``<ledger>_failed`` and it
    stays pending. A file without rows has an entry with zeros. Lines that never become rows
    go to ``<table>_quarantine``. The touched partitions are consolidated (predictions: the
    whole table, as it has none). ``dry_run`` (S16) writes nothing and returns the first 5
    rows (by ts, process, tag) and the per-file counts of the pending files instead."""
    session.configure(spark)
    listing = not_manifest(inc.list_files(spark, dump_dir, "*.gz"))
    if table_path and not dry_run:
        commits.recover(spark, f"{table_path}_tx")
    pend = inc.pending_files(listing, inc.read_ledger(spark, ledger_path), again_if_changed) if ledger_path else listing
    job = JsonJob(dump_dir, table_path, ledger_path, f"{table_path}_touched", flow, default_company, overrides, limit_per_file)
    if dry_run:
        paths = [f["path"] for batch in inc.batches(pend, batch_bytes) for f in batch]
        lines = job.lines(spark, paths) if paths else spark.createDataFrame([], "file string, value string, pos long")
        items = parsed_items(lines, flow, default_company)
        rows = item_table(items, flow, default_company, overrides, inc.json_seq(0)).drop("ingest_seq")
        order = ["ts", "process_id"] + (["tag_id"] if flow == "projections" else [])
        stats = typed_json.per_file_stats(items, rows_mode=(flow != "predictions"))
        return rows.orderBy(*[c for c in order if c in rows.columns]).limit(5), stats
    run, run_id = _Run(), None
    for n, files in enumerate(inc.batches(pend, batch_bytes)):
        run_id = inc.next_run(spark, f"{table_path}_runs") if run_id is None else run_id
        job.load(spark, run, files, inc.json_seq(run_id, n), f"{run_id}-{n}-{time.time_ns()}")
    if run.entries and compact:
        job.consolidate(spark)
    if ledger_path:
        inc.fold_ledger(spark, ledger_path)
    stats = spark.createDataFrame([e[:4] for e in run.entries], "file string, read long, accepted long, discarded long")
    empty = item_table(parsed_items(spark.createDataFrame([], "file string, value string, pos long"), flow, default_company), flow, default_company, overrides, inc.json_seq(0))
    if not commits.Files(spark, table_path).below(table_path):
        return empty, stats
    fields = [f for f in empty.schema.fields if f.name != "month"]
    stored = spark.read.schema(type(empty.schema)(fields)).parquet(table_path)
    return stored.where(F.col("ingest_seq.run") == F.lit(run_id)).select(*empty.columns), stats


@dataclass
class ExportResult:
    file: str        # name of the wide file
    points: int      # A14: long rows read (after last-write-wins unless raw)
    rows: int        # A14: rows of the wide file; 0: nothing written
    elapsed: float   # seconds, measured


def export_wide(spark: SparkSession, readings: DataFrame, company_id: str, date_ini: str, date_end: str,
                tags, out_dir: str, ledger_path: str | None, now, use_final: bool = True) -> ExportResult:
    """Wide export (F14, F15, S5, A8, R2, O2, F12, S10, S14, A14) to ``out_dir/<file>``.

    The slice is read, consolidated and reduced to cells once; points and rows are counted
    as they are written. Any number of tags; rows are sorted in range partitions. An export
    without rows leaves no file, no ledger entry, and removes an earlier file of its name.
    """
    session.configure(spark)
    req = spark.range(1).select(parse_period_bound(F.lit(date_ini)).alias("s"),
                                parse_period_bound(F.lit(date_end)).alias("e"),
                                F.lit(str(now)).cast("timestamp_ntz").alias("now"))
    chk = req.select("s", "e", period_error("s", "e", "now").alias("err"), F.least("e", "now").alias("e2"),
                     export_file_name(F.lit(company_id), "s", F.least("e", "now")).alias("file"),
                     period_label("s", F.least("e", "now")).alias("period")).first()
    if chk["err"]:
        raise ValueError(f"invalid period: {chk['err']}")
    t0, seen = time.time(), Observation()
    long = scan_readings_slice(readings, company_id, chk["s"], chk["e2"], tags, dedup=use_final, keep_seq=True)
    order = "ingest_seq" if "ingest_seq" in readings.columns else None
    cells = materialize(reshape.first_non_null_cells(long.observe(seen, F.count(F.lit(1)).alias("points")), order), "cells")
    try:
        points = session.observed(seen, "points")
        present = sorted(r["tag_id"] for r in cells.select("tag_id").distinct().collect() if r["tag_id"] is not None)  # the header
        header = ";".join(map(csv_cell, [EXPORT_TS_COLUMN, *present]))
        lines = reshape.wide_lines(cells, present).orderBy("ts").select("line")
        rows = sink_lines(lines, header, out_dir, chk["file"])
    finally:
        session.release(cells)
    result = ExportResult(chk["file"], points, rows, round(time.time() - t0, 3))
    if rows and ledger_path:
        entry = spark.createDataFrame([(result.file, company_id, chk["period"], rows, result.elapsed)], EXPORT_LEDGER)
        inc.append_ledger(spark, ledger_path, entry, EXPORT_LEDGER)
    return result


def extract_readings(spark: SparkSession, source: DataFrame, dump_dir: str, made_dir: str, now, days: int = DAYS_BACK,
                     overrides=None, cap: int = SOURCE_ROW_CAP) -> DataFrame:
    """Extraction to interchange CSV (A4, A5, F13, J4, J5, S15, T5, W2, S4, F10, S8, A11, A15):
    ``(process_id, outcome, pairs, rows, errors)`` of every process.

    Pending are the (process, month) pairs without a file in the dump or the done folder, of
    processes with rows in the last ``days``. A month's pairs are one job each for the split
    into parts and for the files. If it fails, its processes are halved until the bad one is
    alone: that pair is an error and stays pending, the others are written.
    """
    session.configure(spark)
    commits.recover(spark, f"{dump_dir}_tx")
    grid = materialize(ex.work_grid(ex.distinct_processes(source), now, days), "grid")
    done = materialize(exported_pairs(spark, dump_dir, made_dir), "done")
    recent = materialize(ex.count_recent_by_process(source, now, days), "recent")
    todo = materialize(ex.pending(grid, done).join(recent.where("recent_rows > 0"), "process_id", "left_semi"), "todo")
    totals, errors = [], []

    def attempt(pairs: DataFrame, parts: int, part: int) -> None:
        mine = pairs.where(F.pmod(F.xxhash64("process_id"), F.lit(parts)) == part)
        try:
            chunks = materialize(ex.number_parts(ex.adaptive_range_split(source, mine, cap)), "chunks")
            rows = ex.scan_source_range(source, chunks.select("process_id", "label", "start", "end", "file_name"), overrides)
            sink_month_process_csv(rows, dump_dir)
            totals.append(chunks)
        except Exception as error:  # noqa: BLE001 — sorted out below
            if not inc.file_fault(spark, error):
                raise
            left = mine.limit(2).collect()
            if len(left) == 1 or parts >= 1 << 62:
                errors.extend((r["process_id"], r["label"], inc.said(error)) for r in left)
            elif left:
                attempt(pairs, 2 * parts, part)
                attempt(pairs, 2 * parts, part + parts)

    for (label,) in todo.select("label").distinct().orderBy("label").collect():  # the months of the look-back
        attempt(todo.where(F.col("label") == label), 1, 0)
    extracted = ex.chunk_row_totals(reduce(DataFrame.unionByName, totals)) if totals else spark.createDataFrame([], "process_id string, label string, rows long, parts long")
    failed = spark.createDataFrame(errors, "process_id string, label string, error string")
    out = materialize(ex.extraction_outcomes(grid, done, recent, extracted, failed), "outcomes")
    session.release(grid, done, recent, todo, *totals)
    return out


def backfill_units(configs: DataFrame, process: DataFrame, config_type: str,
                   process_id: str | None = None, apply_to: str | None = None):
    """Root-unit backfill (S6, P13, P14, J1, J2, P21, E3, A10, S11). Dry run unless
    ``apply_to`` names where the updated config table is written."""
    from telemetra.operators.filters import process_filter
    active = process_filter(scan_active_configs(configs, config_type), process_id)
    outcomes = hierarchy.backfill_outcomes(hierarchy.lookup_configs(active, hierarchy.resolve_roots(process)))
    counts = hierarchy.outcome_counts(outcomes)
    if apply_to:
        updated = hierarchy.apply_updates(configs, hierarchy.change_set(outcomes)).transform(materialize)
        updated.write.mode("overwrite").parquet(apply_to)
    return outcomes, counts


def export_entries(readings: DataFrame, requests: DataFrame, now) -> DataFrame:
    """S14 set-at-a-time: for each export request ``(company_id, date_ini, date_end)`` the
    ledger entry ``(file, company, period, rows, elapsed)``, where rows = wide rows
    (distinct timestamps with a non-null value, after last-write-wins). Requests failing
    validation (F15) are dropped; the period end is clamped to ``now``. ``elapsed`` is a
    request's share, by rows, of the seconds measured for all."""
    n = F.lit(str(now)).cast("timestamp_ntz")
    req = (requests.select("company_id", parse_period_bound("date_ini").alias("s"),
                           parse_period_bound("date_end").alias("e0"))
                   .withColumn("e", F.least("e0", n))
                   .where(period_error("s", "e0", n).isNull()))
    cells = dedup.replace_dedup(readings.select("company_id", "tag_id", "ts", "value", "ingest_seq"),
                                dedup.READINGS_KEY, "ingest_seq")
    ts = cells.where(F.col("value").isNotNull()).select("company_id", "ts").distinct()
    req = req.select(F.col("company_id").alias("r_company"), "s", "e")
    matched = ts.join(req,
                      (F.col("company_id") == F.col("r_company")) & (F.col("ts") >= F.col("s"))
                      & (F.col("ts") <= F.col("e")))
    t0 = time.time()
    rows = materialize(matched.groupBy("company_id", "s", "e").agg(F.count(F.lit(1)).alias("rows")), "entries")
    share = F.col("rows") / F.sum("rows").over(Window.partitionBy())  # one row a request
    return rows.select(export_file_name("company_id", "s", "e").alias("file"),
                       F.col("company_id").alias("company"), period_label("s", "e").alias("period"),
                       "rows", F.round(F.lit(time.time() - t0) * share, 6).alias("elapsed"))
