"""Exports to files: wide CSV (R2, S10, S14, A14) and extraction to month/process CSV."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from telemetra import session
from telemetra.operators import extract as ex
from telemetra.operators import reshape
from telemetra.operators.ledger import EXPORT_LEDGER
from telemetra.plans import flows
from telemetra.plans.catalog import load_all
from telemetra.sources import commits, csv_readings
from telemetra.sources.csv_readings import exported_pairs, scan_readings_csv, sink_month_process_csv
from telemetra.sources.incremental import read_ledger
from telemetra.sources.tables import read_wide_csv

NOW = "2024-02-10 00:00:00"


def folder(spark, name):
    return session.local_path(session.scratch_dir(spark, name))


def readings(spark, rows):
    return spark.createDataFrame(rows, "company_id string, tag_id string, ts string, value double, ingest_seq long") \
                .withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def export(spark, rows, out, tags=None, led=None, **more):
    return flows.export_wide(spark, rows, "acme", "2024-01-01 00:00:00", "2024-01-31 00:00:00", tags, out, led, NOW, **more)


def test_wide_file_of_20000_tags(spark):
    """One file in order of ts, more tags than a pivot takes, written by several tasks."""
    n = 20_000
    rows = spark.range(3 * n).select(
        F.lit("acme").alias("company_id"), F.format_string("tag%05d", F.col("id") % n).alias("tag_id"),
        F.expr("timestamp_ntz '2024-01-02 00:00:00' + make_interval(0,0,0,0,0, cast((id * 7919 + id div 20000) % 40 AS INT))").alias("ts"),
        (F.col("id") / 2).alias("value"), F.col("id").alias("ingest_seq"))
    out = folder(spark, "wide")
    got = export(spark, rows, out)
    assert (got.points, got.rows) == (3 * n, 40)
    assert os.listdir(out) == [got.file] or sorted(os.listdir(out))[-1] == got.file
    lines = open(f"{out}/{got.file}", encoding="utf-8-sig").read().split("\n")
    assert lines.pop() == "" and len(lines) == 41 and all(x.count(";") == n for x in lines)
    assert lines[0].split(";")[:2] == ["TIMESTAMP", "tag00000"]
    labels = [x.split(";")[0] for x in lines[1:]]
    assert labels == sorted(labels) and len(set(labels)) == 40
    cell = {(r["ts"].strftime("%Y-%m-%d %H:%M"), r["tag_id"]): r["value"] for r in rows.where("tag_id IN ('tag00000', 'tag12345', 'tag19999')").collect()}
    for x in lines[1:]:
        c = x.split(";")
        for t in ("tag00000", "tag12345", "tag19999"):
            want = cell.get((c[0], t))
            assert c[1 + int(t[3:])] == ("" if want is None else str(want))


def test_pivot_of_more_tags_than_the_default_limit(spark):
    rows = spark.range(10_050).selectExpr("timestamp_ntz '2024-01-01 00:00:00' AS ts", "concat('t', id) AS tag_id", "id * 1.0 AS value")
    wide = reshape.pivot_wide(rows)
    assert len(wide.columns) == 10_051


def test_wide_file_with_odd_tags_and_values(spark):
    rows = readings(spark, [("acme", 'a;"b"', "2024-01-02 00:00:10", 1e-5, 1), ("acme", "`c`", "2024-01-02 00:00:00", 2.0, 2), ("acme", "é.x", "2024-01-02 00:00:00", -1.0, 3),
                            ("acme", "é.x", "2024-01-02 00:00:00", -2.0, 4), ("acme", "null", "2024-01-02 00:00:00", None, 5), ("other", "z", "2024-01-02 00:00:00", 1.0, 6)])
    out = folder(spark, "odd")
    got = export(spark, rows, out)
    raw = open(f"{out}/{got.file}", "rb").read()
    assert raw.decode("utf-8") == '﻿TIMESTAMP;`c`;"a;""b""";é.x\n2024-01-02 00:00;2.0;;-2.0\n2024-01-02 00:00;;1.0E-5;\n'
    assert (got.points, got.rows) == (4, 2)  # after last-write-wins; the null is a point
    back = read_wide_csv(spark, out)
    assert back.columns == ["TIMESTAMP", "`c`", 'a;"b"', "é.x"] and back.count() == 2
    first = export(spark, rows, folder(spark, "raw"), use_final=False)
    assert (first.points, first.rows) == (5, 2)


def test_wide_frame_of_odd_column_names(spark):
    rows = readings(spark, [("acme", "a`b", "2024-01-02 00:00:00", 1.0, 1)])
    assert reshape.wide_export_frame(reshape.pivot_wide(rows)).columns == ["TIMESTAMP", "a`b"]


def test_empty_export_leaves_no_file(spark):
    """No entry, no file, and the file of an earlier export of the same name goes."""
    rows = readings(spark, [("acme", "t", "2024-01-02 00:00:00", 1.0, 1)])
    out, led = folder(spark, "stale"), folder(spark, "stale-led")
    done = export(spark, rows, out, led=led)
    assert os.path.exists(f"{out}/{done.file}") and done.elapsed > 0
    entry = read_ledger(spark, led, EXPORT_LEDGER).first()
    assert (entry["file"], entry["rows"], entry["elapsed"]) == (done.file, 1, done.elapsed)
    gone = export(spark, rows, out, tags=["no such tag"], led=folder(spark, "none"))
    assert (gone.file, gone.points, gone.rows) == (done.file, 0, 0) and not os.path.exists(f"{out}/{done.file}")


def test_export_reads_its_plan_once(spark, tmp_path):
    """The slice runs once, whatever is written and counted from it."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    base = readings(spark, [("acme", f"t{i % 3}", f"2024-01-02 00:00:{i:02d}", 1.0, i) for i in range(30)])
    got = export(spark, base.mapInPandas(count, base.schema), folder(spark, "once"))
    assert got.rows == 30 and seen.value == 30


def test_contract_names_and_parts(spark):
    """`<month>/processo_<id>[-parteN].csv`, one file each, read back by the CSV scan."""
    rows = spark.range(90).select(
        F.concat(F.lit("P/"), (F.col("id") % 2).cast("string")).alias("process_id"), F.lit("2024-01").alias("label"), (F.col("id") % 3 + 1).alias("part"),
        F.expr("timestamp_ntz '2024-01-02 00:00:00' + make_interval(0,0,0,0,0,0, id)").alias("ts"), F.lit("t").alias("tag_id"), F.col("id").cast("double").alias("value"))
    rows = rows.withColumn("process_id", F.replace("process_id", F.lit("/"), F.lit("=%")))
    rows = rows.withColumn("file_name", F.when(F.col("process_id") == "P=%0", F.format_string("processo_%s-parte%d.csv", "process_id", "part")).otherwise(F.format_string("processo_%s.csv", "process_id")))
    out = folder(spark, "month")
    sink_month_process_csv(rows, out)
    names = sorted(os.path.relpath(p, out) for p in glob.glob(f"{out}/**/*.csv", recursive=True))
    assert names == ["2024-01/processo_P=%0-parte1.csv", "2024-01/processo_P=%0-parte2.csv", "2024-01/processo_P=%0-parte3.csv", "2024-01/processo_P=%1.csv"]
    text = open(f"{out}/2024-01/processo_P=%1.csv").read().split("\n")
    assert text[:2] == ["ts,tag_id,value", "2024-01-02 00:00:01.000000+00:00,t,1.0"] and len(text) == 47
    back = scan_readings_csv(spark, out).groupBy("file_month", "file_process", "file_part").agg(F.count("*")).collect()
    assert sorted(map(tuple, back)) == [("2024-01", "P=%0", 1, 15), ("2024-01", "P=%0", 2, 15), ("2024-01", "P=%0", 3, 15), ("2024-01", "P=%1", 0, 45)]
    assert sorted(map(tuple, exported_pairs(spark, out, f"{out}/none").collect())) == [("P=%0", "2024-01"), ("P=%1", "2024-01")]


def test_lost_driver_leaves_no_month_in_part(spark, monkeypatch):
    rows = spark.range(40).selectExpr("'2024-01' AS label", "concat('processo_x-parte', id % 20 + 1, '.csv') AS file_name",
                                      "timestamp_ntz '2024-01-02 00:00:00' AS ts", "'t' AS tag_id", "id * 1.0 AS value")
    out, real, calls = folder(spark, "part"), commits.Files.move, []

    def move(self, *pair):
        calls.append(pair)
        if len(calls) > 7:
            raise ConnectionError("driver lost")
        return real(self, *pair)
    with monkeypatch.context() as m:
        m.setattr(commits.Files, "move", move)
        with pytest.raises(ConnectionError):
            sink_month_process_csv(rows, out)
    assert len(glob.glob(f"{out}/2024-01/*.csv")) < 20
    commits.recover(spark, f"{out}_tx")
    assert len(glob.glob(f"{out}/2024-01/*.csv")) == 20 and scan_readings_csv(spark, out).count() == 40


def test_many_files_are_taken_some_at_a_time(spark, monkeypatch):
    """What the driver lists, broadcasts and renames at once does not grow with the files; rows stay the same."""
    rows = spark.range(60).selectExpr("'2024-01' AS label", "concat('processo_', id % 10, '=%[x].csv') AS file_name",
                                      "timestamp_ntz '2024-01-02 00:00:00' + make_interval(0,0,0,0,0,0, id) AS ts", "'a,\"b' AS tag_id", "id * 1.0 AS value")
    out, read, lists = folder(spark, "many"), csv_readings.read_cells, []
    sink_month_process_csv(rows, out)
    for name in ("2024-01/processo_bad.csv", "_hidden/processo_1.csv", "2024-01/.x.csv", "2024-01/other.txt", "_kept=1/processo_k.csv"):
        os.makedirs(os.path.dirname(f"{out}/{name}"), exist_ok=True)
        open(f"{out}/{name}", "w").write("ts,value\n2024-01-01,1\n" if "bad" in name else "ts,tag_id,value\n2024-01-01 00:00:00,t,1\n")
    told = lambda: (sorted(map(str, scan_readings_csv(spark, out, keep_text=True).drop("pos").collect())), sorted(map(tuple, exported_pairs(spark, out).collect())))
    want = told()
    monkeypatch.setattr(csv_readings, "read_cells", lambda spark, paths: (lists.append(paths), read(spark, paths))[1])
    monkeypatch.setattr(csv_readings, "BATCH_FILES", 4, raising=False)
    assert told() == want and len(want[0]) == 62
    assert len(lists) == 3 and sum(map(len, lists)) == 12 and max(map(len, lists)) == 4


def test_named_files_are_moved_some_at_a_time(spark, monkeypatch):
    """Also on a file system that is no mounted folder."""
    rows = spark.range(40).selectExpr("'2024-01' AS label", "concat('processo_x=%-parte', id % 20 + 1, '.csv') AS file_name",
                                      "timestamp_ntz '2024-01-02 00:00:00' AS ts", "'t' AS tag_id", "id * 1.0 AS value")
    real, groups = commits._moves, []
    monkeypatch.setattr(commits, "MOVES", 8)
    monkeypatch.setattr(commits, "_moves", lambda *a: (groups.append(len(g)) or g for g in real(*a)))
    for mounted in (True, False):
        if not mounted:
            monkeypatch.setattr(commits.Files, "posix", lambda self, path: None)
        out = folder(spark, "moved")
        sink_month_process_csv(rows, out)
        assert len(glob.glob(f"{out}/2024-01/*.csv")) == 20 and sum(groups) == 20 and max(groups) < 20
        assert scan_readings_csv(spark, out).count() == 40
        groups.clear()
    monkeypatch.setattr(csv_readings, "BATCH_FILES", 6)
    assert scan_readings_csv(spark, out).count() == 40


def source(spark):
    return spark.range(600).selectExpr("concat('p', id % 6) AS processId", "concat('t', id % 2) AS tagId", "id * 1.0 AS value",
                                       "timestamp_ntz '2024-01-05 00:00:00' + make_interval(0,0,0, cast(id % 30 AS INT), 0, 0, id) AS timestamp")


def test_extraction_with_a_bad_process(spark):
    """The bad pairs are errors and stay pending; a done folder counts; a second run makes up."""
    good = source(spark)
    broken = good.withColumn("value", F.when((F.col("processId") == "p3") & (F.col("timestamp") < "2024-02-01"), F.raise_error(F.lit("bad cell")).cast("double")).otherwise(F.col("value")))
    base = folder(spark, "ext")
    os.makedirs(f"{base}/made/2024-01")
    for month in ("2023-12", "2024-01", "2024-02"):
        os.makedirs(f"{base}/made/{month}", exist_ok=True)
        open(f"{base}/made/{month}/processo_p5.csv", "w").write("ts,tag_id,value\n")
    got = {r["process_id"]: tuple(r)[1:] for r in flows.extract_readings(spark, broken, f"{base}/dump", f"{base}/made", NOW, 20, [], cap=1000).collect()}
    assert got["p5"] == ("skipped", 0, 0, 0) and got["p3"][0] == "error" and got["p3"][3] == 1
    assert all(got[f"p{i}"][0] == "extracted" and got[f"p{i}"][3] == 0 for i in (0, 1, 2, 4))
    assert not glob.glob(f"{base}/dump/2024-01/processo_p3*")
    again = {r["process_id"]: tuple(r)[1:] for r in flows.extract_readings(spark, good, f"{base}/dump", f"{base}/made", NOW, 20, [], cap=30).collect()}
    assert again["p3"][:2] == ("extracted", 1)
    rows = scan_readings_csv(spark, f"{base}/dump")
    want = good.where("processId <> 'p5' AND timestamp < '2024-03-01'").count()
    assert rows.count() == want
    parts = glob.glob(f"{base}/dump/2024-01/processo_p3-parte*.csv")
    assert len(parts) > 1 and max(sum(1 for _ in open(p)) - 1 for p in parts) <= 30


def test_extraction_query_takes_every_process(spark, tmp_path):
    spark.range(1, 13).selectExpr("id AS event_id", "timestamp_ntz '2024-01-20 00:00:00' AS ts", "id % 6 AS user_id", "'t' AS event_type", "1.0D AS value",
                                  "'{}' AS props").write.parquet(f"{tmp_path}/events.parquet")
    got = load_all()["extract_readings"].build(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(str(i), "extracted", 1, 2, 0) for i in range(6)]


def test_outcomes(spark):
    grid = spark.createDataFrame([(p, m) for p in "abcd" for m in ("1", "2")], "process_id string, label string")
    done = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], "process_id string, label string")
    recent = spark.createDataFrame([("a", 5), ("b", 5), ("d", 5)], "process_id string, recent_rows long")
    extracted = spark.createDataFrame([("a", "1", 3), ("b", "2", 3), ("c", "1", 4), ("d", "1", 6)], "process_id string, label string, rows long")
    failed = spark.createDataFrame([("d", "2"), ("a", "1")], "process_id string, label string")
    got = sorted(map(tuple, ex.extraction_outcomes(grid, done, recent, extracted, failed).collect()))
    assert got == [("a", "skipped", 0, 0, 0), ("b", "extracted", 1, 3, 0), ("c", "skipped", 0, 0, 0), ("d", "error", 1, 6, 1)]


def test_split_counts_rows_once_a_pass(spark):
    """T5: one struct a row, and both ways of walking down end in the same halves."""
    rows = spark.createDataFrame([("p", "m", 3, (1 << 20) + 2, 17 * i) for i in range(64)], "process_id string, label string, _s0 long, _e0 long, _t long")
    walked = ex._halved(rows.selectExpr("*", "_s0 AS _s", "_e0 AS _e", "0L AS _path"), 8)
    assert "Generate" not in walked._jdf.queryExecution().executedPlan().toString()
    told = session.materialize(walked).withColumn("x", ex._descend("_s0", "_e0", "8", "_t >= mid")).where("x.s = _s AND x.e = _e AND x.path = _path AND _t < _e AND (_t >= _s OR _t < 3)")
    assert told.count() == 64


def test_small_files_are_dealt_over_tasks(spark, monkeypatch):
    """AQE would write them all in one task, as their bytes are few; cells are as Spark writes them."""
    rows = spark.range(200).selectExpr("'2024-01' AS label", "concat('processo_', id, '.csv') AS file_name", "timestamp_ntz '2024-01-02 00:00:00' AS ts",
                                       "CASE id WHEN 0 THEN 'a,\"b' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 't' END AS tag_id", "id * 1.0 AS value")
    out, real, lists = folder(spark, "dealt"), commits.Files.write_text, []
    monkeypatch.setattr(commits.Files, "write_text", lambda self, path, text: (lists.append(text) if path.endswith("_folders") else None, real(self, path, text))[1])
    sink_month_process_csv(rows, out)
    assert len(lists) == 1 and len(lists[0].split()) > 4
    names = glob.glob(f"{out}/2024-01/*.csv")
    assert len(names) == 200
    spark_csv = folder(spark, "spark")
    rows.selectExpr("'2024-01-02 00:00:00.000000+00:00' AS ts", "tag_id", "cast(value AS STRING) AS value").write.option("header", "true").csv(spark_csv)
    lines = lambda paths: {line for p in paths for line in open(p)}
    assert lines(names) == lines(glob.glob(f"{spark_csv}/*.csv"))
