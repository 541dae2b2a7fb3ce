"""Sources and sinks on real files (S1, S2, S3, S10, S12, W3, E1) and streaming."""

import gzip
import json
import os

from pyspark.sql import functions as F

from telemetra import session
from telemetra.operators import dedup
from telemetra.plans import flows
from telemetra.sources.tables import read_wide_csv, sink_wide_csv
from telemetra.sources.typed_json_files import discover_files, limit_per_file, read_lines
from telemetra.streaming.file_stream import stream_import


def _item(i, pid="P-1", tag="T"):
    return json.dumps({"Item": {"process_id": {"S": pid}, "timestamp": {"S": f"2024-01-01 00:{i % 60:02d}:00"},
                                tag: {"N": str(i)}}})


def _write_gz(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def _dump(spark):
    root = session.local_path(session.scratch_dir(spark, "t-dump"))
    _write_gz(f"{root}/a/f1.json.gz", [_item(i) for i in range(10)] + ["", "  "])
    _write_gz(f"{root}/b/sub/f2.gz", [_item(i, "P-2") for i in range(5)])
    _write_gz(f"{root}/manifest-1.json.gz", [_item(i, "P-9") for i in range(7)])
    with open(f"{root}/b/readme.txt", "w") as fh:
        fh.write(_item(1) + "\n")
    return root


def test_discovery_skips_manifests_and_non_gz(spark):
    root = _dump(spark)
    names = sorted(os.path.basename(r.file) for r in discover_files(spark, root).collect())
    assert names == ["f1.json.gz", "f2.gz"]
    assert read_lines(spark, root).where(F.trim("value") != "").count() == 15


def test_limit_per_file_counts_items_not_blanks(spark):
    root = _dump(spark)
    _write_gz(f"{root}/c/f3.json.gz", ["", _item(1), "", _item(2), _item(3), ""])
    kept = limit_per_file(read_lines(spark, root), 2).collect()
    by_file = {}
    for r in kept:
        by_file.setdefault(os.path.basename(r.file), []).append(json.loads(r.value)["Item"]["timestamp"]["S"])
    assert by_file["f3.json.gz"] == ["2024-01-01 00:01:00", "2024-01-01 00:02:00"]
    assert len(by_file["f1.json.gz"]) == 2


def test_wide_csv_has_bom_and_semicolons(spark):
    df = spark.createDataFrame([("2024-01-01 00:00", 1.5, None), ("2024-01-01 00:01", None, 2.0)],
                               "TIMESTAMP string, `a-1` double, `b#2` double")
    out = session.scratch_dir(spark, "t-wide")
    assert sink_wide_csv(df, out)
    files = [f for f in os.listdir(session.local_path(out)) if f.endswith(".csv")]
    assert len(files) == 1
    raw = open(os.path.join(session.local_path(out), files[0]), "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfTIMESTAMP;a-1;b#2")
    assert read_wide_csv(spark, out).columns == ["TIMESTAMP", "a-1", "b#2"]
    assert not sink_wide_csv(df.limit(0), session.scratch_dir(spark, "t-wide-empty"))


def _csv(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("ts,tag_id,value\n" + "".join(f"{a},{b},{c}\n" for a, b, c in rows))


def test_csv_import_incremental_and_fault_isolation(spark):
    dump = session.local_path(session.scratch_dir(spark, "t-csv"))
    base = session.scratch_dir(spark, "t-csv-out")
    now = "2024-06-01 12:00:00"
    _csv(f"{dump}/2024-05/processo_1.csv", [("2024-05-31 10:00:00+00:00", "T", "1.5"),
                                            ("2024-06-01 13:00:00+00:00", "T", "2"),     # future
                                            ("2024-05-31 11:00:00+00:00", "T", "abc")])  # bad value
    _csv(f"{dump}/2024-05/processo_2-parte1.csv", [("not a time", "T", "1")])            # fails
    r1 = flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", now, "acme", 4320, run_id=1)
    led = {os.path.basename(r.file): (r.read, r.inserted, r.discarded) for r in r1.ledger.collect()}
    assert led == {"processo_1.csv": (3, 1, 2)}
    assert [os.path.basename(r.file) for r in r1.failed.collect()] == ["processo_2-parte1.csv"]
    # the failed file stays pending; a new file is picked up; done files are not re-read
    _csv(f"{dump}/2024-05/processo_2-parte1.csv", [("2024-05-31 09:00:00+00:00", "T", "1")])
    _csv(f"{dump}/2024-05/processo_3.csv", [("2024-05-31 09:00:00+00:00", "U", "4")])
    r2 = flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", now, "acme", 4320, run_id=2)
    assert sorted(os.path.basename(r.file) for r in r2.ledger.collect()) == ["processo_2-parte1.csv",
                                                                            "processo_3.csv"]
    r3 = flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", now, "acme", 4320, run_id=3)
    assert r3.ledger.count() == 0
    table = flows.read_table(spark, f"{base}/t")
    assert table.count() == 3  # (T, 10:00) from run 1; (T, 09:00) and (U, 09:00) from run 2
    assert sorted(r.month for r in table.select("month").distinct().collect()) == ["202405"]


def test_stream_only_new_files_and_replay(spark):
    dump = session.local_path(session.scratch_dir(spark, "t-stream"))
    base = session.scratch_dir(spark, "t-stream-out")
    _write_gz(f"{dump}/a.json.gz", [_item(i) for i in range(6)])

    def run(ck):
        q = stream_import(spark, dump, f"{base}/tbl", f"{base}/led", f"{base}/touch", f"{base}/{ck}", "acme",
                          overrides=[])
        q.awaitTermination()

    run("ck1")
    _write_gz(f"{dump}/b.json.gz", [_item(i, "P-2") for i in range(4)])
    run("ck1")
    run("ck1")  # nothing new: no batch, no rows
    tbl = spark.read.parquet(f"{base}/tbl")
    assert tbl.count() == 10
    assert spark.read.parquet(f"{base}/led").count() == 2
    run("ck2")  # replay everything with a fresh checkpoint → duplicates …
    assert spark.read.parquet(f"{base}/tbl").count() == 20
    touched = spark.read.parquet(f"{base}/touch").distinct()
    dedup.compact_touched(spark, f"{base}/tbl", touched, dedup.PROJECTIONS_KEY)
    assert spark.read.parquet(f"{base}/tbl").count() == 10  # … removed by consolidation


def test_csv_import_archives_done_files(spark):
    dump = session.local_path(session.scratch_dir(spark, "t-arch"))
    made = session.local_path(session.scratch_dir(spark, "t-made"))
    base = session.scratch_dir(spark, "t-arch-out")
    _csv(f"{dump}/2024-05/processo_1.csv", [("2024-05-31 10:00:00+00:00", "T", "1.5")])
    _csv(f"{dump}/2024-05/processo_2.csv", [("garbage", "T", "1")])
    flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", "2024-06-01 12:00:00", "acme",
                              4320, run_id=1, archive_dir=made)
    assert os.path.exists(f"{made}/2024-05/processo_1.csv")
    assert not os.path.exists(f"{dump}/2024-05/processo_1.csv")
    assert os.path.exists(f"{dump}/2024-05/processo_2.csv")  # failed: stays for retry


def test_shift_moves_row_into_next_month_partition(spark):
    from telemetra.operators import typed_json as tj
    line = json.dumps({"Item": {"process_id": {"S": "AB-1"}, "timestamp": {"S": "2024-01-31 22:30"},
                                "company_id": {"S": "c"}, "T": {"N": "1"}}})
    lines = spark.createDataFrame([("f", 0, line)], "file string, pos long, value string")
    rows = tj.projections(lines, "d", overrides=["ab1"])           # +4 h (normalised id matches)
    assert [str(r.ts) for r in rows.collect()] == ["2024-02-01 02:30:00"]
    assert [(r.company_id, r.month) for r in dedup.touched_partitions(rows).collect()] == [("c", "202402")]


def test_duplicate_keys_last_write_wins_within_file_and_across_runs(spark):
    dump = session.local_path(session.scratch_dir(spark, "t-dups"))
    base = session.scratch_dir(spark, "t-dups-out")
    now = "2024-06-01 12:00:00"
    t1, t2 = "2024-05-31 10:00:00+00:00", "2024-05-31 11:00:00+00:00"
    _csv(f"{dump}/2024-05/processo_1.csv", [(t1, "T", "1.0"), (t1, "T", "2.0")])      # later line wins
    _csv(f"{dump}/2024-05/processo_1-parte2.csv", [(t2, "T", "5.0"), (t1, "T", "3.0")])  # later part wins
    flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", now, "acme", 4320, run_id=1)
    got = {str(r.ts): r.value for r in flows.read_table(spark, f"{base}/t").collect()}
    assert got == {"2024-05-31 10:00:00": 3.0, "2024-05-31 11:00:00": 5.0}
    _csv(f"{dump}/2024-05/processo_0.csv", [(t2, "T", "7.0")])                        # a later run wins
    flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", now, "acme", 4320, run_id=2)
    got = {str(r.ts): r.value for r in flows.read_table(spark, f"{base}/t").collect()}
    assert got == {"2024-05-31 10:00:00": 3.0, "2024-05-31 11:00:00": 7.0}


def test_typed_json_dry_run_writes_nothing(spark):
    root = _dump(spark)
    table = session.scratch_dir(spark, "t-dry-table")
    sample, stats = flows.import_typed_json(spark, root, table, "projections", "acme", overrides=[],
                                            dry_run=True)
    assert sample.count() == 5
    assert sum(r.read for r in stats.collect()) == 15
    assert not os.path.exists(session.local_path(table))
    rows, _ = flows.import_typed_json(spark, root, table, "projections", "acme", overrides=[])
    assert spark.read.parquet(table).count() == 15


def test_csv_columns_are_found_by_name(spark, tmp_path):
    """A reordered header gives the same rows; a header without a column fails its file only."""
    from telemetra.sources.csv_readings import scan_readings_csv
    from telemetra.sources.incremental import failed_files
    for name, text in (("a", "ts,tag_id,value\n2024-01-02 00:00:00+00:00,t1,1.5\n"),
                       ("b", "value,ts,extra,tag_id\n1.5,2024-01-02 00:00:00+00:00,x,t1\n"),
                       ("c", "ts,tag_id\n2024-01-02 00:00:00+00:00,t1\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    out = scan_readings_csv(spark, str(tmp_path))
    rows = {r.file[-5]: (str(r.ts), r.tag_id, r.value) for r in out.where("ts IS NOT NULL").collect()}
    assert rows["a"] == rows["b"] == ("2024-01-02 00:00:00", "t1", 1.5) and len(rows) == 2
    assert [r.file[-5] for r in failed_files(out).collect()] == ["c"]


def test_ledger_read_errors_are_not_an_empty_ledger(spark, tmp_path):
    import pytest
    from telemetra.sources.incremental import next_run, read_ledger
    assert read_ledger(spark, str(tmp_path / "none")).count() == 0
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception):
        read_ledger(spark, str(bad)).count()
    assert [next_run(spark, str(tmp_path / "runs")) for _ in range(3)] == [1, 2, 3]


def test_repeated_json_key_keeps_the_last_and_bad_lines_are_kept(spark):
    from telemetra.operators import typed_json as tj
    lines = spark.createDataFrame([
        ("f", 1, '{"process_id":{"S":"p"},"ts":{"S":"2024-01-02 00:00:00"},"a":{"N":"1"},"a":{"N":"2"}}'),
        ("f", 2, '{"process_id":{"S":"p"},"ts":{"S":"garbage"},"a":{"N":"1"}}'), ("f", 3, "not json {")], "file string, pos long, value string")
    items = tj.item_rows(tj.parse_items(lines), "c")
    assert [(r.tag_id, r.value) for r in tj.projection_rows(items).collect()] == [("a", 2.0)]
    s = tj.per_file_stats(items).first()
    assert (s.read, s.accepted, s.discarded) == (3, 1, 2)
    assert {(r.pos, r.reason) for r in tj.quarantine(items).collect()} == {(2, "bad_ts"), (3, "malformed")}


def test_what_depends_on_the_file_is_worked_out_once_a_file(spark, tmp_path):
    from telemetra.session import materialize
    from telemetra.sources.csv_readings import read_cells, readings_of
    for i in range(3):
        (tmp_path / f"processo_{i}.csv").write_text("value,ts,tag_id\n" + "".join(f"{j}.5,2024-01-02 00:00:{j:02d}+00:00,t\n" for j in range(40)))
    calls = spark.sparkContext.accumulator(0)

    def name(file):
        calls.add(1)
        return file.rpartition("/")[2]
    cells = materialize(read_cells(spark, str(tmp_path)), "cells")
    got = readings_of(cells, name=lambda f: F.udf(name)(f)).groupBy("file", "file_process").agg(F.count("value").alias("n"), F.count("ts")).collect()
    assert sorted(map(tuple, got)) == [(f"processo_{i}.csv", str(i), 40, 40) for i in range(3)]
    assert calls.value <= 6


def test_lines_of_a_gzip_file_are_parsed_by_many_tasks(spark, tmp_path):
    """A gzip file is read by one task; its lines are dealt out, with their places kept."""
    import gzip
    import random
    from telemetra.plans import flows
    some = random.Random(1)
    with gzip.open(tmp_path / "a.json.gz", "wt") as out:
        out.writelines(f"{i} {some.randbytes(3000).hex()}\n" for i in range(2000))
    job = flows.JsonJob(str(tmp_path), "t", None, "touched", "projections", "acme")
    rows = job.lines(spark, [str(tmp_path / "a.json.gz")]).select("pos", F.split("value", " ")[0].cast("int").alias("i"), F.spark_partition_id().alias("task")).collect()
    assert len({r["task"] for r in rows}) > 2
    assert [r["i"] for r in sorted(rows, key=lambda r: r["pos"])] == list(range(2000))
