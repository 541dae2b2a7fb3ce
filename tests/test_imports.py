"""Imports that meet bad files, lost drivers and retried epochs."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from telemetra import session
from telemetra.operators import dedup
from telemetra.plans import flows
from telemetra.sources import commits
from telemetra.sources import incremental as inc
from telemetra.sources.csv_readings import scan_readings_csv
from telemetra.streaming import file_stream

NOW = "2024-06-01 12:00:00"


def folder(spark, name):
    return session.local_path(session.scratch_dir(spark, name))


def item(i, pid="P-1"):
    return json.dumps({"Item": {"process_id": {"S": pid}, "timestamp": {"S": f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00"}, "T": {"N": str(i)}}})


def write_gz(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wb") as fh:
        fh.write("".join(x + "\n" for x in lines).encode() if isinstance(lines, list) else lines)


def write_csv(path, rows, header="ts,tag_id,value"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(header + "\n" + "".join(",".join(r) + "\n" for r in rows))


def run_json(spark, dump, base, **more):
    return flows.import_typed_json(spark, dump, f"{base}/t", "projections", "acme", overrides=[], ledger_path=f"{base}/l", **more)


def ledger(spark, base):
    return {r["file"]: (r["read"], r["inserted"], r["discarded"]) for r in inc.read_ledger(spark, f"{base}/l").collect()}


def test_imported_files_are_not_opened_again(spark):
    """A run opens pending files only: an imported file may turn into garbage."""
    dump, base = folder(spark, "i-dump"), folder(spark, "i-out")
    write_gz(f"{dump}/a.json.gz", [item(i) for i in range(5)])
    run_json(spark, dump, base)
    with open(f"{dump}/a.json.gz", "wb") as fh:
        fh.write(b"garbage, no gzip")
    rows, stats = run_json(spark, dump, base)
    assert rows.count() == 0 and stats.count() == 0
    write_gz(f"{dump}/b.json.gz", [item(i, "P-2") for i in range(3)])
    rows, stats = run_json(spark, dump, base)
    assert rows.count() == 3 and [r["file"] for r in stats.collect()] == ["b.json.gz"]
    assert spark.read.parquet(f"{base}/t").count() == 8
    rows, stats = run_json(spark, dump, base, again_if_changed=True)
    assert stats.count() == 0  # the changed file is pending again, and can't be read
    failed = spark.read.parquet(f"{base}/l_failed").collect()
    assert [r["file"] for r in failed] == ["a.json.gz"] and ledger(spark, base)["a.json.gz"] == (5, 5, 0)


def test_files_without_rows_are_done(spark):
    dump, base = folder(spark, "z-dump"), folder(spark, "z-out")
    write_gz(f"{dump}/blank.gz", ["", "  "])
    write_gz(f"{dump}/empty.gz", [])
    run_json(spark, dump, base)
    assert ledger(spark, base) == {"blank.gz": (0, 0, 0), "empty.gz": (0, 0, 0)}
    write_csv(f"{dump}/2024-05/processo_1.csv", [])
    r = flows.import_readings_csv(spark, dump, f"{base}/c", f"{base}/cl", NOW, "acme")
    assert [(e["file"], e["read"]) for e in r.ledger.collect()] == [("2024-05/processo_1.csv", 0)]
    assert flows.import_readings_csv(spark, dump, f"{base}/c", f"{base}/cl", NOW, "acme").ledger.count() == 0


@pytest.mark.parametrize("batch_bytes", [1 << 30, 1])
def test_unreadable_files_fail_alone(spark, batch_bytes, monkeypatch):
    """A truncated gzip, bytes that are no text and a file that vanishes after the listing."""
    dump, base = folder(spark, "f-dump"), folder(spark, "f-out")
    for n in range(6):
        write_gz(f"{dump}/good {n} [x]+%.json.gz", [item(i, f"P-{n}") for i in range(4)])
    write_gz(f"{dump}/cut.gz", [item(i) for i in range(5000)])
    whole = open(f"{dump}/cut.gz", "rb").read()
    open(f"{dump}/cut.gz", "wb").write(whole[:len(whole) // 2])
    write_gz(f"{dump}/latin.gz", item(1).encode().replace(b"P-1", b"P-\xe9\xff") + b"\n")
    write_gz(f"{dump}/gone.gz", [item(1)])
    real = inc.batches

    def after_listing(*args):
        for batch in real(*args):
            if os.path.exists(f"{dump}/gone.gz"):
                os.remove(f"{dump}/gone.gz")
            yield batch
    monkeypatch.setattr(inc, "batches", after_listing)
    rows, stats = run_json(spark, dump, base, batch_bytes=batch_bytes)
    assert rows.count() == 24 and stats.count() == 6
    failed = {r["file"]: r["error"] for r in spark.read.parquet(f"{base}/l_failed").collect()}
    assert set(failed) == {"cut.gz", "latin.gz", "gone.gz"} and all(failed.values())
    write_gz(f"{dump}/cut.gz", [item(i) for i in range(7)])  # repaired: still pending
    assert run_json(spark, dump, base)[0].count() == 7


def test_unreadable_csv_fails_alone(spark):
    dump, base = folder(spark, "fc-dump"), folder(spark, "fc-out")
    for n in range(3):
        write_csv(f"{dump}/2024-05/processo_{n}.csv", [("2024-05-31 10:00:00+00:00", f"T{n}", "1")])
    write_csv(f"{dump}/2024-05/processo_7.csv", [], header="ts,value")
    open(f"{dump}/2024-05/processo_8.csv", "wb").write(b"ts,tag_id,value\n2024-05-31 10:00:00,\xff\xfe,1\n")
    r = flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", NOW, "acme")
    assert r.ledger.count() == 3 and flows.read_table(spark, f"{base}/t").count() == 3
    assert {x["file"][-14:]: x["error"] for x in r.failed.collect()} == {"processo_7.csv": "missing column: tag_id", "processo_8.csv": "not UTF-8"}
    assert r.totals.first()["failed_files"] == 2
    assert [x["running"] for x in r.progress().orderBy("file").collect()] == [1, 2, 3]


def test_csv_of_any_width(spark, tmp_path):
    """Columns are found by name wherever they are; quoted cells, byte-order mark, data rows like a header."""
    names = [f"x{i}" for i in range(40)]
    wide = ",".join(names + ["ts", "tag_id", "value"])
    (tmp_path / "w.csv").write_text(wide + "\n" + "," * 40 + "2024-01-02 00:00:00+00:00,t1,1.5\n")
    (tmp_path / "q.csv").write_text('﻿tag_id,"note, ""x""",ts,value\n"a, ""b""","c,d",2024-01-02 00:00:00+00:00,"2"\n,"",2024-01-02 00:00:00,3\n', encoding="utf-8")
    (tmp_path / "h.csv").write_text("ts,tag_id,value\r\n2024-01-02 00:00:00,t,1\r\n\r\n2024-01-02 00:00:01,ts tag_id value,2\r\n")
    got = {(r.file[-5:], r.tag_id, r.value) for r in scan_readings_csv(spark, str(tmp_path)).where("fault IS NULL AND ts IS NOT NULL").collect()}
    assert got == {("w.csv", "t1", 1.5), ("q.csv", 'a, "b"', 2.0), ("q.csv", None, 3.0), ("h.csv", "t", 1.0), ("h.csv", "ts tag_id value", 2.0)}


def test_header_of_a_file_in_many_splits(spark, tmp_path):
    (tmp_path / "big.csv").write_text("value,tag_id,ts\n" + "".join(f"{i},t{i},2024-01-02 00:00:00\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = scan_readings_csv(spark, str(tmp_path))
        assert rows.where("fault IS NULL AND ts IS NOT NULL").agg(F.sum("value")).first()[0] == sum(range(5000))
        assert [int(r.value) for r in rows.orderBy("pos").select("value").limit(3).collect()] == [0, 1, 2]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


class Lost(Exception):
    """The driver is gone."""


def lose(monkeypatch, name, after=0):
    """Lose the driver in the given step of a commit, after so many calls."""
    real, calls = getattr(commits.Files, name), []

    def step(self, *args):
        calls.append(args)
        if len(calls) > after:
            raise Lost(name)
        return real(self, *args)
    monkeypatch.setattr(commits.Files, name, step)


@pytest.mark.parametrize("step, after", [("write_text", 0), ("move", 1), ("delete", 1)])
def test_lost_driver_keeps_table_and_ledger_whole(spark, monkeypatch, step, after):
    """Between write and publication, or in the middle of it: the old ledger and table are
    there, and the next run has each file once."""
    dump, base = folder(spark, "l-dump"), folder(spark, "l-out")
    for n in range(3):
        write_gz(f"{dump}/a{n}.gz", [item(i, f"P-{n}") for i in range(4)])
    run_json(spark, dump, base, compact=False)
    write_gz(f"{dump}/b.gz", [item(i, "P-9") for i in range(4)])
    with monkeypatch.context() as m:
        lose(m, step, after)
        with pytest.raises(Lost):
            run_json(spark, dump, base, compact=False)
    assert {f"a{n}.gz" for n in range(3)} <= set(ledger(spark, base))
    assert spark.read.parquet(f"{base}/t").where("process_id <> 'P-9'").count() == 12
    run_json(spark, dump, base, compact=False)
    assert len(ledger(spark, base)) == 4 and spark.read.parquet(f"{base}/t").count() == 16


@pytest.mark.parametrize("step, after", [("write_text", 0), ("move", 1), ("delete", 1)])
@pytest.mark.parametrize("partitioned", [True, False])
def test_lost_driver_in_consolidation(spark, monkeypatch, partitioned, step, after):
    """No row is ever missing, and the next consolidation ends with each key once."""
    path = folder(spark, "c-table")
    rows = spark.range(40).selectExpr("'c' AS company_id", "concat('p', id % 10) AS process_id", "'t' AS tag_id", "id * 1.0 AS value",
                                      "timestamp_ntz '2024-01-01 00:00:00' AS ts", "id AS ingest_seq").repartition(4)
    from telemetra.sources.tables import sink_append
    sink_append(rows, path, partitioned=partitioned)
    touched = spark.createDataFrame([("c", "202401")], "company_id string, month string")

    def compact():
        if partitioned:
            return dedup.compact_touched(spark, path, touched, dedup.PROJECTIONS_KEY)
        return dedup.compact_table(spark, path, dedup.PREDICTIONS_KEY)
    with monkeypatch.context() as m:
        lose(m, step, after)
        with pytest.raises(Lost):
            compact()
    last = lambda: dedup.replace_dedup(dedup.read_partitioned(spark, path), dedup.PREDICTIONS_KEY)
    assert sorted(r["value"] for r in last().collect()) == [float(i) for i in range(30, 40)]
    assert compact().count() == 10 and spark.read.parquet(path).count() == 10


def test_failed_consolidation_is_made_up_for(spark, monkeypatch):
    dump, base = folder(spark, "m-dump"), folder(spark, "m-out")
    t = "2024-05-31 10:00:00+00:00"
    write_csv(f"{dump}/2024-05/processo_1.csv", [(t, "T", "1"), (t, "T", "2")])
    with monkeypatch.context() as m:
        m.setattr(dedup, "compact_touched", lambda *a: 1 / 0)
        flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", NOW, "acme")
    assert flows.read_table(spark, f"{base}/t").count() == 2
    flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", NOW, "acme")  # nothing pending
    assert [r["value"] for r in flows.read_table(spark, f"{base}/t").collect()] == [2.0]


def test_numbers_are_claimed_once(spark, monkeypatch):
    """Two runs that see the same last number get different ones."""
    path = folder(spark, "runs")
    assert commits.claim(spark, path) == 1
    monkeypatch.setattr(commits.Files, "names", lambda self, f: [])
    assert [commits.claim(spark, path) for _ in range(2)] == [2, 3]


def test_ledger_folds_and_keeps_the_last_entry(spark):
    path = folder(spark, "ledger")
    for n in range(5):
        entries = spark.createDataFrame([("same", n, n, 0, 0.5), (f"f{n}", 1, 1, 0, 0.5)], "file string, read long, inserted long, discarded long, elapsed double")
        inc.append_ledger(spark, path, entries)
    before = sorted(map(tuple, inc.read_ledger(spark, path).select("file", "read").collect()))
    assert before == [*((f"f{n}", 1) for n in range(5)), ("same", 4)]
    assert inc.fold_ledger(spark, path, above=2) and len(commits.Files(spark, path).below(path)) == 1
    assert sorted(map(tuple, inc.read_ledger(spark, path).select("file", "read").collect())) == before


@pytest.mark.parametrize("step, after", [("write_text", 0), ("move", 2), ("delete", 1)])
def test_retried_epoch_leaves_each_row_once(spark, monkeypatch, step, after):
    """An epoch that fails before, in and after its publication is tried again."""
    dump, base = folder(spark, "e-dump"), folder(spark, "e-out")
    for n in range(3):
        write_gz(f"{dump}/{n}.gz", [item(i, f"P-{n}") for i in range(5)])
    args = (spark, dump, f"{base}/t", f"{base}/l", f"{base}/touched", f"{base}/ck", "acme")
    with monkeypatch.context() as m:
        lose(m, step, after)
        with pytest.raises(Exception):
            file_stream.stream_import(*args, overrides=[]).awaitTermination()
    file_stream.stream_import(*args, overrides=[]).awaitTermination()
    rows = spark.read.parquet(f"{base}/t")
    assert rows.count() == 15 and rows.select("process_id", "ts").distinct().count() == 15
    assert spark.read.parquet(f"{base}/l").count() == 3


def test_epoch_done_but_not_committed_is_not_done_twice(spark):
    """The same epoch handed over twice: the second time nothing happens."""
    dump, base = folder(spark, "d-dump"), folder(spark, "d-out")
    write_gz(f"{dump}/a.gz", [item(i) for i in range(5)])
    os.makedirs(f"{base}/ck")
    open(f"{base}/ck/metadata", "w").write('{"id":"q"}')
    job = flows.JsonJob(dump, f"{base}/t", f"{base}/l", f"{base}/touched", "projections", "acme", [])
    write = file_stream.batch_writer(job, f"{base}/ck", 1)
    batch = inc.list_files(spark, dump, "*.gz").select("path", "length", "modified")
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(f"{base}/t").count() == 5
    write(batch, 1)
    assert spark.read.parquet(f"{base}/t").count() == 10 and commits.Files(spark, base).names(f"{base}/t_tx/_done") == ["q-1"]


def test_stream_leaves_bad_files_to_the_batch_import(spark):
    dump, base = folder(spark, "s-dump"), folder(spark, "s-out")
    write_gz(f"{dump}/a.gz", [item(i) for i in range(5)])
    os.makedirs(dump, exist_ok=True)
    open(f"{dump}/bad.gz", "wb").write(b"no gzip at all")
    file_stream.run_stream_import(spark, dump, f"{base}/t", f"{base}/l", f"{base}/ck", "acme", overrides=[], max_bytes_per_trigger=1)
    assert spark.read.parquet(f"{base}/t").count() == 5 and list(ledger(spark, base)) == ["a.gz"]
    assert [r["file"] for r in spark.read.parquet(f"{base}/l_failed").collect()] == ["bad.gz"]
    write_gz(f"{dump}/bad.gz", [item(i, "P-2") for i in range(2)])
    assert run_json(spark, dump, base)[0].count() == 2


def test_limit_per_file_scans_once(spark):
    """One read of the text, and the rank filter is applied before the shuffle."""
    from telemetra.sources.typed_json_files import limit_per_file, read_lines
    dump = folder(spark, "w3")
    write_gz(f"{dump}/a.gz", [item(i) for i in range(50)])
    plan = limit_per_file(read_lines(spark, dump), 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan.split("Exchange")[1]
