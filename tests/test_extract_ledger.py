"""Extraction planning (F13, J4, J5, T5, W2) and ledgers."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from telemetra.functions import timefmt
from telemetra.operators import extract as ex
from telemetra.operators.ledger import import_totals, running_total, upsert_by_key


def test_month_series_covers_lookback(spark):
    m = ex.months(spark, "2024-02-10 00:00:00", 45).orderBy("start").collect()
    assert [r.label for r in m] == ["2023-12", "2024-01", "2024-02"]
    assert str(m[0].end) == "2024-01-01 00:00:00"


def _brute_split(ts_list, s, e, cap):
    n = sum(1 for t in ts_list if s <= t < e)
    if n <= cap:
        return [(s, e, n)] if n > 0 else []
    d = (e - s)
    micros = d.days * 86_400_000_000 + d.seconds * 1_000_000 + d.microseconds
    mid = s + timedelta(microseconds=round(micros / 2))  # round half to even, like timedelta / 2
    return _brute_split(ts_list, s, mid, cap) + _brute_split(ts_list, mid, e, cap)


def test_adaptive_split_matches_recursive_halving(spark):
    base = datetime(2024, 1, 1)
    ts = [base + timedelta(minutes=7 * i + (i % 5)) for i in range(400)] + [base + timedelta(hours=3)] * 30
    src = spark.createDataFrame([("p", t, "tag", 1.0) for t in ts],
                                "processId string, timestamp timestamp_ntz, tagId string, value double")
    ranges = spark.createDataFrame([("p", datetime(2024, 1, 1), datetime(2024, 2, 1), "2024-01")],
                                   "process_id string, start timestamp_ntz, end timestamp_ntz, label string")
    got = sorted((r.start, r.end, r.rows) for r in ex.adaptive_range_split(src, ranges, cap=37).collect())
    want = sorted(_brute_split(ts, datetime(2024, 1, 1), datetime(2024, 2, 1), 37))
    assert got == want
    parts = ex.number_parts(ex.adaptive_range_split(src, ranges, cap=37)).orderBy("start").collect()
    assert [r.part for r in parts] == list(range(1, len(parts) + 1))
    assert parts[0].file_name == "processo_p-parte1.csv"


def test_midpoint_rounds_half_to_even(spark):
    a = datetime(2024, 1, 1)
    rows = [(a, a + timedelta(microseconds=d)) for d in (1, 2, 3, 5, 7)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [r.m for r in df.select(timefmt.midpoint("a", "b").alias("m")).collect()]
    assert got == [a + (b - a) / 2 for a, b in rows]


def test_pending_grid(spark):
    procs = spark.createDataFrame([("1",), ("2",)], "process_id string")
    grid = ex.work_grid(procs, "2024-02-10 00:00:00", 10)
    done = spark.createDataFrame([("1", "2024-01")], "process_id string, label string")
    assert sorted((r.process_id, r.label) for r in ex.pending(grid, done).collect()) == \
        [("1", "2024-02"), ("2", "2024-01"), ("2", "2024-02")]


def test_upsert_and_totals(spark):
    old = spark.createDataFrame([("a", 1, 1, 0), ("b", 2, 1, 1)], "file string, read long, inserted long, discarded long")
    new = spark.createDataFrame([("b", 5, 5, 0), ("c", 3, 2, 1)], "file string, read long, inserted long, discarded long")
    led = upsert_by_key(old, new)
    assert sorted(tuple(r) for r in led.collect()) == [("a", 1, 1, 0), ("b", 5, 5, 0), ("c", 3, 2, 1)]
    tot = [r for r in import_totals(led).collect() if r.file is None][0]
    assert (tot.read, tot.inserted, tot.discarded, tot.files) == (9, 8, 1, 3)


def test_running_total_is_exact(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("x"))
    got = {r.seq: r.running for r in running_total(df, "seq", "x").collect()}
    acc, want = 0, {}
    for i in range(5000):
        acc += i % 3
        want[i] = acc
    assert got == want


def test_running_total_per_group_and_rank(spark):
    from telemetra.operators.dedup import last_write_rank
    # one hot group holding most rows, plus small groups
    rows = [("hot", i) for i in range(3000)] + [(f"g{i % 7}", 10_000 + i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, seq long")
    got = {(r.k, r.seq): r.rank_in_key for r in last_write_rank(df, ["k"], "seq").collect()}
    want = {}
    by = {}
    for k, s in rows:
        by.setdefault(k, []).append(s)
    for k, seqs in by.items():
        for rank, s in enumerate(sorted(seqs, reverse=True), start=1):
            want[(k, s)] = rank
    assert got == want


def test_adaptive_split_deep_multi_pass(spark):
    # rows clustered in one hour of the month with a tiny cap: more than 8 halvings → 2+ passes
    base = datetime(2024, 1, 10, 5)
    ts = [base + timedelta(seconds=(i * 37) % 3600, microseconds=i) for i in range(1500)]
    ts += [datetime(2024, 1, 1) + timedelta(days=d) for d in range(20)]
    src = spark.createDataFrame([("p", t, "tag", 1.0) for t in ts],
                                "processId string, timestamp timestamp_ntz, tagId string, value double")
    ranges = spark.createDataFrame([("p", datetime(2024, 1, 1), datetime(2024, 2, 1), "2024-01")],
                                   "process_id string, start timestamp_ntz, end timestamp_ntz, label string")
    got = sorted((r.start, r.end, r.rows) for r in ex.adaptive_range_split(src, ranges, cap=5).collect())
    want = sorted(_brute_split(ts, datetime(2024, 1, 1), datetime(2024, 2, 1), 5))
    assert got == want and sum(r[2] for r in got) == len(ts)


def test_range_of_equal_timestamps_is_final(spark):
    """A range that cannot be halved ends the splitting instead of failing the run."""
    from telemetra.operators.extract import adaptive_range_split
    src = spark.range(60).selectExpr("'p' AS processId", "TIMESTAMP_NTZ'2024-01-10 01:02:03' + make_interval(0,0,0,0,0,0,IF(id < 50, 0, id)) AS timestamp")
    ranges = spark.sql("SELECT 'p' AS process_id, '2024-01' AS label, TIMESTAMP_NTZ'2024-01-01' AS start, TIMESTAMP_NTZ'2024-02-01' AS end")
    got = adaptive_range_split(src, ranges, cap=40).collect()
    assert sum(r.rows for r in got) == 60 and max(r.rows for r in got) == 50
    assert sum(r.rows > 40 for r in got) == 1


def test_source_scan_pushes_both_bounds(spark, tmp_path):
    from telemetra.operators.extract import scan_source_range
    path = str(tmp_path / "src")
    spark.range(100).selectExpr("'p' AS processId", "TIMESTAMP_NTZ'2024-01-01' + make_interval(0,0,0,cast(id AS int)) AS timestamp",
                                "'t' AS tagId", "1.0D AS value").write.parquet(path)
    ranges = spark.sql("SELECT 'p' AS process_id, TIMESTAMP_NTZ'2024-02-01' AS start, TIMESTAMP_NTZ'2024-03-01 12:00:00' AS end")
    out = scan_source_range(spark.read.parquet(path), ranges)
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan
    assert out.count() == 30
