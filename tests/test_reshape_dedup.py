"""Reshape (R1, R2, A7) and consolidation (A8, A9, A13) properties."""

from pyspark.sql import functions as F

from telemetra import session
from telemetra.operators import dedup, reshape
from telemetra.sources.tables import sink_append

LONG = [("2024-01-01 00:00:00", "CA-H1_#170", 1.0, 1), ("2024-01-01 00:00:00", "a.b", 2.0, 2),
        ("2024-01-01 00:00:30", "a.b", 3.0, 3), ("2024-01-01 00:00:30", "a.b", 4.0, 4),
        ("2024-01-01 00:01:00", "only-null", None, 5), ("2024-01-01 00:02:00", "a.b", None, 6)]


def _long(spark):
    return spark.createDataFrame(LONG, "ts string, tag_id string, value double, seq long") \
                .withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_pivot_drops_null_tags_and_timestamps(spark):
    wide = reshape.pivot_wide(_long(spark), order_col="seq")
    assert wide.columns == ["ts", "CA-H1_#170", "a.b"]
    rows = {str(r.ts): tuple(r)[1:] for r in wide.collect()}
    assert rows == {"2024-01-01 00:00:00": (1.0, 2.0), "2024-01-01 00:00:30": (None, 3.0)}  # first = lowest seq


def test_pivot_with_tag_list_drops_requested_tags_without_values(spark):
    wide = reshape.pivot_wide(_long(spark), tags=["a.b", "only-null", "nope"], order_col="seq")
    assert wide.columns == ["ts", "a.b"]


def test_export_frame_minute_labels_keep_rows(spark):
    out = reshape.wide_export_frame(reshape.pivot_wide(_long(spark), order_col="seq")).collect()
    assert [r.TIMESTAMP for r in out] == ["2024-01-01 00:00", "2024-01-01 00:00"]


def test_pivot_unpivot_roundtrip(spark):
    wide = reshape.pivot_wide(_long(spark), order_col="seq")
    tags = [c for c in wide.columns if c != "ts"]
    back = reshape.unpivot_columns(wide.select("ts", *[F.col(f"`{t}`").alias(t.replace(".", "_"))
                                                      for t in tags]),
                                   ["ts"], [t.replace(".", "_") for t in tags])
    cells = reshape.first_non_null_cells(_long(spark), "seq")
    assert back.count() == cells.count()


def test_replace_dedup_last_wins_and_idempotent(spark):
    df = spark.createDataFrame([("c", "t", 1, 1.0, 1), ("c", "t", 1, 2.0, 5), ("c", "t", 2, 3.0, 2)],
                               "company_id string, tag_id string, ts int, value double, ingest_seq int")
    once = dedup.replace_dedup(df, ["company_id", "tag_id", "ts"])
    assert sorted((r.ts, r.value) for r in once.collect()) == [(1, 2.0), (2, 3.0)]
    twice = dedup.replace_dedup(dedup.replace_dedup(df, ["company_id", "tag_id", "ts"], keep_seq=True),
                                ["company_id", "tag_id", "ts"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_compact_touched_leaves_other_partitions(spark):
    path = session.scratch_dir(spark, "t-compact")
    rows = [("a", "t", "2024-01-31 22:30:00", 1.0, 1), ("a", "t", "2024-01-31 22:30:00", 1.0, 2),
            ("b", "t", "2024-03-01 00:00:00", 5.0, 1), ("b", "t", "2024-03-01 00:00:00", 6.0, 2)]
    df = spark.createDataFrame(rows, "company_id string, tag_id string, ts string, value double, ingest_seq long") \
              .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    sink_append(df, path)
    touched = dedup.touched_partitions(df.where("company_id = 'a'"))
    dedup.compact_touched(spark, path, touched, ["company_id", "tag_id", "ts"])
    back = spark.read.schema("company_id string, tag_id string, ts timestamp_ntz, value double, "
                             "ingest_seq long, month string").parquet(path)
    got = sorted((r.company_id, r.month, r.value) for r in back.collect())
    assert got == [("a", "202401", 1.0), ("b", "202403", 5.0), ("b", "202403", 6.0)]


def test_compaction_keeps_numeric_looking_company_ids(spark):
    path = session.scratch_dir(spark, "t-compact-ids")
    df = spark.createDataFrame([("0123", "t", "2024-01-05 00:00:00", 1.0, 1), ("0123", "t", "2024-01-05 00:00:00", 2.0, 2)],
                               "company_id string, tag_id string, ts string, value double, ingest_seq long") \
              .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    sink_append(df, path)
    dedup.compact_touched(spark, path, dedup.touched_partitions(df), ["company_id", "tag_id", "ts"])
    back = dedup.read_partitioned(spark, path).collect()
    assert [(r.company_id, r.month, r.value) for r in back] == [("0123", "202401", 2.0)]


def test_rank_is_one_algorithm_on_the_native_order(spark):
    """Nulls are oldest, BIGINT beyond 2**53 stays exact, null keys rank, one key holds most rows."""
    big = 2 ** 53
    rows = [("k", None), ("k", 5), ("k", big), ("k", big + 1), (None, 1), (None, 2)] + [("hot", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, seq long")
    got = {(r.k, r.seq): r.rank_in_key for r in dedup.last_write_rank(df, ["k"], "seq").collect()}
    assert [got["k", s] for s in (big + 1, big, 5, None)] == [1, 2, 3, 4]
    assert got[None, 2] == 1 and got[None, 1] == 2
    assert all(got["hot", i] == 2000 - i for i in range(2000))


def test_rank_orders_structs_and_splits_ties(spark):
    df = spark.range(1000).selectExpr("'k' AS k", "id", "struct(id % 10 AS run, cast(id AS string) AS file) AS seq")
    ranks = {r.id: r.rank_in_key for r in dedup.last_write_rank(df, ["k"], "seq").collect()}
    order = sorted(range(1000), key=lambda i: (i % 10, str(i)), reverse=True)
    assert [ranks[i] for i in order] == list(range(1, 1001))
    tied = df.selectExpr("k", "id", "1 AS seq")
    assert sorted(r.rank_in_key for r in dedup.last_write_rank(tied, ["k"], "seq").collect()) == list(range(1, 1001))


def test_last_write_flag_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", None)], "k string, seq long")
    got = {(r.k, r.seq): r.is_last for r in dedup.last_write_flag(df, ["k"], "seq").collect()}
    assert got == {(None, 1): False, (None, 2): True, ("a", 3): True, ("a", None): False}


def test_touched_rows_are_pruned_at_the_scan(spark, tmp_path):
    from telemetra.session import materialize
    path = str(tmp_path / "table")
    df = spark.range(60).selectExpr("id AS v", "date_format(add_months(DATE'2024-01-01', cast(id % 6 AS int)), 'yyyyMM') AS month",
                                    "concat('c', id % 3) AS company_id")
    df.write.partitionBy("month", "company_id").parquet(path)
    touched = materialize(df.where("month IN ('202402', '202403') AND company_id = 'c1'").select("month", "company_id").distinct())
    rows = dedup.touched_rows(dedup.read_partitioned(spark, path), touched)
    plan = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    filters = [x for x in plan.splitlines() if "PartitionFilters" in x]
    assert any("month" in x and ">= 2024" in x and "dynamicpruning" in x for x in filters), plan
    assert {(r.month, r.company_id) for r in rows.collect()} == {(r.month, r.company_id) for r in touched.collect()}
