"""Ingest rules (P4–P7, A1, T3): boundaries, precedence, counters."""

from datetime import datetime

from pyspark.sql import functions as F

from telemetra.operators import validate

NOW = "2024-06-01 12:00:00"
ROWS = [  # (id, ts, value)
    (1, "2024-06-01 12:00:00", 1.0),          # exactly now → accepted
    (2, "2024-06-01 12:00:01", 1.0),          # now + 1 s → future
    (3, "2024-06-01 11:59:59", 1.0),          # now − 1 s → accepted
    (4, "2024-05-31 12:00:00", 1.0),          # exactly the cutoff (24 h) → accepted
    (5, "2024-05-31 11:59:59", 1.0),          # cutoff − 1 s → too old
    (6, "2024-05-31 12:00:01", 1.0),          # cutoff + 1 s → accepted
    (7, None, 1.0),                           # NULL ts → accepted
    (8, "2024-06-01 00:00:00", float("nan")),
    (9, "2024-06-01 00:00:00", float("inf")),
    (10, "2024-06-01 00:00:00", float("-inf")),
    (11, "2024-06-01 00:00:00", None),
    (12, "2024-06-02 00:00:00", float("nan")),  # bad value and future → bad_value first
]


def _df(spark):
    df = spark.createDataFrame(ROWS, "id int, ts string, value double")
    return df.select("id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.lit("t").alias("tag_id"), "value")


def test_reasons_and_boundaries(spark):
    got = {r.id: r.reason for r in validate.annotate(_df(spark), NOW, 24).collect()}
    assert got == {1: None, 2: "timestamp_future", 3: None, 4: None, 5: "timestamp_too_old", 6: None,
                   7: None, 8: "bad_value", 9: "bad_value", 10: "bad_value", 11: "bad_value",
                   12: "bad_value"}


def test_counts_add_up(spark):
    marked = validate.annotate(_df(spark), datetime(2024, 6, 1, 12), 24)
    c = validate.discard_counts(marked).first()
    assert (c.bad_value, c.timestamp_future, c.timestamp_too_old) == (5, 1, 1)
    assert c.accepted + c.discarded == len(ROWS)
    assert c.discarded == c.bad_value + c.timestamp_future + c.timestamp_too_old


def test_valid_rows_get_company_and_order(spark):
    valid, rejected = validate.apply_ingest_rules(_df(spark), NOW, "acme", 24)
    assert valid.columns == ["company_id", "tag_id", "value", "ts"]
    assert {r.company_id for r in valid.collect()} == {"acme"}
    assert valid.count() + rejected.count() == len(ROWS)


def test_lateness_filter_uses_fixed_clock(spark):
    kept = {r.id for r in validate.lateness_filter(_df(spark), NOW, 24).collect()}
    assert 5 not in kept and {1, 2, 4, 6, 7} <= kept
