"""Catalog: flows that write and read files and tables (S1, S2, S3, S9, S10, S12, S13, S14,
A3, A6, A9, A13, A16, E1, O4, U3, U4, W3, T1, T2, T4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra import session
from telemetra.constants import EXPORT_TS_COLUMN
from telemetra.operators import dedup, reshape, typed_json as tj, validate
from telemetra.operators.clock import clock_shift, offset_hours
from telemetra.operators.ledger import import_totals, upsert_by_key
from telemetra.plans import flows, roles
from telemetra.plans.registry import register, with_ctes
from telemetra.sources.csv_readings import scan_readings_csv
from telemetra.sources.incremental import append_ledger, read_ledger
from telemetra.sources.tables import read_wide_csv, sink_append, sink_wide_csv
from telemetra.sources.typed_json_files import discover_files, limit_per_file, read_lines, write_lines
from telemetra.streaming.file_stream import stream_import

R, M, TI, PR = roles.SQL_EVENTS_READINGS, roles.SQL_REASON, roles.SQL_TYPED_ITEMS, roles.SQL_PROJ_ROWS
OR = roles.SQL_ORDERS_READINGS
NOW, H, C = roles.NOW, roles.MAX_PAST_H, roles.COMPANY
#: Event types that sort below this are the first of two imports, the others the second.
SECOND_FROM = "m"


# --- fixtures written by the queries ---------------------------------------------------

def _event_type_of(path_col):
    return F.regexp_extract(path_col, r"event_type=([^/]+)/", 1)


def write_event_csvs(spark, sf, dump: str, types=None, bad_ts: bool = False) -> None:
    """Events-as-readings as interchange CSV, one file per event type (``event_type=<t>/``);
    ``types`` is a condition on the type."""
    r = roles.events_readings(spark, sf)
    if types is not None:
        r = r.where(types(F.col("tag_id")))
    ts_txt = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS'+00:00'")
    if bad_ts:
        ts_txt = F.when((F.col("tag_id") == "error") & (F.col("event_id") % 50 == 0), F.lit("garbage")).otherwise(ts_txt)
    out = r.select(ts_txt.alias("ts"), "tag_id", F.col("value").cast("string").alias("value"),
                   F.col("tag_id").alias("event_type"))
    (out.repartition("event_type").write.mode("append").option("header", "true")
        .partitionBy("event_type").csv(dump))


def write_typed_files(spark, sf, dump: str, types=None, lines: DataFrame | None = None) -> None:
    """Typed-JSON export files (gzip), one per event type, lines in event_id order."""
    df = lines if lines is not None else roles.events_typed_lines(spark, sf)
    if types is not None:
        df = df.where(types(F.col("event_type")))
    df = df.repartition("event_type").sortWithinPartitions("event_type", "pos")
    write_lines(df, dump, gzip=True, partition_by=["event_type"])


def _hadoop(spark, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def add_manifest_and_noise(spark, sf, dump: str) -> None:
    """A ``manifest-*.json.gz`` (whose items would produce rows) and a non-gz file."""
    tmp = session.scratch_dir(spark, "manifest")
    write_lines(roles.events_typed_lines(spark, sf), tmp, gzip=True)
    fs, _, jvm = _hadoop(spark, tmp)
    part = [s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(tmp))
            if s.getPath().getName().startswith("part-")][0]
    fs.rename(part, jvm.org.apache.hadoop.fs.Path(f"{dump}/event_type=click/manifest-0001.json.gz"))
    tmp2 = session.scratch_dir(spark, "noise")
    write_lines(roles.events_typed_lines(spark, sf), tmp2, gzip=False)
    part2 = [s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(tmp2))
             if s.getPath().getName().startswith("part-")][0]
    fs.rename(part2, jvm.org.apache.hadoop.fs.Path(f"{dump}/event_type=view/items.json"))


# --- CSV import flow ---------------------------------------------------------------------

_STATS_SQL = with_ctes(R, M, body="""
SELECT tag_id AS event_type, count(*) AS "read", count(*) FILTER (WHERE reason IS NULL) AS inserted,
       count(*) FILTER (WHERE reason IS NOT NULL) AS discarded
FROM ev_m GROUP BY tag_id""")


def _run_import(spark, sf, bad_ts=False):
    dump = session.scratch_dir(spark, "dump")
    write_event_csvs(spark, sf, dump, bad_ts=bad_ts)
    base = session.scratch_dir(spark, "readings")
    res = flows.import_readings_csv(spark, dump, f"{base}/table", f"{base}/ledger", NOW, C, H, run_id=1)
    return res, base


def _ledger_by_type(ledger):
    return ledger.select(_event_type_of(F.concat(F.lit("/"), F.col("file"))).alias("event_type"),
                         "read", "inserted", "discarded")


@register("import_ledger", "S13 S3 A2 P7", _STATS_SQL)
def import_ledger(spark, sf):
    _, base = _run_import(spark, sf)
    return _ledger_by_type(read_ledger(spark, f"{base}/ledger"))


@register("incremental_import", "S12 J5", with_ctes(R, M, body="""
SELECT tag_id AS event_type, CASE WHEN tag_id < 'm' THEN 1 ELSE 2 END AS run,
       count(*) AS "read", count(*) FILTER (WHERE reason IS NULL) AS inserted,
       count(*) FILTER (WHERE reason IS NOT NULL) AS discarded
FROM ev_m GROUP BY tag_id"""))
def incremental_import(spark, sf):
    dump = session.scratch_dir(spark, "dump")
    base = session.scratch_dir(spark, "readings")
    write_event_csvs(spark, sf, dump, types=lambda t: t < SECOND_FROM)
    r1 = flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", NOW, C, H, run_id=1)
    write_event_csvs(spark, sf, dump, types=lambda t: t >= SECOND_FROM)
    r2 = flows.import_readings_csv(spark, dump, f"{base}/t", f"{base}/l", NOW, C, H, run_id=2)
    return (_ledger_by_type(r1.ledger).withColumn("run", F.lit(1))
            .unionByName(_ledger_by_type(r2.ledger).withColumn("run", F.lit(2))))


@register("ledger_totals", "A3 F6", with_ctes(R, M, body="""
SELECT tag_id AS file, CAST(count(*) AS BIGINT) AS "read", CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS inserted,
       CAST(count(*) FILTER (WHERE reason IS NOT NULL) AS BIGINT) AS discarded, count(DISTINCT tag_id) AS files
FROM ev_m GROUP BY ROLLUP (tag_id)"""))
def ledger_totals(spark, sf):
    _, base = _run_import(spark, sf)
    led = _ledger_by_type(read_ledger(spark, f"{base}/ledger")).withColumnRenamed("event_type", "file")
    return import_totals(led)


@register("run_totals", "A16 E1", with_ctes(R, M, body="""
SELECT count(DISTINCT tag_id) AS files, count(*) AS "read", count(*) FILTER (WHERE reason IS NULL) AS inserted,
       count(*) FILTER (WHERE reason IS NOT NULL) AS discarded, CAST(1 AS BIGINT) AS failed_files
FROM ev_m WHERE tag_id <> 'error'"""))
def run_totals_q(spark, sf):
    res, _ = _run_import(spark, sf, bad_ts=True)
    return res.totals


@register("file_fault_isolation", "E1", with_ctes(R, M, body="""
SELECT tag_id AS event_type, CASE WHEN tag_id = 'error' THEN 'failed' ELSE 'done' END AS status,
       CASE WHEN tag_id = 'error' THEN 0 ELSE count(*) FILTER (WHERE reason IS NULL) END AS inserted
FROM ev_m GROUP BY tag_id"""))
def file_fault_isolation(spark, sf):
    res, base = _run_import(spark, sf, bad_ts=True)
    done = _ledger_by_type(read_ledger(spark, f"{base}/ledger")).select(
        "event_type", F.lit("done").alias("status"), "inserted")
    failed = res.failed.select(_event_type_of(F.concat(F.lit("/"), F.col("file"))).alias("event_type"),
                               F.lit("failed").alias("status"), F.lit(0).cast("long").alias("inserted"))
    return done.unionByName(failed)


@register("upsert_by_key", "U3", with_ctes(R, M, """
old AS (SELECT tag_id AS file, count(*) AS "read", count(*) FILTER (WHERE reason IS NULL) AS inserted
        FROM ev_m GROUP BY tag_id),
new AS (SELECT tag_id AS file, 2 * count(*) AS "read", count(*) FILTER (WHERE reason IS NULL) AS inserted
        FROM ev_m WHERE tag_id IN ('click', 'view') GROUP BY tag_id)""", body="""
SELECT * FROM old WHERE file NOT IN (SELECT file FROM new) UNION ALL SELECT * FROM new"""))
def upsert_by_key_q(spark, sf):
    m = validate.annotate(roles.events_readings(spark, sf), NOW, H)

    def stats(df):
        return df.groupBy(F.col("tag_id").alias("file")).agg(
            F.count(F.lit(1)).alias("read"), F.count_if(F.col("reason").isNull()).alias("inserted"))
    old = stats(m)
    new = stats(m.where(F.col("tag_id").isin("click", "view"))).withColumn("read", 2 * F.col("read"))
    return upsert_by_key(old, new)


@register("scan_readings_csv", "S3 P3 F9", with_ctes(R, body="""
SELECT tag_id, ts, CASE WHEN isfinite(value) THEN value END AS value FROM ev_r"""))
def scan_readings_csv_q(spark, sf):
    dump = session.scratch_dir(spark, "dump")
    write_event_csvs(spark, sf, dump)
    return scan_readings_csv(spark, dump).select("tag_id", "ts", "value")


@register("sink_append", "S9", with_ctes(R, M, body=f"""
SELECT '{C}' AS company_id, tag_id, value, ts, strftime(ts, '%Y%m') AS month FROM ev_m WHERE reason IS NULL"""))
def sink_append_q(spark, sf):
    valid, _ = validate.apply_ingest_rules(roles.events_readings(spark, sf), NOW, C, H)
    path = session.scratch_dir(spark, "append")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    sink_append(valid.where(F.col("ts") < cut), path, batch_rows=1000)
    sink_append(valid.where(F.col("ts") >= cut), path, batch_rows=1000)
    return spark.read.schema("company_id STRING, tag_id STRING, value DOUBLE, ts TIMESTAMP_NTZ, month STRING") \
                .parquet(path).select("company_id", "tag_id", "value", "ts", "month")


_HOURLY = """
hourly AS (SELECT date_trunc('hour', ts) AS ts, event_type AS tag_id, value, event_id FROM events),
cells AS (SELECT ts, tag_id, min_by(value, event_id) AS value FROM hourly WHERE value IS NOT NULL GROUP BY ts, tag_id)"""
_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("sink_wide_csv", "S10 R2 O2 F12", with_ctes(_HOURLY, body=f"""
SELECT strftime(ts, '%Y-%m-%d %H:%M') AS "{EXPORT_TS_COLUMN}", """ + ", ".join(
    f"max(value) FILTER (WHERE tag_id = '{t}') AS {t}" for t in _TYPES) + " FROM cells GROUP BY ts"))
def sink_wide_csv_q(spark, sf):
    hourly = roles.table(spark, sf, "events").select(F.date_trunc("hour", "ts").alias("ts"),
                                                   F.col("event_type").alias("tag_id"), "value", "event_id")
    wide = reshape.wide_export_frame(reshape.pivot_wide(hourly, order_col="event_id"))
    path = session.scratch_dir(spark, "wide")
    sink_wide_csv(wide, path)
    back = read_wide_csv(spark, path)
    return back.select(EXPORT_TS_COLUMN, *[F.col(t).cast("double").alias(t) for t in back.columns
                                           if t != EXPORT_TS_COLUMN])


@register("export_ledger", "S14 F5 F14 F15 A14", with_ctes(OR, """
s AS (SELECT DISTINCT company_id, ts FROM ord_r
      WHERE ts >= TIMESTAMP '1996-01-01' AND ts <= TIMESTAMP '1997-12-31' AND value IS NOT NULL)""", body="""
SELECT company_id || '_1996-01-01_000000_a_1997-12-31_000000.csv' AS file, company_id AS company,
       '1996-01-01 00:00:00 → 1997-12-31 00:00:00' AS period, count(*) AS rows
FROM s GROUP BY company_id"""))
def export_ledger(spark, sf):
    from telemetra.operators.ledger import EXPORT_LEDGER
    o = roles.orders_readings(spark, sf).withColumnRenamed("o_orderkey", "ingest_seq")
    requests = o.select("company_id").distinct().select(
        "company_id", F.lit("1996-01-01-00:00").alias("date_ini"), F.lit("1997-12-31 00:00:00").alias("date_end"))
    entries = flows.export_entries(o, requests, now=roles.ORDERS_NOW)
    path = session.scratch_dir(spark, "export-ledger")
    append_ledger(spark, path, entries, EXPORT_LEDGER)
    return read_ledger(spark, path, EXPORT_LEDGER).select("file", "company", "period", "rows")


# --- touched partitions and consolidation ----------------------------------------------

_OV = ", ".join(str(u) for u in roles.OVERRIDE_USERS)
_LI_TOUCHED = f"""
SELECT DISTINCT l_returnflag AS company_id,
       strftime(l_shipdate + to_hours(CASE WHEN l_suppkey IN ({_OV}) THEN 4 ELSE 3 END), '%Y%m') AS month
FROM lineitem"""


def _li_readings(spark, sf):
    li = roles.table(spark, sf, "lineitem")
    r = li.select(F.col("l_returnflag").alias("company_id"), F.col("l_suppkey").cast("string").alias("process_id"),
                  F.col("l_shipdate").alias("ts"), "l_linenumber")
    return clock_shift(r, [str(u) for u in roles.OVERRIDE_USERS])


@register("touched_partitions", "A6 F10 F11", _LI_TOUCHED)
def touched_partitions(spark, sf):
    return dedup.touched_partitions(_li_readings(spark, sf))


@register("order_partitions", "O4", _LI_TOUCHED + " ORDER BY company_id, month")
def order_partitions(spark, sf):
    from telemetra.operators.ordering import order_partitions as op
    return op(dedup.touched_partitions(_li_readings(spark, sf)))


@register("touched_accumulate", "U4", _LI_TOUCHED)
def touched_accumulate(spark, sf):
    r = _li_readings(spark, sf)
    a = dedup.touched_partitions(r.where(F.col("l_linenumber") % 2 == 1))
    b = dedup.touched_partitions(r.where(F.col("l_linenumber") % 2 == 0))
    return dedup.touched_union(a, b)


_SEQ2 = 1_000_000_000
# events as projections, company = co<user_id % 3>. Batch 1: every event (seq = event_id)
# plus the 'view' events again with value × 2 (raw duplicates in every partition).
# Batch 2: the 'click' events of company co1 with value × 3 → touches only (202401, co1).
_BATCHES = f"""
WITH b AS (
  SELECT 'co' || CAST(user_id % 3 AS VARCHAR) AS company_id, CAST(user_id AS VARCHAR) AS process_id,
         event_type AS tag_id, value, ts, event_id AS seq FROM events
  UNION ALL SELECT 'co' || CAST(user_id % 3 AS VARCHAR), CAST(user_id AS VARCHAR), event_type, value * 2, ts,
         event_id + {_SEQ2} FROM events WHERE event_type = 'view'
  UNION ALL SELECT 'co' || CAST(user_id % 3 AS VARCHAR), CAST(user_id AS VARCHAR), event_type, value * 3, ts,
         event_id + 2 * {_SEQ2} FROM events WHERE event_type = 'click' AND user_id % 3 = 1),
bm AS (SELECT *, strftime(ts, '%Y%m') AS month FROM b),
t AS (SELECT DISTINCT month, company_id FROM bm WHERE seq >= 2 * {_SEQ2}),
ins AS (SELECT bm.* FROM bm JOIN t USING (month, company_id)),
outs AS (SELECT bm.* FROM bm ANTI JOIN t USING (month, company_id))
SELECT company_id, process_id, tag_id, value, ts, month FROM outs
UNION ALL
SELECT company_id, process_id, tag_id, value, ts, month FROM ins
QUALIFY row_number() OVER (PARTITION BY company_id, process_id, tag_id, ts ORDER BY seq DESC) = 1"""


def _event_batches(spark, sf):
    ev = roles.table(spark, sf, "events")
    base = ev.select(F.concat(F.lit("co"), (F.col("user_id") % 3).cast("string")).alias("company_id"),
                     F.col("user_id").cast("string").alias("process_id"), F.col("event_type").alias("tag_id"),
                     "value", "ts", "event_id")
    b1 = base.select("company_id", "process_id", "tag_id", "value", "ts", F.col("event_id").alias("ingest_seq")) \
        .unionByName(base.where(F.col("tag_id") == "view").select(
            "company_id", "process_id", "tag_id", (F.col("value") * 2).alias("value"), "ts",
            (F.col("event_id") + _SEQ2).alias("ingest_seq")))
    b2 = base.where((F.col("tag_id") == "click") & (F.col("company_id") == "co1")).select(
        "company_id", "process_id", "tag_id", (F.col("value") * 3).alias("value"), "ts",
        (F.col("event_id") + 2 * _SEQ2).alias("ingest_seq"))
    return b1, b2


_TABLE_SCHEMA = ("company_id STRING, process_id STRING, tag_id STRING, value DOUBLE, ts TIMESTAMP_NTZ, "
                 "ingest_seq BIGINT, month STRING")


@register("compact_touched", "A9 A8 S9", _BATCHES)
def compact_touched(spark, sf):
    b1, b2 = _event_batches(spark, sf)
    path = session.scratch_dir(spark, "projections")
    sink_append(b1, path)
    sink_append(b2, path)
    dedup.compact_touched(spark, path, dedup.touched_partitions(b2), dedup.PROJECTIONS_KEY)
    return spark.read.schema(_TABLE_SCHEMA).parquet(path).drop("ingest_seq")


@register("compact_table", "A13", with_ctes(OR, f"""
b AS (SELECT company_id, process_id, ts, value AS "index", o_orderkey AS seq FROM ord_r
      UNION ALL SELECT company_id, process_id, ts, value * 2, o_orderkey + {_SEQ2} FROM ord_r)""", body="""
SELECT company_id, process_id, ts, "index" FROM b
QUALIFY row_number() OVER (PARTITION BY company_id, process_id, ts ORDER BY seq DESC) = 1"""))
def compact_table(spark, sf):
    o = roles.orders_readings(spark, sf)
    b1 = o.select("company_id", "process_id", "ts", F.col("value").alias("index"), F.col("o_orderkey").alias("ingest_seq"))
    b2 = o.select("company_id", "process_id", "ts", (F.col("value") * 2).alias("index"),
                  (F.col("o_orderkey") + _SEQ2).alias("ingest_seq"))
    path = session.scratch_dir(spark, "predictions")
    sink_append(b1, path, partitioned=False)
    sink_append(b2, path, partitioned=False)
    dedup.compact_table(spark, path, dedup.PREDICTIONS_KEY, inserted_rows=1)
    return spark.read.parquet(path).drop("ingest_seq")


# --- typed-JSON files ---------------------------------------------------------------------

@register("scan_typed_json", "S1 F22 R1", with_ctes(TI, PR, body="""
SELECT company_id, process_id, tag_id, value, ts FROM proj"""))
def scan_typed_json(spark, sf):
    dump = session.scratch_dir(spark, "typed")
    write_typed_files(spark, sf, dump)
    lines = read_lines(spark, dump).drop("block")
    return tj.projections(lines, C, overrides=roles.override_ids())


@register("discover_files", "S2 U2 O6", with_ctes(TI, body="""
SELECT event_type, count(*) FILTER (WHERE NOT blank) AS lines FROM ti GROUP BY event_type"""))
def discover_files_q(spark, sf):
    dump = session.scratch_dir(spark, "typed")
    write_typed_files(spark, sf, dump)
    add_manifest_and_noise(spark, sf, dump)
    files = discover_files(spark, dump)
    lines = read_lines(spark, dump)
    counted = (lines.where(F.trim("value") != "").groupBy("file").agg(F.count(F.lit(1)).alias("lines")))
    return (files.join(counted, "file", "left")
                 .select(_event_type_of(F.col("file")).alias("event_type"),
                         F.coalesce("lines", F.lit(0)).cast("long").alias("lines")))


@register("limit_per_file", "W3", with_ctes(TI, """
nb AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS line_no FROM ti WHERE NOT blank)""",
    body="SELECT event_type, line_no FROM nb WHERE line_no <= 100"))
def limit_per_file_q(spark, sf):
    dump = session.scratch_dir(spark, "typed")
    write_typed_files(spark, sf, dump)
    kept = limit_per_file(read_lines(spark, dump), 100)
    return kept.select(_event_type_of(F.col("file")).alias("event_type"), "line_no")


def _stream(spark, sf, dump, base, ckpt):
    q = stream_import(spark, dump, f"{base}/table", f"{base}/ledger", f"{base}/touched", ckpt, C,
                      flow="projections", overrides=roles.override_ids(), max_files_per_trigger=2)
    q.awaitTermination()


_PROJ_TABLE = ("company_id STRING, process_id STRING, tag_id STRING, value DOUBLE, ts TIMESTAMP_NTZ, "
               "ingest_seq STRUCT<run: BIGINT, batch: BIGINT, file: STRING, pos: BIGINT>, month STRING")


@register("stream_import", "T1 S9", with_ctes(TI, PR, body="""
SELECT company_id, process_id, tag_id, value, ts FROM proj"""))
def stream_import_q(spark, sf):
    dump, base = session.scratch_dir(spark, "typed"), session.scratch_dir(spark, "stream")
    write_typed_files(spark, sf, dump)
    _stream(spark, sf, dump, base, f"{base}/_checkpoint")
    return spark.read.schema(_PROJ_TABLE).parquet(f"{base}/table").select(
        "company_id", "process_id", "tag_id", "value", "ts")


@register("only_new_files", "T2 S12", with_ctes(TI, PR, body="""
SELECT company_id, process_id, tag_id, value, ts FROM proj"""))
def only_new_files(spark, sf):
    dump, base = session.scratch_dir(spark, "typed"), session.scratch_dir(spark, "stream")
    write_typed_files(spark, sf, dump, types=lambda t: t < SECOND_FROM)
    _stream(spark, sf, dump, base, f"{base}/_checkpoint")
    write_typed_files(spark, sf, dump, types=lambda t: t >= SECOND_FROM)
    _stream(spark, sf, dump, base, f"{base}/_checkpoint")
    return spark.read.schema(_PROJ_TABLE).parquet(f"{base}/table").select(
        "company_id", "process_id", "tag_id", "value", "ts")


# The consolidation key (company, process, tag, ts) is unique in this fixture at every scale
# factor (checked with the SQL below), so after a replay and consolidation every row must
# be there exactly once: the oracle is the single import.
@register("replay_idempotence", "T4 A9", with_ctes(TI, PR, body="""
SELECT company_id, process_id, tag_id, value, ts FROM proj"""))
def replay_idempotence(spark, sf):
    """Import the same files twice (second run with a fresh checkpoint = a replay), then
    consolidate the touched partitions: the table equals a single consolidated import."""
    dump, base = session.scratch_dir(spark, "typed"), session.scratch_dir(spark, "stream")
    write_typed_files(spark, sf, dump)
    _stream(spark, sf, dump, base, f"{base}/_ck1")
    _stream(spark, sf, dump, base, f"{base}/_ck2")
    touched = spark.read.parquet(f"{base}/touched").distinct()
    dedup.compact_touched(spark, f"{base}/table", touched, dedup.PROJECTIONS_KEY)
    return spark.read.schema(_PROJ_TABLE).parquet(f"{base}/table").select(
        "company_id", "process_id", "tag_id", "value", "ts")


@register("replay_correction", "A8 T4 S12", with_ctes(TI, PR, body="""
SELECT company_id, process_id, tag_id, CASE WHEN tag_id = 'click' THEN value * 2 ELSE value END AS value, ts FROM proj"""))
def replay_correction(spark, sf):
    """A corrected file from a lower path, imported later through another checkpoint, wins."""
    first, later, base = (session.scratch_dir(spark, x) for x in ("typed", "corrected", "stream"))
    lines = roles.events_typed_lines(spark, sf)
    write_typed_files(spark, sf, f"{first}/b", lines=lines)
    _stream(spark, sf, f"{first}/b", base, f"{base}/_ck1")
    table = spark.read.schema(_PROJ_TABLE).parquet(f"{base}/table")
    fixed = session.materialize(table.where("tag_id = 'click'").select(
        "company_id", "process_id", "tag_id", (F.col("value") * 2).alias("value"), "ts"))
    text = F.to_json(F.struct(*[F.struct(F.col(c).cast("string").alias("S")).alias(c) for c in ("company_id", "process_id", "tag_id")],
                              F.struct(F.col("value").cast("string").alias("N")).alias("value"),
                              F.struct(F.date_format(F.expr("ts - make_dt_interval(0, h)"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("S")).alias("timestamp")))
    shifted = offset_hours(fixed, roles.override_ids()).withColumnRenamed("offset_h", "h")
    write_lines(shifted.select(text.alias("value"), F.lit("click").alias("event_type")), f"{later}/a", gzip=True, partition_by=["event_type"])
    _stream(spark, sf, f"{later}/a", base, f"{base}/_ck2")
    dedup.compact_touched(spark, f"{base}/table", spark.read.parquet(f"{base}/touched").distinct(), dedup.PROJECTIONS_KEY)
    return spark.read.schema(_PROJ_TABLE).parquet(f"{base}/table").select("company_id", "process_id", "tag_id", "value", "ts")


@register("typed_json_flow", "S12 S13 A2 A9 E2", with_ctes(TI, PR, body="""
SELECT 'rows' AS kind, count(*) AS n FROM proj UNION ALL
SELECT 'second run', 0 UNION ALL
SELECT 'lines', count(*) FILTER (WHERE NOT blank) FROM ti"""))
def typed_json_flow(spark, sf):
    """Batch import with ledger, quarantine and consolidation, twice: the second run finds
    nothing pending and adds nothing."""
    dump, base = session.scratch_dir(spark, "typed"), session.scratch_dir(spark, "batch")
    write_typed_files(spark, sf, dump)
    run = lambda: flows.import_typed_json(spark, dump, f"{base}/table", "projections", C, roles.override_ids(), ledger_path=f"{base}/ledger")
    run()
    table = lambda: spark.read.schema(_PROJ_TABLE).parquet(f"{base}/table").agg(F.count("*").alias("n"))
    once = session.materialize(table())
    run()
    ledger = read_ledger(spark, f"{base}/ledger")
    return (once.select(F.lit("rows").alias("kind"), "n")
            .union(table().select(F.lit("second run"), F.col("n") - F.lit(once.first()["n"])))
            .union(ledger.select(F.lit("lines"), F.sum("read"))))


# --- whole flows --------------------------------------------------------------------------

@register("export_wide_flow", "S5 A8 R2 O2 F12 F14 F15 S10 S14", with_ctes(OR, """
s AS (SELECT ts, tag_id, value FROM ord_r
      WHERE company_id = '1-URGENT' AND ts >= TIMESTAMP '1996-01-01' AND ts <= TIMESTAMP '1997-12-31'
      QUALIFY row_number() OVER (PARTITION BY company_id, tag_id, ts ORDER BY o_orderkey DESC) = 1)""", body=f"""
SELECT strftime(ts, '%Y-%m-%d %H:%M') AS "{EXPORT_TS_COLUMN}",
       max(value) FILTER (WHERE tag_id = 'F') AS F, max(value) FILTER (WHERE tag_id = 'O') AS O,
       max(value) FILTER (WHERE tag_id = 'P') AS P
FROM s GROUP BY ts"""))
def export_wide_flow(spark, sf):
    from telemetra.operators.ledger import EXPORT_LEDGER
    readings = roles.orders_readings(spark, sf).withColumnRenamed("o_orderkey", "ingest_seq")
    out, led = session.scratch_dir(spark, "export"), session.scratch_dir(spark, "export-ledger")
    flows.export_wide(spark, readings, "1-URGENT", "1996-01-01-00:00", "1997-12-31 00:00:00", None,
                      out, led, now=roles.ORDERS_NOW)
    assert read_ledger(spark, led, EXPORT_LEDGER).count() == 1
    back = read_wide_csv(spark, out)
    return back.select(EXPORT_TS_COLUMN, *[F.col(c).cast("double").alias(c) for c in back.columns
                                           if c != EXPORT_TS_COLUMN])


@register("source_to_readings", "S4 F10 P7 P17 P20", with_ctes(roles.SQL_EVENTS_SOURCE, roles.SQL_MONTHS,
                                                             roles.SQL_GRID, f"""
x AS (SELECT s.tagId AS tag_id, s.value,
             s."timestamp" + to_hours(CASE WHEN s.processId IN ({_OV}) THEN 4 ELSE 3 END) AS ts
      FROM src s JOIN grid g ON g.process_id = CAST(s.processId AS VARCHAR)
       AND s."timestamp" >= g.start AND s."timestamp" < g."end")""", body=f"""
SELECT '{C}' AS company_id, tag_id, value, ts FROM x
WHERE NOT (value IS NULL OR isnan(value) OR isinf(value)) AND NOT ts > TIMESTAMP '{NOW}'
  AND NOT ts < TIMESTAMP '{NOW}' - INTERVAL {H} HOUR"""))
def source_to_readings(spark, sf):
    """Extraction → clock shift → ingest rules: rows shifted past ``now`` become future."""
    from telemetra.operators import extract as ex
    src = roles.events_source(spark, sf)
    grid = ex.work_grid(ex.distinct_processes(src), roles.EXTRACT_NOW, roles.EXTRACT_DAYS)
    rows = ex.scan_source_range(src, grid, [str(u) for u in roles.OVERRIDE_USERS])
    valid, _ = validate.apply_ingest_rules(rows, NOW, C, H)
    return valid
