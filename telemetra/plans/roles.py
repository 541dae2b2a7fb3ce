"""Role mapping of the driver tables onto the sensor data model.

``events``   → readings: process = user_id, tag = event_type, value, ts; bad values
               (NaN, ±Inf, NULL) injected by a CASE on event_id so every rule fires.
``events``   → typed-JSON export lines (one item per event) with every item shape.
``orders``   → readings-like: company = o_orderpriority, process = o_custkey,
               tag = o_orderstatus, value = o_totalprice, ts = o_orderdate.
``part``     → process hierarchy (parent = p_partkey div 2, root = 0) with a two-cycle,
               missing parents, NULL levels and a long chain; and model configs.
``lineitem`` → wide rows with four measures.

Each Spark builder has a SQL twin (DuckDB dialect) producing the same rows; the oracle
queries in ``catalog`` are written on top of the twins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra import session

# --- fixed parameters of the catalog --------------------------------------------------
NOW = "2024-01-25 00:00:00"           # ingest clock for events (inside the data range)
MAX_PAST_H = 480                      # age limit used with NOW (cutoff 2024-01-05)
COMPANY = "acme"                      # configured default company
OVERRIDE_USERS = [3, 17, 42]          # processes on the alternative clock offset
EXTRACT_NOW = "2024-02-10 00:00:00"   # extraction clock
EXTRACT_DAYS = 45                     # look-back → months 2023-12, 2024-01, 2024-02
RANGE_CAP = 40                        # row cap per source range (T5)
ORDERS_NOW = "1998-08-02 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session.configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _e() -> Column:
    return F.col("event_id")


# --- events as readings ---------------------------------------------------------------

def events_readings(spark, sf_dir) -> DataFrame:
    e = _e()
    value = (F.when(e % 97 == 0, F.lit(float("nan")))
              .when(e % 89 == 0, F.lit(float("inf")))
              .when(e % 83 == 0, F.lit(float("-inf")))
              .when(e % 79 == 0, F.lit(None).cast("double"))
              .otherwise(F.col("value")))
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("process_id"),
        F.col("event_type").alias("tag_id"), value.alias("value"), "ts")


SQL_EVENTS_READINGS = """
ev_r AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS process_id, event_type AS tag_id,
         CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE
              WHEN event_id % 89 = 0 THEN 'Infinity'::DOUBLE
              WHEN event_id % 83 = 0 THEN '-Infinity'::DOUBLE
              WHEN event_id % 79 = 0 THEN NULL
              ELSE value END AS value,
         ts
  FROM events)"""

SQL_REASON = f"""
ev_m AS (
  SELECT *, CASE WHEN value IS NULL OR isnan(value) OR isinf(value) THEN 'bad_value'
                 WHEN ts > TIMESTAMP '{NOW}' THEN 'timestamp_future'
                 WHEN ts < TIMESTAMP '{NOW}' - INTERVAL {MAX_PAST_H} HOUR THEN 'timestamp_too_old'
            END AS reason
  FROM ev_r)"""


# --- events as typed-JSON export lines ------------------------------------------------
# Item shape is chosen per event by these rules (same in the SQL twin):
#   e % 53 = 0 → blank line;  e % 59 = 0 → malformed line
#   e % 37 = 0 → no process_id;  process_id = 'P-<user_id>' (upper case, hyphen)
#   e % 41 = 0 → "timestamp" is NULL and "ts" present (no fallback);
#   else e % 3 = 0 → only "ts";  else "timestamp"
#   e % 7 = 0 → ts text without seconds, else with microseconds
#   e % 4 = 1 → company 'co<user_id % 3>';  e % 4 = 0 → company "" (default)
#   e % 5 = 0 → long shape (tag_id + value);  else wide: <event_type>, k, flag, note, nul, lst
#   value text: e % 97 = 0 → 'NaN', e % 89 = 0 → '1e400', else the value
#   e % 2 = 0 → wrapped in {"Item": ...};  every item carries "model"

def _q(s: Column) -> Column:
    return F.concat(F.lit('"'), s, F.lit('"'))


def _attr(key: str | Column, letter: str, val: Column, quote: bool = True) -> Column:
    k = F.lit(key) if isinstance(key, str) else key
    return F.concat(F.lit(","), _q(k), F.lit(':{"' + letter + '":'), _q(val) if quote else val, F.lit("}"))


def events_typed_lines(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").repartition(spark.sparkContext.defaultParallelism)
    e, u = _e(), F.col("user_id")
    ts_text = F.when(e % 7 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm")) \
               .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    val_text = (F.when(e % 97 == 0, F.lit("NaN")).when(e % 89 == 0, F.lit("1e400"))
                 .otherwise(F.col("value").cast("string")))
    pid = F.when(e % 37 == 0, F.lit("")).otherwise(
        _attr("process_id", "S", F.concat(F.lit("P-"), u.cast("string"))))
    tsa = (F.when(e % 41 == 0, F.concat(F.lit(',"timestamp":{"NULL":true}'), _attr("ts", "S", ts_text)))
            .when(e % 3 == 0, _attr("ts", "S", ts_text))
            .otherwise(_attr("timestamp", "S", ts_text)))
    comp = (F.when(e % 4 == 1, _attr("company_id", "S", F.concat(F.lit("co"), (u % 3).cast("string"))))
             .when(e % 4 == 0, F.lit(',"company_id":{"S":""}')).otherwise(F.lit("")))
    k = ((e * 7) % 100).cast("string")
    wide = F.concat(_attr(F.col("event_type"), "N", val_text), _attr("k", "S", k),
                    _attr("flag", "BOOL", F.when(e % 6 < 3, F.lit("true")).otherwise(F.lit("false")), quote=False),
                    _attr("note", "S", F.concat(F.lit("x"), e.cast("string"))),
                    F.lit(',"nul":{"NULL":true},"lst":{"L":[{"N":"1"}]}'))
    long = F.concat(_attr("tag_id", "S", F.col("event_type")), _attr("value", "N", val_text))
    body = F.concat(F.lit("{"), F.substr(F.concat(pid, tsa, comp,
                                                     F.when(e % 5 == 0, long).otherwise(wide),
                                                     _attr("model", "S", F.lit("m1"))), F.lit(2)),
                    F.lit("}"))
    line = (F.when(e % 53 == 0, F.lit("")).when(e % 59 == 0, F.lit("not json {"))
             .when(e % 2 == 0, F.concat(F.lit('{"Item":'), body, F.lit("}"))).otherwise(body))
    return ev.select(F.concat(F.lit("dump/"), F.col("event_type"), F.lit(".json.gz")).alias("file"),
                     e.alias("pos"), line.alias("value"), "event_type")


SQL_TYPED_ITEMS = f"""
ti AS (
  SELECT event_id, user_id, event_type, ts, value,
         event_id % 53 = 0 AS blank,
         event_id % 53 <> 0 AND event_id % 59 = 0 AS malformed,
         event_id % 37 <> 0 AS has_pid,
         CASE WHEN event_id % 41 = 0 THEN 'null_ts' WHEN event_id % 3 = 0 THEN 'ts' ELSE 'timestamp' END AS ts_mode,
         CASE WHEN event_id % 7 = 0 THEN date_trunc('minute', ts) ELSE ts END AS ts_parsed,
         CASE WHEN event_id % 4 = 1 THEN 'co' || CAST(user_id % 3 AS VARCHAR) ELSE '{COMPANY}' END AS company_id,
         event_id % 5 = 0 AS is_long,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE value END AS v,
         CAST((event_id * 7) % 100 AS DOUBLE) AS k,
         CASE WHEN event_id % 6 < 3 THEN 1.0 ELSE 0.0 END AS flag,
         'P-' || CAST(user_id AS VARCHAR) AS process_id,
         'dump/' || event_type || '.json.gz' AS file,
         CASE WHEN user_id IN ({", ".join(str(x) for x in OVERRIDE_USERS)}) THEN 4 ELSE 3 END AS off_h
  FROM events),
tv AS (
  SELECT *, NOT blank AND NOT malformed AND has_pid AND ts_mode <> 'null_ts' AS valid FROM ti)"""

SQL_PROJ_ROWS = """
proj AS (
  SELECT company_id, process_id, event_type AS tag_id, v AS value, ts_parsed + to_hours(off_h) AS ts, event_id, file
    FROM tv WHERE valid AND v IS NOT NULL
  UNION ALL
  SELECT company_id, process_id, 'k', k, ts_parsed + to_hours(off_h), event_id, file FROM tv WHERE valid AND NOT is_long
  UNION ALL
  SELECT company_id, process_id, 'flag', flag, ts_parsed + to_hours(off_h), event_id, file FROM tv WHERE valid AND NOT is_long)"""


def override_ids() -> list[str]:
    """Override processes as they appear in the typed-JSON items (normalised)."""
    return [f"p{u}" for u in OVERRIDE_USERS]


# --- orders as readings ---------------------------------------------------------------

def orders_readings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("company_id"),
        F.col("o_custkey").cast("string").alias("process_id"),
        F.col("o_orderstatus").alias("tag_id"), F.col("o_totalprice").alias("value"),
        F.col("o_orderdate").alias("ts"))


SQL_ORDERS_READINGS = """
ord_r AS (
  SELECT o_orderkey, o_orderpriority AS company_id, CAST(o_custkey AS VARCHAR) AS process_id,
         o_orderstatus AS tag_id, o_totalprice AS value, o_orderdate AS ts
  FROM orders)"""


# --- part as process hierarchy and model configs --------------------------------------

def part_process(spark, sf_dir) -> DataFrame:
    k = F.col("p_partkey")
    level = (F.when(k == 0, F.lit("root"))
              .when(k == 3, F.lit("6"))
              .when(k % 97 == 5, F.concat(F.lit("gone-"), k.cast("string")))
              .when(k % 101 == 7, F.lit(None).cast("string"))
              .when((k > 1024) & (k <= 1174), (k - 1).cast("string"))
              .otherwise((k / 2).cast("long").cast("string")))
    return table(spark, sf_dir, "part").select(k.cast("string").alias("process_id"), level.alias("level"))


SQL_PART_PROCESS = """
proc AS (
  SELECT CAST(p_partkey AS VARCHAR) AS process_id,
         CASE WHEN p_partkey = 0 THEN 'root'
              WHEN p_partkey = 3 THEN '6'
              WHEN p_partkey % 97 = 5 THEN 'gone-' || CAST(p_partkey AS VARCHAR)
              WHEN p_partkey % 101 = 7 THEN NULL
              WHEN p_partkey > 1024 AND p_partkey <= 1174 THEN CAST(p_partkey - 1 AS VARCHAR)
              ELSE CAST(p_partkey // 2 AS VARCHAR) END AS level
  FROM part)"""


def part_configs(spark, sf_dir) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") > 48, F.concat(F.lit("ghost-"), k.cast("string")))
         .otherwise(k.cast("string")).alias("process_id"),
        F.format_string("2024-01-%02d", (F.col("p_size") % 28 + 1).cast("int")).alias("created_at"),
        F.when(k % 3 == 0, F.lit("0")).when(k % 3 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("u"), k.cast("string"))).alias("unit_id"),
        (F.col("p_size") % 4 != 0).alias("active"),
        F.when(F.col("p_brand").endswith("1"), F.lit("OTHER")).otherwise(F.lit("PREDICTION_TRIGGER")).alias("type"))


SQL_PART_CONFIGS = """
cfg AS (
  SELECT CASE WHEN p_size > 48 THEN 'ghost-' || CAST(p_partkey AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) END AS process_id,
         printf('2024-01-%02d', CAST(p_size % 28 + 1 AS INTEGER)) AS created_at,
         CASE WHEN p_partkey % 3 = 0 THEN '0' WHEN p_partkey % 3 = 1 THEN NULL ELSE 'u' || CAST(p_partkey AS VARCHAR) END AS unit_id,
         p_size % 4 <> 0 AS active,
         CASE WHEN p_brand LIKE '%1' THEN 'OTHER' ELSE 'PREDICTION_TRIGGER' END AS type
  FROM part)"""

SQL_RESOLVED = """
walk AS (
  SELECT process_id AS start, process_id AS cur, 0 AS idx, [process_id] AS path, false AS revisit FROM proc
  UNION ALL
  SELECT w.start, q.level, w.idx + 1, list_append(w.path, q.level), list_contains(w.path, q.level)
  FROM walk w JOIN proc q ON q.process_id = w.cur
  WHERE NOT w.revisit AND q.level IS NOT NULL AND q.level <> 'root' AND w.idx < 99),
last_step AS (
  SELECT start, arg_max(cur, idx) AS cur, max(idx) AS idx, bool_or(revisit) AS revisit FROM walk GROUP BY start),
resolved AS (
  SELECT l.start AS process_id,
         CASE WHEN NOT l.revisit AND q.level = 'root' THEN l.cur END AS unit_id,
         CASE WHEN l.revisit THEN 'cycle' WHEN q.process_id IS NULL THEN 'missing'
              WHEN q.level IS NULL THEN 'null_level' WHEN q.level = 'root' THEN NULL ELSE 'depth' END AS error,
         CAST(CASE WHEN l.revisit OR q.process_id IS NULL OR q.level IS NULL OR q.level = 'root' THEN l.idx ELSE 100 END AS INTEGER) AS depth
  FROM last_step l LEFT JOIN proc q ON q.process_id = l.cur)"""


def events_prediction_lines(spark, sf_dir) -> DataFrame:
    """Prediction items: index = value (NaN/1e400 injected), threshold = (e % 10)/10;
    e % 3 = 0 → only a "ts" key (predictions read "timestamp" only → discarded);
    e % 11 = 0 → threshold "abc"; e % 13 = 0 → no threshold; other rules as above."""
    ev = table(spark, sf_dir, "events").repartition(spark.sparkContext.defaultParallelism)
    e, u = _e(), F.col("user_id")
    ts_text = F.when(e % 7 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm")) \
               .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    val_text = (F.when(e % 97 == 0, F.lit("NaN")).when(e % 89 == 0, F.lit("1e400"))
                 .otherwise(F.col("value").cast("string")))
    pid = F.when(e % 37 == 0, F.lit("")).otherwise(
        _attr("process_id", "S", F.concat(F.lit("P-"), u.cast("string"))))
    tsa = F.when(e % 3 == 0, _attr("ts", "S", ts_text)).otherwise(_attr("timestamp", "S", ts_text))
    comp = (F.when(e % 4 == 1, _attr("company_id", "S", F.concat(F.lit("co"), (u % 3).cast("string"))))
             .when(e % 4 == 0, F.lit(',"company_id":{"S":""}')).otherwise(F.lit("")))
    thr = (F.when(e % 11 == 0, _attr("threshold", "S", F.lit("abc"))).when(e % 13 == 0, F.lit(""))
            .otherwise(_attr("threshold", "N", ((e % 10) / 10.0).cast("string"))))
    body = F.concat(F.lit("{"), F.substr(F.concat(pid, tsa, comp, _attr("index", "N", val_text), thr,
                                                     _attr("model", "S", F.lit("m1"))), F.lit(2)),
                    F.lit("}"))
    line = (F.when(e % 53 == 0, F.lit("")).when(e % 59 == 0, F.lit("not json {"))
             .when(e % 2 == 0, F.concat(F.lit('{"Item":'), body, F.lit("}"))).otherwise(body))
    return ev.select(F.concat(F.lit("dump/"), F.col("event_type"), F.lit(".json.gz")).alias("file"),
                     e.alias("pos"), line.alias("value"), "event_type")


# --- events as the source warehouse table ---------------------------------------------

def events_source(spark, sf_dir) -> DataFrame:
    """``processId`` (NULL for e % 13 = 0), ``timestamp``, ``tagId``, ``value``."""
    e = _e()
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(e % 13 == 0, F.lit(None).cast("long")).otherwise(F.col("user_id")).alias("processId"),
        F.col("ts").alias("timestamp"), F.col("event_type").alias("tagId"), "value")


SQL_EVENTS_SOURCE = """
src AS (
  SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS processId,
         ts AS "timestamp", event_type AS tagId, value
  FROM events)"""

SQL_MONTHS = f"""
months AS (
  SELECT CAST(m AS TIMESTAMP) AS start, CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) AS "end", strftime(m, '%Y-%m') AS label
  FROM (SELECT unnest(generate_series(date_trunc('month', TIMESTAMP '{EXTRACT_NOW}' - INTERVAL {EXTRACT_DAYS} DAY),
                                      TIMESTAMP '{EXTRACT_NOW}', INTERVAL 1 MONTH)) AS m))"""

SQL_GRID = """
procs AS (SELECT DISTINCT CAST(processId AS VARCHAR) AS process_id FROM src WHERE processId IS NOT NULL),
grid AS (SELECT p.process_id, m.start, m."end", m.label FROM procs p CROSS JOIN months m)"""

# pairs that already have output: user_id % 5 = 0 in 2024-01, and every process in 2023-12
SQL_DONE = """
done AS (SELECT process_id, label FROM grid
         WHERE (CAST(process_id AS BIGINT) % 5 = 0 AND label = '2024-01') OR label = '2023-12')"""
