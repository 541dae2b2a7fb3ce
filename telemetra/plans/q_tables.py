"""Catalog: filters, slices, reshapes, dedup and scalar functions over orders / events /
lineitem / customer (P8–P12, P19, P22, S5, O1, O2, U1, U2, A7, A8, W1, R1 fixed, R2, A14,
F1, F2, F5, F6, F7–F9, F10, F11, F12, F14, F15, F17, F19, F20, J3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions import numbers as fn_num
from telemetra.functions import text as fn_txt
from telemetra.functions import timefmt as fn_t
from telemetra.operators import dedup, filters, reshape
from telemetra.operators.clock import clock_shift, offset_hours
from telemetra.operators.ordering import order_ts_tag
from telemetra.operators.sets import concat_chunks, glob_union
from telemetra.plans import roles
from telemetra.plans.registry import register, with_ctes
from telemetra.sources.tables import scan_readings_slice

OR = roles.SQL_ORDERS_READINGS
P_START, P_END = "1996-01-01 00:00:00", "1997-12-31 00:00:00"
TAGS = ["F", "O"]
URG = "1-URGENT"


def _ord(spark, sf):
    return roles.orders_readings(spark, sf)


@register("company_filter", "P8", with_ctes(OR, body=f"""
SELECT company_id, process_id, tag_id, value, ts FROM ord_r WHERE company_id = '{URG}'"""))
def company_filter(spark, sf):
    return filters.company_filter(_ord(spark, sf), URG).drop("o_orderkey")


@register("period_inclusive", "P9", with_ctes(OR, body=f"""
SELECT o_orderkey, ts FROM ord_r WHERE ts >= TIMESTAMP '{P_START}' AND ts <= TIMESTAMP '{P_END}'"""))
def period_inclusive(spark, sf):
    return filters.period_inclusive(_ord(spark, sf), P_START, P_END).select("o_orderkey", "ts")


@register("period_half_open", "P10", with_ctes(OR, body=f"""
SELECT o_orderkey, ts FROM ord_r WHERE ts >= TIMESTAMP '{P_START}' AND ts < TIMESTAMP '{P_END}'"""))
def period_half_open(spark, sf):
    return filters.period_half_open(_ord(spark, sf), P_START, P_END).select("o_orderkey", "ts")


@register("last_n_days", "P11", with_ctes(OR, body=f"""
SELECT o_orderkey, ts FROM ord_r WHERE ts >= TIMESTAMP '{roles.ORDERS_NOW}' - INTERVAL 400 DAY"""))
def last_n_days(spark, sf):
    return filters.last_n_days(_ord(spark, sf), roles.ORDERS_NOW, 400).select("o_orderkey", "ts")


@register("tag_in_list", "P12", with_ctes(OR, body="""
SELECT o_orderkey, tag_id FROM ord_r WHERE tag_id IN ('F', 'O')"""))
def tag_in_list(spark, sf):
    return filters.tag_in_list(_ord(spark, sf), TAGS).select("o_orderkey", "tag_id")


@register("tag_in_table", "P12", with_ctes(OR, body="""
SELECT o_orderkey, tag_id FROM ord_r WHERE tag_id IN (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus <> 'P')"""))
def tag_in_table(spark, sf):
    tags = roles.table(spark, sf, "orders").where("o_orderstatus <> 'P'").select("o_orderstatus")
    return filters.tag_in_list(_ord(spark, sf), tags).select("o_orderkey", "tag_id")


_SLICE_SQL = with_ctes(OR, body=f"""
SELECT ts, tag_id, value FROM ord_r
WHERE company_id = '{URG}' AND ts >= TIMESTAMP '{P_START}' AND ts <= TIMESTAMP '{P_END}' AND tag_id IN ('F', 'O')
QUALIFY row_number() OVER (PARTITION BY company_id, tag_id, ts ORDER BY o_orderkey DESC) = 1""")


def _slice(spark, sf, dedup_=True):
    r = _ord(spark, sf).withColumnRenamed("o_orderkey", "ingest_seq")
    return scan_readings_slice(r, URG, P_START, P_END, TAGS, dedup=dedup_)


@register("scan_readings_slice", "S5 A8 P8 P9 P12", _SLICE_SQL)
def scan_slice(spark, sf):
    return _slice(spark, sf)


@register("scan_readings_raw", "S5", with_ctes(OR, body=f"""
SELECT ts, tag_id, value FROM ord_r
WHERE company_id = '{URG}' AND ts >= TIMESTAMP '{P_START}' AND ts <= TIMESTAMP '{P_END}' AND tag_id IN ('F', 'O')"""))
def scan_raw(spark, sf):
    return _slice(spark, sf, dedup_=False)


@register("order_ts_tag", "O1", _SLICE_SQL + "\nORDER BY ts, tag_id")
def order_ts_tag_q(spark, sf):
    return order_ts_tag(_slice(spark, sf))


@register("concat_chunks", "U1", with_ctes(OR, body="""
SELECT o_orderkey, ts FROM ord_r WHERE ts < TIMESTAMP '1997-01-01'
UNION ALL SELECT o_orderkey, ts FROM ord_r WHERE ts >= TIMESTAMP '1996-01-01'"""))
def concat_chunks_q(spark, sf):
    o = _ord(spark, sf).select("o_orderkey", "ts")
    return concat_chunks([o.where(F.col("ts") < F.lit("1997-01-01").cast("timestamp_ntz")),
                          o.where(F.col("ts") >= F.lit("1996-01-01").cast("timestamp_ntz"))])


@register("glob_union", "U2", with_ctes(OR, body="""
SELECT process_id, tag_id FROM ord_r WHERE ts < TIMESTAMP '1997-01-01'
UNION SELECT process_id, tag_id FROM ord_r WHERE ts >= TIMESTAMP '1996-01-01'"""))
def glob_union_q(spark, sf):
    o = _ord(spark, sf).select("process_id", "tag_id", "ts")
    a = o.where(F.col("ts") < F.lit("1997-01-01").cast("timestamp_ntz")).drop("ts")
    b = o.where(F.col("ts") >= F.lit("1996-01-01").cast("timestamp_ntz")).drop("ts")
    return glob_union(a, b)


_DEDUP_SQL = """
SELECT o_custkey, strftime(o_orderdate, '%Y%m') AS month, o_orderkey, o_totalprice, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y%m') ORDER BY o_orderkey DESC) = 1"""


@register("replace_dedup", "A8", _DEDUP_SQL)
def replace_dedup_q(spark, sf):
    o = roles.table(spark, sf, "orders").select(
        "o_custkey", fn_t.month_key("o_orderdate").alias("month"), "o_orderkey", "o_totalprice", "o_orderstatus")
    return dedup.replace_dedup(o.withColumn("ingest_seq", F.col("o_orderkey")), ["o_custkey", "month"])


@register("last_write_wins", "W1", """
SELECT o_custkey, strftime(o_orderdate, '%Y%m') AS month, o_orderkey,
       row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y%m') ORDER BY o_orderkey DESC) AS rank_in_key
FROM orders""")
def last_write_wins(spark, sf):
    o = roles.table(spark, sf, "orders").select(
        "o_custkey", fn_t.month_key("o_orderdate").alias("month"), "o_orderkey")
    return dedup.last_write_rank(o, ["o_custkey", "month"], "o_orderkey")


@register("last_write_flag", "W1 A8", """
SELECT o_custkey, strftime(o_orderdate, '%Y%m') AS month, o_orderkey,
       o_orderkey = max(o_orderkey) OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y%m')) AS is_last
FROM orders""")
def last_write_flag(spark, sf):
    o = roles.table(spark, sf, "orders").select(
        "o_custkey", fn_t.month_key("o_orderdate").alias("month"), "o_orderkey")
    return dedup.last_write_flag(o, ["o_custkey", "month"], "o_orderkey")


# --- reshape ------------------------------------------------------------------------------

_HOURLY = """
hourly AS (SELECT date_trunc('hour', ts) AS ts, event_type AS tag_id, value, event_id FROM events)"""
_CELLS = """
cells AS (SELECT ts, tag_id, min_by(value, event_id) AS value FROM hourly WHERE value IS NOT NULL GROUP BY ts, tag_id)"""
_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _hourly(spark, sf):
    return roles.table(spark, sf, "events").select(
        F.date_trunc("hour", "ts").alias("ts"), F.col("event_type").alias("tag_id"), "value", "event_id")


@register("first_non_null_cell", "A7", with_ctes(_HOURLY, _CELLS, body="SELECT ts, tag_id, value FROM cells"))
def first_non_null_cell(spark, sf):
    return reshape.first_non_null_cells(_hourly(spark, sf), "event_id")


def _wide_sql(ts_expr="ts"):
    cols = ", ".join(f"max(value) FILTER (WHERE tag_id = '{t}') AS {t}" for t in _EVENT_TYPES)
    return with_ctes(_HOURLY, _CELLS, body=f"SELECT {ts_expr}, {cols} FROM cells GROUP BY ts")


@register("pivot_long_to_wide", "R2", _wide_sql())
def pivot_long_to_wide(spark, sf):
    return reshape.pivot_wide(_hourly(spark, sf), tags=None, order_col="event_id")


@register("pivot_tag_list", "R2 P12", _wide_sql())
def pivot_tag_list(spark, sf):
    return reshape.pivot_wide(_hourly(spark, sf), tags=_EVENT_TYPES + ["no_such_tag"], order_col="event_id")


@register("order_wide_by_ts", "O2 F12", _wide_sql("strftime(ts, '%Y-%m-%d %H:%M') AS \"TIMESTAMP\"") + " ORDER BY ts")
def order_wide_by_ts(spark, sf):
    return reshape.wide_export_frame(reshape.pivot_wide(_hourly(spark, sf), order_col="event_id"))


@register("unpivot_fixed_columns", "R1", """
SELECT l_orderkey, l_linenumber, tag_id, value FROM (
  SELECT l_orderkey, l_linenumber, 'l_quantity' AS tag_id, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem)
WHERE value IS NOT NULL AND isfinite(value)""")
def unpivot_fixed_columns(spark, sf):
    li = roles.table(spark, sf, "lineitem")
    return reshape.unpivot_columns(li, ["l_orderkey", "l_linenumber"],
                                   ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@register("export_counts", "A14 A8", with_ctes(OR, f"""
s AS (SELECT * FROM ord_r WHERE ts >= TIMESTAMP '{P_START}' AND ts <= TIMESTAMP '{P_END}'
      QUALIFY row_number() OVER (PARTITION BY company_id, tag_id, ts ORDER BY o_orderkey DESC) = 1)""", body="""
SELECT company_id, count(*) AS points, count(DISTINCT ts) FILTER (WHERE value IS NOT NULL) AS periods
FROM s GROUP BY company_id"""))
def export_counts(spark, sf):
    s = filters.period_inclusive(_ord(spark, sf), P_START, P_END)
    last = dedup.replace_dedup(s.select("company_id", "tag_id", "ts", "value", "o_orderkey"), dedup.READINGS_KEY, "o_orderkey")
    return reshape.export_counts(last)


# --- scalar functions ---------------------------------------------------------------------

@register("normalise_id", "F1", """
SELECT o_orderkey, lower(replace('AB-' || CAST(o_custkey AS VARCHAR) || '-X', '-', '')) AS norm FROM orders""")
def normalise_id(spark, sf):
    o = roles.table(spark, sf, "orders")
    raw = F.concat(F.lit("AB-"), F.col("o_custkey").cast("string"), F.lit("-X"))
    return o.select("o_orderkey", fn_txt.normalise_id(raw).alias("norm"))


@register("trim_blank", "F2", """
SELECT c_custkey, NULLIF(trim(CASE WHEN c_custkey % 10 = 0 THEN '   ' ELSE '  ' || c_name || ' ' END), '') AS name
FROM customer""")
def trim_blank(spark, sf):
    c = roles.table(spark, sf, "customer")
    raw = F.when(F.col("c_custkey") % 10 == 0, F.lit("   ")).otherwise(F.concat(F.lit("  "), "c_name", F.lit(" ")))
    return c.select("c_custkey", fn_txt.blank_to_null(raw).alias("name"))


@register("output_names", "F5", with_ctes(OR, body="""
SELECT company_id,
       company_id || '_' || strftime(min(ts), '%Y-%m-%d_%H%M%S') || '_a_' || strftime(max(ts), '%Y-%m-%d_%H%M%S') || '.csv' AS file_name,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') || ' → ' || strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS period
FROM ord_r GROUP BY company_id"""))
def output_names(spark, sf):
    g = _ord(spark, sf).groupBy("company_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return g.select("company_id", fn_txt.export_file_name("company_id", "a", "b").alias("file_name"),
                    fn_txt.period_label("a", "b").alias("period"))


@register("thousands", "F6", """
SELECT c_nationkey, format('{:,}', CAST(sum(c_custkey) * 1234 AS BIGINT)) AS total FROM customer GROUP BY c_nationkey""")
def thousands(spark, sf):
    c = roles.table(spark, sf, "customer")
    return c.groupBy("c_nationkey").agg(fn_num.thousands(F.sum("c_custkey") * 1234).alias("total"))


_TS_TEXT = """CASE WHEN event_id % 4 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
                   WHEN event_id % 4 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+02:00'
                   WHEN event_id % 4 = 2 THEN strftime(ts, '%Y-%m-%d %H:%M')
                   ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"""


@register("parse_utc", "F7 F8 F9", f"""
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN ts
                      WHEN event_id % 4 = 1 THEN ts - INTERVAL 2 HOUR
                      WHEN event_id % 4 = 2 THEN date_trunc('minute', ts)
                      ELSE date_trunc('second', ts) END AS ts
FROM events""")
def parse_utc(spark, sf):
    e = F.col("event_id")
    txt = (F.when(e % 4 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .when(e % 4 == 1, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+02:00")))
            .when(e % 4 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return roles.table(spark, sf, "events").select("event_id", fn_t.parse_utc(txt).alias("ts"))


_OV = ", ".join(str(u) for u in roles.OVERRIDE_USERS)


@register("clock_shift", "F10 J3", f"""
SELECT event_id, ts + to_hours(CASE WHEN user_id IN ({_OV}) THEN 4 ELSE 3 END) AS ts FROM events""")
def clock_shift_q(spark, sf):
    ev = roles.table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("process_id"), "ts")
    return clock_shift(ev, [str(u) for u in roles.OVERRIDE_USERS]).select("event_id", "ts")


@register("override_membership", "J3", f"""
SELECT event_id, CASE WHEN user_id IN ({_OV}) THEN 4 ELSE 3 END AS offset_h FROM events""")
def override_membership(spark, sf):
    ev = roles.table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("process_id"))
    spark_ = ev.sparkSession
    ov = spark_.createDataFrame([(str(u), 4) for u in roles.OVERRIDE_USERS], "process_id string, hours int")
    return offset_hours(ev, ov).select("event_id", "offset_h")


@register("month_keys", "F11", """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m') AS yyyymm, strftime(l_shipdate, '%Y-%m') AS yyyy_mm FROM lineitem""")
def month_keys(spark, sf):
    li = roles.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", fn_t.month_key("l_shipdate").alias("yyyymm"),
                     fn_t.month_dash("l_shipdate").alias("yyyy_mm"))


@register("minute_label", "F12", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS label FROM events""")
def minute_label(spark, sf):
    return roles.table(spark, sf, "events").select("event_id", fn_t.minute_label("ts").alias("label"))


_PB = """CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d-%H:%M:%S')
                            WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d-%H:%M')
                            WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                            WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M')
                            ELSE strftime(o_orderdate, '%d/%m/%Y') END"""


@register("parse_period_bound", "F14", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE o_orderdate END AS bound FROM orders""")
def parse_period_bound(spark, sf):
    o, k = roles.table(spark, sf, "orders"), F.col("o_orderkey")
    d = F.col("o_orderdate")
    txt = (F.when(k % 5 == 0, F.date_format(d, "yyyy-MM-dd-HH:mm:ss"))
            .when(k % 5 == 1, F.date_format(d, "yyyy-MM-dd-HH:mm"))
            .when(k % 5 == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
            .when(k % 5 == 3, F.date_format(d, "yyyy-MM-dd HH:mm"))
            .otherwise(F.date_format(d, "dd/MM/yyyy")))
    return o.select("o_orderkey", fn_t.parse_period_bound(txt).alias("bound"))


@register("period_validation", "F15", f"""
WITH r AS (SELECT o_orderkey, o_orderdate AS s, o_orderdate + to_days(CAST(o_orderkey % 5 - 2 AS INTEGER) * 400) AS e FROM orders)
SELECT o_orderkey,
       CASE WHEN s > e THEN 'start_after_end' WHEN s > TIMESTAMP '{roles.ORDERS_NOW}' THEN 'start_in_future' END AS error,
       least(e, TIMESTAMP '{roles.ORDERS_NOW}') AS end_clamped
FROM r""")
def period_validation(spark, sf):
    o = roles.table(spark, sf, "orders")
    now = F.lit(roles.ORDERS_NOW).cast("timestamp_ntz")
    e = F.col("o_orderdate") + F.make_dt_interval(days=((F.col("o_orderkey") % 5 - 2) * 400).cast("int"))
    r = o.select("o_orderkey", F.col("o_orderdate").alias("s"), e.alias("e"))
    return r.select("o_orderkey", fn_t.period_error("s", "e", now).alias("error"),
                    fn_t.clamp_end("e", now).alias("end_clamped"))


@register("interval_midpoint", "F17", """
WITH r AS (SELECT event_id, ts AS a, ts + to_microseconds(event_id % 1000 + 1) AS b FROM events)
SELECT event_id, make_timestamp(epoch_us(a) + CAST(round_even((epoch_us(b) - epoch_us(a)) / 2.0, 0) AS BIGINT)) AS mid FROM r""")
def interval_midpoint(spark, sf):
    ev = roles.table(spark, sf, "events")
    b = F.col("ts") + F.make_dt_interval(secs=((F.col("event_id") % 1000 + 1) / 1e6).cast("decimal(18,6)"))
    return ev.select("event_id", fn_t.midpoint(F.col("ts"), b).alias("mid"))


@register("throughput_rate", "F19", """
SELECT event_type, CASE WHEN (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 > 0
                        THEN CAST(count(*) AS DOUBLE) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) ELSE 0.0 END AS rate
FROM events GROUP BY event_type""")
def throughput_rate(spark, sf):
    ev = roles.table(spark, sf, "events")
    secs = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6
    return ev.groupBy("event_type").agg(fn_num.safe_rate(F.count(F.lit(1)), secs).alias("rate"))


@register("bool_text", "F20", """
SELECT c_custkey,
       CASE WHEN c_custkey % 6 = 3 THEN false
            ELSE lower(trim(CASE c_custkey % 6 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'sim' WHEN 2 THEN 'no'
                                 WHEN 4 THEN '1' ELSE 'TRUE' END)) IN ('1', 'true', 'yes', 'sim') END AS flag
FROM customer""")
def bool_text(spark, sf):
    c, k = roles.table(spark, sf, "customer"), F.col("c_custkey")
    txt = (F.when(k % 6 == 0, F.lit(" Yes ")).when(k % 6 == 1, F.lit("sim")).when(k % 6 == 2, F.lit("no"))
            .when(k % 6 == 3, F.lit(None).cast("string")).when(k % 6 == 4, F.lit("1")).otherwise(F.lit("TRUE")))
    return c.select("c_custkey", fn_num.bool_text(txt).alias("flag"))
