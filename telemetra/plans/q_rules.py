"""Catalog: ingest rules over events-as-readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions import numbers
from telemetra.functions.numbers import finite_double
from telemetra.functions.timefmt import cutoff
from telemetra.operators import validate
from telemetra.operators.audit import discard_audit
from telemetra.operators.ledger import running_total
from telemetra.operators.ordering import sample_head
from telemetra.plans import roles
from telemetra.plans.registry import register, with_ctes
from telemetra.sources.tables import dry_run

R, M = roles.SQL_EVENTS_READINGS, roles.SQL_REASON
NOW, H = roles.NOW, roles.MAX_PAST_H


def _marked(spark, sf):
    return validate.annotate(roles.events_readings(spark, sf), NOW, H)


@register("ingest_rules", "P7 P17 P20", with_ctes(R, M, body=f"""
SELECT '{roles.COMPANY}' AS company_id, tag_id, value, ts FROM ev_m WHERE reason IS NULL"""))
def ingest_rules(spark, sf):
    valid, _ = validate.apply_ingest_rules(roles.events_readings(spark, sf), NOW, roles.COMPANY, H)
    return valid


@register("rule_bad_value", "P4", with_ctes(R, body="""
SELECT event_id, tag_id FROM ev_r WHERE value IS NULL OR isnan(value) OR isinf(value)"""))
def rule_bad_value(spark, sf):
    return roles.events_readings(spark, sf).where(validate.bad_value()).select("event_id", "tag_id")


@register("rule_future", "P5", with_ctes(R, body=f"""
SELECT event_id, ts FROM ev_r WHERE ts > TIMESTAMP '{NOW}'"""))
def rule_future(spark, sf):
    return roles.events_readings(spark, sf).where(validate.is_future(NOW)).select("event_id", "ts")


@register("rule_too_old", "P6 F16", with_ctes(R, body=f"""
SELECT event_id, ts FROM ev_r WHERE ts < TIMESTAMP '{NOW}' - INTERVAL {H} HOUR"""))
def rule_too_old(spark, sf):
    return roles.events_readings(spark, sf).where(validate.is_too_old(NOW, H)).select("event_id", "ts")


@register("lateness_rule", "T3", with_ctes(R, body=f"""
SELECT event_id, ts FROM ev_r WHERE NOT (ts < TIMESTAMP '{NOW}' - INTERVAL {H} HOUR)"""))
def lateness_rule(spark, sf):
    return validate.lateness_filter(roles.events_readings(spark, sf), NOW, H).select("event_id", "ts")


@register("ingest_reasons", "P7", with_ctes(R, M, body="""
SELECT event_id, reason FROM ev_m"""))
def ingest_reasons(spark, sf):
    return _marked(spark, sf).select("event_id", "reason")


@register("discard_counts", "A1", with_ctes(R, M, body="""
SELECT count(*) FILTER (WHERE reason = 'bad_value') AS bad_value,
       count(*) FILTER (WHERE reason = 'timestamp_future') AS timestamp_future,
       count(*) FILTER (WHERE reason = 'timestamp_too_old') AS timestamp_too_old,
       count(*) FILTER (WHERE reason IS NULL) AS accepted,
       count(*) FILTER (WHERE reason IS NOT NULL) AS discarded
FROM ev_m"""))
def discard_counts(spark, sf):
    return validate.discard_counts(_marked(spark, sf))


@register("discard_audit_by_tag", "A12", with_ctes(R, M, body=f"""
SELECT '{roles.COMPANY}' AS company_id, tag_id, reason, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
FROM ev_m WHERE reason IS NOT NULL GROUP BY tag_id, reason"""))
def discard_audit_by_tag(spark, sf):
    rejected = _marked(spark, sf).where(F.col("reason").isNotNull()).withColumn("company_id", F.lit(roles.COMPANY))
    return discard_audit(rejected)


@register("nan_inf_flags", "F18", with_ctes(R, body="""
SELECT event_id, isnan(value) AS is_nan, isinf(value) AS is_inf FROM ev_r"""))
def nan_inf_flags(spark, sf):
    return roles.events_readings(spark, sf).select("event_id", numbers.is_nan("value").alias("is_nan"), numbers.is_inf("value").alias("is_inf"))


_TXT = """CASE WHEN event_id % 11 = 0 THEN 'abc' WHEN event_id % 13 = 0 THEN '1e400'
              WHEN event_id % 17 = 0 THEN ' ' || CAST(value AS VARCHAR) || ' '
              WHEN event_id % 19 = 0 THEN 'NaN' WHEN event_id % 23 = 0 THEN '0x1p3'
              WHEN event_id % 29 = 0 THEN '1.0d' WHEN event_id % 31 = 0 THEN '-inf'
              WHEN event_id % 43 = 0 THEN '' ELSE CAST(value AS VARCHAR) END"""
_RX = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


@register("finite_number", "P3", f"""
WITH t AS (SELECT event_id, {_TXT} AS txt FROM events),
     p AS (SELECT event_id, CASE WHEN regexp_full_match(txt, '{_RX}') THEN TRY_CAST(trim(txt) AS DOUBLE) END AS x FROM t)
SELECT event_id, CASE WHEN isfinite(x) THEN x END AS value FROM p""")
def finite_number(spark, sf):
    e, v = F.col("event_id"), F.col("value").cast("string")
    txt = (F.when(e % 11 == 0, F.lit("abc")).when(e % 13 == 0, F.lit("1e400"))
            .when(e % 17 == 0, F.concat(F.lit(" "), v, F.lit(" ")))
            .when(e % 19 == 0, F.lit("NaN")).when(e % 23 == 0, F.lit("0x1p3"))
            .when(e % 29 == 0, F.lit("1.0d")).when(e % 31 == 0, F.lit("-inf"))
            .when(e % 43 == 0, F.lit("")).otherwise(v))
    return roles.table(spark, sf, "events").select("event_id", finite_double(txt).alias("value"))


@register("cutoff_arith", "F16", """
SELECT event_id, ts - to_hours(CAST(user_id % 48 AS BIGINT)) AS cutoff_ts FROM events""")
def cutoff_arith(spark, sf):
    ev = roles.table(spark, sf, "events")
    return ev.select("event_id", cutoff(F.col("ts"), (F.col("user_id") % 48)).alias("cutoff_ts"))


@register("running_total", "W4 F19", with_ctes(R, M, body="""
SELECT event_id, CAST(sum(CASE WHEN reason IS NULL THEN 1 ELSE 0 END)
                      OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running
FROM ev_m"""))
def running_total_q(spark, sf):
    m = _marked(spark, sf).select("event_id", F.when(F.col("reason").isNull(), 1).otherwise(0).cast("long").alias("ok"))
    return running_total(m, "event_id", "ok", "running").select("event_id", F.col("running").cast("long"))


@register("sample_head", "O5", with_ctes(R, M, body=f"""
SELECT '{roles.COMPANY}' AS company_id, tag_id, value, ts FROM ev_m WHERE reason IS NULL
ORDER BY ts, tag_id LIMIT 5"""))
def sample_head_q(spark, sf):
    valid, _ = validate.apply_ingest_rules(roles.events_readings(spark, sf), NOW, roles.COMPANY, H)
    return sample_head(valid, 5, ["ts", "tag_id"])


@register("dry_run", "S16", with_ctes(R, M, body=f"""
SELECT s.*, c.rows FROM (SELECT '{roles.COMPANY}' AS company_id, tag_id, value, ts FROM ev_m WHERE reason IS NULL
                        ORDER BY ts, tag_id LIMIT 5) s
CROSS JOIN (SELECT count(*) AS rows FROM ev_m WHERE reason IS NULL) c"""))
def dry_run_q(spark, sf):
    valid, _ = validate.apply_ingest_rules(roles.events_readings(spark, sf), NOW, roles.COMPANY, H)
    sample, count = dry_run(valid, 5, ["ts", "tag_id"])
    return sample.withColumn("rows", F.lit(count.first()["rows"]).cast("long"))
