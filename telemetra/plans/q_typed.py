"""Catalog: typed-JSON items from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.operators import typed_json as tj
from telemetra.plans import roles
from telemetra.plans.registry import register, with_ctes

TI, PR = roles.SQL_TYPED_ITEMS, roles.SQL_PROJ_ROWS
C = roles.COMPANY


def _lines(spark, sf):
    return roles.events_typed_lines(spark, sf)


def _items(spark, sf):
    return tj.parse_items(_lines(spark, sf)).where(~F.col("malformed"))


def _g(k):
    return F.col("item")[k]


@register("unpivot_wide_to_long", "R1 P3 P16 F10 J3 F7 F8", with_ctes(TI, PR, body="""
SELECT company_id, process_id, tag_id, value, ts FROM proj"""))
def unpivot_wide_to_long(spark, sf):
    return tj.projections(_lines(spark, sf), C, overrides=roles.override_ids())


@register("variables_import", "R1 P17 P20", with_ctes(TI, body=f"""
SELECT '{C}' AS company_id, event_type AS tag_id, v AS value, ts_parsed + to_hours(off_h) AS ts
  FROM tv WHERE valid AND v IS NOT NULL AND NOT is_long
UNION ALL SELECT '{C}', 'value', v, ts_parsed + to_hours(off_h) FROM tv WHERE valid AND v IS NOT NULL AND is_long
UNION ALL SELECT '{C}', 'k', k, ts_parsed + to_hours(off_h) FROM tv WHERE valid AND NOT is_long
UNION ALL SELECT '{C}', 'flag', flag, ts_parsed + to_hours(off_h) FROM tv WHERE valid AND NOT is_long"""))
def variables_import(spark, sf):
    return tj.variables(_lines(spark, sf), C, overrides=roles.override_ids())


@register("predictions_import", "P2 P3 P18", with_ctes(TI, body="""
SELECT company_id, process_id, ts_parsed + to_hours(off_h) AS ts, v AS "index",
       (event_id % 10) / 10.0 AS threshold
FROM ti WHERE NOT blank AND NOT malformed AND has_pid AND event_id % 3 <> 0
  AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND v IS NOT NULL"""))
def predictions_import(spark, sf):
    return tj.predictions(roles.events_prediction_lines(spark, sf), C, overrides=roles.override_ids())


@register("flatten_item", "P1", with_ctes(TI, body="""
SELECT event_id,
       CAST((CASE WHEN has_pid THEN 1 ELSE 0 END) + (CASE WHEN ts_mode = 'null_ts' THEN 2 ELSE 1 END)
            + (CASE WHEN event_id % 4 IN (0, 1) THEN 1 ELSE 0 END) + (CASE WHEN is_long THEN 2 ELSE 6 END) + 1
            AS BIGINT) AS n_attrs,
       CASE WHEN has_pid THEN process_id END AS process_id, 'm1' AS model
FROM ti WHERE NOT blank AND NOT malformed"""))
def flatten_item(spark, sf):
    return _items(spark, sf).select(F.col("pos").alias("event_id"),
                                    F.size("item").cast("long").alias("n_attrs"),
                                    tj.attr_str(_g("process_id")).alias("process_id"),
                                    tj.attr_str(_g("model")).alias("model"))


@register("required_fields", "P2", with_ctes(TI, body="""
SELECT event_id, has_pid AND ts_mode <> 'null_ts' AS required FROM ti WHERE NOT blank AND NOT malformed"""))
def required_fields(spark, sf):
    return _items(spark, sf).select(F.col("pos").alias("event_id"), tj.required().alias("required"))


@register("header_key_exclusion", "P15", with_ctes(TI, body="""
SELECT event_id, 'tag_id' AS tag FROM ti WHERE NOT blank AND NOT malformed AND is_long
UNION ALL SELECT event_id, 'value' FROM ti WHERE NOT blank AND NOT malformed AND is_long
UNION ALL SELECT event_id, event_type FROM ti WHERE NOT blank AND NOT malformed AND NOT is_long
UNION ALL SELECT event_id, unnest(['k', 'flag', 'note', 'nul', 'lst']) FROM ti WHERE NOT blank AND NOT malformed AND NOT is_long"""))
def header_key_exclusion(spark, sf):
    return _items(spark, sf).select(F.col("pos").alias("event_id"), F.explode(F.map_keys(tj.tag_attributes())).alias("tag"))


@register("shape_dispatch", "P16", with_ctes(TI, body="""
SELECT event_id, CASE WHEN is_long THEN 'long' ELSE 'wide' END AS shape FROM ti WHERE NOT blank AND NOT malformed"""))
def shape_dispatch(spark, sf):
    return _items(spark, sf).select(F.col("pos").alias("event_id"),
                                    F.when(tj.is_long(), F.lit("long")).otherwise(F.lit("wide")).alias("shape"))


@register("default_company", "P17", with_ctes(TI, body="""
SELECT event_id, company_id FROM ti WHERE NOT blank AND NOT malformed"""))
def default_company(spark, sf):
    return _items(spark, sf).select(F.col("pos").alias("event_id"), tj.company(C).alias("company_id"))


@register("timestamp_key_fallback", "P18 F7 F8", with_ctes(TI, body="""
SELECT event_id, CASE WHEN ts_mode = 'null_ts' THEN NULL ELSE ts_parsed END AS ts
FROM ti WHERE NOT blank AND NOT malformed"""))
def timestamp_key_fallback(spark, sf):
    from telemetra.functions.timefmt import parse_utc
    return _items(spark, sf).select(F.col("pos").alias("event_id"), parse_utc(tj.raw_ts()).alias("ts"))


@register("map_ops", "F21", with_ctes(TI, body="""
SELECT event_id, ts_mode IN ('timestamp', 'null_ts') AS has_timestamp,
       CASE WHEN NOT is_long THEN k END AS k_value
FROM ti WHERE NOT blank AND NOT malformed"""))
def map_ops(spark, sf):
    return _items(spark, sf).select(F.col("pos").alias("event_id"),
                                    tj._has("timestamp").alias("has_timestamp"),
                                    tj.attr_num(F.element_at(F.col("item"), F.lit("k"))).alias("k_value"))


@register("json_parse", "F22 S1", with_ctes(TI, body="""
SELECT event_id, malformed, NOT malformed AND event_id % 2 = 0 AS wrapped FROM ti WHERE NOT blank"""))
def json_parse(spark, sf):
    items = tj.parse_items(_lines(spark, sf))
    return items.select(F.col("pos").alias("event_id"), "malformed",
                        (~F.col("malformed") & (F.instr("value", '{"Item":') == 1)).alias("wrapped"))


@register("per_file_stats", "A2", with_ctes(TI, body="""
SELECT file, count(*) AS "read",
       CAST(sum(CASE WHEN NOT valid THEN 0 WHEN is_long THEN (v IS NOT NULL)::INT ELSE (v IS NOT NULL)::INT + 2 END) AS BIGINT) AS accepted,
       count(*) FILTER (WHERE NOT valid OR (is_long AND v IS NULL)) AS discarded
FROM tv WHERE NOT blank GROUP BY file"""))
def per_file_stats(spark, sf):
    per_item = tj.item_rows(tj.parse_items(_lines(spark, sf)), C, dispatch=True)
    return tj.per_file_stats(per_item)


@register("prediction_file_stats", "A2", with_ctes(TI, body="""
SELECT file, count(*) AS "read",
       count(*) FILTER (WHERE NOT malformed AND has_pid AND event_id % 3 <> 0 AND event_id % 11 <> 0
                        AND event_id % 13 <> 0 AND v IS NOT NULL) AS accepted,
       count(*) FILTER (WHERE NOT (NOT malformed AND has_pid AND event_id % 3 <> 0 AND event_id % 11 <> 0
                        AND event_id % 13 <> 0 AND v IS NOT NULL)) AS discarded
FROM ti WHERE NOT blank GROUP BY file"""))
def prediction_file_stats(spark, sf):
    per_item = tj.prediction_items(roles.events_prediction_lines(spark, sf), C)
    return tj.per_file_stats(per_item, rows_mode=False)


@register("json_abort", "E2", with_ctes(TI, body="""
SELECT file, count(*) FILTER (WHERE malformed) AS malformed_lines FROM ti WHERE NOT blank GROUP BY file"""))
def json_abort(spark, sf):
    items = tj.parse_items(_lines(spark, sf))
    return items.groupBy("file").agg(F.count_if("malformed").alias("malformed_lines"))


@register("id_string_cast", "F23", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS process_id FROM orders""")
def id_string_cast(spark, sf):
    from telemetra.functions.text import to_str
    return roles.table(spark, sf, "orders").select("o_orderkey", to_str("o_custkey").alias("process_id"))
