"""Catalog: extraction planning over events as the source warehouse (A4, A5, P11, P19,
P22, F13, J4, J5, U5, S4, S8, S15, T5, W2, A11, A15, F3, F4, O3, O6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra import session
from telemetra.constants import MANIFEST_PREFIX
from telemetra.functions import text as fn_txt
from telemetra.operators import extract as ex
from telemetra.operators.filters import drop_null_ids, project_rename
from telemetra.operators.ordering import file_name_sort, file_order
from telemetra.plans import roles
from telemetra.plans.registry import register, with_ctes
from telemetra.plans import flows
from telemetra.sources.csv_readings import exported_pairs, scan_readings_csv, sink_month_process_csv

SRC, MON, GRID, DONE = roles.SQL_EVENTS_SOURCE, roles.SQL_MONTHS, roles.SQL_GRID, roles.SQL_DONE
NOW, DAYS, CAP = roles.EXTRACT_NOW, roles.EXTRACT_DAYS, roles.RANGE_CAP
_OV = ", ".join(str(u) for u in roles.OVERRIDE_USERS)
OVERRIDES = [str(u) for u in roles.OVERRIDE_USERS]


def _src(spark, sf):
    return roles.events_source(spark, sf)


def _grid(spark, sf):
    return ex.work_grid(ex.distinct_processes(_src(spark, sf)), NOW, DAYS)


def _done(grid):
    return grid.where(((F.col("process_id").cast("long") % 5 == 0) & (F.col("label") == "2024-01"))
                      | (F.col("label") == "2023-12")).select("process_id", "label")


@register("distinct_processes", "A4 P22", with_ctes(SRC, body="""
SELECT DISTINCT CAST(processId AS VARCHAR) AS process_id FROM src WHERE processId IS NOT NULL"""))
def distinct_processes(spark, sf):
    return ex.distinct_processes(_src(spark, sf))


@register("drop_null_ids", "P22", with_ctes(SRC, body="""
SELECT event_id, CAST(processId AS VARCHAR) AS process_id FROM src WHERE processId IS NOT NULL"""))
def drop_null_ids_q(spark, sf):
    s = _src(spark, sf).select("event_id", F.col("processId").alias("process_id"))
    return drop_null_ids(s)


@register("project_rename", "P19", with_ctes(SRC, body="""
SELECT "timestamp" AS ts, tagId AS tag_id, value FROM src"""))
def project_rename_q(spark, sf):
    return project_rename(_src(spark, sf), {"timestamp": "ts", "tagId": "tag_id", "value": "value"})


@register("count_recent_by_process", "A5 P11", with_ctes(SRC, body=f"""
SELECT CAST(processId AS VARCHAR) AS process_id, count(*) AS recent_rows FROM src
WHERE processId IS NOT NULL AND "timestamp" >= TIMESTAMP '{NOW}' - INTERVAL 20 DAY GROUP BY processId"""))
def count_recent_by_process(spark, sf):
    return ex.count_recent_by_process(_src(spark, sf), NOW, 20)


@register("month_series", "F13 F11", with_ctes(SRC, MON, body="""
SELECT m.label, m.start, m."end", count(s.event_id) AS rows FROM months m
LEFT JOIN src s ON s."timestamp" >= m.start AND s."timestamp" < m."end" GROUP BY ALL"""))
def month_series(spark, sf):
    m = ex.months(spark, NOW, DAYS)
    per_month = (_src(spark, sf).select(F.date_format("timestamp", "yyyy-MM").alias("label"))
                 .groupBy("label").agg(F.count(F.lit(1)).alias("rows")))
    return (m.join(per_month, "label", "left")
             .select("label", "start", "end", F.coalesce("rows", F.lit(0)).cast("long").alias("rows")))


@register("work_grid", "J4", with_ctes(SRC, MON, GRID, body="SELECT process_id, label FROM grid"))
def work_grid(spark, sf):
    return _grid(spark, sf).select("process_id", "label")


@register("anti_already_done", "J5", with_ctes(SRC, MON, GRID, DONE, body="""
SELECT process_id, label FROM grid EXCEPT SELECT process_id, label FROM done"""))
def anti_already_done(spark, sf):
    g = _grid(spark, sf)
    return ex.pending(g, _done(g)).select("process_id", "label")


@register("difference_pending", "U5", with_ctes(SRC, MON, GRID, body="""
SELECT process_id FROM procs EXCEPT SELECT process_id FROM procs WHERE CAST(process_id AS BIGINT) % 5 = 0"""))
def difference_pending(spark, sf):
    p = ex.distinct_processes(_src(spark, sf))
    return ex.difference_pending(p, p.where(F.col("process_id").cast("long") % 5 == 0))


_SCAN_SQL = with_ctes(SRC, MON, GRID, body=f"""
SELECT g.process_id, g.label, s."timestamp" + to_hours(CASE WHEN s.processId IN ({_OV}) THEN 4 ELSE 3 END) AS ts,
       s.tagId AS tag_id, s.value
FROM src s JOIN grid g ON g.process_id = CAST(s.processId AS VARCHAR)
 AND s."timestamp" >= g.start AND s."timestamp" < g."end\"""")


@register("scan_source_range", "S4 P10 P19 F10", _SCAN_SQL)
def scan_source_range(spark, sf):
    out = ex.scan_source_range(_src(spark, sf), _grid(spark, sf), OVERRIDES)
    return out.select("process_id", "label", "ts", "tag_id", "value")


_SPLIT_SQL = with_ctes(SRC, MON, GRID, f"""
r(process_id, label, s, e) AS (
  SELECT process_id, label, start, "end" FROM grid
  UNION ALL
  SELECT x.process_id, x.label, CASE WHEN h.i = 0 THEN x.s ELSE x.mid END, CASE WHEN h.i = 0 THEN x.mid ELSE x.e END
  FROM (SELECT r.process_id, r.label, r.s, r.e,
               make_timestamp(epoch_us(r.s) + CAST(round_even((epoch_us(r.e) - epoch_us(r.s)) / 2.0, 0) AS BIGINT)) AS mid,
               (SELECT count(*) FROM src WHERE CAST(src.processId AS VARCHAR) = r.process_id
                  AND src."timestamp" >= r.s AND src."timestamp" < r.e) AS n
        FROM r) x CROSS JOIN (VALUES (0), (1)) h(i)
  WHERE x.n > {CAP}),
leaves AS (
  SELECT r.process_id, r.label, r.s AS start, r.e AS "end",
         (SELECT count(*) FROM src WHERE CAST(src.processId AS VARCHAR) = r.process_id
            AND src."timestamp" >= r.s AND src."timestamp" < r.e) AS rows
  FROM r)""", body="", recursive=True)


def _chunks(spark, sf):
    return ex.adaptive_range_split(_src(spark, sf), _grid(spark, sf), cap=CAP)


@register("adaptive_range_split", "T5 F17", _SPLIT_SQL + f"""
SELECT process_id, label, start, "end", rows FROM leaves WHERE rows > 0 AND rows <= {CAP}""")
def adaptive_range_split(spark, sf):
    return _chunks(spark, sf).select("process_id", "label", "start", "end", "rows")


@register("part_number", "W2 F5", _SPLIT_SQL + f"""
, lv AS (SELECT * FROM leaves WHERE rows > 0 AND rows <= {CAP})
SELECT process_id, label, start,
       row_number() OVER (PARTITION BY process_id, label ORDER BY start) AS part,
       count(*) OVER (PARTITION BY process_id, label) AS parts,
       CASE WHEN count(*) OVER (PARTITION BY process_id, label) <= 1 THEN 'processo_' || process_id || '.csv'
            ELSE 'processo_' || process_id || '-parte' || CAST(row_number() OVER (PARTITION BY process_id, label ORDER BY start) AS VARCHAR) || '.csv' END AS file_name
FROM lv""")
def part_number(spark, sf):
    return ex.number_parts(_chunks(spark, sf)).select("process_id", "label", "start", "part", "parts", "file_name")


@register("chunk_row_totals", "A11", _SPLIT_SQL + f"""
SELECT process_id, label, CAST(sum(rows) AS BIGINT) AS rows, count(*) AS parts
FROM leaves WHERE rows > 0 AND rows <= {CAP} GROUP BY process_id, label""")
def chunk_row_totals(spark, sf):
    return ex.chunk_row_totals(ex.number_parts(_chunks(spark, sf)))


_FAILED = "CAST(process_id AS BIGINT) % 11 = 3 AND label = '2024-01'"


@register("extraction_outcomes", "A15 A5 J5", with_ctes(SRC, MON, GRID, DONE, f"""
pend AS (SELECT process_id, label FROM grid EXCEPT SELECT process_id, label FROM done),
recent AS (SELECT CAST(processId AS VARCHAR) AS process_id, count(*) AS n FROM src
           WHERE processId IS NOT NULL AND "timestamp" >= TIMESTAMP '{NOW}' - INTERVAL 20 DAY GROUP BY processId),
got AS (SELECT p.process_id, p.label, count(*) AS n FROM pend p JOIN grid g USING (process_id, label)
        JOIN src s ON CAST(s.processId AS VARCHAR) = g.process_id AND s."timestamp" >= g.start AND s."timestamp" < g."end"
        WHERE NOT ({_FAILED.replace('process_id', 'p.process_id').replace('label', 'p.label')}) GROUP BY ALL),
bad AS (SELECT process_id, count(*) AS n FROM pend WHERE {_FAILED} GROUP BY 1),
o AS (SELECT pr.process_id, coalesce(r.n, 0) > 0 AND pr.process_id IN (SELECT process_id FROM pend) AS tried, coalesce(b.n, 0) AS bad
      FROM procs pr LEFT JOIN recent r USING (process_id) LEFT JOIN bad b USING (process_id)),
g AS (SELECT process_id, count(*) AS pairs, sum(n) AS n FROM got GROUP BY 1)""",
    body="""
SELECT process_id, CASE WHEN NOT tried THEN 'skipped' WHEN bad > 0 THEN 'error' ELSE 'extracted' END AS outcome,
       CAST(CASE WHEN tried THEN coalesce(pairs, 0) ELSE 0 END AS BIGINT) AS pairs,
       CAST(CASE WHEN tried THEN coalesce(n, 0) ELSE 0 END AS BIGINT) AS rows,
       CAST(CASE WHEN tried THEN bad ELSE 0 END AS BIGINT) AS errors
FROM o LEFT JOIN g USING (process_id)"""))
def extraction_outcomes(spark, sf):
    """Outcomes with pairs that failed: those of some processes in one month."""
    g = _grid(spark, sf)
    src = _src(spark, sf)
    recent = ex.count_recent_by_process(src, NOW, 20)
    failed = g.where(_FAILED).select("process_id", "label")
    extracted = ex.scan_source_range(src, g, OVERRIDES).groupBy("process_id", "label").agg(F.count(F.lit(1)).alias("rows"))
    return ex.extraction_outcomes(g, _done(g), recent, extracted.join(failed, ["process_id", "label"], "left_anti"), failed)


@register("sink_month_process_csv", "S8 S3 U1", _SCAN_SQL.replace("SELECT g.process_id, g.label,", "SELECT g.label, g.process_id,"))
def sink_month_process_csv_q(spark, sf):
    # every row lands in its chunk (part) of its (process, month): the numbered chunk table
    # is the range table, so the name of its file travels with the row
    chunks = ex.number_parts(_chunks(spark, sf)).select("process_id", "label", "start", "end", "file_name")
    labelled = ex.scan_source_range(_src(spark, sf), chunks, OVERRIDES)
    path = session.scratch_dir(spark, "month-csv")
    sink_month_process_csv(labelled, path)
    back = scan_readings_csv(spark, path)
    return back.select(F.col("file_month").alias("label"), F.col("file_process").alias("process_id"),
                       "ts", "tag_id", "value")


@register("extract_readings", "A15 S15 S8 T5 A11", with_ctes(SRC, MON, GRID, DONE, f"""
pend AS (SELECT process_id, label FROM grid WHERE label <> '2023-12'),
n AS (SELECT g.process_id, g.label, count(*) AS n FROM grid g JOIN pend USING (process_id, label)
      JOIN src s ON CAST(s.processId AS VARCHAR) = g.process_id AND s."timestamp" >= g.start AND s."timestamp" < g."end" GROUP BY ALL),
recent AS (SELECT CAST(processId AS VARCHAR) AS process_id, count(*) AS c FROM src WHERE "timestamp" >= TIMESTAMP '{NOW}' - INTERVAL {DAYS} DAY GROUP BY 1)""", body="""
SELECT p.process_id, CASE WHEN coalesce(any_value(c), 0) > 0 AND count(DISTINCT pend.label) > 0 THEN 'extracted' ELSE 'skipped' END AS outcome,
       CAST(CASE WHEN coalesce(any_value(c), 0) > 0 THEN count(n.n) ELSE 0 END AS BIGINT) AS pairs,
       CAST(CASE WHEN coalesce(any_value(c), 0) > 0 THEN coalesce(sum(n.n), 0) ELSE 0 END AS BIGINT) AS rows, CAST(0 AS BIGINT) AS errors
FROM (SELECT DISTINCT CAST(processId AS VARCHAR) AS process_id FROM src WHERE processId IS NOT NULL) p
LEFT JOIN pend USING (process_id) LEFT JOIN n USING (process_id, label) LEFT JOIN recent USING (process_id) GROUP BY 1"""))
def extract_readings(spark, sf):
    """The extraction flow resumed: the first month is in the done folder, the rest is
    extracted to the dump folder; a second run finds nothing pending."""
    source = _src(spark, sf)
    base = session.scratch_dir(spark, "extraction")
    g = ex.work_grid(ex.distinct_processes(source), NOW, DAYS)
    first = g.where("label = '2023-12'").select("process_id", "label", F.format_string("processo_%s.csv", "process_id").alias("file_name"),
                                               F.col("start").alias("ts"), F.lit("t").alias("tag_id"), F.lit(1.0).alias("value"))
    sink_month_process_csv(first, f"{base}/made")
    return flows.extract_readings(spark, source, f"{base}/dump", f"{base}/made", NOW, DAYS, OVERRIDES, cap=CAP)


def _paths(spark, sf):
    ev = roles.table(spark, sf, "events")
    u, e = F.col("user_id"), F.col("event_id")
    name = (F.when(u % 7 == 0, F.concat(F.lit("other_"), u.cast("string"), F.lit(".txt")))
             .when(u % 3 == 0, F.concat(F.lit("processo_"), u.cast("string"), F.lit("-parte"),
                                        (e % 3 + 1).cast("string"), F.lit(".csv")))
             .otherwise(F.concat(F.lit("processo_"), u.cast("string"), F.lit(".csv"))))
    name = F.when(e % 50 == 0, F.concat(F.lit(MANIFEST_PREFIX), name)).otherwise(name)
    return ev.select(F.concat(F.lit("/dump/"), F.date_format("ts", "yyyy-MM"), F.lit("/"), name).alias("file")).distinct()


_PATHS_SQL = f"""
paths AS (SELECT DISTINCT '/dump/' || strftime(ts, '%Y-%m') || '/' ||
            CASE WHEN event_id % 50 = 0 THEN '{MANIFEST_PREFIX}' ELSE '' END ||
            CASE WHEN user_id % 7 = 0 THEN 'other_' || CAST(user_id AS VARCHAR) || '.txt'
                 WHEN user_id % 3 = 0 THEN 'processo_' || CAST(user_id AS VARCHAR) || '-parte' || CAST(event_id % 3 + 1 AS VARCHAR) || '.csv'
                 ELSE 'processo_' || CAST(user_id AS VARCHAR) || '.csv' END AS file
          FROM events)"""
_RX = r"processo_(.+?)(?:-parte(\d+))?\.csv$"


@register("filename_parse", "F3", with_ctes(_PATHS_SQL, body=f"""
SELECT file,
       coalesce(NULLIF(regexp_extract(regexp_extract(file, '[^/]*$'), '{_RX}', 1), ''), regexp_extract(file, '[^/]*$')) AS sort_process,
       CAST(coalesce(NULLIF(regexp_extract(regexp_extract(file, '[^/]*$'), '{_RX}', 2), ''), '0') AS INTEGER) AS sort_part
FROM paths"""))
def filename_parse(spark, sf):
    p = _paths(spark, sf)
    return p.select("file", fn_txt.parse_csv_name_process("file").alias("sort_process"),
                    fn_txt.parse_csv_name_part("file").alias("sort_part"))


@register("path_parts", "F4", with_ctes(_PATHS_SQL, body=f"""
SELECT file, regexp_extract(file, '[^/]*$') AS base, split_part(file, '/', 3) AS parent,
       starts_with(regexp_extract(file, '[^/]*$'), '{MANIFEST_PREFIX}') AS is_manifest
FROM paths"""))
def path_parts(spark, sf):
    p = _paths(spark, sf)
    return p.select("file", fn_txt.base_name("file").alias("base"), fn_txt.parent_dir("file").alias("parent"),
                    fn_txt.has_prefix(fn_txt.base_name("file"), MANIFEST_PREFIX).alias("is_manifest"))


@register("file_order", "O3", with_ctes(_PATHS_SQL, body=f"""
SELECT file,
       coalesce(NULLIF(regexp_extract(regexp_extract(file, '[^/]*$'), '{_RX}', 1), ''), regexp_extract(file, '[^/]*$')) AS sort_process,
       split_part(file, '/', 3) AS sort_month,
       CAST(coalesce(NULLIF(regexp_extract(regexp_extract(file, '[^/]*$'), '{_RX}', 2), ''), '0') AS INTEGER) AS sort_part
FROM paths ORDER BY sort_process, sort_month, sort_part"""))
def file_order_q(spark, sf):
    return file_order(_paths(spark, sf))


@register("file_name_sort", "O6 S2", with_ctes(_PATHS_SQL, body=f"""
SELECT file FROM paths WHERE NOT starts_with(regexp_extract(file, '[^/]*$'), '{MANIFEST_PREFIX}')
  AND ends_with(file, '.csv') ORDER BY file"""))
def file_name_sort_q(spark, sf):
    p = _paths(spark, sf)
    keep = ~fn_txt.base_name("file").startswith(MANIFEST_PREFIX) & F.col("file").endswith(".csv")
    return file_name_sort(p.where(keep))


@register("resume_export", "S15 J5", with_ctes(SRC, MON, GRID, DONE, body="""
SELECT process_id, label FROM grid EXCEPT SELECT process_id, label FROM done"""))
def resume_export(spark, sf):
    """What is left to extract, by the files in the dump and the done folder."""
    g = _grid(spark, sf)
    done = _done(g).select("process_id", "label", F.format_string("processo_%s.csv", "process_id").alias("file_name"), F.lit("t").alias("tag_id"),
                           F.to_timestamp_ntz("label", F.lit("yyyy-MM")).alias("ts"), F.lit(1.0).alias("value"))
    base = session.scratch_dir(spark, "exported")
    sink_month_process_csv(done.where("label = '2023-12'"), f"{base}/made")
    sink_month_process_csv(done.where("label <> '2023-12'"), f"{base}/dump")
    return ex.pending(g, exported_pairs(spark, f"{base}/dump", f"{base}/made")).select("process_id", "label")
