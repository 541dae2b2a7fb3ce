"""Catalog: process hierarchy and unit-id backfill over part (J1, J2, E3, P13, P14, P21,
A10, S6, S7, S11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra import session
from telemetra.constants import MODEL_CONFIG_TYPE
from telemetra.operators import hierarchy as h
from telemetra.operators.filters import active_of_type, changed, process_filter
from telemetra.plans import roles
from telemetra.plans.registry import register, with_ctes
from telemetra.sources.tables import lookup_process, scan_active_configs, write_keyed_update

PP, PC, RES = roles.SQL_PART_PROCESS, roles.SQL_PART_CONFIGS, roles.SQL_RESOLVED
T = MODEL_CONFIG_TYPE

_ACTIVE = f"act AS (SELECT process_id, created_at, unit_id FROM cfg WHERE active AND type = '{T}')"
_JOINED = """
joined AS (
  SELECT a.process_id, a.created_at, a.unit_id, r.unit_id AS resolved_unit_id,
         CASE WHEN r.process_id IS NULL THEN 'missing' ELSE r.error END AS error
  FROM act a LEFT JOIN resolved r ON r.process_id = a.process_id)"""
_OUTCOME = """
outc AS (
  SELECT *, CASE WHEN error IS NOT NULL THEN 'error'
                 WHEN unit_id IS DISTINCT FROM resolved_unit_id THEN 'updated' ELSE 'skipped' END AS outcome
  FROM joined)"""


def _roots(spark, sf):
    return h.resolve_roots(roles.part_process(spark, sf))


def _outcomes(spark, sf):
    configs = scan_active_configs(roles.part_configs(spark, sf), T)
    return h.backfill_outcomes(h.lookup_configs(configs, _roots(spark, sf)))


@register("resolve_root", "J2", with_ctes(PP, RES, body="SELECT process_id, unit_id, error, depth FROM resolved", recursive=True))
def resolve_root(spark, sf):
    return _roots(spark, sf)


@register("update_roots", "J2 P21", with_ctes(PP, RES, body="SELECT process_id, unit_id, error, depth FROM resolved", recursive=True))
def update_roots(spark, sf):
    """The roots after a change: before it, one process in 97 was a root of its own and one
    in 101 was not there yet. Only what leads to those is resolved again."""
    now = roles.part_process(spark, sf)
    one_in = lambda n: F.crc32(F.col("process_id").cast("string")) % n == 0
    before = now.where(~one_in(101)).withColumn("level", F.when(one_in(97), "root").otherwise(F.col("level")))
    known = session.materialize(h.resolve_roots(before), "roots")
    return h.update_roots(now, known, now.where(one_in(97) | one_in(101)).select("process_id"))


@register("scan_active_configs", "S6 P13", with_ctes(PC, _ACTIVE, body="SELECT * FROM act"))
def scan_active(spark, sf):
    return scan_active_configs(roles.part_configs(spark, sf), T)


@register("active_of_type", "P13", with_ctes(PC, body=f"""
SELECT process_id, created_at FROM cfg WHERE active AND type = 'OTHER'"""))
def active_other(spark, sf):
    return active_of_type(roles.part_configs(spark, sf), "OTHER").select("process_id", "created_at")


@register("process_filter", "P14", with_ctes(PC, _ACTIVE, body="SELECT * FROM act WHERE process_id = '1102'"))
def process_filter_q(spark, sf):
    return process_filter(scan_active_configs(roles.part_configs(spark, sf), T), "1102")


@register("lookup_process", "S7", with_ctes(PP, PC, body="""
SELECT c.process_id, p.level FROM cfg c LEFT JOIN proc p ON p.process_id = c.process_id"""))
def lookup_process_q(spark, sf):
    return lookup_process(roles.part_process(spark, sf), roles.part_configs(spark, sf))


@register("config_process_lookup", "J1", with_ctes(PP, PC, RES, _ACTIVE, _JOINED, body="SELECT * FROM joined", recursive=True))
def config_process_lookup(spark, sf):
    configs = scan_active_configs(roles.part_configs(spark, sf), T)
    return h.lookup_configs(configs, _roots(spark, sf))


@register("row_error_isolation", "E3", with_ctes(PP, PC, RES, _ACTIVE, _JOINED, _OUTCOME, body="""
SELECT process_id, created_at, outcome, error FROM outc""", recursive=True))
def row_error_isolation(spark, sf):
    return _outcomes(spark, sf).select("process_id", "created_at", "outcome", "error")


@register("change_filter", "P21", with_ctes(PP, PC, RES, _ACTIVE, _JOINED, body="""
SELECT process_id, created_at, unit_id, resolved_unit_id FROM joined
WHERE error IS NULL AND unit_id IS DISTINCT FROM resolved_unit_id""", recursive=True))
def change_filter(spark, sf):
    j = h.lookup_configs(scan_active_configs(roles.part_configs(spark, sf), T), _roots(spark, sf))
    return j.where(F.col("error").isNull() & changed()).select("process_id", "created_at", "unit_id",
                                                               "resolved_unit_id")


@register("backfill_outcome_counts", "A10", with_ctes(PP, PC, RES, _ACTIVE, _JOINED, _OUTCOME, body="""
SELECT outcome, count(*) AS n FROM outc GROUP BY outcome""", recursive=True))
def backfill_outcome_counts(spark, sf):
    return h.outcome_counts(_outcomes(spark, sf))


@register("sink_keyed_update", "S11", with_ctes(PP, PC, RES, _ACTIVE, _JOINED, _OUTCOME, body="""
SELECT c.process_id, c.created_at,
       coalesce(u.resolved_unit_id, c.unit_id) AS unit_id, c.active, c.type
FROM cfg c LEFT JOIN (SELECT process_id, created_at, resolved_unit_id FROM outc WHERE outcome = 'updated') u
  ON u.process_id = c.process_id AND u.created_at = c.created_at""", recursive=True))
def sink_keyed_update(spark, sf):
    configs = roles.part_configs(spark, sf)
    updated = h.apply_updates(configs, h.change_set(_outcomes(spark, sf)))
    path = session.scratch_dir(spark, "configs")
    write_keyed_update(updated, path)
    return spark.read.parquet(path)
