"""Extraction planning from a source readings table (A4, A5, F13, J4, J5, U5, S4, S15,
T5, W2, A11, A15).

The source table has ``processId, timestamp, tagId, value`` (any ``spark.read`` relation).
What used to be one remote query per process and month becomes set-at-a-time joins and
aggregates: one ``groupBy(process)`` instead of N count queries, one grid join instead of a
nested loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from telemetra.session import materialize, release

from telemetra.constants import DAYS_BACK, SOURCE_ROW_CAP
from telemetra.functions.text import csv_part_name
from telemetra.functions.timefmt import midpoint, month_dash, month_series
from telemetra.operators.clock import clock_shift
from telemetra.operators.filters import drop_null_ids



def _lit_ts(now):
    return now if hasattr(now, "alias") else F.lit(str(now)).cast("timestamp_ntz")


def distinct_processes(source: DataFrame, col: str = "processId") -> DataFrame:
    """A4 + P22: distinct non-null process ids as strings."""
    return drop_null_ids(source.select(F.col(col).alias("process_id")), "process_id").distinct()


def count_recent_by_process(source: DataFrame, now, days: int = DAYS_BACK,
                            col: str = "processId", ts: str = "timestamp") -> DataFrame:
    """A5 + P11: rows per process in the last N days (one aggregate for all processes).
    Processes with zero recent rows are absent (callers left-join and treat NULL as 0)."""
    since = _lit_ts(now) - F.make_dt_interval(days=F.lit(days))
    return (source.where(F.col(ts) >= since).where(F.col(col).isNotNull())
                  .groupBy(F.col(col).cast("string").alias("process_id"))
                  .agg(F.count(F.lit(1)).alias("recent_rows")))


def months(spark, now, days: int = DAYS_BACK) -> DataFrame:
    """``(start, end, label)`` for each month from the month of (now − days) to now."""
    base = spark.range(1).select(F.explode(month_series(_lit_ts(now), days)).alias("start"))
    return base.select("start", (F.col("start") + F.expr("INTERVAL 1 MONTH")).alias("end"),
                       month_dash(F.col("start")).alias("label"))


def work_grid(processes: DataFrame, now, days: int = DAYS_BACK) -> DataFrame:
    """Every process × every month of the look-back, as ``(process_id, start, end,
    label)``. Each process row explodes the month array (a few dozen entries at most,
    bounded by the look-back) — a per-row generator, no join."""
    m = F.explode(month_series(_lit_ts(now), days)).alias("start")
    return (processes.select("*", m)
                     .withColumn("end", F.col("start") + F.expr("INTERVAL 1 MONTH"))
                     .withColumn("label", month_dash(F.col("start"))))


def pending(grid: DataFrame, done: DataFrame, keys=("process_id", "label")) -> DataFrame:
    """Grid minus the (process, month) pairs that already have output."""
    return grid.join(done.select(*keys).distinct(), list(keys), "left_anti")


def difference_pending(candidates: DataFrame, done: DataFrame) -> DataFrame:
    """Id-only set difference (duplicates in ``candidates`` removed, like a set)."""
    return candidates.subtract(done)


def _within(src: DataFrame, r: DataFrame) -> DataFrame:
    """Rows of ``src`` (process_id, ts, ...) joined to the ranges (_rp, _rs, _re, ...) they
    fall in. A range is listed once for each day it touches."""
    low, high = r.agg(F.min("_rs"), F.max("_re")).first()
    if low is not None:
        src = src.where((F.col("ts") >= F.lit(low).cast("timestamp_ntz")) & (F.col("ts") < F.lit(high).cast("timestamp_ntz")))
    last = F.col("_re").cast("timestamp_ntz") - F.expr("INTERVAL 0.000001 SECOND")
    days = F.sequence(F.to_date("_rs"), F.greatest(F.to_date(last), F.to_date("_rs")))
    by_day = r.where("_rs < _re").withColumn("_day", F.explode(days))
    return src.join(by_day, (F.col("process_id") == F.col("_rp")) & (F.to_date("ts") == F.col("_day"))
                    & (F.col("ts") >= F.col("_rs")) & (F.col("ts") < F.col("_re")), "inner").drop("_day")


def scan_source_range(source: DataFrame, ranges: DataFrame, overrides=None,
                      col: str = "processId", ts: str = "timestamp", tag: str = "tagId") -> DataFrame:
    """S4 + P10 + P19: rows of each (process, [start, end)) range, renamed to
    ``ts, tag_id, value`` and shifted by the process's clock offset.

    The outer bounds of all ranges are literals on ``ts``, so they reach the scan; the join
    is on process and day, so a source row meets only the ranges of its process and day, and
    the half-open condition is checked on those.
    """
    r = ranges.select(F.col("process_id").alias("_rp"), F.col("start").alias("_rs"),
                      F.col("end").alias("_re"), *[c for c in ranges.columns
                                                   if c not in ("process_id", "start", "end")])
    src = source.select(F.col(col).cast("string").alias("process_id"), F.col(ts).alias("ts"),
                        F.col(tag).alias("tag_id"), F.col("value"))
    joined = _within(src, r)
    return clock_shift(joined.drop("_rp", "_rs", "_re"), overrides)


LEVELS_PER_PASS = 8


def _us(c):
    return F.unix_micros(c.cast("timestamp"))


def _ts_from_us(c):
    return F.timestamp_micros(c).cast("timestamp_ntz")


def _descend(start, end, levels, right: str):
    """The range (s, e, path) that is ``levels`` (a column) halvings below ``[start, end)`` in
    micros; ``right`` is SQL over ``mid`` and the level ``i`` that chooses the half, ``path``
    the halves taken as bits. The midpoint rounds half to even like the original."""
    mid = "(a.s + cast(bround(cast(a.e - a.s AS DOUBLE) / 2) AS BIGINT))"
    goes = f"({right.replace('mid', mid)})"
    step = f"named_struct('s', if({goes}, {mid}, a.s), 'e', if({goes}, a.e, {mid}), 'path', a.path * 2 + if({goes}, 1L, 0L))"
    return F.expr(f"aggregate(slice(sequence(0, {levels}), 1, {levels}), named_struct('s', {start}, 'e', {end}, 'path', 0L), (a, i) -> {step})")


def _halved(rows: DataFrame, levels: int) -> DataFrame:
    """``rows`` (``_t`` in ``[_s, _e)``) with ``_path``, the halves that ``levels`` halvings put ``_t``
    in: the walk of ``_descend`` as plain columns, for the many rows."""
    for _ in range(levels):
        rows = rows.withColumn("_m", F.col("_s") + F.bround((F.col("_e") - F.col("_s")).cast("double") / 2.0).cast("long"))
        right, mid = F.col("_t") >= F.col("_m"), F.col("_m")
        rows = rows.withColumns({"_s": F.when(right, mid).otherwise(F.col("_s")), "_e": F.when(right, F.col("_e")).otherwise(mid),
                                 "_path": F.col("_path") * 2 + F.when(right, 1).otherwise(0).cast("long")}).drop("_m")
    return rows


def adaptive_range_split(source: DataFrame, ranges: DataFrame, cap: int = SOURCE_ROW_CAP,
                         col: str = "processId", ts: str = "timestamp") -> DataFrame:
    """T5 (re-aimed): halve every range holding more than ``cap`` rows until none does.

    Month ranges within the cap are final after one aggregate. Rows of the others are
    projected to (process, month, ts) and staged once, never rewritten. A pass is one
    counting of them by the finest cell, 8 halvings below the ranges still over the cap (a
    partial aggregate of at most 256 cells a range); the ranges in between are sums of
    cells. Final are ranges with rows but no more than ``cap``, whose parent had more; the
    deepest still over the cap start the next pass, where rows find them by their path of
    halves, an equi-join. A range of one microsecond cannot be halved and is final whatever
    it holds. Returns ``(process_id, label, start, end, rows)`` for the non-empty final
    ranges; together they hold exactly the rows of the unsplit ranges.
    """
    r = ranges.select(F.col("process_id").alias("_rp"), F.col("start").alias("_rs"),
                      F.col("end").alias("_re"), F.col("label"))
    rows = _within(source.select(F.col(col).cast("string").alias("process_id"), F.col(ts).alias("ts")), r).select(
        "process_id", "label", "ts", F.col("_rs").alias("start"), F.col("_re").alias("end"))
    month = ["process_id", "label", "start", "end"]
    counts = rows.groupBy(*month).agg(F.count(F.lit(1)).alias("rows")).transform(materialize)
    final = counts.where(F.col("rows") <= cap)
    over = counts.where(F.col("rows") > cap).select(*month)
    if over.isEmpty():
        return final
    at = ["process_id", "label", "_s0", "_e0"]
    live = (rows.join(over, month, "left_semi")
                .select("process_id", "label", _us(F.col("start")).alias("_s0"), _us(F.col("end")).alias("_e0"), _us(F.col("ts")).alias("_t"))
                .transform(materialize))
    stages, still, depth = [counts], None, 0
    while True:
        if depth == 0:
            walked = live.withColumns({"_s": F.col("_s0"), "_e": F.col("_e0"), "_path": F.lit(0).cast("long")})
        else:
            walked = live.withColumn("x", _descend("_s0", "_e0", depth, "_t >= mid")).select("*", F.col("x.s").alias("_s"), F.col("x.e").alias("_e"), F.col("x.path").alias("_path")).drop("x")
            walked = walked.join(still, [*at, "_path"], "left_semi")
        top = F.col("_path")
        cells = _halved(walked.withColumn("_top", top).withColumn("_path", F.lit(0).cast("long")), LEVELS_PER_PASS)
        cells = cells.groupBy(*at, "_top", F.col("_path").alias("_cell")).agg(F.count(F.lit(1)).alias("n")).transform(materialize)
        stages.append(cells)
        # every range between: the cells that share its first d halves
        levels = F.explode(F.array(*map(F.lit, range(1, LEVELS_PER_PASS + 1)))).alias("d")
        sums = cells.select(*at, "_top", levels, "_cell", "n")
        sums = sums.groupBy(*at, "_top", "d", F.expr(f"shiftright(_cell, {LEVELS_PER_PASS} - d)").alias("x")).agg(F.sum("n").alias("rows"))
        parents = sums.select(*at, "_top", (F.col("d") + 1).alias("d"), F.col("x").alias("_px"), F.col("rows").alias("_pn"))
        cand = sums.withColumn("_px", F.shiftright("x", 1)).join(parents, [*at, "_top", "d", "_px"], "left")
        cand = cand.where((F.col("d") == 1) | (F.col("_pn") > cap))  # at d = 1 the parent is the pass's range
        cand = cand.withColumn("_path", F.expr("shiftleft(_top, d) | x"))
        bounded = _bounds(cand.select(*at, "d", "_path", "rows"), depth).transform(materialize)
        stages.append(bounded)
        ends = (F.col("rows") <= cap) | ((F.col("d") == LEVELS_PER_PASS) & (F.col("_e") - F.col("_s") <= 1))
        final = final.unionByName(bounded.where(ends).select("process_id", "label", _ts_from_us(F.col("_s")).alias("start"),
                                                             _ts_from_us(F.col("_e")).alias("end"), "rows"))
        still = bounded.where((F.col("d") == LEVELS_PER_PASS) & ~ends).select(*at, "_path")
        depth += LEVELS_PER_PASS
        if still.isEmpty():
            out = final.transform(materialize)
            release(live, *stages)   # row and count stages are not read by the result
            return out


def _bounds(ranges: DataFrame, depth: int) -> DataFrame:
    """``[_s, _e)`` of ranges given by their path, ``depth + d`` halves below ``[_s0, _e0)``."""
    at = _descend("_s0", "_e0", f"({depth} + d)", f"(shiftright(_path, {depth} + d - 1 - i) & 1) = 1")
    return ranges.withColumn("x", at).select("*", F.col("x.s").alias("_s"), F.col("x.e").alias("_e")).drop("x")


def number_parts(chunks: DataFrame) -> DataFrame:
    """``part`` = 1..N in time order inside each (process, month), ``parts`` = N, and the
    output file name (F5)."""
    g = ["process_id", "label"]
    w = Window.partitionBy(*g).orderBy("start")
    return (chunks.withColumn("part", F.row_number().over(w).cast("long"))
                  .withColumn("parts", F.count(F.lit(1)).over(Window.partitionBy(*g)).cast("long"))
                  .withColumn("file_name", csv_part_name(F.col("process_id"), F.col("part"), F.col("parts"))))


def chunk_row_totals(numbered: DataFrame) -> DataFrame:
    """Total rows and number of parts per (process, month)."""
    return (numbered.groupBy("process_id", "label")
                    .agg(F.sum("rows").cast("long").alias("rows"), F.max("part").cast("long").alias("parts")))


def extraction_outcomes(grid: DataFrame, done: DataFrame, recent: DataFrame, extracted: DataFrame,
                        failed: DataFrame | None = None) -> DataFrame:
    """One row per process: ``skipped`` (nothing pending, or no recent rows: nothing is
    extracted), ``error`` (a pending pair is in ``failed``), else ``extracted``; with the
    number of (process, month) pairs that produced output, their rows where ``extracted`` has
    them, and the number of failed pairs."""
    pend = pending(grid, done).select("process_id", "label")
    rows = F.col("rows") if "rows" in extracted.columns else F.lit(None).cast("long")
    pairs = extracted.groupBy("process_id", "label").agg(F.sum(rows).alias("rows"))
    got = pairs.join(pend, ["process_id", "label"], "left_semi").groupBy("process_id").agg(F.count(F.lit(1)).alias("pairs"), F.sum("rows").alias("rows"))
    bad = (grid.limit(0) if failed is None else failed).select("process_id", "label").distinct()
    bad = bad.join(pend, ["process_id", "label"], "left_semi").groupBy("process_id").agg(F.count(F.lit(1)).alias("errors"))
    waiting = pend.groupBy("process_id").agg(F.count(F.lit(1)).alias("pending_months"))
    out = grid.select("process_id").distinct()
    for side in (waiting, recent, got, bad):
        out = out.join(side, "process_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    skipped = F.col("pending_months").isNull() | (zero("recent_rows") == 0)
    count = lambda c: F.when(skipped, F.lit(0).cast("long")).otherwise(zero(c)).alias(c)
    return out.select("process_id", F.when(skipped, "skipped").when(zero("errors") > 0, "error").otherwise("extracted").alias("outcome"),
                      count("pairs"), count("rows"), count("errors"))
