"""Table scans and sinks (S4 wrapper, S5, S6, S7, S9, S10, S11, S16).

Stored tables are parquet folders partitioned by ``(month, company_id)`` (month = yyyyMM
of the shifted ts) except predictions, which is unpartitioned. Filters on company, period
and tags are written so the parquet scan shows them in ``PushedFilters`` and the partition
filters prune folders.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from telemetra.constants import EXPORT_TS_COLUMN
from telemetra.session import observed
from telemetra.sources import commits
from telemetra.operators.dedup import READINGS_KEY, replace_dedup, with_partition_cols
from telemetra.operators.filters import active_of_type, company_filter, period_inclusive, tag_in_list


def scan_readings_slice(readings: DataFrame, company_id: str, start, end, tags=None,
                        dedup: bool = True, key=READINGS_KEY, seq: str = "ingest_seq", keep_seq: bool = False) -> DataFrame:
    """``ts, tag_id, value`` of one company, inclusive period, optional tags; consolidated
    (last write wins, read-time) unless ``dedup`` is False, which returns raw duplicates.
    With ``keep_seq`` also the sequence (null if the table has none), which orders them."""
    month_col = "month" if "month" in readings.columns else None
    df = period_inclusive(company_filter(readings, company_id), start, end, month_col=month_col)
    df = tag_in_list(df, tags)
    if dedup and seq in df.columns:
        df = replace_dedup(df.select(*key, "value", seq), key, seq, keep_seq=keep_seq)
    if not keep_seq:
        return df.select("ts", "tag_id", "value")
    return df.select("ts", "tag_id", "value", (F.col(seq) if seq in df.columns else F.lit(None).cast("long")).alias(seq))


def scan_active_configs(configs: DataFrame, config_type: str) -> DataFrame:
    """S6 + P13: active configs of one type, projected to the fields the backfill needs."""
    return active_of_type(configs, config_type).select("process_id", "created_at", "unit_id")


def lookup_process(process: DataFrame, ids: DataFrame) -> DataFrame:
    """``(process_id, level)`` for each requested id, NULL level when absent."""
    p = process.select("process_id", "level").dropDuplicates(["process_id"])
    return ids.select("process_id").join(p, "process_id", "left")


def sink_append(df: DataFrame, path: str, partitioned: bool = True, batch_rows: int | None = None) -> None:
    """Append rows to a parquet table (partitioned by month and company unless not).
    ``batch_rows`` bounds rows per written file."""
    out = with_partition_cols(df) if partitioned and "month" not in df.columns else df
    if partitioned:
        # AQE rebalance: rows of one (month, company) meet in few tasks (few files), a hot
        # partition is split across tasks instead of landing in one
        out = out.hint("rebalance", "month", "company_id")
    w = out.write.mode("append")
    if batch_rows:
        w = w.option("maxRecordsPerFile", batch_rows)
    if partitioned:
        w = w.partitionBy("month", "company_id")
    w.parquet(path)


BOM = "\ufeff"


def csv_cell(text: str, sep: str = ";") -> str:
    """A text as a CSV cell: quoted where it holds a separator, a quote or a line end."""
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in (sep, '"', "\n", "\r")) else text


def sink_lines(lines: DataFrame, header: str, path: str, name: str) -> int:
    """The rows of ``lines`` (one text column), in the frame's order, under ``header`` as
    the one file ``path/name``; the number of rows.

    Sorted partitions are written side by side and joined byte by byte, so no task holds or
    sorts all rows. The plan runs once: rows are counted as they are written. Without rows
    there is no file, and one of an earlier export under the same name goes.
    """
    spark = lines.sparkSession
    fs, parts, seen = commits.Files(spark, path), f"{path}/_parts-{uuid.uuid4().hex[:12]}", Observation()
    try:
        lines.observe(seen, F.count(F.lit(1)).alias("rows")).write.text(parts)
        rows = observed(seen, "rows")
        if rows:
            fs.join(f"{BOM}{header}\n", parts, f"{path}/{name}")
        else:
            fs.delete(f"{path}/{name}")
    finally:
        fs.delete(parts)
    return rows


def sink_wide_csv(wide_text: DataFrame, path: str, name: str = "export.csv") -> bool:
    """S10 for a wide frame: one ``;``-separated CSV file with header and a UTF-8 BOM, rows in
    the frame's order; nothing when empty. Returns whether it wrote."""
    def text(field):
        value = F.coalesce(F.col(f"`{field.name.replace('`', '``')}`").cast("string"), F.lit(""))
        if field.dataType.typeName() != "string":
            return value
        return F.when(value.rlike('[;"\n\r]'), F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(value)
    line = F.concat_ws(";", *[text(f) for f in wide_text.schema.fields])
    return sink_lines(wide_text.select(line.alias("line")), ";".join(map(csv_cell, wide_text.columns)), path, name) > 0


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read back a wide export; the BOM is removed from the first column name."""
    df = spark.read.option("sep", ";").option("header", "true").option("escape", '"').csv(path)
    first = df.columns[0]
    return df.withColumnRenamed(first, first.lstrip(BOM)) if first.startswith(BOM) else df


def write_keyed_update(updated_configs: DataFrame, path: str) -> None:
    """S11 sink: rewrite the config table with the updated ``unit_id`` values."""
    updated_configs.write.mode("overwrite").parquet(path)


def dry_run(df: DataFrame, n: int = 5, order=None) -> tuple[DataFrame, DataFrame]:
    """The sample (first ``n`` rows) and the row count, nothing written."""
    sample = (df.orderBy(*order) if order else df).limit(n)
    return sample, df.agg(F.count(F.lit(1)).alias("rows"))


__all__ = ["scan_readings_slice", "scan_active_configs", "lookup_process", "sink_append",
           "sink_wide_csv", "read_wide_csv", "write_keyed_update", "dry_run", "EXPORT_TS_COLUMN"]
