"""Clock shift (F10) with override membership.

Every process is shifted by the default offset, override processes by their own offset.
Overrides are either a short literal list (``isin``) or a ``(process_id, hours)`` table.
The planner and adaptive execution choose the join by the table's bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.constants import ALT_HOURS_OFFSET, ALT_PROCESSES, HOURS_OFFSET
from telemetra.functions.text import normalise_id
from telemetra.functions.timefmt import shift_hours


def offset_hours(df: DataFrame, overrides: DataFrame | list[str] | None = None,
                 process_col: str = "process_id", default_hours: int = HOURS_OFFSET,
                 alt_hours: int = ALT_HOURS_OFFSET) -> DataFrame:
    """Add ``offset_h`` — the override's hours when the normalised id is listed."""
    key = normalise_id(F.col(process_col))
    if overrides is None:
        overrides = ALT_PROCESSES
    if isinstance(overrides, (list, tuple, set)):
        ids = sorted({str(i).replace("-", "").lower() for i in overrides})
        return df.withColumn("offset_h", F.when(key.isin(*ids), F.lit(alt_hours))
                                          .otherwise(F.lit(default_hours)))
    ov = (overrides.select(normalise_id("process_id").alias("_ov_id"),
                           F.col("hours").cast("int").alias("_ov_h"))
                   .groupBy("_ov_id").agg(F.max("_ov_h").alias("_ov_h")))
    out = df.withColumn("_ov_key", key).join(ov, F.col("_ov_key") == F.col("_ov_id"), "left")
    return (out.withColumn("offset_h", F.coalesce(F.col("_ov_h"), F.lit(default_hours)))
               .drop("_ov_key", "_ov_id", "_ov_h"))


def clock_shift(df: DataFrame, overrides: DataFrame | list[str] | None = None,
                process_col: str = "process_id", ts_col: str = "ts",
                default_hours: int = HOURS_OFFSET, alt_hours: int = ALT_HOURS_OFFSET) -> DataFrame:
    """``ts`` ← ``ts`` + offset hours (fixed arithmetic, not a time-zone conversion)."""
    out = offset_hours(df, overrides, process_col, default_hours, alt_hours)
    return out.withColumn(ts_col, shift_hours(F.col(ts_col), F.col("offset_h"))).drop("offset_h")
