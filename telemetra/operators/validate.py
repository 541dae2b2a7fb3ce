"""Ingest rules for long readings (P4–P7), their counters (A1) and the lateness rule.

One pass: every row gets the first matching rejection reason (or NULL); the valid and the
rejected rows are two filters over the same annotated frame, and the counters are one
aggregate with ``count_if`` (partial aggregation map-side, one row to the driver).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.constants import (
    MAX_PAST_HOURS, READINGS_COLUMNS, REASON_BAD_VALUE, REASON_FUTURE, REASON_TOO_OLD,
)
from telemetra.functions.numbers import is_nan_or_inf
from telemetra.functions.timefmt import cutoff


def _now(now) -> Column:
    if isinstance(now, Column):
        return now
    if isinstance(now, datetime):
        return F.lit(now).cast("timestamp_ntz")
    return F.lit(str(now)).cast("timestamp_ntz")


def bad_value(value="value") -> Column:
    """NULL, NaN or ±Inf."""
    v = F.col(value) if isinstance(value, str) else value
    return v.isNull() | is_nan_or_inf(v)


def is_future(now, ts="ts") -> Column:
    """P5: strictly after now (equal is accepted)."""
    return F.col(ts) > _now(now)


def is_too_old(now, max_past_hours: int = MAX_PAST_HOURS, ts="ts") -> Column:
    """Strictly before now − max_past_hours (equal is accepted)."""
    return F.col(ts) < cutoff(_now(now), max_past_hours)


def reason(now, max_past_hours: int = MAX_PAST_HOURS, value="value", ts="ts") -> Column:
    """First matching reason in rule order, NULL when the row is valid.

    A NULL ts fails both time comparisons and is accepted, as in the rules being matched.
    """
    return (F.when(bad_value(value), F.lit(REASON_BAD_VALUE))
             .when(is_future(now, ts), F.lit(REASON_FUTURE))
             .when(is_too_old(now, max_past_hours, ts), F.lit(REASON_TOO_OLD)))


def annotate(df: DataFrame, now, max_past_hours: int = MAX_PAST_HOURS) -> DataFrame:
    """Add the ``reason`` column."""
    return df.withColumn("reason", reason(now, max_past_hours))


def apply_ingest_rules(df: DataFrame, now, company_id: str,
                       max_past_hours: int = MAX_PAST_HOURS) -> tuple[DataFrame, DataFrame]:
    """P7 + P17 + P20: ``(valid readings, rejected rows with reason)``.

    ``df`` has ``ts, tag_id, value`` (extra columns are kept on the rejected side).
    Valid rows get the configured company and the target column order.
    """
    marked = annotate(df, now, max_past_hours)
    valid = (marked.where(F.col("reason").isNull())
                   .withColumn("company_id", F.lit(company_id))
                   .select(*READINGS_COLUMNS))
    rejected = marked.where(F.col("reason").isNotNull())
    return valid, rejected


def discard_counts(marked: DataFrame) -> DataFrame:
    """A1: one row with the three rule counts, accepted and discarded (BIGINT)."""
    r = F.col("reason")
    return marked.agg(
        F.count_if(r == REASON_BAD_VALUE).alias("bad_value"),
        F.count_if(r == REASON_FUTURE).alias("timestamp_future"),
        F.count_if(r == REASON_TOO_OLD).alias("timestamp_too_old"),
        F.count_if(r.isNull()).alias("accepted"),
        F.count_if(r.isNotNull()).alias("discarded"),
    )


def lateness_filter(df: DataFrame, now, max_past_hours: int = MAX_PAST_HOURS,
                    ts: str = "ts") -> DataFrame:
    """Drop events older than now − N hours, against a fixed clock (not a watermark)."""
    return df.where(~is_too_old(now, max_past_hours, ts) | F.col(ts).isNull())
