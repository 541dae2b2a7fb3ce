"""Rejection audit (A12): discards consolidated per tag and reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def discard_audit(rejected: DataFrame) -> DataFrame:
    """Per (company, tag, reason): count and the ts span of the rejected rows."""
    return (rejected.groupBy("company_id", "tag_id", "reason")
                    .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"),
                         F.max("ts").alias("last_ts")))
