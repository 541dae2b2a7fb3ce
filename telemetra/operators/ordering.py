"""Orderings and heads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.functions.text import parent_dir, parse_csv_name_part, parse_csv_name_process


def order_ts_tag(df: DataFrame) -> DataFrame:
    """O1: by ts, then tag_id."""
    return df.orderBy("ts", "tag_id")


def file_sort_keys(files: DataFrame, path: str = "file") -> DataFrame:
    """O3 + F3/F4: (process, month folder, numeric part) parsed from each path."""
    p = F.col(path)
    return (files.withColumn("sort_process", parse_csv_name_process(p))
                 .withColumn("sort_month", parent_dir(p))
                 .withColumn("sort_part", parse_csv_name_part(p)))


def file_order(files: DataFrame, path: str = "file") -> DataFrame:
    """O3: all months of a process together, then month, then part number."""
    return file_sort_keys(files, path).orderBy("sort_process", "sort_month", "sort_part")


def order_partitions(touched: DataFrame) -> DataFrame:
    """Touched partitions in (company, month) order."""
    return touched.orderBy("company_id", "month")


def sample_head(df: DataFrame, n: int = 5, order=None) -> DataFrame:
    """The first ``n`` rows (by ``order`` when given) — the dry-run sample."""
    return (df.orderBy(*order) if order else df).limit(n)


def file_name_sort(files: DataFrame, path: str = "file") -> DataFrame:
    """Discovery list sorted by path."""
    return files.orderBy(path)
