"""Import / export ledgers (S13, S14, U3, A3, A16) and running totals.

A ledger is a small table keyed by ``file``, to which every run adds its entries (see
``sources/incremental``); ``length`` and ``modified`` identify the file that was imported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.functions.numbers import safe_rate
from telemetra.session import materialize

IMPORT_LEDGER = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("read", T.LongType()),
    T.StructField("inserted", T.LongType()), T.StructField("discarded", T.LongType()),
    T.StructField("elapsed", T.DoubleType()),
    T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType()),
])
EXPORT_LEDGER = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("company", T.StringType()),
    T.StructField("period", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("elapsed", T.DoubleType()),
])


def upsert_by_key(old: DataFrame, new: DataFrame, key=("file",)) -> DataFrame:
    """Entries of ``new`` replace same-key entries of ``old``; the rest is appended."""
    fresh = new.dropDuplicates(list(key))
    return old.join(fresh.select(*key), list(key), "left_anti").unionByName(fresh)


def import_totals(ledger: DataFrame) -> DataFrame:
    """A3: one row per file plus a grand-total row (``file`` NULL) via ROLLUP; ``files`` is
    the number of files under each row."""
    return (ledger.rollup("file")
                  .agg(F.sum("read").cast("long").alias("read"),
                       F.sum("inserted").cast("long").alias("inserted"),
                       F.sum("discarded").cast("long").alias("discarded"),
                       F.count("file").alias("files")))


def run_totals(run: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Files, read, inserted, discarded of one run, and the number of failed files."""
    nfail = failed.count() if failed is not None else 0  # one number (files that failed)
    return run.agg(F.count(F.lit(1)).alias("files"), F.sum("read").cast("long").alias("read"),
                   F.sum("inserted").cast("long").alias("inserted"),
                   F.sum("discarded").cast("long").alias("discarded"),
                   F.lit(nfail).cast("long").alias("failed_files"))


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the right side's keys are dropped."""
    keys = list(keys)
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def running_total(df: DataFrame, order_col: str, value_col: str, out_col: str = "running",
                  seconds_col: str | None = None, partition_cols=(), descending: bool = False) -> DataFrame:
    """Cumulative sum of ``value_col`` in ``order_col`` order (rows up to the current;
    nulls last, ties in input order), optionally restarting per ``partition_cols`` group.

    Distributed prefix sum on the column's own order, whatever its type: rows are range
    partitioned by (group, order, position), so one group that holds a third of all rows is
    cut over many slices, tied rows included; each (group, slice) total is offset by the
    totals of the group's earlier slices, and the running sum inside a slice is a window
    over that slice only. With ``seconds_col`` also the cumulative rate (F19).
    """
    parts = list(partition_cols)
    order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    tagged = df.withColumn("_tie", F.monotonically_increasing_id())
    tagged = tagged.repartitionByRange(*parts, order, "_tie").withColumn("_slice", F.spark_partition_id())
    tagged = materialize(tagged, "slices")  # the slices are read twice and must not move in between
    cols = [value_col] + ([seconds_col] if seconds_col else [])
    totals = tagged.groupBy(*parts, "_slice").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wb = Window.partitionBy(*parts).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*parts, "_slice", *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0)).alias(f"_o_{c}")
                                                for c in cols])
    w = Window.partitionBy(*parts, "_slice").orderBy(order, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    out = null_safe_join(tagged, offsets, [*parts, "_slice"], "left")
    out = out.withColumn(out_col, (F.sum(value_col).over(w) + F.col(f"_o_{value_col}")))
    if seconds_col:
        out = out.withColumn("_cum_s", F.sum(seconds_col).over(w) + F.col(f"_o_{seconds_col}"))
        out = out.withColumn("rate", safe_rate(F.col(out_col), F.col("_cum_s"))).drop("_cum_s")
    return out.drop("_slice", "_tie", *[f"_o_{c}" for c in cols])
