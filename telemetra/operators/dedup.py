"""Last-write-wins consolidation.

"Last" needs an order: ``ingest_seq`` (larger = inserted later). The consolidation is a
``max_by(struct, ingest_seq)`` aggregate with a map-side partial step (sort-based: the
buffer is a struct), so a key holding a third of all rows is reduced inside each task
before the shuffle. The
window form (``row_number``) is kept for callers who need the losing rows too.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.functions.timefmt import month_key
from telemetra.operators.ledger import null_safe_join, running_total
from telemetra.sources import commits

READINGS_KEY = ["company_id", "tag_id", "ts"]
PROJECTIONS_KEY = ["company_id", "process_id", "tag_id", "ts"]
PREDICTIONS_KEY = ["company_id", "process_id", "ts"]


def replace_dedup(df: DataFrame, key: list[str], seq: str = "ingest_seq",
                  keep_seq: bool = False) -> DataFrame:
    """One row per ``key``, the one with the greatest ``seq``."""
    others = [c for c in df.columns if c not in key and c != seq]
    payload = F.struct(*[F.col(c) for c in others + [seq]])
    out = (df.groupBy(*key).agg(F.max_by(payload, F.col(seq)).alias("_w"))
             .select(*key, *[F.col(f"_w.{c}").alias(c) for c in others + [seq]]))
    cols = [c for c in df.columns if keep_seq or c != seq]
    return out.select(*cols)


def last_write_rank(df: DataFrame, key: list[str], seq: str = "ingest_seq") -> DataFrame:
    """``rank_in_key`` = 1 for the winning row, 2.. for older duplicates.

    One way for every key: the distributed prefix count of ``ledger.running_total`` in
    descending order of ``seq`` itself (number, text or struct; null is the oldest), so a
    key holding a third of all rows is ranked by many tasks.
    """
    ranked = running_total(df.withColumn("_one", F.lit(1).cast("long")), seq, "_one", "rank_in_key",
                           partition_cols=key, descending=True)
    return ranked.drop("_one").withColumn("rank_in_key", F.col("rank_in_key").cast("long"))


def last_write_flag(df: DataFrame, key: list[str], seq: str = "ingest_seq") -> DataFrame:
    """W1, skew-safe: ``is_last`` marks the row that wins its key. The winning sequence per
    key is a partial-aggregated ``max`` (a hot key is reduced map-side) joined back on the
    key, null keys included (AQE splits a hot key on the big side; the per-key side is small)."""
    last = df.groupBy(*key).agg(F.max(seq).alias("_last"))
    return (null_safe_join(df, last, key, "left")
            .withColumn("is_last", F.col(seq).eqNullSafe(F.col("_last"))).drop("_last"))


def touched_partitions(df: DataFrame, ts: str = "ts", company: str = "company_id") -> DataFrame:
    """Distinct ``(company_id, month)`` pairs (month = yyyyMM of the shifted ts)."""
    return df.select(F.col(company).alias("company_id"), month_key(F.col(ts)).alias("month")).distinct()


def touched_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: set union of touched partitions over batches."""
    return a.unionByName(b).distinct()


def with_partition_cols(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add the storage partition column ``month`` (yyyyMM) used by ``partitionBy``."""
    return df.withColumn("month", month_key(F.col(ts)))


PARTITION_COLS = ("month", "company_id")


def read_partitioned(spark: SparkSession, path: str, partition_cols=PARTITION_COLS) -> DataFrame:
    """Read a (month, company)-partitioned table keeping partition values as STRING —
    type inference would turn a company id such as ``0123`` into the number 123 and a
    rewrite would then move its rows to another partition."""
    inferred = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType(), True) if f.name in partition_cols else f
              for f in inferred.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def touched_rows(table: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of ``table`` in the touched (month, company_id) partitions, pruned at the scan.

    The months' bounds are literals on the table and on the list, so other months are pruned
    statically; the list side thereby carries a predicate, which is what makes the planner
    prune the remaining partitions at run time (dynamic partition pruning).
    """
    pairs = touched.select("month", "company_id").distinct()
    low, high = pairs.agg(F.min("month"), F.max("month")).first()
    inside = F.col("month").between(F.lit(low), F.lit(high))
    return table.where(inside).join(pairs.where(inside), ["month", "company_id"], "left_semi")


def _partition_files(spark: SparkSession, table_path: str, pairs: list) -> list[str]:
    """The data files of some (month, company_id) partitions."""
    part = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    fs, found = commits.Files(spark, table_path), []
    for month, company in pairs:
        folder = f"{table_path}/{part('month', month)}/{part('company_id', company)}"
        found += [f"{folder}/{name}" for name in fs.below(folder)]
    return found


def compact_touched(spark: SparkSession, table_path: str, touched: DataFrame, key: list[str],
                    seq: str = "ingest_seq") -> DataFrame:
    """Consolidate only the (month, company_id) partitions an import wrote.

    Reads the touched partitions of the parquet table and writes them, consolidated, beside
    it; then the new files take the place of those that were read (``sources.commits``). The
    rows are whole at any moment: a driver lost before the exchange leaves the table as it
    was, one lost during it leaves both versions of some rows, of which the last write is the
    same, and the next call finishes. Partitions not touched are never read or written, nor
    are files that others add meanwhile. Returns the consolidated rows as they are in the table.
    """
    commits.recover(spark, f"{table_path}_tx")
    pairs = [tuple(r) for r in touched.select("month", "company_id").distinct().collect()]  # partitions, no rows

    def write(stage: str) -> list[str]:
        old = _partition_files(spark, table_path, pairs)
        merged = replace_dedup(touched_rows(read_partitioned(spark, table_path), touched), key, seq, keep_seq=True)
        merged.hint("rebalance", "month", "company_id").write.partitionBy("month", "company_id").parquet(f"{stage}/rows")
        return old
    commits.transact(spark, f"{table_path}_tx", f"compact-{uuid.uuid4().hex[:12]}", write, {"rows": table_path})
    return touched_rows(read_partitioned(spark, table_path), touched)


def compact_table(spark: SparkSession, table_path: str, key: list[str], seq: str = "ingest_seq",
                  inserted_rows: int = 1) -> DataFrame | None:
    """Whole-table consolidation of an unpartitioned table, opt-in and only when rows
    were inserted. The new files are whole before the old ones go, as in ``compact_touched``."""
    if inserted_rows <= 0:
        return None
    commits.recover(spark, f"{table_path}_tx")

    def write(stage: str) -> list[str]:
        old = [f"{table_path}/{name}" for name in commits.Files(spark, table_path).below(table_path)]
        replace_dedup(spark.read.parquet(table_path), key, seq, keep_seq=True).write.parquet(f"{stage}/rows")
        return old
    commits.transact(spark, f"{table_path}_tx", f"compact-{uuid.uuid4().hex[:12]}", write, {"rows": table_path})
    return spark.read.parquet(table_path)
