"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame operations only.

A benchmark item is short and a document may be long, so Jaccard signatures say nothing;
containment does. Items are partitioned by size (numbers of shingles that share a power
of two). An item's sketch is the shingles of its smallest hashes; each partition sets
how many: one more than an item of its largest size may miss. A document that contains
the wanted share of an item then holds at least one shingle of the sketch, so the search
loses nothing, and candidates are verified by exact shingle containment.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.session import materialize, release

#: Sketch rows broadcast at once (three numbers each: some 10 MB); more go in blocks.
BLOCK_ROWS = 200_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; null: none."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(flat, " "), lambda w: w != "")


def with_words(df: DataFrame, id_col: str) -> DataFrame:
    """(id, words). The one-row generator keeps the optimizer from splitting the text anew
    for every shingle that refers to the words."""
    return df.select(F.col(id_col).cast("long").alias(id_col), F.explode(F.array(words(F.col("text")))).alias("words"))


def shingles(ws: Column, size: int, of) -> Column:
    """``of(first word's place)`` for each shingle; fewer words: the whole sequence; none: none."""
    last = F.greatest(F.size(ws) - size + 1, F.lit(1))
    return F.when(F.size(ws) > 0, F.transform(F.sequence(F.lit(1), last), of)).otherwise(F.array())


def shingle_hashes(df: DataFrame, size: int) -> DataFrame:
    hashes = shingles(F.col("words"), size, lambda i: F.xxhash64(F.slice("words", i, size)))
    return df.withColumn("hashes", F.explode(F.array(hashes)))


def item_shingles(benchmark: DataFrame, size: int) -> DataFrame:
    """(item_id, shingle, n): the distinct shingles of each item and their number."""
    rows = with_words(benchmark, "item_id")
    rows = rows.where("item_id IS NOT NULL").withColumn(
        "shingle", F.explode(shingles(F.col("words"), size, lambda i: F.array_join(F.slice("words", i, size), " "))))
    rows = rows.select("item_id", "shingle").distinct()
    return rows.join(rows.groupBy("item_id").agg(F.count("*").alias("n")), "item_id")


def sketches(items: DataFrame, size: int, containment: float) -> DataFrame:
    """(item_id, h, least): the sketch of each item and the fewest distinct shingles a
    document needs to contain it."""
    top = 2 * F.pow(2.0, F.floor(F.log2("n"))) - 1  # largest size of the partition
    keep = F.floor((1 - containment) * top + 1e-9) + 1
    hashed = items.withColumn("h", F.xxhash64(F.split("shingle", " ")))
    ranked = hashed.groupBy("item_id", "n").agg(F.array_sort(F.collect_set("h")).alias("hs"))  # one item's own shingles
    picked = ranked.withColumn("h", F.explode(F.slice("hs", F.lit(1), keep.cast("int"))))
    return picked.select("item_id", "h", F.ceil(F.lit(containment) * F.col("n") - 1e-9).alias("least"))


def candidates(docs: DataFrame, sketch: DataFrame, size: int) -> DataFrame:
    """(doc_id, item_id): documents that hold a shingle of an item's sketch and are large enough."""
    blocks = max(1, math.ceil(sketch.count() / BLOCK_ROWS))
    rows = shingle_hashes(with_words(docs, "doc_id"), size)
    rows = rows.select("doc_id", F.size("hashes").alias("size"), F.explode("hashes").alias("h"))
    out = None
    for b in range(blocks):
        part = F.broadcast(sketch.where(F.pmod(F.xxhash64("h"), F.lit(blocks)) == b))
        hit = rows.join(part, "h").where("size >= least").select("doc_id", "item_id")
        out = hit if out is None else out.union(hit)
    return out.distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = 5, containment: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) where a document contains at
    least ``containment`` of an item's distinct ``size``-word shingles.

    Words are lower-case runs of letters and digits of whole texts. Items without words
    and rows without an id are not searched; rows that share a doc_id are one document,
    rows that share an item_id one item; null and empty texts contain nothing; other
    columns are not read; empty tables give no rows. An item shorter than a shingle is
    found as a whole text of the same words only.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    items = materialize(item_shingles(benchmark, size), "items")
    sketch = materialize(sketches(items, size, containment), "sketch")
    found = materialize(candidates(docs, sketch, size), "candidates")
    release(sketch)
    own = with_words(docs.join(found.select("doc_id").distinct(), "doc_id", "left_semi"), "doc_id")
    own = own.select("doc_id", F.explode(shingles(F.col("words"), size, lambda i: F.array_join(F.slice("words", i, size), " "))).alias("shingle"))
    # candidate pairs meet their item's shingles first: a shingle that many items and documents share joins no other pairs
    wanted = found.join(items, "item_id")
    shared = own.distinct().join(wanted, ["doc_id", "shingle"])
    counted = shared.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"), F.max("n").alias("n_shingles"))
    return counted.where(F.col("n_shared") >= F.ceil(F.lit(containment) * F.col("n_shingles") - 1e-9)).select(
        "doc_id", "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, size: int = 5, containment: float = 0.8) -> DataFrame:
    """``docs`` without the documents that contain an item; all columns are kept, and so
    are rows without a doc_id."""
    bad = leaks(docs, benchmark, size, containment).select(F.col("doc_id").alias("_leak_id")).distinct()  # an anti-join returns none of its columns
    return docs.join(bad, docs["doc_id"].cast("long") == bad["_leak_id"], "left_anti")


#: The same in SQL, by brute force over all shingles.
SQL = r"""
WITH split AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT 'b', item_id, text FROM benchmark WHERE item_id IS NOT NULL),
w AS (SELECT kind, id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws FROM split),
s AS (SELECT DISTINCT kind, id, unnest(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i:i + 4], ' '))) AS shingle FROM w WHERE len(ws) > 0),
n AS (SELECT id, count(*) AS n_shingles FROM s WHERE kind = 'b' GROUP BY id),
c AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared FROM s d JOIN s b ON d.kind = 'd' AND b.kind = 'b' AND d.shingle = b.shingle GROUP BY 1, 2)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM c JOIN n ON n.id = c.item_id WHERE 10 * n_shared >= 8 * n_shingles
"""
