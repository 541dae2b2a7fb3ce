"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import LOWER, doc_text, free_names, map_slices, texts_of
from telemetra.llm.components import connected_components
from telemetra.session import materialize

SEED = 42
#: Hashes whose bits are summed at once (a long text goes through in such steps).
STEP = 1 << 16
#: A block group above this many distinct fingerprints is divided by further blocks.
SPLIT_ABOVE = 64


def simhash(text: bytes, shingle: int = 3) -> int:
    """64-bit fingerprint: a bit is set where over half of the shingle hashes set it."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = [b" ".join(words)], 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, STEP):
        bits = np.unpackbits(hashes[i:i + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, row): the fingerprint as a signed 64-bit number (no words: zero) and
    the text's xxhash64 (texts may share a doc_id)."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        fps = np.array([simhash(t, shingle) for t in texts_of(batch)], dtype=np.uint64)
        return [batch.column(0), pa.array(fps.view(np.int64)), batch.column(2)]
    return map_slices(doc_text(docs, "doc_id", "text", text_hash(docs).alias("row")), run, "doc_id long, fp long, row long")


def text_hash(docs: DataFrame) -> Column:
    return F.xxhash64(docs["text"].cast("string"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def block_masks(fixed: int, distance: int) -> list[int]:
    """Masks that add two of ``distance + 2`` equal blocks of the bits outside ``fixed``:
    words within ``distance`` bits agree on at least two of those blocks."""
    free = [i for i in range(64) if not fixed >> i & 1]
    blocks = [sum(1 << int(i) for i in part) for part in np.array_split(free, distance + 2) if len(part)]
    return [fixed | a | b for a, b in combinations(blocks, 2)] or [fixed]


def _grouped(members: DataFrame) -> DataFrame:
    """Members of the groups with two fingerprints or more, with the group's size."""
    sizes = members.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    return members.join(sizes, ["mask", "key"])


def links(fps: DataFrame, distance: int = 2, levels: int = 3) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints within ``distance`` bits.

    Each level fixes two more blocks, so close pairs always share a group. A group of
    over ``SPLIT_ABOVE`` members is not joined but divided by the blocks of its remaining
    bits; the last level leaves so few free bits that a group is bounded (2 bits distance,
    3 levels: 8 free bits, 256 fingerprints). The join emits verified pairs only.
    """
    masks, nodes = block_masks(0, distance), fps
    key = lambda m: F.col("fp").bitwiseAND(m)
    out = None
    for level in range(levels):
        if level == 0:
            members = nodes.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
        else:
            finer = {m: block_masks(m, distance) for m in masks}
            table = F.create_map(*[x for m, sub in finer.items() for x in (
                F.lit(_signed(m)), F.array(*[F.lit(_signed(s)) for s in sub]))])
            members = nodes.select("fp", F.explode(table[F.col("mask")]).alias("mask")).distinct()
            masks = sorted({s for sub in finer.values() for s in sub})
        grouped = materialize(_grouped(members.select("fp", "mask", key(F.col("mask")).alias("key"))), "blocks")
        last = level == levels - 1
        small = grouped if last else grouped.where(F.col("n") <= SPLIT_ABOVE)
        a = small.select("mask", "key", F.col("fp").alias("a"))
        b = small.select("mask", "key", F.col("fp").alias("b"))
        close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
        pairs = a.join(b, (a.mask == b.mask) & (a.key == b.key) & (F.col("a") < F.col("b")) & close).select("a", "b")
        out = pairs if out is None else out.union(pairs)
        nodes = grouped.where(F.col("n") > SPLIT_ABOVE).select("fp", "mask")
        if not last and nodes.isEmpty():
            break
    return out.distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``.

    Documents link when their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the smallest doc_id reachable over links, itself included. Copies
    collapse to one fingerprint by a partial minimum before anything is joined. Null and
    empty texts and texts without words have fingerprint zero and link like any other. A
    null doc_id keeps its row and carries links, but never is the smallest (a component
    of null ids only: null). Repeated rows give repeated results; other columns are not
    read. An empty table gives no rows.
    """
    return labelled(docs, shingle, distance).select("doc_id", "fp", "component_id")


def labelled(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, fp, row, root, component_id), one row per row of ``docs``; ``root`` is the
    component's own, while components may share their smallest doc_id."""
    fps = materialize(fingerprints(docs, shingle), "fps")
    reps = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = connected_components(links(reps.select("fp"), distance))
    rooted = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    label = materialize(rooted.join(least, "root").select("fp", "root", "component_id"), "labels")
    return fps.join(label, "fp").select("doc_id", "fp", "row", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    All columns are kept. Rows that share a doc_id are decided each by its own text: of a
    component's rows with the smallest doc_id the one with the smallest xxhash64 of its
    text stays, once. Rows without a doc_id go where their component has a row with one; a
    component whose doc_ids are all null keeps every row (nothing says which one is first).
    """
    rows = labelled(docs, shingle, distance).groupBy("doc_id", "row", "root", "component_id").agg(F.count("*").alias("rows"))
    rows = rows.where("doc_id <=> component_id")
    named = rows.where("doc_id IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "row", "rows")).alias("x")).select("x.*")
    keep = named.union(rows.where("doc_id IS NULL").select("doc_id", "row", F.lit(1).cast("long").alias("rows")))
    own_id, own_row, times = free_names(docs, "_keep_id", "_keep_row", "_keep_rows")
    keep = keep.withColumnsRenamed({"doc_id": own_id, "row": own_row, "rows": times})
    key = docs["doc_id"].cast("long").eqNullSafe(F.col(own_id)) & (text_hash(docs) == F.col(own_row))
    kept = docs.join(keep, key)
    once = kept.where(F.col(times) == 1).select(docs.columns)
    again = kept.where(F.col(times) > 1).dropDuplicates([own_id, own_row]).select(docs.columns)
    return once.union(again)
