"""Hard negatives by a BOND scan: branch and bound over vertically stored vectors.

Rows are packed into blocks of columns, one contiguous array a dimension. An anchor reads
a block's dimensions in the order of its own descending magnitude. After every few
dimensions the least and the most that the rest can add (from each dimension's minimum and
maximum in the block) bound each candidate's score; candidates outside of what is still
wanted leave the bitmap, and later dimensions are read for the rest alone. The first scan
finds an anchor's positives, the second the negatives in the score windows they set.

Scores are exact whole numbers throughout. A task carries each anchor's best rows from
block to block, so its bounds get tighter as it goes; Spark merges the tasks' few rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import map_slices
from telemetra.session import materialize, release, scratch_dir

#: Rows of a block; dimensions read between two looks at the bounds.
BLOCK_ROWS, STEP = 8192, 8
#: Anchors scanned at once: with their positives all that is sent to the tasks.
ANCHORS = 2048
NONE = np.iinfo(np.int64).min
BLOCKS = "ids binary, labels binary, columns binary, dims int"


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, x): one row for each vec_id, with a label and finite components only."""
    x = F.col("x")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")


def _matrix(batch: pa.RecordBatch, scale: int) -> np.ndarray:
    """floor(scale * x) as whole numbers, one row a dimension; shorter vectors end in zeros."""
    x = batch.column(batch.schema.get_field_index("x"))
    ends, flat = x.offsets.to_numpy(), x.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(ends)
    out = np.zeros((int(lengths.max(initial=0)), len(x)), np.int64)
    row = np.repeat(np.arange(len(x)), lengths)
    out[np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], lengths), row] = np.floor(scale * flat[ends[0]:ends[-1]]).astype(np.int64)
    return out


def blocks(rows: DataFrame, scale: int) -> DataFrame:
    """Vertical blocks of at most ``BLOCK_ROWS`` rows of (vec_id, label, x)."""
    def pack(batch: pa.RecordBatch) -> list[pa.Array]:
        m = _matrix(batch, scale)
        keep = [batch.column(i).to_numpy().astype(np.int64).tobytes() for i in (0, 1)]
        return [pa.array([v], pa.binary()) for v in (*keep, m.tobytes())] + [pa.array([len(m)], pa.int32())]
    return map_slices(rows, pack, BLOCKS, BLOCK_ROWS)


class Block:
    """Columns of a block and each dimension's range."""

    def __init__(self, ids: bytes, labels: bytes, columns: bytes, dims: int):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.columns = np.frombuffer(columns, np.int64).reshape(dims, len(self.ids))
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, wanted: Callable[[np.ndarray, int, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the rows of ``alive`` (places) that stay wanted to the end.

        ``wanted(scores so far, least the rest adds, most the rest adds)`` is the bitmap of
        the candidates that may still be wanted.
        """
        q = anchor[:len(self.columns)]
        order = np.argsort(-np.abs(q), kind="stable")
        q = q[order]
        a, b = q * self.low[order], q * self.high[order]
        rest = lambda v: np.append(np.cumsum(v[::-1])[::-1], 0)
        least, most = rest(np.minimum(a, b)), rest(np.maximum(a, b))
        scores = np.zeros(len(alive), np.int64)
        whole = len(alive) == len(self.ids)
        for i in range(0, len(q), STEP):
            for d, w in zip(order[i:i + STEP], q[i:i + STEP]):
                column = self.columns[d]
                scores += w * (column if whole else column[alive])
            done = min(i + STEP, len(q))
            keep = wanted(scores, least[done], most[done])
            if not keep.all():
                alive, scores, whole = alive[keep], scores[keep], False
            if not len(alive):
                break
        return alive, scores


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.lexsort((ids, -scores))[:k]
    return scores[at], ids[at]


def _largest(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else NONE


class Positives:
    """An anchor's best rows of its own label."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, block: Block, anchor: np.ndarray, anchor_id: int, label: int) -> None:
        def wanted(scores, least, most):
            floor = max(_largest(self.scores, self.k), _largest(scores + least, self.k))
            return scores + most >= floor
        at, scores = block.scan(anchor, np.flatnonzero((block.labels == label) & (block.ids != anchor_id)), wanted)
        self.scores, self.ids = _best(np.append(self.scores, scores), np.append(self.ids, block.ids[at]), self.k)


class Windows:
    """An anchor's best rows of other labels in each window ``low <= score <= high``."""

    def __init__(self, highs: list[int], lows: list[int], k: int):
        self.k, self.highs, self.lows = k, highs, lows
        self.scores, self.ids = ([np.zeros(0, np.int64) for _ in highs] for _ in range(2))

    def add(self, block: Block, anchor: np.ndarray, anchor_id: int, label: int) -> None:
        floors = [max(low, _largest(s, self.k)) for low, s in zip(self.lows, self.scores)]

        def wanted(scores, least, most):
            keep = np.zeros(len(scores), bool)
            for floor, high in zip(floors, self.highs):
                keep |= (scores + most >= floor) & (scores + least <= high)
            return keep
        at, scores = block.scan(anchor, np.flatnonzero(block.labels != label), wanted)
        ids = block.ids[at]
        for w, (floor, high) in enumerate(zip(floors, self.highs)):
            fit = (scores >= floor) & (scores <= high)
            self.scores[w], self.ids[w] = _best(np.append(self.scores[w], scores[fit]), np.append(self.ids[w], ids[fit]), self.k)


def _scanned(packed: DataFrame, state: Callable[[], list], give: Callable[[list], list[np.ndarray]], anchors, schema: str) -> DataFrame:
    """Every block through every anchor's state; each task gives the states' rows at its end."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = anchors.value
        states = state()
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(**row)
                for i, s in enumerate(states):
                    s.add(block, vectors[i], ids[i], labels[i])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in give(states)], names)

    return packed.mapInArrow(run, schema)


def _first(rows: DataFrame, by: list[str], score: str, row_id: str, k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(row_id))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _flat(states: list, ids: np.ndarray, scores, found) -> list[np.ndarray]:
    n = [len(scores(s)) for s in states]
    cat = lambda f: np.concatenate([np.zeros(0, np.int64), *map(f, states)])
    return [np.repeat(ids, n).astype(np.int64), cat(found), cat(scores)]


def mine(rows: DataFrame, is_anchor, k_positive: int = 5, k_negative: int = 5, low_percent: int = 80, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has vec_id, label and embedding; ``is_anchor`` is a condition on them. The
    score of a row is the inner product of ``floor(scale * x)`` with the anchor's. Positives
    are an anchor's ``k_positive`` best other rows of its label, negatives the
    ``k_negative`` best rows of other labels with a score of ``low_percent`` per cent of the
    positive's to all of it (a positive below zero has none). Ties go to the smaller vec_id.

    Rows with a null vec_id, label, vector or component, or a component that is not finite,
    take no part. Of rows that share a vec_id the one with the smallest label, then vector,
    counts. A shorter vector ends in zeros; an empty one scores zero. Other columns are not
    read. Empty tables and tables without anchors give no rows.

    Anchors go to the tasks in groups of at most ``ANCHORS``; each group scans all blocks
    twice. Everything else stays in tables.
    """
    spark = rows.sparkSession
    good = materialize(usable(rows), "usable")
    packed = materialize(blocks(good, scale), "blocks")
    chosen = good.where(is_anchor)
    groups = -(-chosen.count() // (ANCHORS // 2))  # hashed, so that a group of twice the mean does not occur
    out = scratch_dir(spark, "negatives")
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for g in range(groups):
        part = blocks(chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).coalesce(1), scale)
        found = [Block(**r.asDict()) for r in part.collect()]  # one group: its size is bounded
        if not found:
            continue
        ids, labels = (np.concatenate([getattr(b, n) for b in found]) for n in ("ids", "labels"))
        dims = max(len(b.columns) for b in found)
        vectors = np.concatenate([np.pad(b.columns, ((0, dims - len(b.columns)), (0, 0))) for b in found], axis=1).T.copy()
        anchors = spark.sparkContext.broadcast((ids, labels, vectors))

        near = _scanned(packed, lambda n=len(ids): [Positives(k_positive) for _ in range(n)],
                        lambda states, ids=ids: _flat(states, ids, lambda s: s.scores, lambda s: s.ids), anchors,
                        "anchor_id long, positive_id long, positive_score long")
        positives = materialize(_first(near, ["anchor_id"], "positive_score", "positive_id", k_positive).drop("rank"), "positives")
        by_anchor: dict[int, list] = {int(i): [] for i in ids}
        for r in positives.where("positive_score >= 0").collect():  # k_positive rows an anchor of the group
            by_anchor[r["anchor_id"]].append((r["positive_score"], r["positive_id"]))
        wanted = [by_anchor[int(i)] for i in ids]

        def windows(wanted=wanted):
            return [Windows([p for p, _ in w], [-(-low_percent * p // 100) for p, _ in w], k_negative) for w in wanted]

        def rows_of(states, ids=ids, wanted=wanted):
            n = [[len(x) for x in s.scores] for s in states]
            pairs = [(i, *w, m) for i, ws, ms in zip(ids, wanted, n) for w, m in zip(ws, ms)]
            each = np.repeat(np.array([(i, pid, p) for i, p, pid, _ in pairs], np.int64).reshape(-1, 3), [m for *_, m in pairs], axis=0)
            cat = lambda name: np.concatenate([np.zeros(0, np.int64), *(x for s in states for x in getattr(s, name))])
            return [each[:, 0], each[:, 1], each[:, 2], cat("ids"), cat("scores")]

        far = _scanned(packed, windows, rows_of, anchors, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
        _first(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", k_negative).drop("rank").write.mode("append").parquet(out)
        release(positives)
        anchors.unpersist()
    release(packed, good)
    found = spark.read.schema(schema).parquet(out)
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return found.select("anchor_id", "positive_id", F.row_number().over(w).alias("rank"), "negative_id", "positive_score", "negative_score")


#: The query in SQL, by brute force (vectors of one length).
SQL = r"""
WITH r AS (SELECT vec_id, label::BIGINT AS label, embedding::DOUBLE[] AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
           QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, x) = 1),
v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(x, lambda c: floor(256 * c)) AS x FROM r),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_inner_product(a.x, v.x)::BIGINT AS score
      FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""
