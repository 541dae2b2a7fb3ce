"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z, every other byte unchanged.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: Rows handled at once inside a task: the bound on the texts a Python worker holds.
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder. Python workers are told where the driver found this
    package (a cluster gets it with its job, as a Python file or installed)."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that ``df`` does not have: the wanted ones, with underscores
    before them where they are taken (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def doc_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator works on, so extra columns never clash with its own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | list[pa.Array]],
               schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """``mapInArrow`` with ``fn`` applied to slices of at most ``rows`` rows."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, rows):
                out = fn(b.slice(i, rows))
                yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_arrays(out, names)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null is the empty text."""
    return [t or b"" for t in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]


def held_out(mod: int, remainder: int):
    """True where crc32 of the id's decimal text leaves ``remainder``; null ids: false."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == remainder, F.lit(False))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    BOUND = 400_000

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.BOUND:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) on unsigned numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bit_filter(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A one-hash filter of ``bits`` bits (a power of two) over a column of hashes: tasks
    give bit positions, Spark joins them by ``or``; the result has a fixed size."""
    at = F.col(column).bitwiseAND(F.lit(bits - 1))
    rows = df.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast({column} & 63 AS INT))").alias("bit"))
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(max(1, bits // 64), np.uint64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return out


def in_filter(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(words) * 64 - 1)
    return (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def power_of_two(n: int, least: int, most: int) -> int:
    return min(most, max(least, 1 << max(0, n - 1).bit_length()))
