"""Set operations over partial results and file listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def concat_chunks(chunks: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name (duplicates kept)."""
    return reduce(lambda a, b: a.unionByName(b), chunks)


def glob_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set union of two listings."""
    return a.unionByName(b).distinct()
