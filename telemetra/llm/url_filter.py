"""URL verdicts: host and path rules, and a Bloom filter cascade over listed domains.

The cascade alternates: its first level encodes the listed keys, the next one those
unlisted keys of the corpus that the first level wrongly holds, the next one the listed
keys that the second wrongly holds, and so on until a level is wrong about no key. For
every key of the universe it was built over, the parity of the first level that does not
hold the key is the exact answer, so classifying needs no join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import mix64
from telemetra.session import materialize, release

#: Bits of all levels of one cascade at most (32 MB to broadcast). Keys beyond that are
#: split by hash over several cascades, which are applied one after the other.
MAX_BITS = 1 << 28
#: Filter bits a listed key takes over all levels, generously, to choose that split.
BITS_A_KEY = 32
MAX_LEVELS = 64
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Verdict, host and path of each rule; the rule's name is host and path together.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Listed domains of the registered query: they and all their subdomains are blocked.
LISTED = tuple(f"{name}.example.{top}" for name in (
    "ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org"))


def with_host_path(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path): the host is what follows the first ``://`` up to ``/``, ``?``,
    ``#`` or the end, A-Z in lower case, the path what follows up to ``?``, ``#`` or the end; a null url or one without ``://`` has both empty."""
    df = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("_url"))
    rest = F.when(F.col("_url").contains("://"), F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    return df.select("page_id", rest.alias("_rest")).select(
        "page_id", F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), UPPER, UPPER.lower()).alias("host"), F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))


def rule_columns(rules) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits host and path; none: null. Of
    equally long rules the one with the longer host, then the blocking one."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    name = verdict = None
    for kind, host, path in order:
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name = F.when(fits, host + path) if name is None else name.when(fits, host + path)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def domain_keys(host: Column) -> Column:
    """A host and its parent domains, each of two labels or more; other hosts: the host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    own = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(own)


def places(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, bits: int) -> np.ndarray:
    """(key, hash) bit positions of keys, given two hashes of each, on one level."""
    j = np.arange(1, hashes + 1, dtype=np.uint64) + np.uint64(level * 64)
    step = j * np.uint64(0x9E3779B97F4A7C15)
    return mix64(mix64(h1[:, None] + step) ^ (h2[:, None] * (j | np.uint64(1)))) % np.uint64(bits)


@dataclass
class Cascade:
    """Levels as (hashes, bits, words); no level: nothing is listed."""

    levels: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def holds(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        hashes, bits, words = self.levels[level]
        at = places(h1, h2, level, hashes, bits)
        return (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).all(axis=1)

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key is listed: exact for keys of the universe."""
        out = np.zeros(len(h1), bool)
        live = np.arange(len(h1))
        for level in range(len(self.levels)):
            live = live[self.holds(level, h1[live], h2[live])]
            out[live] = level % 2 == 0
        return out


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _level(keys: DataFrame, level: int, hashes: int, bits: int) -> np.ndarray:
    """Filter words of ``keys`` (h1, h2): tasks give bit positions, Spark joins them by ``or``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = places(_unsigned(b.column(0)), _unsigned(b.column(1)), level, hashes, bits).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["word", "bit"])

    words = np.zeros(bits // 64 + 1, np.uint64)
    found = keys.select("h1", "h2").mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return words


def _held(keys: DataFrame, cascade: Cascade, level: int) -> DataFrame:
    handle = keys.sparkSession.sparkContext.broadcast(cascade.levels[level])  # at most MAX_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Cascade([None] * level + [handle.value])
        for b in batches:
            yield b.filter(pa.array(own.holds(level, _unsigned(b.column(0)), _unsigned(b.column(1)))))

    return keys.mapInArrow(run, "h1 long, h2 long")


def build(listed: DataFrame, others: DataFrame) -> Cascade:
    """The cascade of two disjoint sets of keys, each (h1, h2) and distinct.

    The first level's rate of false positives follows the ratio of the sets' sizes, later
    ones halve what is left, so all levels together stay near the size of the first.
    """
    inside, outside = materialize(listed, "cascade"), materialize(others, "cascade")
    n_in, n_out = inside.count(), outside.count()
    cascade = Cascade()
    rate = min(0.5, max(1e-6, math.sqrt(0.5) * n_in / max(n_out, 1)))
    while n_in:
        level = len(cascade.levels)
        if level == MAX_LEVELS:
            raise ValueError("two keys of the universe share both hashes")
        hashes = max(1, round(math.log2(1 / rate)))
        bits = max(64, math.ceil(n_in * math.log2(1 / rate) / math.log(2)))
        if bits > MAX_BITS:
            raise ValueError(f"a level of {bits} bits is beyond MAX_BITS")
        cascade.levels.append((hashes, bits, _level(inside, level, hashes, bits)))
        wrong = materialize(_held(outside, cascade, level), "cascade")
        release(outside)
        inside, outside, n_in, rate = wrong, inside, wrong.count(), 0.5
    release(inside, outside)
    return cascade


def _hashes(key: str) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2")


def listed_hosts(hosts: DataFrame, listed: DataFrame) -> DataFrame:
    """``hosts`` (page_id, host, ...) with a boolean ``listed``: whether the host or a
    parent domain of it is a key of ``listed`` (column key).

    The universe is every domain key of ``hosts``; keys that no host has are left out of
    the filters, null keys too. Without keys or hosts nothing is listed.
    """
    spark = hosts.sparkSession
    keys = hosts.select(F.explode(domain_keys(F.col("host"))).alias("key")).distinct()
    wanted = listed.select(F.col("key").cast("string").alias("key")).where("key IS NOT NULL").distinct().withColumn("listed", F.lit(True))
    universe = materialize(keys.join(wanted, "key", "left").select(*_hashes("key"), F.coalesce("listed", F.lit(False)).alias("listed")), "universe")
    n = universe.where("listed").count()
    splits = max(1, math.ceil(n * BITS_A_KEY / MAX_BITS))
    split = F.pmod(F.xxhash64("h1"), F.lit(splits))
    out = hosts.withColumn("listed", F.lit(False))
    names, schema = hosts.columns, out.schema
    for s in range(splits):
        part = universe.where(split == s)
        handle = spark.sparkContext.broadcast(build(part.where("listed").select("h1", "h2"), part.where("NOT listed").select("h1", "h2")))
        own = F.filter(domain_keys(F.col("host")), lambda k: F.pmod(F.xxhash64(F.xxhash64(F.lit(1), k)), F.lit(splits)) == s)
        rows = out.withColumn("_h1", F.transform(own, lambda k: F.xxhash64(F.lit(1), k))).withColumn("_h2", F.transform(own, lambda k: F.xxhash64(F.lit(2), k)))

        def run(batches: Iterator[pa.RecordBatch], handle=handle) -> Iterator[pa.RecordBatch]:
            cascade = handle.value
            for b in batches:
                h1, h2 = b.column(len(names) + 1), b.column(len(names) + 2)
                hit = cascade.listed(_unsigned(h1.flatten()), _unsigned(h2.flatten()))
                row = np.repeat(np.arange(b.num_rows), h1.value_lengths().to_numpy(zero_copy_only=False))
                flag = b.column(len(names)).to_numpy(zero_copy_only=False) | (np.bincount(row, hit, b.num_rows) > 0)
                yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(flag, pa.bool_())], [*names, "listed"])

        out = rows.mapInArrow(run, schema)
        if splits > 1:
            out = materialize(out, "listed")
    release(universe)
    return out


def judge(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``.

    The longest rule that fits decides; without one the verdict is ``block`` for hosts
    under a listed domain, else ``allow`` (empty hosts included). A null url or one
    without ``://`` has an empty host and path. Null and repeated page ids keep their
    rows; other columns are not read; an empty table gives no rows.
    """
    found = listed_hosts(with_host_path(pages), listed)
    rule, verdict = rule_columns(rules)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))


_ORDER = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
_FITS = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in _ORDER]
#: The same in SQL, with plain membership in place of the cascade.
SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path,
  CASE {' '.join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(_FITS, _ORDER))} END AS rule,
  CASE {' '.join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(_FITS, _ORDER))}
    WHEN {' OR '.join(f"host = '{d}' OR ends_with(host, '.{d}')" for d in LISTED)} THEN 'block' ELSE 'allow' END AS verdict
FROM h
"""
