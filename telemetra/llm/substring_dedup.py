"""Removal of repeated passages by groups of suffixes.

A suffix starts at each word that has ``window - 1`` words after it; only its first
``window`` words matter. Suffixes are dealt out by the smallest ``GRAM``-word gram of the
window (called its prefix below): equal windows have equal grams, and neighbouring
suffixes mostly share the gram, so they travel together as one piece of text. Each
memory-sized group numbers its windows by prefix doubling, one level of a suffix tree, the
only one that is asked for; no whole tree is built. Equal numbers are the repeats, and the
smallest doc_id of each says which occurrences go.

Grams met in one document only cannot repeat; a bounded filter keeps their suffixes from
being shuffled. Grams with more pieces of text than a group should hold, be it in many
documents or often in a few, are extended to the full window, compared by 128-bit hashes
and reduced by a partial minimum, so no group is ever unbounded; windows that make up a
large part of these rows are joined without moving the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import WordHashes, bit_filter, free_names, in_filter, mix64, power_of_two, texts_of
from telemetra.session import materialize, release

GRAM = 8
#: Suffixes of one piece of text at most.
PIECE = 128
#: Pieces of a prefix, over all texts, above which it is extended to the whole window.
HOT = 4000
#: One in so many repeated windows' occurrences makes a window frequent; fewer than that many can be.
FREQUENT = 10_000
#: Pieces a group should hold, and the most a task takes up at once.
GROUP_PIECES = 20_000
#: Bounds of the filters of repeated and of hot prefixes, in bits (16 MB at most); fuller
#: filters let more suffixes through and change no result.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
_ODD = np.uint64(0x9E3779B97F4A7C15)


def window_prefixes(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each suffix the hash of the smallest gram of its window."""
    gram = min(GRAM, window)
    n = len(hashes) - gram + 1
    grams = np.zeros(n, np.uint64)
    for k in range(gram):
        grams = grams * _ODD + hashes[k:n + k]
    low, have, want = mix64(grams), 1, window - gram + 1
    while have < want:  # minima of `have` grams, doubled until they cover the window
        step = min(have, want - have)
        low, have = np.minimum(low[:len(low) - step], low[step:]), have + step
    return low


def pieces(prefixes: np.ndarray, chosen: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first suffix, number) of the runs of chosen suffixes with one prefix, ``PIECE`` at most."""
    if not chosen.any():
        return
    cut = np.flatnonzero((prefixes[1:] != prefixes[:-1]) | (chosen[1:] != chosen[:-1])) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(prefixes)]):
        if chosen[a]:
            for s in range(a, b, PIECE):
                yield s, min(PIECE, b - s)


def piece_counts(prefixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct prefixes of a text and how many of its ``pieces`` each has."""
    start = np.flatnonzero(np.concatenate([[True], prefixes[1:] != prefixes[:-1]]))
    n = -(-np.diff(start, append=len(prefixes)) // PIECE)
    own, at = np.unique(prefixes[start], return_inverse=True)
    return own, np.bincount(at, n, len(own)).astype(np.int64)


def _sources(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("row", F.xxhash64("text"))


def _scan(docs: DataFrame, window: int, emit: Callable, schema: str) -> DataFrame:
    """Rows of ``emit(doc, row, words, prefixes)`` for the texts that have a window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        types = pa.schema([(f.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[f.split()[1]]) for f in schema.split(", ")])
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part, out = b.slice(i, 64), []
                for doc, row, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), texts_of(part)):
                    words = text.split()
                    if len(words) >= window:
                        out.extend(emit(doc, row, words, window_prefixes(known.of(words), window)))
                cols = list(zip(*out)) or [[]] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types.types)], schema=types)

    return _sources(docs).mapInArrow(run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def node_of(ids: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The node at ``depth`` of the suffix tree of ``ids`` for the suffixes at ``starts``
    (each with ``depth`` words): suffixes get one number where their first words agree.

    Numbers of the suffixes' first 2, 4, 8, ... words are made from pairs of numbers of
    half that depth; the binary digits of ``depth`` put the last one together.
    """
    def paired(a, b):
        return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]

    rank, reach = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    node, done = np.zeros(len(starts), np.int64), 0
    while True:
        if depth & reach:
            node, done = paired(node, rank[starts + done]), done + reach
        if reach * 2 > depth:
            return node
        shifted = np.zeros(len(rank), np.int64)
        shifted[:len(rank) - reach] = rank[reach:]
        rank, reach = paired(rank, shifted), reach * 2


def repeated_in_tree(texts: list[bytes], least_doc: np.ndarray, window: int) -> list[np.ndarray]:
    """For each piece, the suffixes whose window also starts a suffix of a piece with a smaller doc_id."""
    split = [t.split(b" ") for t in texts]
    known: dict[bytes, int] = {}
    size = np.fromiter(map(len, split), np.int64, len(split))
    ids = np.fromiter((known.setdefault(w, len(known)) for ws in split for w in ws), np.int64, int(size.sum()))
    count = size - window + 1
    first = np.cumsum(size) - size
    piece = np.repeat(np.arange(len(split)), count)
    inner = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    node = node_of(ids, first[piece] + inner, window)
    low = np.full(int(node.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(low, node, least_doc[piece])
    hit = low[node] < least_doc[piece]
    return np.split(np.where(hit, inner, -1), np.cumsum(count)[:-1])


def _runs(own: np.ndarray) -> tuple[list[int], list[int]]:
    """Start and length of the runs of consecutive non-negative numbers."""
    own = own[own >= 0]
    if not len(own):
        return [], []
    cut = np.flatnonzero(np.diff(own) != 1) + 1
    parts = np.split(own, cut)
    return [int(p[0]) for p in parts], [len(p) for p in parts]


def repeated(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, row, starts): the suffixes, as structs (s, n) of runs, of each text whose
    ``window`` words also start in a document with a smaller doc_id. ``row`` is the
    text's xxhash64 (texts may share a doc_id)."""
    def count(doc, row, words, low):
        own, n = piece_counts(low)
        return zip(own.view(np.int64).tolist(), repeat(doc), n.tolist())

    counted = materialize(
        _scan(docs, window, count, "g long, doc_id long, n long")
        .groupBy("g").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.sum("n").alias("n")).where("a < b"), "prefixes")
    total, kinds, hot_kinds = counted.agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") > HOT)).first()
    spark = docs.sparkSession
    many = spark.sparkContext.broadcast(bit_filter(counted, "g", power_of_two(32 * kinds, LEAST_BITS, MOST_BITS)))
    hot_bits = power_of_two(64 * hot_kinds, LEAST_BITS, MOST_BITS)
    hot = spark.sparkContext.broadcast(bit_filter(counted.where(F.col("n") > HOT), "g", hot_bits) if hot_kinds else None)
    release(counted)

    def choose(low, wanted_hot):
        own = in_filter(many.value, low)
        if hot.value is None:
            return own & (not wanted_hot)
        return own & (in_filter(hot.value, low) == wanted_hot)

    def emit(doc, row, words, low):
        for s, n in pieces(low, choose(low, False)):
            text = b" ".join(words[s:s + n + window - 1])
            yield _signed(int(low[s])), _signed(xxhash.xxh64_intdigest(text, 7)), doc, row, s, n, text

    found = _scan(docs, window, emit, "g long, k long, doc_id long, row long, s int, n int, text binary")
    distinct = found.groupBy("g", "k", "text").agg(F.min("doc_id").alias("least"))
    groups = max(1, -(-int(total or 0) // GROUP_PIECES))

    def tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(rows):
            hits = repeated_in_tree([r["text"] for r in rows], np.array([r["least"] for r in rows], np.int64), window)
            runs = [_runs(h) for h in hits]
            return pa.RecordBatch.from_arrays([
                pa.array([r["g"] for r in rows]), pa.array([r["k"] for r in rows]), pa.array([r["least"] for r in rows]),
                pa.array([a for a, _ in runs], pa.list_(pa.int32())), pa.array([n for _, n in runs], pa.list_(pa.int32()))], ["g", "k", "least", "at", "len"])

        held: list[dict] = []
        for b in batches:
            for row in b.to_pylist():
                if len(held) >= GROUP_PIECES and row["g"] != held[-1]["g"]:  # rows come sorted by prefix
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    solved = distinct.repartition(groups, "g").sortWithinPartitions("g").mapInArrow(tree, "g long, k long, least long, at array<int>, len array<int>")
    solved = materialize(solved, "trees")
    seen = found.select("g", "k", "doc_id", "row", "s", "n").join(solved, ["g", "k"])
    inner = F.arrays_zip(F.transform("at", lambda x: x + F.col("s")).alias("s"), F.col("len").alias("n"))
    whole = F.array(F.struct("s", "n"))
    runs = F.when(F.col("doc_id") > F.col("least"), whole).otherwise(
        F.transform(inner, lambda x: F.struct(x["s"].alias("s"), x["n"].alias("n"))))
    out = seen.select("doc_id", "row", F.explode(runs).alias("x")).select("doc_id", "row", "x.s", "x.n")
    if hot_kinds:
        out = out.union(_full_windows(docs, window, choose))
    return out.groupBy("doc_id", "row").agg(F.collect_list(F.struct("s", "n")).alias("starts"))  # one text's own runs


def _full_windows(docs: DataFrame, window: int, choose) -> DataFrame:
    """(doc_id, row, s, n) of the repeated suffixes with a hot prefix, extended to the
    whole window (128 bits of it) and reduced by a partial minimum."""
    def emit(doc, row, words, low):
        for s in np.flatnonzero(choose(low, True)).tolist():
            h = xxhash.xxh3_128_intdigest(b" ".join(words[s:s + window]))
            yield _signed(h >> 64), _signed(h & (1 << 64) - 1), doc, row, s

    rows = materialize(_scan(docs, window, emit, "h1 long, h2 long, doc_id long, row long, s int"), "windows")
    least = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("times"))
    least = materialize(least.where("least < most").drop("most"), "least")
    often = F.col("times") > (least.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0] // FREQUENT)
    # fewer than FREQUENT windows are that frequent: they travel to the rows; the rows of all others, to theirs
    head = F.broadcast(least.where(often).drop("times"))
    rest = rows.join(head, ["h1", "h2"], "left_anti").join(least.where(~often).drop("times"), ["h1", "h2"])
    return rows.join(head, ["h1", "h2"]).unionByName(rest).where("doc_id > least").select("doc_id", "row", "s", F.lit(1).alias("n"))


def cover(n_words: int, starts, window: int) -> np.ndarray:
    """Which words lie in a removed window."""
    edge = np.zeros(n_words + 1, np.int64)
    for x in starts or ():
        edge[x["s"]] += 1
        edge[min(n_words, x["s"] + x["n"] + window - 1)] -= 1
    return np.cumsum(edge[:-1]) > 0


def _joined(docs: DataFrame, window: int) -> DataFrame:
    """``docs`` with one more column, its last: the repeated suffixes of the row's text."""
    doc, row, starts = free_names(docs, "_doc", "_row", "_starts")
    runs = repeated(docs, window).select(F.col("doc_id").alias(doc), F.col("row").alias(row), F.col("starts").alias(starts))
    return docs.join(runs, (docs["doc_id"].cast("long") == runs[doc]) & (F.xxhash64(docs["text"].cast("string")) == runs[row]), "left").drop(doc, row)


def digests(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per row of ``docs``.

    A word goes if a window of ``window`` consecutive words of its text that covers it
    also starts in a document with a smaller doc_id, as the texts came in. Words are runs
    without ASCII white space, unchanged. Null texts have no words; shorter texts and
    rows without a doc_id lose nothing and take nothing from others; rows that share a
    doc_id do not count as smaller than each other; other columns are not read; an empty
    table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part, out = b.slice(i, 64), []
                for text, starts in zip(texts_of(part), part.column(2).to_pylist()):
                    words = text.split()
                    gone = cover(len(words), starts, window)
                    kept = [w for w, g in zip(words, gone) if not g] if starts else words
                    out.append((len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
                n, gone, sha = zip(*out)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)],
                                                 ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _joined(rows, window).select("doc_id", "text", "_starts").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``: the kept words joined by one
    space. Texts that lose nothing stay as they are; every row stays; a column ``n_chars``
    follows its text."""
    schema, names = docs.schema, docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                texts, cols = part.column(at).cast(pa.binary()).to_pylist(), list(part.columns[:-1])
                count = cols[chars].to_pylist() if chars >= 0 else []
                for k, starts in enumerate(part.column(len(names)).to_pylist()):
                    if starts:
                        words = texts[k].split()
                        texts[k] = b" ".join([w for w, g in zip(words, cover(len(words), starts, window)) if not g])
                        if chars >= 0:
                            count[k] = len(texts[k].decode())
                cols[at] = pa.array(texts, pa.binary()).cast(part.column(at).type)
                if chars >= 0:
                    cols[chars] = pa.array(count, cols[chars].type)
                yield pa.RecordBatch.from_arrays(cols, names)

    return _joined(docs, window).mapInArrow(run, schema)
