"""BPE encoding by speculation and verification, and decoding.

Greedy longest match proposes the tokens of a word; a proposal is the exact encoding if
every adjacent pair of its tokens is compatible (merging the pair's own text gives that
pair back). All distinct pairs of a batch are tested at once on arrays; only words with
an incompatible pair are merged exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, pre_tokenizers

from telemetra.llm.common import doc_text, map_slices, texts_of

#: Distinct chunks a worker remembers (some 250 MB); the store is emptied when it is full.
MEMORY_CHUNKS = 1_000_000
NEVER = 1 << 30
#: Words of up to so many symbols are merged by scanning.
SHORT = 32
#: First symbols by which the longest token that may follow is known.
HEAD = 5
#: An ASCII letter as the last one of its word.
ENDS = {chr(b): chr(b + 256) for b in range(128)}
#: Below this letter a text is composed (NFC) and its case and classes are settled.
LATIN_END = "\u0180"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + odd.index(b)) for b in range(256)]


class WordBPE:
    """A byte-level BPE vocabulary with word ends, read from a tokenizers JSON file.

    A word is a string of symbols: byte ``b`` is ``chr(b)``, as the last one of its word
    ``chr(b + 256)``. A token is known by its symbols.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.names = [b""] * size
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name.encode()
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern, regex.V0).findall
        self.unicode_form = Tokenizer.from_file(path).normalizer.normalize_str
        self.unicode_split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split

        self.base = {}
        symbols = [None] * size
        for b, letter in enumerate(byte_letters()):
            for symbol, name in ((chr(b), letter), (chr(b + 256), letter + suffix)):
                self.base[symbol] = vocab[name]
                symbols[vocab[name]] = symbol
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.made = np.full(size, -1)
        for rank, (a, b) in enumerate(model["merges"]):
            a, b, t = vocab[a], vocab[b], vocab[a + b]
            self.merges[a, b] = rank, t
            if symbols[t] is None:
                symbols[t], self.left[t], self.right[t], self.made[t] = symbols[a] + symbols[b], a, b, rank
        keys = np.array([a << 32 | b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        # a token that exact merging does not give back for its own text is never proposed
        self.tokens = {s: t for t, s in enumerate(symbols) if s and (len(s) == 1 or self.merged(s) == [t])}
        self.reach: dict[str, int] = {}  # the longest token with the same first symbols
        for s in self.tokens:
            self.reach[s[:HEAD]] = max(len(s), self.reach.get(s[:HEAD], 0))

    def merged(self, word: str) -> list[int]:
        """Exact encoding: the pair of the lowest rank, the leftmost first, until none is left."""
        ids = [self.base[s] for s in word]
        return self._scanned(ids) if len(ids) <= SHORT else self._heaped(ids)

    def _scanned(self, ids: list[int]) -> list[int]:
        """The next pair by a scan over all ranks, which for short words is the quicker way."""
        find, none = self.merges.get, (NEVER, -1)
        steps = [find(pair, none) for pair in zip(ids, ids[1:])]
        while steps:
            best = min(steps)
            if best[0] == NEVER:
                break
            i = steps.index(best)
            ids[i:i + 2] = [best[1]]
            del steps[i]
            if i:
                steps[i - 1] = find((ids[i - 1], ids[i]), none)
            if i < len(steps):
                steps[i] = find((ids[i], ids[i + 1]), none)
        return ids

    def _heaped(self, ids: list[int]) -> list[int]:
        """The next pair from a heap, for words of any length."""
        n, merges = len(ids), self.merges
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(*m, i) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heap = [(rank, i, ids[i], ids[i + 1], t) for rank, t, i in heap]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, t = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = t, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if m := merges.get((t, ids[after[i]])):
                    heapq.heappush(heap, (m[0], i, t, ids[after[i]], m[1]))
            if (p := before[i]) >= 0 and (m := merges.get((ids[p], t))):
                heapq.heappush(heap, (m[0], p, ids[p], t, m[1]))
        return [i for i in ids if i >= 0]

    def proposed(self, word: str) -> list[int]:
        """Greedy longest match from the left."""
        out, i, n, token, reach = [], 0, len(word), self.tokens.get, self.reach.get
        while i < n:
            j = min(n, i + reach(word[i:i + HEAD], HEAD - 1))
            while (t := token(word[i:j])) is None:
                j -= 1
            out.append(t)
            i = j
        return out

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER) if len(self.pair_keys) else key * 0 + NEVER

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether exact merging keeps the boundary between each two tokens.

        The merges that made the two tokens are undone from the last one; ``x`` and ``y``
        are the pieces on both sides of the boundary at that moment. The boundary is lost
        if the two could merge before the step that was undone last (``until``, with the
        step itself included where the crossing pair lies to its left).
        """
        x, y = a.astype(np.int64), b.astype(np.int64)
        ok, live, until = np.ones(len(x), bool), np.arange(len(x)), np.full(len(x), NEVER)
        while len(live):
            lost = self.rank_of(x, y) < until
            ok[live[lost]] = False
            go = ~lost & ((self.made[x] >= 0) | (self.made[y] >= 0))
            live, x, y, until = live[go], x[go], y[go], until[go]
            rx, ry = self.made[x], self.made[y]
            undo_x = rx > ry
            until = np.where(undo_x, rx, ry + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return ok

    def verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` with every distinct pair tested once."""
        pairs, at = np.unique(a << 32 | b, return_inverse=True)
        return self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[at]

    def unicode_pieces(self, part: str) -> list[str]:
        """Pieces of a text beyond Latin letters, by the library's own Unicode tables
        (composition, lower case, letter classes), which differ from Python's by version."""
        return [s for s, _ in self.unicode_split(self.unicode_form(part))]

    def words(self, chunk: bytes) -> list[str | int]:
        """The words of a text without ASCII white space, as symbols; special tokens as ids."""
        text = chunk.decode()
        parts = self.at_special(text) if "<|" in text else [text]
        out: list[str | int] = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
                continue
            if part.isascii():
                out += [piece[:-1] + ENDS[piece[-1]] for piece in self.pieces(part.lower())]
                continue
            for piece in self.pieces(part.lower()) if max(part) < LATIN_END else self.unicode_pieces(part):
                raw = piece.encode()
                out.append(raw[:-1].decode("latin-1") + chr(raw[-1] + 256))
        return out

    def encode(self, chunks: list[bytes]) -> list[list[int]]:
        """Token ids of each chunk."""
        split = list(map(self.words, chunks))
        found = set(chain.from_iterable(split))
        by_word: dict[str | int, list[int]] = {w: [w] for w in found if isinstance(w, int)}
        todo = [w for w in found if isinstance(w, str)]
        ids = list(map(self.proposed, todo))
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(lens.sum()))
        word = np.repeat(np.arange(len(ids)), lens)
        inner = np.flatnonzero(word[1:] == word[:-1]) if len(flat) > 1 else np.empty(0, np.int64)
        failing = np.unique(word[inner[~self.verified(flat[inner], flat[inner + 1])]])
        for i in failing.tolist():
            ids[i] = self.merged(todo[i])
        by_word.update(zip(todo, ids))
        return [by_word[ws[0]] if len(ws) == 1 else [t for w in ws for t in by_word[w]] for ws in split]

    def decode(self, ids: Iterable[int]) -> bytes:
        """The vocabulary names of the ids joined by one space (the file has no decoder)."""
        return b" ".join(map(self.names.__getitem__, ids))


class Encoder:
    """Encodes texts through a bounded memory of chunks (runs without ASCII white space)."""

    def __init__(self, bpe: WordBPE):
        self.bpe = bpe
        self.clear()

    def clear(self):
        self.at: dict[bytes, int] = {}
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.start, self.count = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.decoded: list[bytes] = []

    def learn(self, chunks: list[bytes]):
        ids = self.bpe.encode(chunks)
        self.at.update(zip(chunks, range(len(self.at), len(self.at) + len(chunks))))
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        used, more = int(self.start[-1]), int(count.sum())
        if used + more > len(self.flat):
            self.flat = np.concatenate([self.flat[:used], np.empty(max(used, more), np.uint32)])
        self.flat[used:used + more] = np.fromiter(chain.from_iterable(ids), np.uint32, more)
        self.decoded += map(self.bpe.decode, ids)
        self.count = np.concatenate([self.count, count])
        self.start = np.concatenate([self.start, used + np.cumsum(count)])

    def _places(self, texts: list[bytes]) -> list[list[int]]:
        """The places of each text's chunks in the memory."""
        if len(self.at) > MEMORY_CHUNKS:
            self.clear()
        split = [t.split() for t in texts]
        new = set().union(*split).difference(self.at) if split else ()
        if new:
            self.learn(list(new))
        return [list(map(self.at.__getitem__, chunks)) for chunks in split]

    def _ids(self, places: list[int]) -> np.ndarray:
        which = np.array(places, np.int64)
        count = self.count[which]
        skip = self.start[which] - (np.cumsum(count) - count)
        return self.flat[np.repeat(skip, count) + np.arange(int(count.sum()))]

    def texts(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit arrays."""
        return list(map(self._ids, self._places(texts)))

    def both(self, texts: list[bytes]) -> tuple[list[np.ndarray], list[bytes]]:
        """Ids and decoded form of each text. Decoding joins tokens by a space, so a text's
        form is that of its chunks joined, each decoded once; chunks without ids have none."""
        places = self._places(texts)
        return list(map(self._ids, places)), [b" ".join(filter(None, map(self.decoded.__getitem__, p))) for p in places]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(WordBPE(path))
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>): the exact ids of each whole text.

    Null, empty and white-space texts give an empty array; a null doc_id keeps its row;
    repeated rows give repeated results; other columns are not read. ``path`` must be a
    file every executor has.
    """
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        ids = encoder(path).texts(texts_of(batch))
        return [batch.column(0), pa.array([x.view(np.int32) for x in ids], pa.list_(pa.int32()))]
    return map_slices(doc_text(docs), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text): ids of ``encode`` back to text; null or empty ids: the empty text."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        bpe = encoder(path).bpe
        texts = [bpe.decode(x or []) for x in batch.column(1).to_pylist()]
        return [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())]
    return map_slices(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode and decode in one pass, with
    only the digests kept. Same rows and edge cases as ``encode``."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, decoded = encoder(path).both(texts_of(batch))
        return [batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4", copy=False)).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())]
    return map_slices(doc_text(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with n_tokens, ids and the digest of the decoded text in place of ``text``.

    Same edge cases as ``encode``; the other columns pass through, but for any that have
    one of the three names.
    """
    more = ["n_tokens", "ids", "decoded_sha256"]
    keep = [c for c in docs.columns if c not in ("text", *more)]
    rows = docs.select(F.col("text").cast("string").alias("text"), *keep)
    schema = T.StructType([*rows.schema.fields[1:], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids, decoded = enc.both(texts_of(part))
                yield pa.RecordBatch.from_arrays([
                    *part.columns[1:], pa.array([len(x) for x in ids], pa.int64()), pa.array([x.view(np.int32) for x in ids], pa.list_(pa.int32())),
                    pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())], [*keep, *more])

    return rows.mapInArrow(run, schema)
