"""Shards of the bounded-load ring against a plain walk around it."""

import zlib
from collections import Counter
from hashlib import md5

import pytest

from telemetra.llm import sharding

SCHEMA = "doc_id long, text string, arc int, n int, cell string"


def place(text):
    return int(md5(text.encode()).hexdigest()[:15], 16)


def plain(rows, shards, nodes, slack=0.0, chunk=sharding.CHUNK):
    """Every document walks: its own shard first, in ring order; then the surplus, one by one."""
    arcs = sorted((place(f"shard:{s}:{v}"), s) for s in range(shards) for v in range(nodes))
    total = len(rows)
    cap = [-(-round(total * (1 + slack) * 10**6) // (shards * 10**6)) if slack else total // shards + (s < total % shards) for s in range(shards)]
    seen, docs = Counter(), []
    for i, t in rows:
        b = (t or "").encode()
        d = ("" if i is None else str(i), len(b) + 16, zlib.crc32(b))
        copy = seen[d] // chunk
        seen[d] += 1
        p = place(d[0])
        arc = next((k for k, (at, _) in enumerate(arcs) if p <= at), 0)
        docs.append((arc, place("|".join(map(str, (*d, copy)))), (i is not None, i or 0), d[1:], copy, i))
    own = Counter(arcs[d[0]][1] for d in docs)
    used, out, queue = Counter(), [], {}
    for d in sorted(docs, key=lambda d: d[:5]):
        s = arcs[d[0]][1]
        if used[s] < cap[s]:
            out.append((d[5], *d[3], s, used[s], s))
            used[s] += 1
        else:
            queue.setdefault(d[0], []).append(d)
    waiting = []
    for lap in range(2):
        for k, (_, s) in enumerate(arcs):
            waiting += queue.get(k, []) if lap == 0 else []
            while waiting and own[s] < cap[s] and used[s] < cap[s]:
                d = waiting.pop(0)
                out.append((d[5], *d[3], s, used[s], arcs[d[0]][1]))
                used[s] += 1
    assert not waiting
    return sorted(out, key=str)


def rows_of(n):
    return [(i, f"text {i} " * (i % 7)) for i in range(n)] + [(None, "a"), (None, None), (5, "again"), (5, "again"), (5, None), (6, ""), (-1, "é" * 3000)]


def run(spark, rows, *args, **more):
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, sharding.assign(docs, *args, **more).collect()), key=str)


@pytest.mark.parametrize("n, shards, nodes", [(500, 7, 16), (30, 40, 8), (0, 3, 2), (700, 2, 1), (100, 1, 4)])
def test_against_a_walk(spark, n, shards, nodes):
    rows = rows_of(n)
    assert run(spark, rows, shards, nodes) == plain(rows, shards, nodes)


def test_slack(spark):
    rows = rows_of(400)
    got = run(spark, rows, 8, 8, slack=0.25)
    assert got == plain(rows, 8, 8, 0.25)
    assert max(Counter(r[3] for r in got).values()) <= -(-len(rows) * 5 // 32)


def test_even_and_gapless(spark):
    got = run(spark, rows_of(1000), 40)
    counts = Counter(r[3] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r[4] for r in got if r[3] == s) == list(range(c)) for s, c in counts.items())


def test_hot_rows_are_cut(spark, monkeypatch):
    """A third of all rows is one row, another third one doc_id; cells and chunks stay small."""
    monkeypatch.setattr(sharding, "CHUNK", 10)
    monkeypatch.setattr(sharding, "CELL", 16)
    rows = [(7, "same")] * 300 + [(8, f"t{i}") for i in range(300)] + [(100 + i, "z") for i in range(300)]
    got = run(spark, rows, 5, 8)
    assert got == plain(rows, 5, 8, chunk=10)
    assert max(Counter(r[3] for r in got).values()) == 180


def test_little_moves(spark):
    """One more shard, and one per cent more rows: what moves stays near the new shard's share."""
    rows = [(i, "t") for i in range(4000)]
    shard = lambda rows, n: {r[0]: r[3] for r in run(spark, rows, n)}
    before, grown, more = shard(rows, 20), shard(rows, 21), shard(rows + [(i, "t") for i in range(4000, 4040)], 20)
    assert sum(before[i] != grown[i] for i in before) < 0.25 * len(rows)
    assert sum(before[i] != more[i] for i in before) < 0.1 * len(rows)


def test_empty(spark):
    got = sharding.assign(spark.createDataFrame([], SCHEMA), 4)
    assert got.collect() == [] and got.columns == ["doc_id", "size", "text_crc32", "shard", "slot", "home_shard"]
