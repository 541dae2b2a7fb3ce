"""Hard negatives against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from telemetra.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, x string, rank int"


def brute(rows, anchors, kp=5, kn=5):
    ok = {}
    for i, e, lab, *_ in rows:
        if i is None or e is None or lab is None or any(v is None or not math.isfinite(v) for v in e):
            continue
        ok[i] = min(ok.get(i, (lab, e)), (lab, e))
    ok = {i: (lab, [math.floor(256 * v) for v in e]) for i, (lab, e) in ok.items()}
    out = []
    for a, (la, ea) in ok.items():
        if a % anchors:
            continue
        scored = sorted((-sum(p * q for p, q in zip(ea, e)), i) for i, (_, e) in ok.items() if i != a)
        for s, p in [x for x in scored if ok[x[1]][0] == la][:kp]:
            found = [(n, i) for n, i in scored if ok[i][0] != la and 80 * -s <= 100 * -n <= 100 * -s][:kn]
            out += [(a, p, r, i, -s, -n) for r, (n, i) in enumerate(found, 1)]
    return sorted(out)


def table(seed, n=400, dims=12, values=None):
    rnd = random.Random(seed)
    value = (lambda: rnd.choice(values)) if values else (lambda: rnd.gauss(0, 0.3))
    rows = [(i, [value() for _ in range(dims)], rnd.randrange(3), "x", 1) for i in range(n)]
    return [(i, [float(v) for v in e], *r) for i, e, *r in rows]


def exact32(rows):
    import numpy as np
    return [(i, e and [None if v is None else float(np.float32(v)) for v in e], *r) for i, e, *r in rows]


@pytest.mark.parametrize("anchors, block", [(2048, 8192), (6, 37)])
def test_against_brute_force(spark, monkeypatch, anchors, block):
    """One and several anchor groups and blocks."""
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    rows = exact32(table(1))
    got = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 20 == 0)
    want = brute(rows, 20)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_ties_and_copies(spark):
    """Few values: equal scores everywhere, and one vector in a third of all rows."""
    rows = exact32(table(2, 300, 4, [0.0, 0.5, 1.0]))
    rows = [(i, [1.0, 0.5, 1.0, 0.0] if i % 3 == 0 else e, *r) for i, e, *r in rows]
    got = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 30 == 0)
    want = brute(rows, 30)
    assert sorted(map(tuple, got.collect())) == want and want


def test_odd_rows(spark):
    """Nulls, non-finite components, repeated ids, short and empty vectors, clashing columns."""
    rows = exact32(table(3, 60, 6))
    rows += [(None, [1.0] * 6, 1, "x", 1), (100, None, 1, "x", 1), (101, [None] + [1.0] * 5, 1, "x", 1), (102, [float("nan")] * 6, 1, "x", 1),
             (103, [float("inf")] * 6, 1, "x", 1), (104, [1.0] * 6, None, "x", 1), (5, [9.0] * 6, 0, "x", 1), (5, [9.0] * 6, 0, "x", 1),
             (120, [0.5, 0.5], 1, "x", 1), (140, [], 2, "x", 1)]
    got = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def test_empty(spark):
    for rows in ([], [(1, [1.0], 0, "x", 1)]):
        got = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0)
        assert got.collect() == []
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_scan_reads_fewer_dimensions(monkeypatch):
    """Candidates outside of the bounds leave early, and the scores of the rest are whole."""
    import numpy as np
    rnd = np.random.default_rng(0)
    m = rnd.integers(-5, 6, (64, 500))
    m[:8] *= 100
    b = hard_negatives.Block(np.arange(500).tobytes(), np.zeros(500, np.int64).tobytes(), np.ascontiguousarray(m).tobytes(), 64)
    anchor, seen = m[:, 7].copy(), []

    def wanted(scores, least, most):
        seen.append(len(scores))
        return scores + most >= anchor @ anchor
    at, scores = b.scan(anchor, np.arange(500), wanted)
    assert list(at) == [7] and scores[0] == anchor @ anchor and seen[0] == 500 and seen[1] < 5
