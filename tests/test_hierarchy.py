"""Root resolution (J2) against a brute-force walk with the reference semantics."""

import random

from telemetra.constants import MAX_DEPTH
from telemetra.operators import hierarchy as h


def brute(levels: dict, start: str):
    """Walk up from ``start``; returns (unit, error, depth) with the reference's rules."""
    visited, cur = set(), start
    for i in range(MAX_DEPTH):
        if cur in visited:
            return None, "cycle", i
        visited.add(cur)
        if cur not in levels:
            return None, "missing", i
        lvl = levels[cur]
        if lvl is None:
            return None, "null_level", i
        if lvl == "root":
            return cur, None, i
        cur = lvl
    return None, "depth", MAX_DEPTH


def _check(spark, levels: dict):
    df = spark.createDataFrame(list(levels.items()), "process_id string, level string")
    got = {r.process_id: (r.unit_id, r.error, r.depth) for r in h.resolve_roots(df).collect()}
    want = {k: brute(levels, k) for k in levels}
    assert got == want


def test_edge_shapes(spark):
    lv = {"r": "root", "self": "self", "a": "b", "b": "a", "t": "a", "m": "ghost", "n": None, "c": "n"}
    chain = {f"c{i}": f"c{i - 1}" for i in range(1, 130)}
    chain["c0"] = "root"
    lv.update(chain)  # c99 has its root at index 99 (ok); c100 at 100 (depth)
    _check(spark, lv)
    got = {r.process_id: r for r in h.resolve_roots(
        spark.createDataFrame(list(lv.items()), "process_id string, level string")).collect()}
    assert got["c99"].unit_id == "c0" and got["c100"].error == "depth"
    assert got["self"].error == "cycle" and got["t"].error == "cycle" and got["m"].error == "missing"


def test_random_functional_graphs(spark):
    rnd = random.Random(7)
    levels = {}
    for g in range(6):
        n = rnd.randint(5, 60)
        ids = [f"g{g}n{i}" for i in range(n)]
        for i, x in enumerate(ids):
            r = rnd.random()
            if i == 0 or r < 0.05:
                levels[x] = "root"
            elif r < 0.08:
                levels[x] = None
            elif r < 0.11:
                levels[x] = "nowhere"
            else:
                levels[x] = rnd.choice(ids[:i]) if rnd.random() < 0.9 else rnd.choice(ids)
    _check(spark, levels)


def test_backfill_outcomes(spark):
    proc = spark.createDataFrame([("r", "root"), ("a", "r"), ("x", "x")], "process_id string, level string")
    cfg = spark.createDataFrame([("a", "1", "r", True, "T"), ("a", "2", None, True, "T"), ("x", "1", None, True, "T"),
                                 ("zz", "1", None, True, "T"), ("a", "3", "q", False, "T")],
                                "process_id string, created_at string, unit_id string, active boolean, type string")
    from telemetra.plans.flows import backfill_units
    outcomes, counts = backfill_units(cfg, proc, "T")
    assert {r.outcome: r.n for r in counts.collect()} == {"skipped": 1, "updated": 1, "error": 2}
    changes = h.change_set(outcomes)
    upd = {(r.process_id, r.created_at): r.unit_id for r in h.apply_updates(cfg, changes).collect()}
    assert upd[("a", "2")] == "r" and upd[("a", "3")] == "q" and upd[("zz", "1")] is None
