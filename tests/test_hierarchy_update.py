"""Roots after a change of few processes (J2): the same as resolving everything again."""

import random

from telemetra.operators import hierarchy as h
from telemetra.session import materialize


def frame(spark, levels):
    return spark.createDataFrame(list(levels.items()), "process_id string, level string")


def rows(df):
    return {r.process_id: (r.unit_id, r.error, r.depth) for r in df.collect()}


def graph(rnd):
    """Trees, cycles, missing parents, null levels, and a chain past the depth limit."""
    levels = {}
    for g in range(5):
        n = rnd.randint(5, 40)
        for i in range(n):
            levels[f"g{g}-{i}"] = "root" if i == 0 else rnd.choice([f"g{g}-{rnd.randrange(i)}", f"g{g}-{rnd.randrange(n)}", "ghost", None, f"g{g}-{rnd.randrange(i)}"])
    levels |= {"c0": "root"} | {f"c{i}": f"c{i - 1}" for i in range(1, 120)}
    return levels


def test_update_equals_resolving_again(spark):
    rnd = random.Random(11)
    levels = graph(rnd)
    known = materialize(h.resolve_roots(frame(spark, levels)))
    for _ in range(2):
        ids = rnd.sample(sorted(levels), 4) + ["c40"]
        for i in ids:
            levels[i] = rnd.choice(["root", None, "ghost", "new", rnd.choice(sorted(levels))])
        gone = rnd.choice([i for i in sorted(levels) if i not in ids])
        del levels[gone]
        levels["new"], levels["ghost"] = "root", rnd.choice(["root", "g1-0"])
        changed = spark.createDataFrame([(i,) for i in (*ids, gone, "new", "ghost", "no such id")], "process_id string")
        process = frame(spark, levels)
        got = materialize(h.update_roots(process, known, changed))
        assert rows(got) == rows(h.resolve_roots(process))
        known = got


def test_only_what_leads_to_a_change_is_affected(spark):
    levels = {"r": "root", "a": "r", "b": "a", "c": "b", "x": "r", "q": "root", "y": "q"}
    known = h.resolve_roots(frame(spark, levels))
    found = h.affected_nodes(frame(spark, levels), known, spark.createDataFrame([("a",)], "process_id string"))
    assert sorted(r.node for r in found.collect()) == ["a", "b", "c"]
