"""Containment search against all pairs of a small fixture."""

import random
import re

from telemetra.llm import decontaminate


def grams(text, k=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, items, t=0.8):
    own, want = {}, {}
    for rows, out in ((docs, own), (items, want)):
        for i, text in rows:
            if i is not None:
                out[i] = out.get(i, set()) | grams(text)
    return sorted((d, i, len(g), len(g & h)) for d, h in own.items() for i, g in want.items() if g and 10 * len(g & h) >= 10 * t * len(g))


def fixture(seed=2):
    rnd = random.Random(seed)
    prose = lambda n: [rnd.choice("ab cd ef gh ij kl mn op qr st uv wx yz".split()) + str(rnd.randrange(40)) for _ in range(n)]
    items = [(i, " ".join(prose(rnd.choice([3, 5, 6, 12, 40, 150])))) for i in range(25)]
    items += [(50, None), (51, ""), (None, "no id here at all"), (1, items[1][1])]
    docs = [(1, None), (2, ""), (None, items[4][1]), (3, "..."), (4, items[0][1])]
    for d in range(10, 90):
        w = prose(rnd.choice([10, 300, 3000]))
        if d % 2:
            p = items[rnd.randrange(25)][1].split()
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                p[rnd.randrange(len(p))] = "Changed,"
            at = rnd.randrange(len(w))
            w[at:at] = [p[0].upper()] + [x + rnd.choice(["", ",", "\n"]) for x in p[1:]]
        docs.append((d, " ".join(w)))
    return docs + [(10, "second row of one document")], items


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, n int, item_id string"),
            spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string"))


def rows(df):
    return sorted((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in df.collect())


def test_against_all_pairs(spark):
    docs, items = fixture()
    want = brute(docs, items)
    assert 20 < len(want)
    assert rows(decontaminate.leaks(*frames(spark, docs, items))) == want


def test_blocks_of_the_sketch(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ROWS", 37)
    docs, items = fixture(3)
    assert rows(decontaminate.leaks(*frames(spark, docs, items))) == brute(docs, items)


def test_items_and_documents_that_share_an_opening(spark):
    """Shingles common to many items and documents pair only what the sketches found."""
    head = "which of the following statements about the given passage is true"
    items = [(i, f"{head} " + " ".join(f"q{i}w{j}" for j in range(8))) for i in range(20)]
    docs = [(d, f"{head} " + " ".join(f"q{d}w{j}" for j in range(8 if d % 2 else 1)) + " end") for d in range(20)] + [(99, head)] * 3
    want = brute(docs, items)
    assert [x[:2] for x in want] == [(d, d) for d in range(1, 20, 2)]
    assert rows(decontaminate.leaks(*frames(spark, docs, items))) == want


def test_main_path_is_native(spark):
    docs, items = frames(spark, *fixture())
    plan = decontaminate.leaks(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_drop_and_empty_tables(spark):
    docs, items = fixture()
    d, b = frames(spark, docs, items)
    bad = {x[0] for x in brute(docs, items)}
    kept = decontaminate.drop_leaking(d, b)
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in bad)
    assert decontaminate.leaks(d.limit(0), b).collect() == [] == decontaminate.leaks(d, b.limit(0)).collect()
