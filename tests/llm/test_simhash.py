"""SimHash near-duplicates against a brute-force model."""

import random

import xxhash

from telemetra.llm import simhash

SCHEMA = "doc_id long, text string, fp string, n int"


def brute(rows, k=3, d=2):
    def fp(text):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        if not w:
            return 0
        grams = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
        hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    fps = [fp(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= d and comp[i] != comp[j]:
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, f, least.get(c)) for (i, _), f, c in zip(rows, fps, comp)), key=str)


def corpus(n=120, seed=3):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(300)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "One two"), (7, "one TWO"), (7, "one TWO"),
            (None, "one two"), (None, "quite alone here"), (9, "É é\x0bÉ"), (10, "x" * 5000)]
    for i in range(20, 20 + n):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([5, 60, 400]))]
        rows.append((i, " ".join(w)))
        for j in range(rnd.choice([0, 0, 1, 3])):
            v = list(w)
            for _ in range(rnd.choice([0, 1, 2])):
                v[rnd.randrange(len(v))] = rnd.choice(vocab)
            rows.append((1000 * i + j, " ".join(v)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)


def result(df):
    return sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    rows = corpus()
    assert result(simhash.near_duplicates(frame(spark, rows))) == brute(rows)


def test_hot_groups_are_divided(spark, monkeypatch):
    """Fingerprints crowded into few blocks take the finer blocks and lose no link."""
    monkeypatch.setattr(simhash, "SPLIT_ABOVE", 4)
    rnd = random.Random(5)
    fps = {0, (1 << 64) - 1} | {sum(1 << rnd.randrange(64) for _ in range(rnd.choice([1, 2, 3]))) & (1 << 64) - 1 for _ in range(150)}
    fps |= {rnd.getrandbits(64) for _ in range(30)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    got = {(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(df, 2).collect()}
    want = {frozenset((a, b)) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 2}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)


def test_empty_table_and_all_null(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert result(simhash.near_duplicates(frame(spark, [(None, None)]))) == [(None, 0, None)]


def test_keep_one(spark):
    rows = corpus()
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "n"]
    want = sorted({i for i, _, c in brute(rows) if i is not None and i == c})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want


def test_keep_one_with_repeated_and_null_ids(spark):
    """Each row is decided by its own component, not by all rows of its doc_id."""
    rnd = random.Random(9)
    a, b, c, d = (" ".join("w%d" % rnd.randrange(10 ** 6) for _ in range(100)) for _ in range(4))
    rows = [(3, a), (5, a), (5, b), (5, c), (None, b), (None, d), (None, d), (8, c), (5, c)]
    kept = simhash.keep_one(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(3, a), (5, b), (5, c), (None, d), (None, d)], key=str)


def test_chain_of_links(spark):
    from telemetra.llm.components import connected_components
    n = 300
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(7, 7), (900, 800)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 900: 800, 800: 800}
    assert connected_components(edges.limit(0)).collect() == []
