"""Filter interactions against a plain count."""

import random
from itertools import permutations

import pytest

from telemetra.llm import filter_audit

SCHEMA = "doc_id long, text string, source string, h long, n int"
SPACE = " \t\n\r\x0b\x0c"


def words(text):
    out, word = [], ""
    for c in text:
        if c in SPACE:
            out, word = out + [word] * bool(word), ""
        else:
            word += c
    return out + [word] * bool(word)


def plain_bits(text):
    ws = words(text)
    upper = sum("A" <= c <= "Z" for c in text)
    return "".join(f for f, bad in (("A", len(ws) < 200), ("B", 100 * len(set(ws)) < 50 * len(ws)),
                                    ("C", 100 * upper > 2 * len(text)), ("D", any(c in "#$%&*|" for c in text))) if bad)


def plain(rows, labels):
    first, good, toxic = {}, set(), set()
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, q, x in labels:
        good |= {i} if q == 1 else set()
        toxic |= {i} if x == 1 else set()
    docs = [(s or "", set(plain_bits(t or "") + ("E" if i is not None and first[t or ""] < i else "")), i is not None and i in good, i is not None and i in toxic) for i, t, s, *_ in rows]
    out, total = [], {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            alive = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                redundant = sum(f in d[1] for d in gone)
                out_here = [d for d in alive if f in d[1]]
                alive = [d for d in alive if f not in d[1]]
                gone += out_here
                total[part, f] = total.get((part, f), 0) + len(out_here)
                unique = sum(d[0] == part and d[1] == {f} for d in docs)
                out.append((part, order, step, len(alive), len(out_here), redundant, unique, sum(d[2] for d in out_here), sum(d[3] for d in out_here)))
    return sorted((*r, total[r[0], r[1][r[2] - 1]]) for r in out)


def corpus():
    rnd = random.Random(5)
    texts = [None, "", " \n", "one", "ONE two", "a #", "é x " * 150, "Ä" * 300, "x" * 100_000]
    texts += [" ".join(rnd.choice(["w%d", "W%d", "w%d$"]) % rnd.randrange(rnd.choice([20, 2000])) for _ in range(rnd.choice([3, 199, 200, 260]))) for _ in range(40)]
    rows = [(i, rnd.choice(texts), rnd.choice(["a", "b", "", None]), 7, 1) for i in range(150)]
    rows += [(None, "one", "a", 0, 0), (None, "one", "a", 0, 0), (3, "one", "a", 0, 0), (3, "one", "a", 0, 0), (3, "other text", "b", 0, 0), (-4, "", None, 0, 0)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("hot", [200, 2])
def test_against_plain_counts(spark, monkeypatch, hot):
    """Nulls, empty and long texts, repeated rows and ids, clashing columns, salted groups."""
    monkeypatch.setattr(filter_audit, "HOT", hot)
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, got.collect())) == plain(rows, labels)


def test_empty(spark):
    got = filter_audit.audit(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert got.collect() == [] and len(got.columns) == 10


def test_full_filter_keeps_every_copy(spark, monkeypatch):
    """A saturated bitmap only lets more texts through; the copies are the same."""
    monkeypatch.setattr(filter_audit, "FILTER_BITS", 1 << 12)
    monkeypatch.setattr(filter_audit, "power_of_two", lambda n, least, most: 64)
    rows = [(i, f"text {i % 400}", "s", 0, 0) for i in range(700)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = filter_audit.later_copies(docs, filter_audit.text_failures(docs).select("h"))
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(400, 700))


def test_other_letters(spark):
    """Interactions of any number of filters."""
    combos = spark.createDataFrame([("p", 3, True, False, 4), ("p", 1, False, False, 2), ("p", 0, False, True, 1)], "part string, bits int, good boolean, toxic boolean, docs long")
    got = {(r["filter_order"], r["step"]): r for r in filter_audit.interactions(combos, "XY").collect()}
    assert got["XY", 1]["removed"] == 6 and got["XY", 2]["removed"] == 0 and got["XY", 2]["redundant"] == 4
    assert got["YX", 1]["removed"] == 4 and got["YX", 2]["unique_fails"] == 2 and got["XY", 1]["shapley"] == 8
