"""Repeated passages against a brute-force version."""

import hashlib
import random

import numpy as np
import pytest

from telemetra.llm import substring_dedup as sub

W = 50


def brute(rows, w=W):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, ws in split:
        if i is not None:
            for s in range(len(ws) - w + 1):
                k = b" ".join(ws[s:s + w])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, ws in split:
        gone = set()
        if i is not None:
            for s in range(len(ws) - w + 1):
                if first[b" ".join(ws[s:s + w])] < i:
                    gone.update(range(s, s + w))
        out.append((i, len(ws), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(ws) if k not in gone)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=1, n=70):
    rnd = random.Random(seed)
    prose = lambda k: ["".join(rnd.choice("ab cd ef gé".split()) for _ in range(rnd.randrange(1, 4))) for _ in range(k)]
    shared = [prose(rnd.choice([49, 50, 51, 90, 300])) for _ in range(6)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "short text"), (None, " ".join(shared[3])), (5, "By " * 400), (6, "By " * 300 + "end"), (7, "By\tBy " * 100)]
    for i in range(10, 10 + n):
        ws = prose(rnd.choice([20, 60, 200, 900]))
        for _ in range(rnd.choice([0, 1, 2])):
            p, at = rnd.choice(shared), rnd.randrange(len(ws))
            ws[at:at] = p if rnd.random() < 0.7 else p[:len(p) // 2] + ["changed"] + p[len(p) // 2:]
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(ws)))
    rows += [(200, rows[20][1]), (15, rows[20][1]), (201, rows[20][1]), (201, rows[20][1]), (202, rows[30][1] + " tail"), (202, "other " + rows[31][1])]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 3, len(t or "")) for i, t in rows], "doc_id long, text string, row string, s int, n_chars long")


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    rows = corpus()
    want = brute(rows)
    assert sum(x[2] > 0 for x in want) > 20
    assert result(sub.digests(frame(spark, rows))) == want


@pytest.mark.parametrize("frequent", [1, 6, 10_000])
def test_hot_prefixes_and_small_groups(spark, monkeypatch, frequent):
    """Every way through the operator: extended prefixes, several groups, cut pieces, a full filter."""
    rows = corpus(2)
    monkeypatch.setattr(sub, "HOT", 3)
    monkeypatch.setattr(sub, "FREQUENT", frequent)  # none, some and all of the windows are joined as frequent ones
    monkeypatch.setattr(sub, "GROUP_PIECES", 10)
    monkeypatch.setattr(sub, "PIECE", 7)
    monkeypatch.setattr(sub, "LEAST_BITS", 64)
    monkeypatch.setattr(sub, "MOST_BITS", 64)
    assert result(sub.digests(frame(spark, rows))) == brute(rows)


def test_prefix_often_in_few_texts_is_hot(spark, monkeypatch):
    """A phrase met hundreds of times in each of three texts, every time between other
    words, has many pieces though few documents: no group may take them all."""
    rnd = random.Random(7)
    other = lambda k: ["w%d" % rnd.randrange(10 ** 6) for _ in range(k)]
    known = sub.WordHashes()
    phrase = min((other(sub.GRAM) for _ in range(3000)), key=lambda p: int(sub.window_prefixes(known.of(p), sub.GRAM)[0]))  # leads its windows
    tail = other(80)
    rows = [(i, " ".join([w for _ in range(200) for w in (*phrase, *other(20))] + tail)) for i in range(3)]
    monkeypatch.setattr(sub, "HOT", 100)
    monkeypatch.setattr(sub, "GROUP_PIECES", 50)
    whole, extended = [], sub._full_windows
    monkeypatch.setattr(sub, "_full_windows", lambda *a: whole.append(1) or extended(*a))
    assert result(sub.digests(frame(spark, rows))) == brute(rows)
    assert whole


def test_piece_counts(monkeypatch):
    monkeypatch.setattr(sub, "PIECE", 7)
    low = np.random.default_rng(3).integers(0, 4, 40).repeat(np.random.default_rng(4).integers(1, 30, 40)).astype(np.uint64)
    want = {}
    for s, _ in sub.pieces(low, np.ones(len(low), bool)):
        want[int(low[s])] = want.get(int(low[s]), 0) + 1
    own, n = sub.piece_counts(low)
    assert dict(zip(own.tolist(), n.tolist())) == want


def test_remove_repeats(spark):
    rows = corpus(3)
    out = sub.remove_repeats(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "row", "s", "n_chars"]
    got = sorted(((r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in out.collect()), key=str)
    assert got == sorted(((i, h) for i, _, _, h in brute(rows)), key=str)
    same = {i for i, _, k, _ in brute(rows) if not k}
    before = {i: t for i, t in rows if sum(j == i for j, _ in rows) == 1}
    assert all(r.text == before[r.doc_id] for r in out.collect() if r.doc_id in same and r.doc_id in before)
    assert all(r.n_chars == len(r.text or "") for r in out.collect())


def test_empty_table(spark):
    assert sub.digests(frame(spark, [])).collect() == []
    assert result(sub.digests(frame(spark, [(None, None)]))) == brute([(None, None)])


def test_tree_nodes():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 2, 400)
    for depth in (1, 2, 5, 8, 13):
        starts = rng.permutation(400 - depth + 1)
        node = sub.node_of(ids, starts, depth)
        key = {}
        assert all(key.setdefault(tuple(ids[s:s + depth]), n) == n for s, n in zip(starts, node)) and len(set(key.values())) == len(key)
