"""Toxicity and quality: held-out accuracy, defined results for odd input, the numpy parts against plain versions."""

import math
import zlib

import numpy as np
import pytest

from telemetra.llm import quality_classifier as quality
from telemetra.llm import queries, toxicity

SF = "/root/testdata/sf0.1"
ODD = [(1, None, "a"), (2, "", "b"), (None, "no id", "c"), (3, " \n", "d"), (3, " \n", "d"), (4, "é" * 40000, "e"), (5, "one", "f")]
ODD_SCHEMA = "doc_id long, text string, score string"


def rates(spark, df, label, mod, remainder):
    truth = {r.doc_id: r[1] for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label).collect()}
    rows = df.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == remainder) for r in rows)
    own = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    hit = lambda y: sum(p == t for p, t in own if t == y) / sum(t == y for _, t in own)
    return hit(0), hit(1)


def test_toxicity_held_out(spark):
    clean, toxic = rates(spark, queries.op5_toxicity(spark, SF), "toxic", 5, 0)
    assert clean > 0.99 and toxic > 0.85


def test_quality_held_out(spark):
    junk, good = rates(spark, queries.op6_quality_classifier(spark, SF), "quality", 4, 2)
    assert junk > 0.98 and good > 0.98


def test_nnpu_separates_and_stays_calibrated():
    rng = np.random.default_rng(1)
    pos = (rng.random((400, 6)) < [0.9, 0.6, 0.1, 0.1, 0.1, 0.1]).astype(np.float32)
    neg = (rng.random((1800, 6)) < [0.02, 0.05, 0.1, 0.1, 0.1, 0.1]).astype(np.float32)
    hidden = (rng.random((200, 6)) < [0.9, 0.6, 0.1, 0.1, 0.1, 0.1]).astype(np.float32)
    w, b = toxicity.nnpu(pos, np.vstack([neg, hidden]), 0.1)
    assert (neg @ w + b < 0).mean() > 0.95 and (hidden @ w + b > 0).mean() > 0.85


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


def test_toxicity_odd_rows(spark, odd):
    model = toxicity.Model({b"bad$": 5.0, b"quit": 1.0}, -2.0)
    df = odd.union(spark.createDataFrame([(9, "BAD, quite", "g")], ODD_SCHEMA))
    got = sorted(((r.doc_id, r.score) for r in toxicity.score(df, model).collect()), key=str)
    base, high = 1 / (1 + math.exp(2)), 1 / (1 + math.exp(-4))
    assert [i for i, _ in got] == [1, 2, 3, 3, 4, 5, 9, None]
    assert all(s == pytest.approx(high if i == 9 else base) for i, s in got)
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and sorted(map(str, kept.collect())) == sorted(str(r) for r in df.collect() if r.doc_id != 9)
    assert toxicity.score(odd.limit(0), model).collect() == []


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, label int")
    for labels in (none, spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, label int")):
        assert toxicity.fit(odd, labels).weights == {}
    assert toxicity.fit(odd.limit(0), none).weights == {}


def test_quality_odd_rows(spark, odd):
    feats = quality.features(odd)
    empty = quality.fit(feats, spark.createDataFrame([], "doc_id long, label int"))
    assert [r.score for r in quality.score(feats, empty).collect()] == [0.5] * len(ODD)
    few = quality.fit(feats, spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 7)], "doc_id long, label int"))
    scores = {(r.doc_id, r.score) for r in quality.score(feats, few).collect()}
    assert len({s for i, s in scores if i in (1, 2)}) == 1 and all(0 <= s <= 1 for _, s in scores)
    assert quality.score(quality.features(odd.limit(0)), few).collect() == []


def test_discriminant_equals_direct_densities():
    rng = np.random.default_rng(2)
    k = len(quality.FEATURES)
    x = {c: rng.normal(c, 1 + c, (200, k)) for c in (0, 1)}
    model = quality.model_of({c: quality.moments(v) for c, v in x.items()}, 0.1)
    pooled = np.cov(np.vstack([x[0], x[1]]).T, bias=True)
    probe, density = rng.normal(0.5, 1, (20, k)), []
    for c in (0, 1):
        cov = 0.9 * np.cov(x[c].T, bias=True) + 0.1 * np.diag(np.diag(pooled))
        d = probe - x[c].mean(axis=0)
        density.append(np.log(201 / 402) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.score(probe), 1 / (1 + np.exp(density[0] - density[1])))


def test_repeated_triples_are_counted():
    at = quality.FEATURES.index("repeats")
    assert quality.statistics(b"a b c a b c")[at] == pytest.approx(math.log(1 / 4 + 1e-2))
    assert quality.statistics(b"a b c d")[at] == pytest.approx(math.log(1e-2))
