"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier is trained from confirmed toxic texts and unlabelled texts: the
risk of the negatives is the unlabelled risk less the prior's share of the positives',
and where that goes below zero its gradient is turned round (Kiryo et al. 2017).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import LOWER, doc_text, map_slices, texts_of
from telemetra.session import materialize, release

#: Bounds of the training sample, in rows; the rows of the smallest id hashes are taken.
POSITIVE_ROWS = 8000
UNLABELLED_ROWS = 16000
#: Features the classifier weighs, the most telling of the sample.
FEATURES = 256
#: What makes a feature telling: its share of the positives against that of the unlabelled
#: texts as a ratio, that difference in standard errors, and positives that have it.
LIFT, GAIN, LEAST = 4.0, 4.0, 5
#: Bytes of the word beginnings that are features besides the whole word (stems inflect).
BEGINNINGS = (4, 5)
#: Times that count at most: a text that repeats one word is not endlessly more toxic.
MOST = 5
_SPACED = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in LOWER)


def features_of(text: bytes, wanted=None) -> dict[bytes, int]:
    """Times each feature is met in a whole text, ``MOST`` at most: the words, ended by
    ``$``, and their beginnings; A-Z in lower case, ASCII punctuation as spaces.
    ``wanted``: only these features."""
    out: dict[bytes, int] = {}
    for w, n in Counter(text.translate(_SPACED).split()).items():
        for f in (w + b"$", *[w[:k] for k in BEGINNINGS if len(w) >= k]):
            if wanted is None or f in wanted:
                out[f] = min(MOST, out.get(f, 0) + n)
    return out


@dataclass
class Model:
    """Weights of the features, for each time a text has them, and a constant."""

    weights: dict[bytes, float]
    bias: float

    def score(self, text: bytes) -> float:
        found = features_of(text, self.weights)
        z = self.bias + sum([self.weights[f] * found[f] for f in sorted(found)])
        return float(1 / (1 + np.exp(-min(max(z, -700.0), 700.0))))


def nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 400, rate: float = 0.1, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss (Adam).

    Risk: prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)).
    """
    p, u = (np.hstack([x, np.ones((len(x), 1), x.dtype)]) for x in (p, u))
    w = np.zeros(p.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for t in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        positive = prior * (p.T @ (sig(zp) - 1)) / len(p)
        negative = (u.T @ sig(zu)) / len(u) - prior * (p.T @ sig(zp)) / len(p)
        risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g = positive + negative if risk >= 0 else -negative
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, positive, features, times): at most ``POSITIVE_ROWS`` confirmed toxic texts and
    ``UNLABELLED_ROWS`` others, whatever their label, by the hash of the id."""
    text = doc_text(docs).where("doc_id IS NOT NULL")
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("label").alias("label")).where("label = 1")
    order = F.xxhash64(F.lit("sample"), "doc_id")
    pos = known.orderBy(order, "doc_id").limit(POSITIVE_ROWS).select("doc_id", F.lit(1).alias("positive"))
    unl = text.select("doc_id").orderBy(order, "doc_id").limit(UNLABELLED_ROWS).distinct().select("doc_id", F.lit(0).alias("positive"))
    chosen = materialize(pos.union(unl), "sample")  # bounded: two documented row counts, two numbers a row

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [sorted(features_of(t).items()) for t in texts_of(batch)]
        return [batch.column(0), batch.column(2), pa.array([[f for f, _ in x] for x in found], pa.list_(pa.binary())),
                pa.array([[n for _, n in x] for x in found], pa.list_(pa.int32()))]

    rows = text.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "positive")
    return map_slices(rows, run, "doc_id long, positive int, features array<binary>, times array<int>")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on a bounded sample of ``docs`` (``labels``: doc_id, label; 1 confirms toxic).

    Only the rows given are learned from, so callers leave out what is held out. Labels
    of 0 serve the class prior alone (share of 1 among the labelled). The feature counts are
    made by Spark; the driver gets the chosen features' counts, at most ``FEATURES`` columns
    for the sample's rows. Without a positive or an unlabelled text the model is constant.
    """
    counts = labels.agg(F.count("label"), F.sum("label")).first()
    prior = min(max((counts[1] or 0) / (counts[0] or 1), 1e-3), 0.5)
    bias = float(np.log(prior / (1 - prior)))
    sample = materialize(training_sample(docs, labels).dropDuplicates(["positive", "features"]), "toxic-sample")
    size = {r[0]: r[1] for r in sample.groupBy("positive").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        release(sample)
        return Model({}, bias)
    df = sample.select("positive", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("positive").alias("p"), F.sum(1 - F.col("positive")).alias("u"))
    share_p, share_u = F.col("p") / n1, F.col("u") / n0
    gain = (share_p - share_u) / F.sqrt(share_p * (1 - share_p) / n1 + share_u * (1 - share_u) / n0 + 1e-9)
    top = df.where((F.col("p") >= LEAST) & (share_p >= LIFT * share_u) & (gain >= GAIN)).orderBy(gain.desc(), "f").limit(FEATURES)
    vocab = {bytes(r.f): i for i, r in enumerate(top.select("f").collect())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = zip(b.column(1).to_pylist(), b.column(2).to_pylist())
            own = [[vocab[f] * (MOST + 1) + n for f, n in zip(fs, ns) if f in vocab] for fs, ns in both]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.list_(pa.int32()))], ["positive", "own"])

    rows = sample.select("positive", "features", "times").mapInArrow(run, "positive int, own array<int>")
    kinds = rows.groupBy("positive", "own").count().orderBy("positive", "own").collect()
    release(sample)
    x = {0: [], 1: []}
    for r in kinds:
        line = np.zeros(len(vocab), np.float32)
        at, times = np.divmod(np.array(r.own, dtype=int), MOST + 1)
        line[at] = times
        x[r.positive] += [line] * r[2]
    w, bias = nnpu(np.array(x[1]), np.array(x[0]), prior)
    return Model({k: float(w[i]) for k, i in vocab.items()}, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score), one row per row of ``docs``: 0 to 1, higher is likelier toxic.

    Reads whole texts. Null and empty texts get the constant's score; a null doc_id keeps
    its row; repeated rows give repeated results; other columns are not read; an empty
    table gives no rows.
    """
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [batch.column(0), pa.array([model.score(t) for t in texts_of(batch)], pa.float64())]
    return map_slices(doc_text(docs), run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns are kept,
    null texts are scored as empty."""
    schema, at = docs.schema, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = part.column(at).cast(pa.binary()).to_pylist()
                yield part.filter(pa.array([model.score(t or b"") < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, schema)
