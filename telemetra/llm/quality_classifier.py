"""Document quality by a regularised quadratic discriminant on text statistics.

Each class has a mean and a covariance of transformed statistics, shrunk towards their
diagonal; the score is the logistic of the difference of the two log densities, each a
Mahalanobis distance through the class's cached Cholesky factor.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import doc_text, map_slices, texts_of

FEATURES = ("words", "upper", "digits", "symbols", "punctuation", "exclamations", "repeats",
            "copied_lines", "distinct", "word_length", "stops", "lines")
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of a whole text: logarithms of rates, each with a floor."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    count = lambda chars: len(text) - len(text.translate(None, chars))
    triples = len(words) - 2
    # a triple is known by where its words are first met, so equal triples are equal numbers
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    repeated = 0.0
    if triples > 0:
        base = np.uint64(len(ids) + 1)
        three = (code[:-2] * base + code[1:-1]) * base + code[2:]
        kinds = np.unique(three)
        repeated = 1 - len(kinds) / triples
    lines = [x for x in text.split(b"\n") if x.strip()]
    copied = 1 - len(set(lines)) / len(lines) if lines else 0.0
    rate = lambda k, floor=1e-3: float(np.log(k / size + floor))
    return [float(np.log1p(len(words))), rate(count(UPPER)), rate(count(DIGITS)), rate(count(SYMBOLS)),
            rate(count(PUNCTUATION)), rate(text.count(b"!")), float(np.log(repeated + 1e-2)),
            float(np.log(copied + 1e-2)), len(ids) / n, float(np.log((size - count(b" \t\n\r\x0b\x0c")) / n + 1e-2)),
            float(np.log((text.count(b".") + text.count(b"?")) / n + 1e-2)), float(np.log(len(lines) / n + 1e-3))]


@dataclass
class Model:
    """Per class: log prior, mean, lower Cholesky factor, half log determinant."""

    log_prior: list[float]
    mean: list[np.ndarray]
    factor: list[np.ndarray]
    half_log_det: list[float]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        density = []
        for prior, mean, factor, half in zip(self.log_prior, self.mean, self.factor, self.half_log_det):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(prior - half - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def moments(x: np.ndarray) -> np.ndarray:
    """Count, sums and sums of products of the rows, in one vector."""
    return np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])


def model_of(sums: dict[int, np.ndarray], shrinkage: float) -> Model:
    """The model of per-class moments; a class without enough rows takes the pooled spread."""
    k = len(FEATURES)
    zero = np.zeros(1 + k + k * k)
    total = sums.get(0, zero) + sums.get(1, zero)

    def spread(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = max(s[0], 1.0)
        mean = s[1:k + 1] / n
        return mean, s[k + 1:].reshape(k, k) / n - np.outer(mean, mean)

    pooled_mean, pooled = spread(total)
    out = Model([], [], [], [])
    for c in (0, 1):
        s = sums.get(c, zero)
        mean, cov = spread(s) if s[0] > k else (pooled_mean, pooled)
        target = np.diag(np.maximum(np.diag(pooled), 1e-4))
        cov = (1 - shrinkage) * cov + shrinkage * target
        factor = np.linalg.cholesky(cov)
        out.log_prior.append(float(np.log((s[0] + 1) / (total[0] + 2))))
        out.mean.append(mean)
        out.factor.append(factor)
        out.half_log_det.append(float(np.log(np.diag(factor)).sum()))
    return out


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of each whole text; null is the empty text.

    One row per row of ``docs``, null and repeated ids included; other columns are not
    read. Stage the result when it serves both ``fit`` and ``score``: the texts are then
    read once and never shuffled.
    """
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [batch.column(0), pa.array([statistics(t) for t in texts_of(batch)], pa.list_(pa.float64()))]
    return map_slices(doc_text(docs), run, "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=float).reshape(-1, len(FEATURES))


def fit(feats: DataFrame, labels: DataFrame, shrinkage: float = 0.05) -> Model:
    """Train on every labelled row (``labels``: doc_id, label 0 or 1).

    Tasks add up the moments of their rows; the driver gets one vector per class (a fixed
    number of sums, whatever the number of rows). Rows without a label or id give nothing;
    a repeated id counts once per row and label; no usable row at all gives a model that
    scores everything one half.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    rows = feats.join(known.where("label IN (0, 1)"), "doc_id").select("x", "label")

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        x, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
        sums = [moments(x[y == c]) for c in (0, 1)]
        return [pa.array([0, 1], pa.int32()), pa.array([s.tolist() for s in sums], pa.list_(pa.float64()))]

    size = len(moments(_matrix(pa.array([], pa.list_(pa.float64())))))
    parts = map_slices(rows, run, "label int, sums array<double>", rows=8192)
    found = parts.groupBy("label").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)]).collect()
    return model_of({r[0]: np.array(r[1:], dtype=float) for r in found}, shrinkage)


def score(feats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): the probability of label 1 for each row of ``features``."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [batch.column(0), pa.array(model.score(_matrix(batch.column(1))), pa.float64())]
    return map_slices(feats, run, "doc_id long, score double", rows=8192)
