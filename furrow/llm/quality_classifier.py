"""Quality classifier: Bradley-Terry scores learnt from preference pairs, thresholded at a score quantile.

Every pair sets a document of label 1 against one of label 0; logistic loss on the difference of their features gives the
weights of a linear score. The threshold is the training score's quantile that separates the labels best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm import stats
from furrow.llm import text as T

ACCEPT = 0.3  #: documents of at least this score are predicted 1


def features(x: np.ndarray) -> np.ndarray:
    """The statistics, and for shares also square roots and steps, so that a linear score can bend."""
    shares = np.clip(x[:, 2:11], 0, 1)
    return np.concatenate([x, np.sqrt(shares), shares > 0.03, shares > 0.15, shares > 0.4], 1)


@dataclass
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float
    spread: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        """Features by their mean and spread, far outliers held at 6 spreads."""
        return np.clip((features(x) - self.mean) / self.scale, -6, 6)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, monotone in the raw score; the cut lies at ACCEPT."""
        return 1 / (1 + np.exp(-np.clip((self.raw(x) - self.cut) / self.spread + np.log(ACCEPT / (1 - ACCEPT)), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = 60_000, rounds: int = 300, ridge: float = 1e-3, seed: int = 7) -> Ranker:
    """Learn from labelled statistics. Without both labels every document scores above the threshold."""
    f = features(x)
    width = f.shape[1]
    if len(f) == 0 or y.min() == y.max():
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), -1.0, 1.0)
    mean, scale = f.mean(0), np.maximum(f.std(0), 1e-3)
    model = Ranker(mean, scale, np.zeros(width), 0.0, 1.0)
    z = model.standard(x)
    draw = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    d = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, rounds + 1):  # Adam on the whole set of pairs
        g = -(d / (1 + np.exp(np.clip(d @ w, -30, 30)))[:, None]).mean(0) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    s = z @ w
    cuts = np.quantile(s, np.linspace(0.005, 0.6, 240))
    fair = [((s[y == 1] >= c).mean() + (s[y == 0] < c).mean()) for c in cuts]
    best = np.flatnonzero(np.array(fair) >= max(fair) - 1e-9)
    cut = float(cuts[best[len(best) // 2]])
    model.weight, model.cut, model.spread = w, cut, float(max(np.std(s), 1e-6)) / 2
    return model


def train(docs: DataFrame, labels: DataFrame, most: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> Ranker:
    """A ranker from at most `most` labelled rows outside the held-out fold."""
    return fit(*stats.labelled_sample(docs, labels, "quality", most, id_col, text_col))


def classify(docs: DataFrame, model: Ranker, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns in keep, score (0 to 1) and predicted (score >= 0.3) of every document.

    Null texts are scored as empty ones, very long ones whole; repeated ids and rows give one row each; equal texts have equal
    scores, and a score of 0.3 itself is predicted 1; columns that are neither named nor kept are
    not read, so their names cannot clash; an empty table gives no rows.
    """
    # a kept text goes to the workers once
    carried = text_col in keep
    bare = F.lit(None).cast("binary") if carried else T.as_bytes(F.col(text_col))
    texts = docs.select(id_col, bare.alias("_text"), F.struct(F.lit(0).alias("_"), *keep).alias("_rest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(2).field(text_col) if carried else b.column(1)
            for a, z in T.slices(T.flat(column)[1], 4 << 20):
                found = stats.measure(column.slice(a, z - a))
                score = model.score(np.stack([found[k] for k in stats.SHARES], 1))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), b.column(2).slice(a, z - a), pa.array(score, pa.float64()), pa.array((score >= ACCEPT).astype(np.int32))], ["_id", "_rest", "_score", "_predicted"])

    kind, rest = (texts.schema[c].dataType.simpleString() for c in (id_col, "_rest"))
    out = texts.mapInArrow(run, f"_id {kind}, _rest {rest}, _score double, _predicted int")
    return out.select(F.col("_id").alias(id_col), *(F.col(f"_rest.`{c}`").alias(c) for c in keep), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"))
