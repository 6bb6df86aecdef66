"""Quality rules: base rules, then gradient-boosted trees over document statistics.

The trees are grown here on histograms with logistic loss; chosen features may only lower (or raise) the score. A grown
model is flattened into numpy node arrays, so a batch of documents descends all trees by array indexing.
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

#: -1: more of it can only make a document look worse.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "echo_share": -1, "shout_share": -1}


@dataclass
class Trees:
    """Nodes of all trees one after another; a leaf points at itself."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, least: int = 5, ridge: float = 1.0) -> Trees:
    """Fit trees to labels 0/1. With one class or no rows the model is that class's (smoothed) rate."""
    rate_1 = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate_1 / (1 - rate_1)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "limit", "left", "right", "value")}
    roots: list[int] = []

    def node(value: float) -> int:
        i = len(nodes["value"])
        for k, v in (("feature", 0), ("limit", np.inf), ("left", i), ("right", i), ("value", value)):
            nodes[k].append(v)
        return i

    if len(y) < 2 * least or y.min() == y.max():
        roots.append(node(0.0))
        return Trees(*(np.array(nodes[k]) for k in nodes), np.array(roots), 0, base)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    place = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    out = np.full(len(y), base)

    def split(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float, left: int) -> int:
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
        i = node(rate * value)
        out[rows] += 0 if left else rate * value
        if not left:
            return i
        best = (1e-6, None)
        gs, hs = g[rows].sum(), h[rows].sum()
        for f in range(x.shape[1]):
            n = len(edges[f]) + 1
            if n < 2:
                continue
            p = place[rows, f]
            gl, hl, nl = (np.cumsum(np.bincount(p, v, n))[:-1] for v in (g[rows], h[rows], np.ones(len(rows))))
            vl, vr = -gl / (hl + ridge), -(gs - gl) / (hs - hl + ridge)
            gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
            gain[(nl < least) | (len(rows) - nl < least) | ((vr - vl) * monotone[f] < 0)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, k, float(vl[k]), float(vr[k])))
        if best[1] is None:
            out[rows] += rate * value
            return i
        f, k, vl, vr = best[1]
        middle = float(np.clip((vl + vr) / 2, low, high))
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(monotone[f])]
        goes = place[rows, f] <= k
        nodes["feature"][i], nodes["limit"][i] = f, edges[f][k]
        nodes["left"][i] = split(rows[goes], g, h, *bounds[0], left - 1)
        nodes["right"][i] = split(rows[~goes], g, h, *bounds[1], left - 1)
        return i

    for _ in range(trees):
        p = 1 / (1 + np.exp(-out))
        roots.append(split(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), -4.0, 4.0, depth))
    return Trees(*(np.array(nodes[k]) for k in nodes), np.array(roots), depth, base)


def train(docs: DataFrame, labels: DataFrame, most: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees from at most `most` labelled rows outside the held-out fold."""
    x, y = stats.labelled_sample(docs, labels, "quality", most, id_col, text_col)
    return grow(x, y, np.array([MONOTONE.get(k, 0) for k in stats.SHARES]))


def judge(docs: DataFrame, model: Trees, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, base_failed, tree score, kept.

    Null texts count as empty and fail the base rules (under 10 words); very long ones are read whole; a score at the threshold
    is kept; repeated ids and rows give one row each; other columns
    of docs, whatever their names, are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = stats.measure(b.column(1))
            score = model.score(np.stack([found[k] for k in stats.SHARES], 1)) if b.num_rows else np.zeros(0)
            failed = (found["n_words"] < 10) | (100 * found["n_repeat_words"] > 20 * found["n_words"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(found[k], pa.int64()) for k in stats.COUNTS), pa.array(failed, pa.bool_()), pa.array(score, pa.float64()), pa.array(~failed & (score >= threshold), pa.bool_())],
                [id_col, *stats.COUNTS, "base_failed", "score", "kept"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(id_col, T.as_bytes(F.col(text_col)).alias("_text"))
    return texts.mapInArrow(run, f"{id_col} {kind}, " + ", ".join(f"{k} long" for k in stats.COUNTS) + ", base_failed boolean, score double, kept boolean")
