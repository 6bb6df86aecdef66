"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut into halves; each half has its own codebook, and the pairs of codewords form a grid of cells. A vector lies
in the cell of its nearest codewords. To find what lies near it, a multi-sequence traversal visits cells from the nearest on:
per half and codeword the squared distance to that codeword's region is bounded from below (by the planes that part it from the
vector's nearest codewords), the two halves' bounds are summed, and cells are visited in the order of the sum up to a limit. The limit is set on planted pairs at
exactly the threshold, so that `recall` of those would be visited (closer pairs more often); recall 1 takes the radius itself,
which misses nothing. What is visited is verified by the cosine in double precision.

Equal vectors are one class with a weight, so copies never meet in pairs. Each pair of classes is looked for from the lower cell
only. The codebooks grow with the table up to MOST_CODES, so that cells stay small. Large cells are split both ways, members and
visitors by hashes of their own, and every part of members meets every part of visitors: a task holds at most about two parts,
whatever the cell. A part returns, for each class, how many vectors it linked, and a star forest of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow import session
from furrow.operators.components import components

SAMPLE = 20_000  #: vectors that codebooks are learnt from, those of lowest hash
CELL = 24  #: classes that a cell should hold, up to MOST_CODES codewords a half (25 million classes)
MOST_CODES = 1024  #: a twentieth of the sample
PLANES = 8  #: nearest codewords whose planes bound distances
PART = 4096  #: members, or visitors, of a part of a cell
LINKS = "id long, h long, links long, to long"


@dataclass
class Grid:
    """Codebooks of the halves, distances between their codewords, and the limit of the traversal."""

    codes: tuple[np.ndarray, np.ndarray]
    limit: float = np.inf

    def __post_init__(self) -> None:
        self.gaps = tuple(np.sqrt(np.maximum((c**2).sum(1)[:, None] - 2 * c @ c.T + (c**2).sum(1), 1e-12)) for c in self.codes)

    def halves(self, u: np.ndarray) -> list[np.ndarray]:
        """Squared distances of each half to its codewords."""
        cut = self.codes[0].shape[1]
        return [np.maximum((x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1), 0) for x, c in zip((u[:, :cut], u[:, cut:]), self.codes, strict=True)]

    def cell(self, u: np.ndarray) -> np.ndarray:
        a, b = self.halves(u)
        return a.argmin(1) * len(self.codes[1]) + b.argmin(1)

    def bounds(self, u: np.ndarray) -> list[np.ndarray]:
        """Lower bounds of the squared distance of each half to each codeword's region."""
        out = []
        for d, gap in zip(self.halves(u), self.gaps, strict=True):
            most, n = np.zeros_like(d), min(PLANES, d.shape[1])
            for k in np.argpartition(d, n - 1, axis=1)[:, :n].T:
                np.maximum(most, (d - np.take_along_axis(d, k[:, None], 1)) / (2 * gap[k]), out=most)
            out.append(most**2)
        return out

    def visit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Multi-sequence traversal for one vector: cells by ascending sum of the halves' bounds, up to the limit."""
        oa, ob = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        reach = np.searchsorted(b[ob], self.limit - a[oa], "right")
        row = np.repeat(np.arange(len(oa)), reach)
        col = np.arange(len(row)) - np.repeat(np.cumsum(reach) - reach, reach)
        order = np.argsort(a[oa][row] + b[ob][col], kind="stable")
        return (oa[row] * len(b) + ob[col])[order]


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    draw = np.random.default_rng(seed)
    codes = x[draw.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (-2 * x @ codes.T + (codes**2).sum(1)).argmin(1)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(codes)
        np.add.at(total, near, x)
        codes = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], codes)
    return np.unique(codes, axis=0)


def learn(sample: np.ndarray, n: int, threshold: float, recall: float, seed: int = 5) -> Grid:
    """Codebooks for n classes from a sample of unit vectors, and the limit that finds `recall` of pairs at the threshold."""
    distinct = np.unique(sample, axis=0)
    k = int(max(1, min(MOST_CODES, len(distinct), round(np.sqrt(n / CELL)))))
    cut = max(1, sample.shape[1] // 2)
    grid = Grid(tuple(kmeans(x, min(k, len(x)), seed=seed) for x in (distinct[:, :cut], distinct[:, cut:])))
    radius = 2 - 2 * threshold
    if recall >= 1 or sample.shape[1] < 2:
        grid.limit = radius + 1e-9
        return grid
    draw = np.random.default_rng(seed)
    u = distinct[draw.choice(len(distinct), 4000)]
    away = draw.normal(size=u.shape)
    away -= (away * u).sum(1, keepdims=True) * u
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    a, b = grid.bounds(u)
    i, j = np.divmod(grid.cell(threshold * u + np.sqrt(1 - threshold**2) * away), len(grid.codes[1]))
    rows = np.arange(len(u))
    grid.limit = float(min(radius, np.quantile(a[rows, i] + b[rows, j], recall)) + 1e-9)
    return grid


def unit(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float32()))
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def star(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node reachable from each of n nodes over links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(width: int, threshold: float):
    """One part of a cell: its members against the vectors that visit it."""

    def run(members: pa.Table, visitors: pa.Table) -> pa.Table:
        empty = {"id": pa.array([], pa.int64()), "h": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "to": pa.array([], pa.int64())}
        if not members.num_rows or not visitors.num_rows:
            return pa.table(empty)
        m, v = ({c: t[c].to_numpy() for c in ("id", "h", "weight", "home")} for t in (members, visitors))
        mu, vu = unit(members["vector"], width), unit(visitors["vector"], width)
        cell = members["cell"][0].as_py()
        got_m, got_v = np.zeros(len(mu), np.int64), np.zeros(len(vu), np.int64)
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        for a in range(0, len(vu), 512):
            q, p = np.nonzero(vu[a : a + 512] @ mu.T >= threshold)
            q = q + a
            # inside a cell each pair is met from both ends: the lower one counts
            once = (v["home"][q] != cell) | (v["id"][q] < m["id"][p]) | ((v["id"][q] == m["id"][p]) & (v["h"][q] < m["h"][p]))
            q, p = q[once], p[once]
            if len(q):
                got_v += np.bincount(q, m["weight"][p], len(vu)).astype(np.int64)
                got_m += np.bincount(p, v["weight"][q], len(mu)).astype(np.int64)
                label = star(q, len(vu) + p, len(vu) + len(mu))
                moved = np.flatnonzero(label != np.arange(len(label)))
                ends.append((moved, label[moved]))
        ids = np.concatenate([v["id"], m["id"]])
        label = star(*(np.concatenate([e[i] for e in ends]) if ends else np.zeros(0, np.int64) for i in (0, 1)), len(ids))
        keep = np.flatnonzero(np.concatenate([got_v, got_m]) > 0)
        return pa.table({"id": ids[keep], "h": np.concatenate([v["h"], m["h"]])[keep], "links": np.concatenate([got_v, got_m])[keep], "to": ids[label[keep]]})

    return run


def _links(classes: DataFrame, width: int, n: int, threshold: float, recall: float) -> DataFrame:
    """The links of n classes, all vectors of one width."""
    sample = classes.orderBy("h", "id").limit(SAMPLE).select("vector").toArrow()
    grid = learn(unit(sample["vector"], width), n, threshold, recall)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                u = unit(part.column(0), width)
                home = grid.cell(u)
                bounds = grid.bounds(u)
                visits = [(c := grid.visit(x, y))[c >= h].tolist() for x, y, h in zip(*bounds, home.tolist(), strict=True)]
                # the home cell is always visited
                visits = [v if h in v else [h, *v] for v, h in zip(visits, home.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home, pa.int64()), pa.array(visits, pa.list_(pa.int64()))], ["vector", "id", "weight", "h", "home", "visits"])

    kind = classes.schema["vector"].dataType.simpleString()
    placed = session.written(classes.mapInArrow(place, f"vector {kind}, id long, weight long, h long, home long, visits array<long>"), "placed")
    sizes = placed.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("m"))
    visits = placed.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.count("*").alias("v"))
    # at most MOST_CODES ** 2 rows; cells that nothing is in are not visited
    cells = sizes.join(visits, "cell").select("cell", F.expr(f"CAST(ceil(m / {PART}) AS INT)").alias("ms"), F.expr(f"CAST(ceil(v / {PART}) AS INT)").alias("vs"))
    cells = session.written(cells, "cells")
    one = cells.agg(F.max("ms").alias("ms"), F.max("vs").alias("vs")).first()
    split = (one["ms"] or 1) > 1 or (one["vs"] or 1) > 1
    row = lambda df, *part: df.select("cell", *part, "id", "h", "weight", "home", "vector")
    known = placed.withColumn("cell", F.explode("visits")).join(cells, "cell")
    own = placed.withColumn("cell", F.col("home")).join(cells.where("ms > 1 OR vs > 1"), "cell", "left") if split else placed.withColumn("cell", F.col("home"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n, salt: F.expr(f"CAST(pmod(xxhash64(h, id, {salt}), {n}) AS INT)")
    if split:
        own = own.fillna(1, ["ms", "vs"])
        members = row(own.select("*", deal("ms", 1).alias("mp"), every("vs").alias("vp")), "mp", "vp")
        visitors = row(known.select("*", every("ms").alias("mp"), deal("vs", 2).alias("vp")), "mp", "vp")
    else:
        members, visitors = (row(df, F.lit(0).alias("mp"), F.lit(0).alias("vp")) for df in (own, known))
    visitors = visitors.select(*(F.col(c).alias(c) for c in visitors.columns))  # columns of its own beside members'
    found = members.groupBy("cell", "mp", "vp").cogroup(visitors.groupBy("cell", "mp", "vp")).applyInArrow(_compare(width, threshold), LINKS)
    return session.written(found, "vector-links")


def near_dedup(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.995, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, n_links, component_id and kept of every row.

    Null or zero vectors and vectors with null or non-finite components link with nothing, others with vectors of equal width;
    each width has an index of its own. A cosine of exactly the threshold links; float vectors are compared in double precision,
    and all other numbers are read as doubles. Rows with the same id are one node of the components but separate vectors for n_links.
    Other columns are not read; an empty table gives no rows.
    """
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"))
    fine = F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0) & F.col("id").isNotNull(), F.lit(False))
    rows = rows.withColumn("vector", F.when(fine, F.col("vector")))
    classes = rows.where("vector IS NOT NULL").groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("weight")).withColumn("h", F.xxhash64("vector"))
    classes = session.written(classes, "vector-classes")
    found = vectors.sparkSession.createDataFrame([], LINKS)
    # a row for each width: a table has as many as models made its vectors
    for width, n in classes.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n")).where("n > 1").orderBy("width").collect():
        found = found.unionByName(_links(classes.where(F.size("vector") == width), width, n, threshold, recall))
    named = components(found.select("id", "to"), "id", "to")
    links = found.groupBy("id", "h").agg(F.sum("links").alias("links"))
    whole = classes.join(links, ["id", "h"], "left").join(named, F.col("id") == F.col("node"), "left")
    whole = whole.select(F.col("vector").alias("_v"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.join(whole, F.col("vector") == F.col("_v"), "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))
