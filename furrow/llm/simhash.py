"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: ASCII-lowered words, shingles of three words (repeats included; fewer words: one shingle of all; none: zero),
XXH64 with seed 42 of each; a bit is 1 if it is set in over half of the hashes.

Links: equal fingerprints are one class. Distinct ones that differ in at most `most_bits` bits agree on one of
most_bits + 1 disjoint fields, so each is dealt to one group for each field and value, and every linked pair meets in a
group. Fields are as wide as the number of distinct fingerprints asks for; a group that stays large (many near copies share a
value) is dealt again by further fields of its own, which keeps every pair. Inside a group the fingerprints are sorted by
Gray rank and indexed: a node covers neighbours in that order and holds the bits they share and its parent does not (a mask
and a pattern); a search adds up differences from the top and leaves a whole node when they pass the limit. A group returns a
spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow import session
from furrow.llm import text as T
from furrow.operators.components import components

GROUP = 20_000  #: fingerprints a group should hold
FAN = 16  #: children of a node
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def fingerprint(raw: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of one text."""
    import xxhash

    found = raw.lower().split()
    if not found:
        return 0
    joined, size = b" ".join(found), min(shingle, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[: len(found) - size]]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[a:b], seed) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[a : a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """id and fp (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.fromiter((fingerprint(x.as_py(), shingle, seed) for x in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64))], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, T.as_bytes(F.col(text_col)).alias("_text")).mapInArrow(run, f"{id_col} {kind}, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each number in the binary-reflected Gray code."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Nodes over fingerprints in Gray order, level by level; the last level is the fingerprints."""

    def __init__(self, fps: np.ndarray) -> None:
        self.fps = fps[np.argsort(gray_rank(fps))]
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        ones, zeros = [self.fps], [~self.fps]
        while len(ones[-1]) > FAN:
            at = np.arange(0, len(ones[-1]), FAN)
            ones.append(np.bitwise_and.reduceat(ones[-1], at))
            zeros.append(np.bitwise_and.reduceat(zeros[-1], at))
        self.levels = []  # from the top: own mask and pattern of each node
        above = None
        for one, zero in zip(reversed(ones), reversed(zeros), strict=True):
            shared = one | zero
            own = shared if above is None else shared & ~np.repeat(above, FAN)[: len(shared)]
            self.levels.append((own & every, one & own))
            above = shared

    def near(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, place in self.fps) of all pairs that differ in at most `most` bits."""
        top = len(self.levels[0][0])
        q, node = np.repeat(np.arange(len(queries)), top), np.tile(np.arange(top), len(queries))
        diff = np.zeros(len(q), np.uint8)
        for level, (mask, pattern) in enumerate(self.levels):
            diff = diff + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            keep = diff <= most
            q, node, diff = q[keep], node[keep], diff[keep]
            if level + 1 < len(self.levels):
                n = len(self.levels[level + 1][0])
                child = (node[:, None] * FAN + np.arange(FAN)).ravel()
                inside = child < n
                q, node, diff = np.repeat(q, FAN)[inside], child[inside], np.repeat(diff, FAN)[inside]
        return q, node


def forest(fps: np.ndarray, most: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of distinct fingerprints under Hamming distance `most`."""
    index = GrayIndex(fps)
    fps, n = index.fps, len(index.fps)
    parent = np.arange(n)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    a, b = [], []
    for at in range(0, n, block):
        q, node = index.near(fps[at : at + block], most)
        q = q + at
        for x, y in zip(*(v[q < node].tolist() for v in (q, node)), strict=True):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                a.append(x)
                b.append(y)
    return fps[np.array(a, np.int64)], fps[np.array(b, np.int64)]


def _field(fp: Column, fields: list[tuple[int, int]]) -> Column:
    """One struct (field, value) for each field of a fingerprint."""
    return F.array(*(F.struct(F.lit(i).alias("field"), F.shiftrightunsigned(fp, start).bitwiseAND((1 << width) - 1).alias("value")) for i, (start, width) in enumerate(fields)))


def plan_fields(n: int, most: int) -> list[tuple[int, int]]:
    """most + 1 disjoint fields (start, width), for n fingerprints."""
    step = 64 // (most + 1)
    return [(i * step, min(step, (n // GROUP).bit_length())) for i in range(most + 1)]


def _links(group: DataFrame, keys: list[str], most: int) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        a, b = forest(np.unique(t["fp"].combine_chunks().to_numpy(zero_copy_only=False)).view(np.uint64), most)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return group.select(*keys, "fp").groupBy(*keys).applyInArrow(run, "a long, b long")


def near_links(fps: DataFrame, most: int = 2) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that join what is reachable by pairs of at most `most` differing bits."""
    n = fps.count()
    fields = plan_fields(n, most)
    dealt = fps.select("fp", F.explode(_field(F.col("fp"), fields)).alias("k")).select("fp", "k.field", "k.value")
    if not fields[0][1]:
        return _links(fps.withColumn("field", F.lit(0)), ["field"], most)  # one group holds all
    dealt = session.written(dealt, "fields")
    sizes = dealt.groupBy("field", "value").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > 4 * GROUP)
    # A large group is dealt again by fields that lie beside the first ones: its pairs agree on one of those, too.
    again = dealt.join(large, ["field", "value"])
    usual = dealt.join(large, ["field", "value"], "left_anti")
    out = _links(usual, ["field", "value"], most)
    if (worst := large.agg(F.max("n")).first()[0]) is not None:
        beside, room = fields[0][1], 64 // (most + 1) - fields[0][1]
        second = [(start + beside, min(width, room)) for start, width in plan_fields(worst, most)]
        inner = again.select("fp", "field", "value", F.explode(_field(F.col("fp"), second)).alias("k")).select("fp", "field", "value", F.col("k.field").alias("field2"), F.col("k.value").alias("value2"))
        out = out.unionByName(_links(inner, ["field", "value", "field2", "value2"], most))
    return out


def signed(raw: bytes) -> int:
    """The SimHash of one text as fingerprints() gives it."""
    fp = fingerprint(raw)
    return fp - (1 << 64) if fp >> 63 else fp


def grouped(docs: DataFrame, most_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp, root (a fingerprint that names the component) and component_id (the smallest id reachable, itself included).

    Null and empty texts have fingerprint zero and link like any other; very long texts are read whole. Equal fingerprints are
    one class, whose least id names it. Rows with the same id and different texts may lie in
    several components; null ids belong to a component but never name it, unless all its ids are null. Other columns are not
    read; an empty table gives no rows.
    """
    found = session.written(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = session.written(found.groupBy("fp").agg(F.min(id_col).alias("least")), "classes")
    joined = components(near_links(classes.select("fp"), most_bits))
    # A class that has no near class is its own component.
    of_class = classes.join(joined, classes.fp == joined.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    of_root = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of_class.select("fp", "root").join(of_root, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return found.join(named, F.col("fp") == F.col("_fp")).select(id_col, "fp", "root", "component_id")


def near_dedup(docs: DataFrame, most_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp and component_id of every row; see grouped()."""
    return grouped(docs, most_bits, id_col, text_col).select(id_col, "fp", "component_id")


def hex16(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
