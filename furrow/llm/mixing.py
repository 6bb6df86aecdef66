"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets share all words by weight; a source's target stops at `most_repeats` times its size and the excess is reshared. A source
that has stopped takes all its words that often, however few they are. The target of every other one becomes a whole number of
blocks: block after block goes to the source with the highest quotient weight / (2 * blocks + 1) that may still take one. The
result of that sequence is found directly: a divisor d gives every source the rounded weight / d, and the blocks that a last
divisor leaves over go by quotient. In a shard the documents stand in an order drawn from the seed and are cut into blocks whose
lengths differ by one word at most, so none is a remnant. All shards take every block as often as the source's words fill it
whole; of the rest each takes its part by size, as a drawn choice of blocks, and what rounding leaves over goes to the next shard.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow import session
from furrow.llm import text as T

SHARD_DOCS = 50_000  #: documents a shard should hold
BLOCKS_A_SOURCE = 4096  #: how finely the average source is cut
BLOCK_WORDS = 4096  #: the largest block


def water_fill(weights: Sequence[float], caps: Sequence[float], total: float) -> np.ndarray:
    """Shares of total by weight, none above its cap, the excess reshared by weight."""
    w, c = np.asarray(weights, float), np.asarray(caps, float)
    out, free, rest = np.zeros(len(w)), np.ones(len(w), bool), float(total)
    while free.any():
        share = np.where(free, rest * w / w[free].sum(), 0)
        over = free & (share > c)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = c[over]
        rest -= c[over].sum()
        free &= ~over
    return out


def sainte_lague(weights: np.ndarray, caps: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotient weight / (2k + 1); none above its cap; ties to the earlier entry."""
    w, c = np.asarray(weights, float), np.asarray(caps, np.int64)
    seats = int(min(seats, c[w > 0].sum()))
    if seats <= 0:
        return np.zeros(len(w), np.int64)
    given = lambda d: np.minimum(c, np.where(w > 0, np.ceil(w / d - 0.5), 0).astype(np.int64)).clip(0)  # noqa: E731  the seats whose quotient w / (k + 0.5) is above d
    low, high = w[w > 0].min() / (2.0 * seats + 2.0 * c.max() + 2.0), 2.1 * w.max()
    for _ in range(200):
        mid = (low + high) / 2
        if given(mid).sum() > seats:
            low = mid
        else:
            high = mid
    out = given(high)
    left = seats - int(out.sum())
    for _ in range(left):  # quotients that the last two divisors do not tell apart
        quotient = np.where((out < c) & (w > 0), w / (2 * out + 1), -1.0)
        out[int(np.argmax(quotient))] += 1
    return out


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """_id, _source, _tie (a hash of the text) and _size (words) of every row."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.xxhash64(text_col).alias("_tie"), T.as_bytes(F.col(text_col)).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = T.flat(b.column(3))
            count = [np.diff(T.words(data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a]).first) for a, z in T.slices(offsets)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(np.concatenate(count) if count else np.zeros(0, np.int64), pa.int64())], ["_id", "_source", "_tie", "_size"])

    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, _source string, _tie long, _size long")


def plan(shards: DataFrame, most_repeats: int = 3, seed: int = 11) -> DataFrame:
    """One row a shard (source, shard, words) -> also source_words, target, source_due (words to take), block and quota (blocks).

    One row a source is weighed in one task: sources are few beside documents, and shards of one source beside its documents.
    """
    sources = shards.groupBy("_source").agg(F.sum("words").alias("source_words"))

    def weigh(t: pa.Table) -> pa.Table:
        rank = np.array(sorted(range(t.num_rows), key=lambda i: ((s := t["_source"][i].as_py()) is None, s.encode() if s is not None else b"")), np.int64)
        t = t.take(pa.array(rank))
        size = t["source_words"].to_numpy()
        weights = np.arange(len(size)) % 3 + 1.0
        target = water_fill(weights, most_repeats * size, size.sum())
        block = int(min(BLOCK_WORDS, max(1, size.sum() // max(1, len(size) * BLOCKS_A_SOURCE))))
        most = most_repeats * size
        stopped = target >= most  # these need no blocks: they take all they have
        quota = sainte_lague(np.where(stopped, 0, weights), -(-most // block), int(round(target[~stopped].sum() / block)))
        due = np.where(stopped, most, np.minimum(quota * block, most))
        return pa.table({"_source": t["_source"], "source_words": size, "target": target, "source_due": due, "block": np.full(len(size), block)})

    weighed = sources.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(weigh, "_source string, source_words long, target double, source_due long, block long")

    def share(t: pa.Table) -> pa.Table:
        t = t.sort_by("shard")
        block, due = int(t["block"][0].as_py()), int(t["source_due"][0].as_py())
        quota = spread(t["words"].to_pylist(), t["shard"].to_pylist(), block, due, seed)
        return t.append_column("quota", pa.array(quota, pa.int64()))

    keyed = shards.withColumn("_s", F.coalesce("_source", F.lit(""))).withColumn("_none", F.col("_source").isNull())
    joined = keyed.join(weighed, keyed["_source"].eqNullSafe(weighed["_source"])).select("_s", "_none", "shard", "words", "source_words", "target", "source_due", "block")
    kind = "_s string, _none boolean, shard long, words long, source_words long, target double, source_due long, block long, quota long"
    return joined.groupBy("_s", "_none").applyInArrow(share, kind)


def mix(docs: DataFrame, most_repeats: int = 3, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, tie, source_size, target, size, taken and cuts of every row.

    taken: words the mix takes, repeats counted, at most most_repeats times size. cuts: (from, to, times) over the document's
    words, in order, for the words that are taken. tie: a hash of the text, which tells rows of one id apart. Null and empty
    texts have size 0 and are not taken; null sources are one source, the last. Rows with the same id and text share an order
    place and stand beside one another. Other columns are not read; an empty table gives no rows.
    """
    found = session.written(sizes(docs, id_col, text_col, source_col), "sizes")
    n_shards = max(1, -(-found.count() // SHARD_DOCS))
    found = found.withColumn("shard", F.expr(f"pmod(xxhash64(_id, _tie, {seed}), {n_shards}L)")).withColumn("_s", F.coalesce("_source", F.lit(""))).withColumn("_none", F.col("_source").isNull())
    planned = session.written(plan(found.groupBy("_source", "shard").agg(F.sum("_size").alias("words")), most_repeats, seed), "plan")
    order = Window.partitionBy("_s", "_none", "shard").orderBy(F.xxhash64(F.lit(seed), "_id", "_tie"), "_id", "_tie")
    placed = found.withColumn("before", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))
    rows = placed.join(planned, ["_s", "_none", "shard"]).select("_id", "_tie", "_source", "shard", "_size", "before", "words", "source_words", "target", "block", "quota")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for b in batches:
            taken, cuts = [], []
            for source, shard, size, before, words, block, quota in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5, 6, 9, 10)), strict=True):
                key = (source, shard)
                if key not in held:
                    if len(held) >= 64:
                        held.clear()
                    held[key] = times(words, block, quota, seed, shard)
                t, c = take(held[key], words, before, size)
                taken.append(t)
                cuts.append(c)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(4), b.column(7), b.column(8), pa.array(taken, pa.int64()), pa.array(cuts, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64()), ("times", pa.int64())])))],
                [id_col, "tie", "size", "source_size", "target", "taken", "cuts"],
            )

    kind = found.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"{id_col} {kind}, tie long, size long, source_size long, target double, taken long, cuts array<struct<from:long,to:long,times:long>>")


def drawn(n: int, seed: int, shard: int) -> np.ndarray:
    """The n blocks of a shard in the order in which they are chosen."""
    return np.argsort(T.mix(np.arange(n, dtype=np.uint64) + np.uint64((seed * 1_000_003 + shard) % (1 << 63))), kind="stable")


def spread(words: Sequence[int], shards: Sequence[int], block: int, due: int, seed: int) -> list[int]:
    """Blocks that each shard of a source takes, repeats counted, so that their words add up to due (to half a block)."""
    total, seen, given, out = sum(words), 0, 0, []
    passes, rest = divmod(due, total) if total else (0, 0)
    for w, shard in zip(words, shards, strict=True):
        n, seen = -(-w // block), seen + w
        extra = min(n, max(0, int((rest * seen / total - given) * n / w + 0.5))) if rest and n else 0
        if extra:
            cut = np.arange(n + 1) * w // n
            given += int(np.diff(cut)[drawn(n, seed, shard)[:extra]].sum())
        out.append(passes * n + extra)
    return out


def times(words: int, block: int, quota: int, seed: int, shard: int) -> np.ndarray:
    """How often each block of a shard is taken."""
    n = -(-words // block)
    if not n:
        return np.zeros(0, np.int64)
    out = np.full(n, quota // n, np.int64)
    if quota % n:
        out[drawn(n, seed, shard)[: quota % n]] += 1
    return out


def take(often: np.ndarray, words: int, before: int, size: int) -> tuple[int, list[dict[str, int]]]:
    """Words taken of a document that begins at `before` of a shard's words, and its runs of words with how often they are taken."""
    if not size:
        return 0, []
    n = len(often)
    a, z = ((before + 1) * n - 1) // words, ((before + size) * n - 1) // words  # block i begins at i * words // n
    counts = often[a : z + 1]
    edges = np.clip(np.arange(a, z + 2) * words // n - before, 0, size)
    runs = np.flatnonzero(np.concatenate([[True], counts[1:] != counts[:-1]]))
    ends = np.append(runs[1:], len(counts))
    return int((np.diff(edges) * counts).sum()), [{"from": int(edges[i]), "to": int(edges[j]), "times": int(counts[i])} for i, j in zip(runs, ends, strict=True) if counts[i]]


def render(docs: DataFrame, mixed: DataFrame, columns: Sequence[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixed corpus: for each pass over a document a row with the words that this pass takes, n_chars set anew if present.

    Runs of taken words keep the white space between them; separate runs are joined by a line break.
    """
    names = [c for c in columns if c != text_col]
    left = docs.select(F.struct(*names).alias("_rest"), F.col(id_col).alias("_lid"), F.xxhash64(text_col).alias("_tie"), T.as_bytes(F.col(text_col)).alias("_text"))
    # rows with the same id and text are numbered by what else they hold, so that each meets cuts of its own, also on a retry
    number = lambda df, i, t, n, by: df.withColumn(n, F.row_number().over(Window.partitionBy(i, t).orderBy(F.to_json(F.struct(*by)))))
    right = mixed.where("taken > 0").select(F.col(id_col).alias("_mid"), F.col("tie").alias("_mtie"), F.col("cuts").alias("_cuts"))
    repeated = mixed.groupBy(id_col, "tie").count().where("count > 1").limit(1).count()
    if repeated:
        left, right = number(left, "_lid", "_tie", "_no", ["_rest"]), number(right, "_mid", "_mtie", "_mno", ["_cuts"])
    on = F.col("_lid").eqNullSafe(F.col("_mid")) & (F.col("_tie") == F.col("_mtie"))
    both = left.join(right, on & (F.col("_no") == F.col("_mno")) if repeated else on).select("_rest", "_text", "_cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets = T.flat(b.column(1))[1]
            for lo, hi in T.slices(offsets, 1 << 21):
                at, out = [], []
                for i, (raw, cuts) in enumerate(zip(b.column(1).slice(lo, hi - lo).to_pylist(), b.column(2).slice(lo, hi - lo).to_pylist(), strict=True)):
                    data = np.frombuffer(raw, np.uint8)
                    w = T.words(data, np.array([0, len(data)]))
                    for p in range(1, max((c["times"] for c in cuts), default=0) + 1):
                        spans: list[list[int]] = []
                        for c in cuts:
                            if c["times"] >= p:
                                if spans and spans[-1][1] == c["from"]:
                                    spans[-1][1] = c["to"]
                                else:
                                    spans.append([c["from"], c["to"]])
                        whole = spans == [[0, len(w.start)]]
                        at.append(lo + i)
                        out.append(raw if whole else b"\n".join(raw[w.start[x] : w.end[y - 1]] for x, y in spans))
                if at:
                    yield pa.RecordBatch.from_arrays([T.loosen(b.column(0).take(pa.array(at))), pa.array(out, pa.binary())], ["_rest", "_text"])

    done = both.mapInArrow(run, f"_rest {both.schema['_rest'].dataType.simpleString()}, _text binary")
    text = F.col("_text").cast("string")
    named = {c: F.col(f"_rest.`{c}`") for c in names} | {text_col: text}
    if "n_chars" in named:
        named["n_chars"] = F.length(text).cast("long")
    return done.select(*(named[c].alias(c) for c in columns))
