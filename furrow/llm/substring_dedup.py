"""Substring dedup by level-wise doubling.

A window is `min_words` consecutive words of one document; words covered by a window whose words also start earlier (smaller
id, or same document, earlier start) are removed. Windows are judged on the input.

Levels: each window names one inner run of `base_words` words, the one of least hash (equal windows name equal runs, and
neighbours mostly share theirs, so about one word in eight is named). Runs that occur once end their windows there. What
repeats is extended to twice the length, around the same place in the window, until the length is `min_words`; there the first
occurrence of each window is found. Windows that no longer repeat at some length are no candidates at the next.

Shorter lengths only sift, by 64-bit hashes. At min_words two windows are taken for equal if two independent 64-bit hashes of their
words' bytes agree (among 2e13 windows, some 100 TB, the chance that any two differ then is below 1e-11).

Layout: documents are dealt by a hash of id and text into blocks of a few MB. A block sends each bucket (a range of hashes) one
binary with its distinct hashes, and gets back one bit for each: so one passage in a third of all documents costs a bucket
one entry a block, and no row is made for a pair. Every level is a grouped pass over the same exchange of blocks, which Spark
reuses, and there is no action in between: lost executors only cost the stages they held.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm import text as T

BLOCK_BYTES = 4 << 20
BUCKET_WORDS = 2_000_000  #: words of the input for each bucket
MESSAGE = "bucket long, block long, hashes binary, checks binary, ids binary, id_counts binary"
CHECK_BASE = 0xA0761D6478BD642F  #: of the second hash of a window
VERDICT = "level int, bucket long, block long, bits binary"


def ladder(min_words: int, base_words: int) -> list[int]:
    """Lengths by doubling, the last one min_words."""
    out = [min(base_words, min_words)]
    while out[-1] < min_words:
        out.append(min(2 * out[-1], min_words))
    return out


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` entries the place of its least one, the leftmost of equals."""
    at, span = np.arange(len(h)), 1
    while span < width:
        step = min(span, width - span)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(h[b] < h[a], b, a)
        span += step
    return at


class Block:
    """The windows of one block's documents, which every pass works out anew from the same rows."""

    def __init__(self, t: pa.Table, lengths: list[int], buckets: int) -> None:
        T.thrifty()
        texts = t["_text"].combine_chunks()
        missing = t["_id"].combine_chunks().is_null().to_numpy(zero_copy_only=False)
        ids = t["_id"].combine_chunks().fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        tie = t["_tie"].combine_chunks().to_numpy(zero_copy_only=False)
        order = np.lexsort((tie, ids, ~missing))
        self.rows = t.take(pa.array(order))
        self.keys = np.stack([ids[order], tie[order]], 1)
        self.lengths, self.buckets = lengths, np.uint64(buckets)
        self.data, self.offsets = T.flat(texts.take(pa.array(order)))
        starts, ends, hashes, counts, self.pieces = [], [], [], [], []
        for a, b in T.slices(self.offsets):
            lo = self.offsets[a]
            piece = self.data[lo : self.offsets[b]]
            w = T.words(piece, self.offsets[a : b + 1] - lo)
            self.pieces.append((lo, w))
            starts.append(w.start + lo)
            ends.append(w.end + lo)
            hashes.append(T.word_hashes(piece, w))
            counts.append(np.diff(w.first))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.start, self.end, self.hash = join(starts, np.int64), join(ends, np.int64), join(hashes, np.uint64)
        self.count = join(counts, np.int64)
        self.owner = np.repeat(np.arange(len(self.count)), self.count)
        size, base = lengths[-1], lengths[0]
        self.size = size
        n = len(self.hash) - size + 1
        self.alive = np.flatnonzero(self.owner[:n] == self.owner[size - 1 :]) if n > 0 else np.zeros(0, np.int64)
        self.offset = least_places(T.window_hashes(self.hash, base), size - base + 1)[self.alive] - self.alive if n > 0 else self.alive

    def level(self, k: int) -> tuple[np.ndarray, ...]:
        """Distinct hashes at length k, their second hashes (last level only), each one's bucket, first place and count, and each live window's entry."""
        length = self.lengths[k]
        place = self.alive + np.minimum(self.offset, self.size - length)
        places, window_of = np.unique(place, return_inverse=True)
        found = T.window_hashes(self.hash, length)[places] if len(places) else np.zeros(0, np.uint64)
        check = self.checks(places) if k == len(self.lengths) - 1 else found[:0]
        entry, _ = pd.factorize(found)  # in the order of first places
        if len(check):
            entry, _ = pd.factorize(entry * np.int64(len(entry)) + pd.factorize(check)[0])
        many = np.bincount(entry)
        first = np.empty(len(many), np.int64)
        first[entry[::-1]] = np.arange(len(entry) - 1, -1, -1)
        hashes, check, first = found[first], check[first] if len(check) else check, places[first]
        bucket = (((hashes >> np.uint64(32)) * self.buckets) >> np.uint64(32)).astype(np.int64)
        return hashes, check, bucket, first, many, entry[window_of]

    def checks(self, places: np.ndarray) -> np.ndarray:
        """The second hash of the windows at these places; only their words are hashed again."""
        needed, out, at = T.covered(places, self.size, len(self.hash)), [], 0
        for lo, w in self.pieces:
            only = np.flatnonzero(needed[at : at + len(w.start)])
            out.append(T.word_hashes(self.data[lo : lo + int(w.end[-1])], w, 1, only) if len(only) else np.zeros(len(w.start), np.uint64))
            at += len(w.start)
        return T.window_hashes(np.concatenate(out), self.size, CHECK_BASE)[places] if len(places) else np.zeros(0, np.uint64)

    def messages(self, k: int, block: int) -> pa.Table:
        hashes, checks, bucket, first, _, _ = self.level(k)
        last = k == len(self.lengths) - 1
        order = np.argsort(bucket, kind="stable")
        hashes, first, bucket = hashes[order], first[order], bucket[order]
        checks = checks[order] if last else checks
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, int)
        out: dict[str, list] = {"bucket": [], "block": [], "hashes": [], "checks": [], "ids": [], "id_counts": []}
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            owner = self.owner[first[a:b]] if last else np.zeros(0, np.int64)
            turns = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if last else owner
            many = np.diff(np.concatenate([turns, [len(owner)]])).astype(np.int32).tobytes() if last else b""
            for name, x in (("bucket", int(bucket[a])), ("block", block), ("hashes", hashes[a:b].tobytes()), ("checks", checks[a:b].tobytes()), ("ids", self.keys[owner[turns]].tobytes()), ("id_counts", many)):
                out[name].append(x)
        return pa.table({"bucket": pa.array(out["bucket"], pa.int64()), "block": pa.array(out["block"], pa.int64()), **{c: pa.array(out[c], pa.binary()) for c in ("hashes", "checks", "ids", "id_counts")}})

    def apply(self, k: int, verdict: dict[int, bytes]) -> np.ndarray | None:
        """Drop windows that don't repeat at level k; at the last, say which live windows start later than their first."""
        _, _, bucket, first, many, entry = self.level(k)
        bits = np.zeros(len(bucket), bool)
        for b in np.unique(bucket):
            at = np.flatnonzero(bucket == b)
            bits[at] = np.unpackbits(np.frombuffer(verdict[int(b)], np.uint8), count=len(at), bitorder="little").astype(bool)
        if k == len(self.lengths) - 1:
            return ~(bits[entry] & (first[entry] == self.alive))
        keep = (bits | (many > 1))[entry]
        self.alive, self.offset = self.alive[keep], self.offset[keep]
        return None


def _verdicts(t: pa.Table) -> dict[int, dict[int, bytes]]:
    out: dict[int, dict[int, bytes]] = {}
    for level, bucket, bits in zip(t["level"].to_pylist(), t["bucket"].to_pylist(), t["bits"].to_pylist(), strict=True):
        out.setdefault(level, {})[bucket] = bits
    return out


def _judge(t: pa.Table, level: int, last: bool) -> pa.Table:
    """One bucket: a bit for each entry of each block: it occurs in other blocks too; at the last level: it is the first."""
    T.thrifty()
    parts = [np.frombuffer(x, np.uint64) for x in t["hashes"].to_pylist()]
    h = np.concatenate(parts)
    if last:
        check = np.concatenate([np.frombuffer(x, np.uint64) for x in t["checks"].to_pylist()])
        keys = np.concatenate([np.repeat(np.frombuffer(x, np.int64).reshape(-1, 2), np.frombuffer(n, np.int32), 0) for x, n in zip(t["ids"].to_pylist(), t["id_counts"].to_pylist(), strict=True)])
        order = np.lexsort((keys[:, 1], keys[:, 0], check, h))
        new = (h[order][1:] != h[order][:-1]) | (check[order][1:] != check[order][:-1])
    else:
        order = np.argsort(h, kind="stable")
        new = h[order][1:] != h[order][:-1]
    new = np.concatenate([[True], new])
    flag = np.empty(len(h), bool)
    flag[order] = new if last else ~(new & np.concatenate([new[1:], [True]]))
    cuts = np.cumsum([0, *map(len, parts)])
    bits = [np.packbits(flag[a:b], bitorder="little").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"level": pa.array([level] * t.num_rows, pa.int32()), "bucket": t["bucket"], "block": t["block"], "bits": pa.array(bits, pa.binary())})


def _judge_at(level: int, last: bool):
    return lambda t: _judge(t, level, last)


def _extend_to(level: int, lengths: list[int], buckets: int):
    def extend(t: pa.Table, v: pa.Table) -> pa.Table:
        b, known = Block(t, lengths, buckets), _verdicts(v)
        for i in range(level):
            b.apply(i, known.get(i, {}))
        return b.messages(level, t["block"][0].as_py())

    return extend


def _spans(removed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of True: where they begin and end."""
    change = np.diff(np.concatenate([[0], removed.astype(np.int8), [0]]))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def dedup(docs: DataFrame, min_words: int = 20, base_words: int = 5, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, the columns in keep, n_words, n_removed, the text without the removed words, of every row.

    A text that loses nothing comes back as it is (null stays null); else each removed word goes with the white space after it.
    Null and empty texts have no words; documents under min_words words have no window and lose nothing. Rows with the same id are separate documents, ordered by a hash of their text, null ids before all others; rows alike in both
    are interchangeable, and one of them stands first. Columns neither named nor kept are not read, so their names cannot clash; an empty table gives no rows.
    """
    lengths = ladder(min_words, base_words)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first()["n"]
    n_blocks, buckets = max(1, -(-size // block_bytes)), max(1, -(-size // (6 * BUCKET_WORDS)))
    kind = docs.schema[id_col].dataType.simpleString()
    blocks = docs.select(
        F.expr(f"pmod(xxhash64(`{id_col}`, `{text_col}`), {n_blocks}L)").alias("block"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_tie"),
        T.as_bytes(F.col(text_col)).alias("_text"), F.struct(F.col(text_col).isNull().alias("_null"), *keep).alias("_rest"),
    )
    groups = blocks.groupBy("block")

    def begin(t: pa.Table) -> pa.Table:
        return Block(t, lengths, buckets).messages(0, t["block"][0].as_py())

    verdicts, messages = None, groups.applyInArrow(begin, MESSAGE)
    for k in range(len(lengths)):
        last = k == len(lengths) - 1
        verdict = messages.groupBy("bucket").applyInArrow(_judge_at(k, last), VERDICT)
        verdicts = verdict if verdicts is None else verdicts.unionByName(verdict)
        if not last:
            messages = groups.cogroup(verdicts.groupBy("block")).applyInArrow(_extend_to(k + 1, lengths, buckets), MESSAGE)

    rest = blocks.schema["_rest"].dataType.simpleString()

    def finish(t: pa.Table, v: pa.Table) -> pa.Table:
        b, known = Block(t, lengths, buckets), _verdicts(v)
        for i in range(len(lengths)):
            later = b.apply(i, known.get(i, {}))
        gone = T.covered(b.alive[later], min_words, len(b.hash))
        first = np.concatenate([[0], np.cumsum(b.count)])
        lost = np.concatenate([[0], np.cumsum(gone)])
        n_removed = lost[first[1:]] - lost[first[:-1]]
        raw, out = b.data.tobytes(), b.rows["_text"].to_pylist()
        for i in np.flatnonzero(n_removed):
            f, z = first[i], first[i + 1]
            at, to = _spans(gone[f:z])
            starts = np.append(b.start[f:z], b.offsets[i + 1])
            pieces = zip([b.offsets[i], *starts[to]], [*starts[at], b.offsets[i + 1]], strict=True)
            out[i] = b"".join(raw[x:y] for x, y in pieces)
        return pa.table({"_id": b.rows["_id"], "_rest": T.loosen(b.rows["_rest"]), "n_words": pa.array(b.count, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "_text": pa.array(out, pa.binary())})

    done = groups.cogroup(verdicts.groupBy("block")).applyInArrow(finish, f"_id long, _rest {rest}, n_words long, n_removed long, _text binary")
    return done.select(
        F.col("_id").cast(kind).alias(id_col), *(F.col(f"_rest.`{c}`").alias(c) for c in keep), "n_words", "n_removed",
        F.when(~F.col("_rest._null"), F.col("_text").cast("string")).alias(text_col),
    )
