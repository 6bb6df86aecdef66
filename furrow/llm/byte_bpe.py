"""Byte-level BPE by overlapping chunks, and decoding by joining raw bytes.

A long text is cut into chunks that overlap; each chunk is pre-tokenised and encoded on its own, wherever it lies in the
cluster, and the chunks' ids are stitched where the pre-token boundaries of neighbours resynchronise. A text no longer
than one chunk needs no stitching and no shuffle.

Boundaries: the pattern never looks back, so two scans that share one boundary agree from there on. A scan of a cut text is
only sure of boundaries that lie 4 or more characters before the cut. A chunk ends just behind an anchor, a place that is a
boundary of every scan: after a letter (of a script whose letters all engines know) and before white space, a digit or a mark
that no token puts behind a letter. The next chunk begins at most OVERLAP characters before that anchor, so chunks add up to
little more than the text in any script. Between two anchors lies hardly more than one pre-token, which cannot be cut anyway.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm import text as T

CHUNK = 1 << 15  #: characters of a chunk
SURE = 4  #: characters before a cut from which a boundary is sure
HELD = 150_000  #: pieces whose ids a worker remembers
OVERLAP = 64  #: characters of a chunk that the next one scans again
#: Letters of the anchors, by script: Latin, Greek, Cyrillic, Hebrew, Arabic, Devanagari, Thai, kana, Han, Hangul.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u0391-\u03a1\u03a3-\u03ff\u0400-\u0481\u048a-\u04ff\u05d0-\u05ea\u0620-\u064a\u0904-\u0939\u0e01-\u0e30\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_loaded: dict[tuple[str, str], "Codec"] = {}
_anchor = re.compile(f"[{LETTERS}](?=[ \t\n\r0-9.,;:!?()\u3001\u3002\uff01\uff08\uff09\uff0c\uff1a\uff1b\uff1f\u0964\u060c\u061f])")


class Pieces(dict):
    """Ids of a piece as little-endian unsigned 32-bit integers, worked out on first sight."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encode(piece.encode()), "<u4").tobytes()
        if len(self) >= HELD:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Codec:
    """Ranks and pattern of one vocabulary."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = pattern
        self.encoding = tiktoken.Encoding("furrow", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.pieces = Pieces(self.encoding._core_bpe.encode_single_piece)
        self.usual, self._exact = regex.compile(pattern).findall, None
        self.tokens = np.empty(max(self.ranks.values(), default=0) + 1, object)
        for token, i in self.ranks.items():
            self.tokens[i] = token

    def exact(self):
        """The pattern with the letters and numbers that the encoder's own regex engine knows, spelt out.

        Two engines may follow different versions of Unicode. The encoder drops what its pattern does not match, so encoding
        every code point by the pattern `\\p{L}` tells its letters.
        """
        if self._exact is None:
            import regex
            import tiktoken

            every, spelt = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000), self.pattern
            for name in (r"\p{L}", r"\p{N}"):
                e = tiktoken.Encoding("furrow-class", pat_str=name, mergeable_ranks=self.ranks, special_tokens={})
                points = np.array([ord(c) for c in e.decode_bytes(e.encode_ordinary(every)).decode()])
                cuts = np.flatnonzero(np.diff(points) != 1)
                ranges = "".join(f"\\U{points[a]:08x}-\\U{points[b]:08x}" for a, b in zip([0, *(cuts + 1)], [*cuts, len(points) - 1], strict=True))
                spelt = re.sub(r"\[[^\]]*\]|" + re.escape(name), lambda m, name=name, ranges=ranges: m[0].replace(name, ranges) if m[0][0] == "[" else f"[{ranges}]", spelt)
            self._exact = regex.compile(spelt).findall
        return self._exact

    def split(self, text: str, plain: bool) -> list[str]:
        """Pre-tokens. plain: the text has only characters below U+0500, on which all engines agree."""
        return (self.usual if plain else self.exact())(text)

    def encode(self, raw: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(raw.decode(), is_plain(raw))))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


def is_plain(raw: bytes) -> bool:
    return not raw or raw.isascii() or int(np.frombuffer(raw, np.uint8).max()) < 0xD4


def codec(path: str, pattern: str) -> Codec:
    """One codec for each vocabulary in a worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Codec(path, pattern)
    return _loaded[path, pattern]


def chunks(text: str, size: int) -> list[tuple[int, int]]:
    """Overlapping ranges; all but the last hold an anchor, and the next range begins shortly before it."""
    out, a, back = [], 0, min(OVERLAP, size // 2)
    while True:
        m = _anchor.search(text, a + size) if a + size < len(text) else None
        b = m.end() + SURE + 1 if m else len(text)
        if b >= len(text):
            return [*out, (a, len(text))]
        out.append((a, b))
        a = m.end() - back


def _boundaries(pieces: list[str], start: int) -> np.ndarray:
    return start + np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))])


def encode_chunk(c: Codec, text: str, start: int, after: int, head_to: int, plain: bool) -> tuple[int, bytes, np.ndarray, np.ndarray]:
    """Ids of the chunk that begins at `start`, up to where its scan meets the next chunk's.

    after: where the next chunk begins, or -1. Returns the meeting place (-1: none follows), the ids, and for the
    boundaries up to head_to their places and how many ids lie before each.
    """
    pieces = c.split(text, plain)
    at = _boundaries(pieces, start)
    meet = -1
    if after >= 0:
        end = start + len(text)
        other = _boundaries(c.split(text[after - start :], plain), after)
        both = np.intersect1d(at[at <= end - SURE], other[other <= end - SURE])
        meet = int(both[0])
        pieces = pieces[: int(np.searchsorted(at, meet))]
    ids = list(map(c.pieces.__getitem__, pieces))
    before = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int64)
    head = np.flatnonzero(at[: len(before)] <= head_to)
    return meet, b"".join(ids), at[head], before[head]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, keep: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """id, the columns in keep, n_tokens (long), ids (binary, little-endian unsigned 32-bit) of every row.

    decoded: also what the ids decode to (binary), in the same pass over the text.

    Null and empty texts give no ids; repeated ids and rows each give their row; columns neither named nor kept are not read,
    so clashing names do no harm; an empty table gives no rows. path: a vocabulary file that every executor has.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.struct(F.lit(0).alias("_"), *keep).alias("_rest"), T.as_bytes(F.col(text_col)).alias("_text"))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("_id", "_rest")}
    schema = f"_id {kinds['_id']}, _rest {kinds['_rest']}, ids binary" + ", decoded binary" * decoded

    def finished(c: Codec, ids: list[bytes]) -> dict[str, pa.Array]:
        return {"ids": pa.array(ids, pa.binary())} | ({"decoded": pa.array([c.decode(x) for x in ids], pa.binary())} if decoded else {})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            for a, z in T.slices(T.flat(b.column(2))[1], 1 << 21):
                part = b.slice(a, z - a)
                done = finished(c, [c.encode(x) for x in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *done.values()], ["_id", "_rest", *done])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, raw in enumerate(b.column(2).to_pylist()):
                text, plain, head_to = raw.decode(), is_plain(raw), -1
                spans = chunks(text, chunk)
                for k, (a, z) in enumerate(spans):
                    after = spans[k + 1][0] if k + 1 < len(spans) else -1
                    row = [b.column(0).slice(i, 1), b.column(1).slice(i, 1), b.column(3).slice(i, 1)]
                    yield pa.RecordBatch.from_arrays([*row, *(pa.array([x]) for x in (k, a, after, head_to, plain)), pa.array([text[a:z].encode()], pa.binary())], ["_id", "_rest", "_h", "k", "a", "after", "head_to", "plain", "piece"])
                    head_to = z

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            for i, (a, after, head_to, plain, raw) in enumerate(zip(*(b.column(j).to_pylist() for j in range(4, 9)), strict=True)):
                meet, ids, at, before = encode_chunk(c, raw.decode(), a, after, head_to, plain)
                yield pa.RecordBatch.from_arrays([*(b.column(j).slice(i, 1) for j in range(4)), pa.array([meet]), *(pa.array([x], pa.binary()) for x in (ids, at.tobytes(), before.tobytes()))], ["_id", "_rest", "_h", "k", "meet", "ids", "at", "before"])

    def stitch(t: pa.Table) -> pa.Table:
        """Chunks of one text (rows with the same id, text and rest give each chunk as often) -> a row for each copy."""
        t = t.sort_by("k")
        k = t["k"].to_numpy()
        copies, firsts = int((k == 0).sum()), np.unique(k, return_index=True)[1]
        out, meet = [], -1
        for i in firsts:
            ids, skip = t["ids"][i].as_py(), 0
            if meet >= 0:
                at = np.frombuffer(t["at"][i].as_py(), np.int64)
                skip = int(np.frombuffer(t["before"][i].as_py(), np.int64)[np.searchsorted(at, meet)])
            out.append(ids[4 * skip :])
            meet = t["meet"][i].as_py()
        first = t.slice(0, 1).combine_chunks()
        return pa.table({"_id": pa.concat_arrays([first["_id"].combine_chunks()] * copies), "_rest": pa.concat_arrays([T.loosen(first["_rest"])] * copies), **finished(codec(path, pattern), [b"".join(out)] * copies)})

    is_long = F.octet_length("_text") > chunk
    short = rows.where(~is_long).mapInArrow(whole, schema)
    parts = rows.where(is_long).withColumn("_h", F.xxhash64("_text", F.to_json("_rest")))
    parts = parts.mapInArrow(cut, f"_id {kinds['_id']}, _rest {kinds['_rest']}, _h long, k long, a long, after long, head_to long, plain boolean, piece binary")
    parts = parts.repartition("_id", "_h", "k").mapInArrow(one, f"_id {kinds['_id']}, _rest {kinds['_rest']}, _h long, k long, meet long, ids binary, at binary, before binary")
    out = short.unionByName(parts.groupBy("_id", "_h").applyInArrow(stitch, schema))
    return out.select(F.col("_id").alias(id_col), *(F.col(f"_rest.`{c}`").alias(c) for c in keep), F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"), "ids", *(["decoded"] if decoded else []))


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns of encoded, and the raw bytes of the ids joined."""
    names = encoded.columns
    if to in names:
        raise ValueError(f"{to} is a column already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, at = codec(path, pattern), names.index(ids_col)
        for b in batches:
            for i, j in T.slices(T.flat(b.column(at))[1], 1 << 23):
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([c.decode(x) for x in part.column(at).to_pylist()], pa.binary())], [*names, to])

    return encoded.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema), f"`{to}` binary"]))
