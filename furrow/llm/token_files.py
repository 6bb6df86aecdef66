"""Token-id files: shards of one id array each, with Elias-Fano coded document boundaries.

A shard's body is

    magic "FTS1" | id width (1: u16, 2: u32) | low bits l | u32 documents n | u64 ids u
    | lows: n+1 values of l bits | highs: unary coded | select samples: u32 bit place of every 256th one | ids

all little-endian. Boundary i is where document i begins; boundary n is u. Its high part is found by select on the unary
bits (a sample, then a scan of at most a few bytes), its low part by its place, so no table of 64-bit offsets is kept: about
2 + log2(u/n) bits a document. Shards are rows (part, seq, doc_ids, n_docs, n_tokens, body) of a Parquet table, which any
store that Spark writes can hold; (part, seq) orders them by ascending document id.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furrow.llm import text as T

HEAD = struct.Struct("<4sBBxxIQ")
SAMPLE = 256  #: ones between select samples
SHARD_IDS = 1 << 21  #: ids after which a shard is closed
SHARD = "part int, seq int, doc_ids array<bigint>, n_docs long, n_tokens long, body binary"
HELD = 1_000_000  #: words whose ids a worker remembers
HELD_BYTES = 1 << 24  #: their bytes and ids at most, before the newest
JOINED = 64  #: words that are encoded as one text
_ones = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class EliasFano:
    """A non-decreasing sequence in near-minimal space; select(i) is its i-th value."""

    def __init__(self, n: int, l: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray) -> None:  # noqa: E741
        self.n, self.l, self.lows, self.highs, self.samples = n, l, lows, highs, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, top = len(values), int(values[-1]) if len(values) else 0
        l = max(0, (top // max(n, 1)).bit_length() - 1)  # noqa: E741
        bits = (values[:, None] >> np.arange(l)) & 1
        places = (values >> l) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        unary[places] = 1
        return cls(n, l, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"), np.packbits(unary, bitorder="little"), places[::SAMPLE].astype("<u4"))

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for b in range(self.l):
            at = i * self.l + b
            out |= ((self.lows[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << b
        return out

    def select(self, i: int) -> int:
        place = int(self.samples[i // SAMPLE])
        todo, byte = i % SAMPLE, place >> 3
        rest = int(self.highs[byte]) & (0xFF << (place & 7))
        while todo >= (ones := bin(rest).count("1")):
            todo, byte = todo - ones, byte + 1
            rest = int(self.highs[byte])
        for _ in range(todo):
            rest &= rest - 1
        return ((byte * 8 + (rest & -rest).bit_length() - 1 - i) << self.l) | int(self._low(np.array([i]))[0])

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        return ((places - np.arange(self.n)) << self.l) | self._low(np.arange(self.n))


def pack(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """A shard's body."""
    ef = EliasFano.of(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]))
    wide = 2 if len(ids) and ids.max() > 0xFFFF else 1
    return b"".join([HEAD.pack(b"FTS1", wide, ef.l, len(lengths), len(ids)), ef.lows.tobytes(), struct.pack("<I", len(ef.highs)), ef.highs.tobytes(), ef.samples.tobytes(), ids.astype("<u2" if wide == 1 else "<u4").tobytes()])


def unpack(body: bytes) -> tuple[EliasFano, np.ndarray]:
    magic, wide, l, n, total = HEAD.unpack_from(body)  # noqa: E741
    if magic != b"FTS1":
        raise ValueError("not a token shard")
    at = HEAD.size
    size = ((n + 1) * l + 7) // 8
    lows = np.frombuffer(body, np.uint8, size, at)
    (highs_size,) = struct.unpack_from("<I", body, at + size)
    at += size + 4
    highs = np.frombuffer(body, np.uint8, highs_size, at)
    at += highs_size
    samples = np.frombuffer(body, "<u4", n // SAMPLE + 1, at)
    return EliasFano(n + 1, l, lows, highs, samples), np.frombuffer(body, "<u2" if wide == 1 else "<u4", total, at + 4 * len(samples))


def _byte_letters() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on. In UTF-8, two bytes each from 128 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    places = {b: 256 + i for i, b in enumerate(rest)}
    return np.array([list(chr(places.get(b, b)).encode()) for b in range(128, 256)], np.uint8)


def _spelled(raw: bytes) -> str:
    """Text whose ASCII bytes are letters and spaces, in the letters of a byte-level vocabulary."""
    b = np.frombuffer(raw, np.uint8)
    wide = b >= 128
    out = np.repeat(b, 1 + wide)
    at = np.flatnonzero(wide)
    pair = _spelling[b[at] - 128]
    at += np.arange(len(at))
    out[at], out[at + 1] = pair[:, 0], pair[:, 1]
    return out.tobytes().decode()


class WordIds:
    """Ids of texts by a tokenizer that drops white space, so that words are encoded apart and remembered.

    A word's final marks are a word of their own where the splitter cuts there too. New words of Latin letters only, nearly all of
    them, skip the tokenizer's normaliser and splitter, which leave them whole: they are lower-cased, joined, encoded by its BPE
    model alone, and cut where an id ends a word. The others go the long way.

    Words known are numbered and found by their hashes, and their bytes are compared; all lie in arrays, without objects of their own.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        bare = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": " "}, "added_tokens": []}
        self.letters = Tokenizer.from_str(json.dumps(bare))
        vocabulary = self.letters.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.type = np.dtype("<u2" if max(self.tokenizer.get_vocab().values()) <= 0xFFFF else "<u4")
        self._forget()

    def _forget(self) -> None:
        self.hash, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)  #: hashes in order, and whose they are
        self.text, self.place = np.zeros(0, np.uint8), np.zeros(1, np.int64)  #: word k is text[place[k] : place[k + 1]]
        self.ids, self.begin = np.zeros(0, self.type), np.zeros(1, np.int64)  #: its ids are ids[begin[k] : begin[k + 1]]

    def _find(self, low: np.ndarray, start: np.ndarray, size: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 where not known."""
        out = np.full(len(start), -1, np.int64)
        if not len(self.hash):
            return out
        order = np.argsort(hashes)
        at = np.empty(len(order), np.int64)
        at[order] = np.searchsorted(self.hash, hashes[order])
        at[at == len(self.hash)] = 0
        like = np.flatnonzero(self.hash[at] == hashes)
        number = self.number[at[like]]
        fine = T.equal_bytes(low, start[like], size[like], self.text, self.place[number], self.place[number + 1] - self.place[number])
        out[like[fine]] = number[fine]
        return out

    def _learn(self, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Numbers of new words. Of words with one hash the first one known is found again; the others are learned each time."""
        kinds = np.array([0 if w.isalpha() else 2 if w.translate(None, _letters) else 1 for w in words])
        order = np.argsort(kinds, kind="stable")
        a, b = np.cumsum(np.bincount(kinds, minlength=3))[:2].tolist()
        words = [words[i] for i in order.tolist()]
        joined = [b" ".join(words[i : min(i + JOINED, a)]).decode() for i in range(0, a, JOINED)]
        joined += [_spelled(b" ".join(words[i : min(i + JOINED, b)]).decode().lower().encode()) for i in range(a, b, JOINED)]
        ids, stops, last = [self.ids], [self.begin], len(self.ids)
        for i in range(0, len(joined), JOINED):
            x = np.concatenate([np.array(e.ids, self.type) for e in self.letters.encode_batch_fast(joined[i : i + JOINED], add_special_tokens=False)])
            ids.append(x)
            stops.append(np.flatnonzero(self.ends[x]) + (last + 1))
            last += len(x)
        for i in range(b, len(words), 4096):
            each = [np.array(e.ids, self.type) for e in self.tokenizer.encode_batch_fast([w.decode() for w in words[i : i + 4096]], add_special_tokens=False)]
            ids += each
            stops.append(np.cumsum([len(x) for x in each]) + last)
            last = int(stops[-1][-1])
        known = len(self.place) - 1
        self.ids, self.begin = np.concatenate(ids), np.concatenate(stops)
        if len(self.begin) != known + len(words) + 1:
            raise ValueError("the vocabulary has words without an end")
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(words), np.uint8)])
        self.place = np.concatenate([self.place, np.cumsum([len(w) for w in words]) + self.place[-1]])
        out = np.empty(len(order), np.int64)
        out[order] = np.arange(known, known + len(order))
        fresh, first = np.unique(hashes, return_index=True)
        at = np.searchsorted(self.hash, fresh)
        if len(self.hash):
            unlike = self.hash[np.minimum(at, len(self.hash) - 1)] != fresh
            fresh, first, at = fresh[unlike], first[unlike], at[unlike]
        self.hash, self.number = np.insert(self.hash, at, fresh), np.insert(self.number, at, out[first])
        return out

    def _numbers(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        hashes = T.word_hashes(low, T.Words(start, end, np.zeros(0, np.int64)))
        number = self._find(low, start, end - start, hashes)
        new = np.flatnonzero(number < 0)
        if len(self.place) + len(new) > HELD or len(self.ids) + len(self.text) > HELD_BYTES:
            self._forget()
            new = np.arange(len(start))
        if len(new):
            raw = low.tobytes()
            number[new] = self._learn([raw[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)], hashes[new])
        return number

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that lie one after another, and how many each has.

        The tokenizer folds case, so folding ASCII first only makes more words alike. Within a slice of texts equal words are
        looked up once; their bytes are compared.
        """
        low = _fold[data]
        w = _without_marks(low, T.words(low, offsets))
        inverse, first = T.word_ids(low, w)
        number = self._numbers(low, w.start[first], w.end[first])
        begin = self.begin[number]
        each = (self.begin[number + 1] - begin)[inverse]
        total = np.concatenate([[0], np.cumsum(each)])
        at = np.repeat(begin[inverse] - total[:-1], each)
        at += np.arange(total[-1])
        return self.ids[at], np.diff(total[w.first])


def _without_marks(low: np.ndarray, w: T.Words) -> T.Words:
    """Words with a final run of marks after a letter as a word of its own; the splitter always cuts there. Runs over 16 marks are left."""
    at = w.end.copy()
    live = marked = np.flatnonzero(_is_mark[low[w.end - 1]])
    for _ in range(16):
        at[live] -= 1
        live = live[at[live] > w.start[live]]
        live = live[_is_mark[low[at[live] - 1]]]
    at[live] = w.start[live]
    cut = marked[at[marked] > w.start[marked]]
    place = at[cut]
    last = low[place - 1]
    letter = (last >= 97) & (last <= 122) | (low[np.maximum(place - 2, 0)] == 0xC3) & _is_second[last]
    cut, place = cut[letter], place[letter]
    return T.Words(np.insert(w.start, cut + 1, place), np.insert(w.end, cut, place), w.first + np.searchsorted(cut, w.first))


_spelling = _byte_letters()
_is_mark = np.isin(np.arange(256), list(b".,;:!?#*$%&|<>()"))
_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
#: Second bytes of the letters U+00C0 to U+00FF (0x97 and 0xB7 end signs); their first byte is 0xC3.
_seconds = [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]
_is_second = np.isin(np.arange(256), _seconds)
#: Bytes of words that hold only a-z and those letters.
_letters = bytes([*range(97, 123), 0xC3, *_seconds])
_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def write(docs: DataFrame, to: str, vocabulary: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Encode every row and write shards in ascending id order, null ids first.

    Null and empty texts hold the end id only, very long ones are encoded whole; rows with the same id follow one another in the order of a hash of their
    text; an empty table gives a table without shards; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_tie"), T.as_bytes(F.col(text_col)).alias("_text"))
    ordered = rows.repartitionByRange("_id", "_tie").sortWithinPartitions("_id", "_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq = word_ids(vocabulary), TaskContext.get().partitionId(), 0
        names: list[pa.Array] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            ids, lengths = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            doc_ids = pa.ListArray.from_arrays([0, len(lengths)], pa.concat_arrays(names))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), doc_ids, pa.array([len(lengths)], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([pack(ids, lengths)], pa.binary())], ["part", "seq", "doc_ids", "n_docs", "n_tokens", "body"])

        for b in batches:
            data, offsets = T.flat(b.column(2))
            for a, z in T.slices(offsets, 1 << 21):
                names.append(b.column(0).slice(a, z - a))
                ids, count = encode(data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a])
                ids = ids.astype(np.promote_types(ids.dtype, np.min_scalar_type(end_id)), copy=False)
                held.append((np.insert(ids, np.cumsum(count), end_id), count + 1))
                if sum(len(x) for x, _ in held) >= shard_ids:
                    yield close()
                    names, held, seq = [], [], seq + 1
        if held:
            yield close()

    ordered.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(to)


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id, start (ids of all documents before it), n_tokens, ids_crc32 of every document in the files."""
    shards = spark.read.schema(SHARD).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ef, ids = unpack(b.column(3)[i].as_py())
                at = ef.all()
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[i].as_py()] * n, pa.int32()), pa.array([b.column(1)[i].as_py()] * n, pa.int32()), b.column(2)[i].values, pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())], ["part", "seq", "_id", "place", "n_tokens", "ids_crc32"])

    rows = shards.select("part", "seq", "doc_ids", "body").mapInArrow(run, "part int, seq int, _id long, place long, n_tokens long, ids_crc32 long")
    # One row a shard, in two steps: within a part, then over the parts.
    sizes = shards.select("part", "seq", "n_tokens")
    inner = sizes.withColumn("inner", F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens"))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("outer", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    base = inner.join(parts, "part").select("part", "seq", (F.col("inner") + F.col("outer")).alias("base"))
    return rows.join(base, ["part", "seq"]).select(F.col("_id").alias(id_col), (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def open_document(body: bytes, i: int) -> np.ndarray:
    """Ids of document i of a shard, found by select alone."""
    ef, ids = unpack(body)
    return ids[ef.select(i) : ef.select(i + 1)]
