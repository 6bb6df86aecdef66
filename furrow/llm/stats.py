"""Statistics of whole documents, many at a time; shared by the quality rules and the quality classifier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm import text as T

#: Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = (
    "log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "echo_share",
    "upper_share", "shout_share", "digit_share", "mark_share", "line_words",
)

IS_SYMBOL, IS_UPPER, IS_DIGIT, IS_MARK = (np.isin(np.arange(256), list(x)) for x in (SYMBOLS, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?.,;:"))
IS_LETTER = np.isin(np.arange(256) & 0xDF, np.arange(65, 91)) & (np.arange(256) < 128) | (np.arange(256) >= 0xC3)
CONTINUES = (np.arange(256) & 0xC0) == 0x80


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def _dup_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that equal an earlier line, of each text."""
    raw, n = data.tobytes(), len(offsets) - 1
    lines, again = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        found = [x for x in raw[offsets[i] : offsets[i + 1]].split(b"\n") if x and not x.isspace()]
        lines[i], again[i] = len(found), len(found) - len(set(found))
    return lines, again


def _firsts(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries (owner, key): whether each is the first of its kind, and whether its kind occurs twice or more."""
    order = np.lexsort((key, owner))
    k, o = key[order], owner[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    first, many = np.empty(len(k), bool), np.empty(len(k), bool)
    first[order] = new
    last = np.ones(len(k), bool)
    last[:-1] = new[1:]
    many[order] = ~(new & last)
    return first, many


def _slice(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    w = T.words(data, offsets)
    count = np.diff(w.first)
    owner = np.repeat(np.arange(n), count)
    ids, _ = T.word_ids(data, w)
    inside = T.IS_WORD[data]
    chars = _per_text(inside & ~CONTINUES[data], offsets)
    first_word, _ = _firsts(ids, owner)
    window = T.run_ids(ids, 5)
    starts = np.flatnonzero(owner[: len(window)] == owner[4:]) if len(window) else np.zeros(0, np.int64)
    _, many = _firsts(window[starts], owner[starts])
    repeated = T.covered(starts[many], 5, len(ids))
    echo = np.zeros(len(ids), bool)
    echo[1:] = (ids[1:] == ids[:-1]) & (owner[1:] == owner[:-1])
    lines, dup = _dup_lines(data, offsets)
    by_word = lambda flags: np.bincount(owner, flags, n) if len(owner) else np.zeros(n)
    symbols, letters = _per_text(IS_SYMBOL[data], offsets), _per_text(IS_LETTER[data], offsets)
    upper = _per_text(IS_UPPER[data], offsets)
    total, some, lots = np.maximum(chars, 1), np.maximum(count, 1), np.maximum(lines, 1)
    ends_loud = np.zeros(len(ids), bool)
    if len(ids):
        ends_loud = data[w.end - 1] == ord("!")
    return {
        "n_words": count, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": by_word(repeated).astype(np.int64),
        "log_words": np.log1p(count), "mean_word": chars / some, "symbol_share": symbols / total, "dup_line_share": dup / lots,
        "repeat_share": by_word(repeated) / some, "distinct_share": by_word(first_word) / some, "echo_share": by_word(echo) / some,
        "upper_share": upper / np.maximum(letters, 1), "shout_share": by_word(ends_loud) / some,
        "digit_share": _per_text(IS_DIGIT[data], offsets) / total, "mark_share": _per_text(IS_MARK[data], offsets) / total,
        "line_words": np.log1p(count / lots),
    }


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """All statistics of the texts of one Arrow column."""
    T.thrifty()
    data, offsets = T.flat(column)
    parts = [_slice(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in T.slices(offsets)]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in (*COUNTS, *SHARES)}


def measured(texts: DataFrame, key: str) -> DataFrame:
    """key (long), text (binary) -> key and every statistic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = measure(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(found[k], pa.int64() if k in COUNTS else pa.float64()) for k in (*COUNTS, *SHARES))], [key, *COUNTS, *SHARES])

    return texts.mapInArrow(run, f"{key} long, " + ", ".join(f"{k} long" for k in COUNTS) + ", " + ", ".join(f"{k} double" for k in SHARES))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Statistics and 0/1 labels of at most `most` labelled rows that are not held out, those of lowest id hash.

    The bound is the only limit, and what comes to the driver is `most` short rows. Rows without text or label are left out.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & ~T.held_out(F.col(id_col)))
        .select(F.col(id_col).alias("_key"), F.col(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_key"), "_key", "_label").limit(most)
    )
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_key"), T.as_bytes(F.col(text_col)).alias("_text"))
    texts = texts.join(F.broadcast(chosen.select("_key").distinct()), "_key", "left_semi")
    rows = measured(texts, "_key").join(F.broadcast(chosen), "_key").orderBy(F.xxhash64("_key"), "_key", *SHARES).limit(most).toPandas()
    return rows[list(SHARES)].to_numpy(float), rows["_label"].to_numpy(int)
