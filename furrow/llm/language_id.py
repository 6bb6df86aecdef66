"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a little labelled text; a text is parsed greedily into the longest pieces that occur in
that text, and the language that needs the fewest pieces (times the logarithm of its automaton's text, a piece's cost) wins.

Transitions of all automata lie in one array: a state's begin at its base, shifted so that few slots stay empty, and each slot
names the state that owns it. So one step of the parse is a look at one slot (a slot of another state means that the phrase
ends, and a new one begins at the root with the same byte), and all texts of a batch are parsed side by side against all
languages. Long texts are cut into segments that are parsed side by side, too; then the parse of each segment is carried on into
the next until both begin a phrase at the same byte, from where they agree. So the phrases are those of one parse of the text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm import text as T

CLASSES = 256
SEGMENT = 2048  #: bytes
SAMPLE_DOCS = 200  #: labelled documents of a language that are looked at
SAMPLE_BYTES = 1 << 15  #: of a language: documents are taken whole until they hold as much
SHORT = 1 << 12  #: bytes of documents that are taken before longer ones
_letter = regex.compile(r"\p{L}").search


def _byte_classes() -> np.ndarray:
    """Letters A-Z without case, white space as one, digits as one, every other byte for itself."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[[9, 10, 11, 12, 13]] = 32
    out[48:58] = 48
    return out


BYTE_CLASS = _byte_classes()


def suffix_automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of each state of the suffix automaton of a sequence of classes; state 0 is the root."""
    step, link, size, last = [{}], [-1], [0], 0
    for c in text.tolist():
        new = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


def packed(step: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base of each state, and for each slot its owner and the next state: state s goes by c to slot base[s] + c, if that is its own.

    The root has no slots: whatever byte comes there begins a phrase.
    """
    step = [{}, *step[1:]]
    base, used = np.zeros(len(step), np.int64), 0  # used: a bit for each slot
    for s in sorted((s for s in range(len(step)) if len(step[s]) > 1), key=lambda s: -len(step[s])):
        blocked, own = 0, 0
        for c in step[s]:
            blocked, own = blocked | used >> c, own | 1 << c
        at = (~blocked & (blocked + 1)).bit_length() - 1  # the first place where all its slots are free
        base[s], used = at, used | own << at
    alone = np.array([s for s in range(len(step)) if len(step[s]) == 1], np.int64)
    size = used.bit_length() + len(alone) + 2 * CLASSES
    taken = np.unpackbits(np.frombuffer(used.to_bytes(-(-size // 8), "little"), np.uint8), bitorder="little")
    base[alone] = np.flatnonzero(taken[CLASSES:] == 0)[: len(alone)] + CLASSES - np.array([next(iter(step[s])) for s in alone], np.int64)
    owner, after = np.full(size + CLASSES, -1), np.zeros(size + CLASSES, np.int64)
    for s, moves in enumerate(step):
        for c, to in moves.items():
            owner[base[s] + c], after[base[s] + c] = s, to
    end = int(base.max()) + CLASSES
    return base, owner[:end], after[:end]


@dataclass
class Model:
    languages: list[str]
    base: np.ndarray  #: of the states of all automata, one after another
    slots: np.ndarray  #: owner of each slot, and in the low 32 bits the next state
    begin: np.ndarray  #: languages x classes: the state behind a byte that begins a phrase
    roots: np.ndarray
    cost: np.ndarray  #: of a phrase in each language

    def step(self, state: np.ndarray, codes: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and whether a phrase begins with this byte. fresh: the states behind phrases that would begin."""
        got = self.slots.take(self.base.take(state) + codes)
        new = (got >> 32) != state
        return np.where(new, fresh, got & 0xFFFFFFFF), new

    def phrases(self, data: np.ndarray, offsets: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        n, k = len(offsets) - 1, len(self.languages)
        pieces = -(-np.diff(offsets) // segment)
        owner = np.repeat(np.arange(n), pieces)
        begin = offsets[:-1][owner] + segment * (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        length = np.minimum(segment, offsets[1:][owner] - begin)
        if not len(owner) or not k:
            return np.zeros((n, k))
        codes = BYTE_CLASS[data].astype(np.int64)
        order = np.argsort(-length, kind="stable")
        first, size = begin[order], length[order]
        state = np.repeat(self.roots[:, None], len(owner), 1)
        starts = np.zeros((int(size[0]), k, len(owner)), bool)  # where a phrase begins, segments by length
        live = len(owner)
        for t in range(int(size[0])):
            live = int(np.searchsorted(-size, -t, "left")) if size[live - 1] <= t else live
            now = codes.take(first[:live] + t)
            state[:, :live], starts[t, :, :live] = self.step(state[:, :live], now, self.begin.take(now, 1))
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        starts[0] = True
        # of each segment the phrases that begin in it, by its own parse
        whole = starts.sum(0, dtype=np.int64)[:, rank]
        follows = np.concatenate([owner[1:] == owner[:-1], [False]])  # whether another segment of the text follows
        gain, onward = np.zeros_like(whole), np.full(whole.shape, -1)
        source, language = (x.ravel() for x in np.meshgrid(np.flatnonzero(follows), np.arange(k)))
        into, carried = source + 1, state[language, rank[source]]
        while len(source):  # carry on the parse of each source; gain: its phrases up to where it meets another's, and that one's from there
            met, seen, passed = np.zeros(len(into), bool), np.zeros(len(into), np.int64), np.zeros(len(into), np.int64)
            active, t = np.arange(len(into)), 0
            while len(active := active[length[into[active]] > t]):
                place = begin[into[active]] + t
                carried[active], new = self.step(carried[active], codes[place], self.begin[language[active], codes[place]])
                own = starts[t, language[active], rank[into[active]]]
                met[active[new & own]] = True
                on = ~(new & own)
                active, t = active[on], t + 1
                seen[active] += new[on]
                passed[active] += own[on]
            gain[language, source] += seen + np.where(met, whole[language, into] - passed, 0)
            onward[language[met], source[met]] = into[met]
            on = ~met & follows[into]
            source, language, carried, into = source[on], language[on], carried[on], into[on] + 1
        at = np.repeat(np.append((np.cumsum(pieces) - pieces), 0)[:n][None], k, 0)
        at[:, pieces == 0] = -1
        out, every = np.where(at >= 0, np.take_along_axis(whole, np.maximum(at, 0), 1), 0), np.arange(k)[:, None]
        while (at >= 0).any():  # from each text's first segment to where its parse meets another's, and so on
            out += np.where(at >= 0, gain[every, at], 0)
            at = np.where(at >= 0, onward[every, at], -1)
        return out.T.astype(float)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each text, and its share of the weight exp(-8 * bits a byte)."""
        bits = self.phrases(data, offsets) * self.cost / np.maximum(np.diff(offsets), 1)[:, None]
        best = bits.argmin(1)
        weight = np.exp(-8 * (bits - bits.min(1, keepdims=True)))
        return best, 1 / weight.sum(1)


def build(texts: dict[str, bytes]) -> Model:
    """A model from some text of each language."""
    languages = sorted(texts)
    bases, tables = [], []
    begin, roots, cost, states, slots = np.zeros((len(languages), CLASSES), np.int64), [], [], 0, 0
    for i, name in enumerate(languages):
        step = suffix_automaton(BYTE_CLASS[np.frombuffer(texts[name], np.uint8)])
        base, owner, after = packed(step)
        bases.append(base + slots)
        tables.append(np.where(owner >= 0, (owner + states) << 32 | (after + states), -1))
        begin[i] = states
        for c, to in step[0].items():
            begin[i, c] = states + to
        roots.append(states)
        cost.append(np.log2(max(2, len(texts[name]))))
        states, slots = states + len(base), slots + len(owner)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return Model(languages, join(bases), join(tables), begin, np.array(roots, np.int64), np.array(cost))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_each: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from sample()."""
    return build(sample(docs, id_col, text_col, lang_col, docs_each, sample_bytes))


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_each: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """Some text of each language, from rows outside the held-out fold that have a language and a text.

    Bounded sample, the same for each language however many there are: at most docs_each documents, whole ones, of lowest hash
    until they hold sample_bytes; documents over SHORT bytes come after all others, the shortest first, and of them at most one is
    taken. Copies of a row count once. The model takes about 40 bytes for each byte of the sample.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~T.held_out(F.col(id_col)))
    key = [F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_tie")]
    sized = known.select(*key, F.xxhash64(id_col, text_col, F.lit("language")).alias("_h"), F.octet_length(text_col).alias("_n")).where("_n > 0")
    long = F.col("_n") > SHORT
    order = [long.cast("int"), F.when(long, F.col("_n")), "_h", "_id"]
    # in two steps, so that no task ranks what all input tasks send of one language
    salted = sized.withColumn("_salt", F.pmod("_h", F.lit(16)))
    number = lambda *by: F.dense_rank().over(Window.partitionBy(*by).orderBy(*order))  # noqa: E731  copies share a place
    salted = salted.withColumn("_r", number("lang", "_salt")).where(F.col("_r") <= docs_each).groupBy("lang", "_id", "_tie", "_h", "_n").count()
    ranked = salted.withColumn("_r", number("lang")).where(F.col("_r") <= docs_each)
    before = F.sum("_n").over(Window.partitionBy("lang").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    longs = F.sum(long.cast("int")).over(Window.partitionBy("lang").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0))
    chosen = ranked.withColumn("_before", before).withColumn("_longs", longs).where((F.col("_before") < sample_bytes) & (F.col("_longs") <= 1)).select("lang", "_id", "_tie", "_r")
    # at most docs_each rows a language, and of their texts one for each
    rows = known.select(*key, F.col(text_col).alias("_text")).join(F.broadcast(chosen), ["lang", "_id", "_tie"]).groupBy("lang", "_r").agg(F.min("_text").alias("_text")).orderBy("lang", "_r").collect()
    texts: dict[str, list[bytes]] = defaultdict(list)
    for r in rows:
        texts[r["lang"]].append(r["_text"].encode())
    return {k: b"\n".join(v) for k, v in texts.items()}


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score (0 to 1) of every row.

    `und` with score 0 for a null or empty text, one without a letter, or where no language was learnt. Repeated rows each give
    theirs; very long texts are parsed whole; ties go to the language that sorts first; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        letters = np.isin(np.arange(CLASSES), np.arange(97, 123))
        for b in batches:
            data, offsets = T.flat(b.column(1))
            for a, z in T.slices(offsets, 2 << 20):
                piece, own = data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a]
                plain = np.concatenate([[0], np.cumsum(letters[BYTE_CLASS[piece]])])
                some = (plain[own[1:]] - plain[own[:-1]]) > 0
                for i in np.flatnonzero(~some):
                    some[i] = _letter(piece[own[i] : own[i + 1]].tobytes().decode()) is not None
                if m.languages:
                    best, score = m.predict(piece, own)
                    names = [m.languages[k] if s else "und" for k, s in zip(best, some, strict=True)]
                    score = np.where(some, score, 0.0)
                else:
                    names, score = ["und"] * (z - a), np.zeros(z - a)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array(names, pa.string()), pa.array(score, pa.float64())], [id_col, "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, T.as_bytes(F.col(text_col)).alias("_text")).mapInArrow(run, f"{id_col} {kind}, lang_pred string, score double")
