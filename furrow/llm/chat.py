"""Chat formatting: transcript parsing by a hidden Markov model, then canonical turns.

A transcript is plain text. Each of its lines is observed by its speaker marker (one observation a role, and one for a bare name)
and by line features (blank, question, indented or list, other). Hidden states are (role, first line of a turn or a later one);
the chances of a step and of what is seen also depend on whether the line before is blank. Viterbi gives the likeliest states, so a missing or odd marker
is read from its surroundings. The tables are counted over labelled conversations, all that are not held out; a weak prior
(markers by role, roles that alternate) stands for what they do not show and serves where nothing was learnt.

`transcripts` writes conversations as such plain text, in several styles; in some, markers are missing or give a bare name only.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm import text as T

#: Markers by role, as transcripts write them.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "me", "prompter"),
    "assistant": ("assistant", "bot", "ai", "agent", "answer", "a", "model", "support"),
    "tool": ("tool", "function", "observation"),
}
FEATURES = ("name", "blank", "question", "list", "plain")  #: what a line without a role's marker is seen as
MOST_ROLES = 12  #: roles that a model tells apart, those of most turns
PART = 512  #: turn numbers of a transcript
PRIOR_LINES = 4.0  #: lines that the prior counts for
_name = re.compile(r"^[ \t]*([^\W\d_]{1,20})(?: [^\W\d_]{1,20})?:[ \t]")
_list = re.compile(r"[ \t]{2,}|[ \t]*(?:[-*•]|\d{1,3}[.)])[ \t]")
#: Text lines that could be read as blank or as a marker, or that begin with the escape itself, are written behind a backslash.
ESCAPED = r"(?m)^(?=\\|[ \t\r]*$|[ \t]*(?:[#*<]|\[)|[ \t]*[\p{L}\p{N}_ ]{1,60}:)"


def _reads(roles: Sequence[str]) -> tuple[dict[str, int], re.Pattern]:
    """Role by marker name, and the pattern of a marker."""
    of_name = {name: i for i, role in enumerate(roles) for name in (role.lower(), *MARKERS.get(role, ()))}
    names = "(" + "|".join(map(re.escape, sorted(of_name, key=len, reverse=True))) + ")"
    marker = rf"^[ \t]*(?:(?:#{{1,4}}[ \t]*|\*{{1,2}}|\[|<\|?){names}(?::?\*{{1,2}}|\]|\|?>)?[ \t]*(?::|>|(?<=[\]>*])|(?=\r?$))|{names}[ \t]*:)[ \t]?"
    return of_name, re.compile(marker, re.IGNORECASE)


def _prior(roles: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chances before any count: start (states), step (after no blank line, after one; states x states), emission (likewise; states x observations)."""
    r, at = len(roles), {role: i for i, role in enumerate(roles)}
    emit = np.zeros((2 * r, r + len(FEATURES)))
    emit[:r, :r] = 0.001
    emit[np.arange(r), np.arange(r)] = 0.85
    emit[:r, r:] = (0.03, 0.003, 0.04, 0.01, 0.06)
    emit[r:, :r] = 1e-6
    emit[r:, r:] = (0.01, 0.14, 0.05, 0.14, 0.65)
    turn = np.full((r, r), 0.02)
    for role, after in (("system", "user"), ("user", "assistant"), ("assistant", "user"), ("tool", "assistant")):
        if role in at and after in at:
            turn[at[role], at[after]] = 0.9
    turn = 0.07 * turn / turn.sum(1, keepdims=True)
    step = np.zeros((2, 2 * r, 2 * r))
    step[:, :r, :r] = step[:, r:, :r] = turn
    for later in (np.arange(r), np.arange(r) + r):
        step[:, later, np.arange(r) + r] = 0.93
    step[1, :, :r] *= 6
    start = np.full(2 * r, 0.003)
    start[:r] = [{"user": 0.65, "system": 0.25}.get(role, 0.05) for role in roles]
    return start, step, np.stack([emit, emit])


@dataclass
class Model:
    """Roles, and logarithms of the chances."""

    roles: tuple[str, ...]
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    def __post_init__(self) -> None:
        self.of_name, self.marker = _reads(self.roles)

    def observe(self, line: str, escaped: bool = False) -> tuple[int, int]:
        """The observation of a line, and where its text begins (behind a marker or an escape)."""
        r = len(self.roles)
        if escaped and line.startswith("\\"):
            line, begin = line[1:], 1
        elif m := self.marker.match(line):
            return self.of_name[(m[1] or m[2]).lower()], m.end()
        elif not line.strip():
            return r + 1, 0
        elif m := _name.match(line):
            return r, m.end()
        else:
            begin = 0
        return r + (2 if line.rstrip().endswith("?") else 3 if _list.match(line) else 4), begin

    def states(self, seen: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi over many sequences side by side: the likeliest states of each; ties go to the earlier role."""
        size = np.array([len(x) for x in seen], np.int64)
        order = np.argsort(-size, kind="stable")
        live = int((size > 0).sum())
        if not live:
            return [np.zeros(0, np.int64) for _ in seen]
        rows = np.zeros((live, int(size.max())), np.int64)
        for i, k in enumerate(order[:live]):
            rows[i, : size[k]] = seen[k]
        lengths, blank = size[order[:live]], len(self.roles) + 1
        score = self.start + self.emit[0][:, rows[:, 0]].T
        back = []
        for t in range(1, rows.shape[1]):
            live = int(np.searchsorted(-lengths, -t, "left"))
            after = (rows[:live, t - 1] == blank).astype(np.int64)
            way = score[:live, :, None] + self.step[after]
            best = way.argmax(1)
            back.append(best.astype(np.int8))
            score[:live] = np.take_along_axis(way, best[:, None], 1)[:, 0] + self.emit[after, :, rows[:live, t]]
        out, now = np.zeros_like(rows), score.argmax(1)
        for t in range(rows.shape[1] - 1, -1, -1):
            ends = lengths > t
            out[ends, t] = now[ends]
            if t:
                live = len(back[t - 1])
                now[:live] = back[t - 1][np.arange(live), now[:live]]
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(seen)
        for i, k in enumerate(order[: len(rows)]):
            found[k] = out[i, : size[k]]
        return found

    def parse(self, transcripts: Sequence[str | None], escaped: bool = False) -> list[list[tuple[str, str]]]:
        """(role, text) of each turn of each transcript; blank lines at a turn's ends go. Null, empty or blank text has no turn."""
        lines = [x.split("\n") if x and x.strip() else [] for x in transcripts]
        found = [[self.observe(x, escaped) for x in some] for some in lines]
        r, out = len(self.roles), []
        for some, seen, states in zip(lines, found, self.states([np.array([k for k, _ in x], np.int64) for x in found]), strict=True):
            turns: list[tuple[str, list[str]]] = []
            for line, (kind, begin), state in zip(some, seen, states.tolist(), strict=True):
                if state < r or not turns:
                    turns.append((self.roles[state % r], [line[begin:]]))
                else:
                    turns[-1][1].append(line[begin:] if kind > r + 1 else line)
            out.append([(role, "\n".join(x).strip("\n")) for role, x in turns])
        return out


def model(roles: Sequence[str] = tuple(MARKERS), start: np.ndarray | float = 0.0, step: np.ndarray | float = 0.0, emit: np.ndarray | float = 0.0) -> Model:
    """A model from counts over labelled lines, none by default."""
    prior = _prior(roles)
    total = [PRIOR_LINES * p / p.sum(-1, keepdims=True) + counted for p, counted in zip(prior, (start, step, emit), strict=True)]
    return Model(tuple(roles), *(np.log(np.maximum(x / x.sum(-1, keepdims=True), 1e-12)) for x in total))


@functools.cache
def default() -> Model:
    return model()


def parse(transcript: str | None) -> list[tuple[str, str]]:
    """(role, text) of each turn of one transcript, by the prior alone."""
    return default().parse([transcript])[0]


def render(turns: list[tuple[str, str]]) -> str:
    """Canonical turns."""
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def learn(conversations: DataFrame) -> Model:
    """A model counted over the lines of all labelled conversations (conv_id, turn, role, text) that are not held out.

    Rows without a conversation, a turn number or a role are left out, as are roles beyond the MOST_ROLES of most turns. A table
    without rows gives the prior. What comes to the driver is one number for each cell of the tables.
    """
    known = conversations.where(F.col("role").isNotNull() & F.col("turn").isNotNull() & ~T.held_out(F.col("conv_id")))
    found = [r["role"] for r in known.groupBy("role").count().orderBy(F.desc("count"), "role").limit(MOST_ROLES).collect()]
    roles = (*MARKERS, *sorted(set(found) - set(MARKERS)))
    plain, r = model(roles), len(roles)
    states, kinds = 2 * r, r + len(FEATURES)
    cells = states + 2 * states * states + 2 * states * kinds
    written = _written(known.where(F.col("role").isin(*roles))).select(F.transform("s", lambda x: x["role"]).alias("roles"), F.transform("s", lambda x: x["x"]).alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        start, step, emit = np.split(total, [states, states + 2 * states * states])
        step, emit = step.reshape(2, states, states), emit.reshape(2, states, kinds)
        for b in batches:
            for names, texts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                before, blank = -1, False
                for role, text in zip(names, texts, strict=True):
                    for i, line in enumerate(text.split("\n")):
                        state, (kind, _) = roles.index(role) + r * (i > 0), plain.observe(line, True)
                        emit[int(blank), state, kind] += 1
                        if before < 0:
                            start[state] += 1
                        else:
                            step[int(blank), before, state] += 1
                        before, blank = state, kind == r + 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["cell", "n"])

    counted = np.zeros(cells)
    for row in written.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counted[row["cell"]] = row["n"]
    start, step, emit = np.split(counted, [states, states + 2 * states * states])
    return model(roles, start, step.reshape(2, states, states), emit.reshape(2, states, kinds))


def parsed(transcripts: DataFrame, id_col: str, text_col: str, using: Model | None = None, escaped: bool = False) -> DataFrame:
    """id, turns (role, text) and rendered (canonical text) of every transcript; id_col must not be called turns or rendered.

    using: a learnt model, else the prior. escaped: lines may stand behind a backslash, as transcripts() writes them.
    Null and empty transcripts have no turns; repeated rows each give theirs; a very long transcript is read whole, by one task;
    of equally likely readings the one of earlier roles wins; other columns are not read; an empty table gives no rows.
    """
    if id_col in ("turns", "rendered"):
        raise ValueError(f"{id_col} is a column of the result")
    using = using or default()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for b in batches:
            for a, z in T.slices(T.flat(b.column(1))[1], 1 << 20):
                turns = using.parse([x.decode() for x in b.column(1).slice(a, z - a).to_pylist()], escaped)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array([[{"role": r, "text": t} for r, t in x] for x in turns], kind), pa.array([render(x) for x in turns], pa.string())], [id_col, "turns", "rendered"])

    kind = transcripts.schema[id_col].dataType.simpleString()
    return transcripts.select(id_col, T.as_bytes(F.col(text_col)).alias("_text")).mapInArrow(run, f"{id_col} {kind}, turns array<struct<role:string,text:string>>, rendered string")


#: How styles write the markers of roles; other roles are written by their own names.
STYLES = (("{}: ", {}), ("### {}:\n", {"user": "Human"}), ("[{}] ", {}), ("**{}:** ", {"system": "Context", "user": "Q", "assistant": "A"}))
NAMES = ("Kim", "Robin", "Sascha", "Andrea")  #: of speakers whose role is not told


def _line(spaced: Column) -> Column:
    """A turn as lines: a marker, or a bare name, or none, and the escaped text."""
    role, text, turn = F.col("role"), F.coalesce("text", F.lit("")), F.coalesce("turn", F.lit(0))
    draw = F.xxhash64("conv_id", "turn")
    style = F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(len(STYLES)))
    marker = None
    for i, (form, names) in enumerate(STYLES):
        name = F.initcap(role)
        for own, called in names.items():
            name = F.when(role == own, F.lit(called)).otherwise(name)
        before, after = form.split("{}")
        one = F.concat(F.lit(before), name, F.lit(after))
        marker = one if marker is None else F.when(style == i, one).otherwise(marker)
    bare = F.concat(F.element_at(F.array(*map(F.lit, NAMES)), (F.pmod(draw, F.lit(len(NAMES))) + 1).cast("int")), F.lit(": "))
    # where turns are set apart by blank lines, every other turn may do without its marker
    loose = spaced & (turn % 2 == 1) & text.rlike(r"\A[^\n]*[^\s]")
    chosen = F.when(loose & (F.pmod(F.shiftright(draw, 8), F.lit(3)) == 0), F.lit("")).when(loose & (F.pmod(F.shiftright(draw, 8), F.lit(3)) == 1), bare)
    escaped = F.regexp_replace(text, ESCAPED, r"\\")
    return F.concat(F.coalesce(chosen, marker, bare), escaped, F.when(spaced, F.lit("\n")).otherwise(F.lit("")))


def _written(conversations: DataFrame) -> DataFrame:
    """conv_id, part, and s: the turns in order, each with its role and lines (x)."""
    spaced = F.coalesce(F.pmod(F.expr(f"conv_id DIV {len(STYLES)}"), F.lit(2)) == 1, F.lit(False))
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    turn = F.struct(F.coalesce("turn", F.lit(0)).alias("t"), _line(spaced).alias("x"), F.col("role").alias("role"))
    rows = conversations.select("conv_id", F.expr(f"turn DIV {PART}").alias("part"), turn.alias("s"), known.alias("known"))
    grouped = rows.where("known").groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("s")).alias("s"))
    return grouped.unionByName(rows.where("NOT known").select("conv_id", "part", F.array("s").alias("s")))


def transcripts(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) as plain transcripts: conv_id, part, text.

    The style varies with the conversation: four ways to write markers, each either for every turn or with a blank line between
    turns, where every other turn may lack its marker or have a bare name. Text lines that could be read as something else
    stand behind a backslash. Rows of one turn number follow one another by their text. A transcript holds PART turn numbers: a
    longer conversation is several transcripts, each of which begins with a marked turn. A row without a conversation or a turn
    number is a transcript of its own (so no group of such rows is ever gathered). A row without a role has a bare name; null
    texts are empty; other columns are not read; an empty table gives no rows.
    """
    return _written(conversations).select("conv_id", "part", F.array_join(F.transform("s", lambda x: x["x"]), "\n").alias("text"))
