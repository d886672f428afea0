"""Chat formatting: speaker roles by a hidden Markov model, then rendering.

The hidden state of a line is (role, first line of a turn or a later one). What
is seen of a line is whether it opens with a speaker marker, whether it opens a
record, its length and its punctuation. Viterbi gives the likeliest roles; runs
of lines become turns in one canonical form, markers stripped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarnlake.session import materialize

ROLES = ("system", "user", "assistant")
#: Speaker markers by role, matched without case at the start of a line.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "you", "customer", "question", "q", "prompter", "student"),
    "assistant": ("assistant", "ai", "bot", "gpt", "model", "agent", "answer", "a", "response", "tutor"),
}
#: Records of one conversation that are decoded in one piece.
BLOCK = 4096
#: How a turn is written.
TURN = "<|{role}|>\n{text}\n<|end|>"

LENGTHS = (40, 80, 160, 320, 640)
SHAPE = {"marker": 4, "opens": 2, "length": len(LENGTHS) + 1, "asks": 2, "lines": 4, "start": 2}
STATES = [(r, b) for r in range(len(ROLES)) for b in (True, False)]  # (role, first line of a turn)

_NAMES = "|".join(w for ws in MARKERS.values() for w in sorted(ws, key=len, reverse=True))
_MARKER = re.compile(
    rf"^\s*(?:<\|(?:im_start\|>)?\s*({_NAMES})\s*(?:\|>)?|\[({_NAMES})\]:?|\#+\s*({_NAMES})\s*:?\s*$|(?:\*\*)?({_NAMES})(?:\s*\([^)]{{0,40}}\))?(?:\*\*)?\s*:(?:\*\*)?)\s*",
    re.I,
)
_ROLE_OF = {w: r for r, (_, ws) in enumerate(MARKERS.items()) for w in ws}


def marker(line: str) -> tuple[int, str]:
    """(role + 1 or 0, the line without its marker)."""
    m = _MARKER.match(line)
    if m is None:
        return 0, line
    word = next(g for g in m.groups() if g).lower()
    return _ROLE_OF[word] + 1, line[m.end() :]


def features(text: str | None, first: bool) -> list[tuple[tuple[int, ...], str]]:
    """(feature values, line without marker) for the lines of a record."""
    out = []
    lines = [marker(line) for line in (text or "").split("\n")]
    # How long a record is tells of its role only if it is one turn.
    extent = 3 if any(mark for mark, _ in lines) else min(len(lines) - 1, 2)
    for k, (mark, rest) in enumerate(lines):
        length = sum(len(rest) >= x for x in LENGTHS)
        asks = int(rest.rstrip().endswith(("?", "？", "¿")))
        out.append(((mark, int(k == 0), length, asks, extent, int(first and k == 0)), rest))
    return out


class Model:
    """Log probabilities: features given the state, states given the last."""

    def __init__(self, emit: list[np.ndarray], step: np.ndarray, start: np.ndarray):
        self.emit, self.step, self.start = emit, step, start

    @classmethod
    def from_counts(cls, rows: list[tuple[int, int, int, int, int]]) -> Model:
        """From (what, state, value, n) counts over labelled records.

        what >= 0: feature number; -1: role to role at a turn; -2: first role.
        How often turns bear markers, and how often they begin inside a
        record, differs from one source to the next and is set, not counted:
        labelled records without any marker must not teach that none comes.
        """
        n = len(STATES)
        emit = [np.full((n, size), 1.0) for size in SHAPE.values()]
        turn = np.full((len(ROLES), len(ROLES)), 1.0) + 5.0 * np.array([[0, 2, 1], [0, 0, 3], [0, 3, 0]])
        start = np.array([2.0, 4.0, 1.0])
        stay = np.array([1.0, 1.0])  # a turn goes on, a turn ends
        for what, state, value, k in rows:
            if what >= 0:
                emit[what][state, value] += k
                if what == 1:
                    stay[int(STATES[state][1])] += k
            elif what == -1:
                turn[state, value] += k
            else:
                start[state] += k
        stay = stay / stay.sum()
        turn = turn / turn.sum(axis=1, keepdims=True)
        step = np.full((n, n), -np.inf)
        for i, (a, _) in enumerate(STATES):
            for j, (b, first) in enumerate(STATES):
                if first:
                    step[i, j] = np.log(stay[1] * turn[a, b])
                elif a == b:
                    step[i, j] = np.log(stay[0])
        begin = np.full(n, -np.inf)
        begin[[s for s, (_, first) in enumerate(STATES) if first]] = np.log(start / start.sum())
        chance = [e / e.sum(axis=1, keepdims=True) for e in emit]
        for s, (role, first) in enumerate(STATES):
            chance[0][s] = 0.0005
            chance[0][s, 0] = 0.5 if first else 0.99
            if first:
                chance[0][s, role + 1] = 0.5
            chance[1][s] = (0.02, 0.98) if first else (0.98, 0.02)
        chance[4][:, 3] = 1.0  # a marked record: its extent says nothing
        return cls([np.log(c) for c in chance], step, begin)

    def seen(self, values: np.ndarray) -> np.ndarray:
        """Log probability of each line under each state."""
        return sum(e[:, values[:, k]] for k, e in enumerate(self.emit)).T

    def transfer(self, values: np.ndarray) -> np.ndarray:
        """Best score of a block from the state of its first line to its last's."""
        seen = self.seen(values)
        out = np.where(np.eye(len(STATES), dtype=bool), seen[0][None, :], -np.inf)
        for row in seen[1:]:
            out = (out[:, :, None] + self.step[None, :, :]).max(axis=1) + row[None, :]
        return out

    def borders(self, blocks: list[np.ndarray]) -> list[tuple[int, int]]:
        """States of the first and the last line of each block on one best
        path, from the blocks' transfer scores."""
        best, back = self.start[:, None] + blocks[0], []
        for m in blocks[1:]:
            hop = best.max(axis=0)[:, None] + self.step
            back.append((best.argmax(axis=0), hop.argmax(axis=0)))
            best = hop.max(axis=0)[:, None] + m
        first, last = divmod(int(best.argmax()), best.shape[1])
        out = [(first, last)]
        for firsts, lasts in reversed(back):
            last = int(lasts[first])
            first = int(firsts[last])
            out.append((first, last))
        return out[::-1]

    def decode(self, values: np.ndarray, entry: np.ndarray, leave: np.ndarray | None = None) -> np.ndarray:
        """Viterbi states; ``entry``: scores before the first line's evidence;
        ``leave``: scores of the last line's states beside its evidence."""
        seen = self.seen(values)
        best, back = entry + seen[0], []
        for row in seen[1:]:
            hop = best[:, None] + self.step
            back.append(hop.argmax(axis=0))
            best = hop.max(axis=0) + row
        state = int((best if leave is None else best + leave).argmax())
        path = [state]
        for b in reversed(back):
            state = int(b[state])
            path.append(state)
        return np.array(path[::-1])


def fit_model(labelled: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Model:
    """Count features and role changes over all labelled records.

    Rows without a known role are left out. Feature counts are summed inside
    the tasks first: what is shuffled and what reaches the driver is bounded
    by the model's size. Role changes come from consecutive turn numbers.
    """
    src = labelled.where(F.col(role).isin(*ROLES))
    code = F.array_position(F.array(*map(F.lit, ROLES)), F.col(role)).cast("int") - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, int] = {}
        for b in batches:
            for r, t, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for k, (values, _) in enumerate(features(t, first)):
                    state = 2 * r + int(k > 0)
                    for f, v in enumerate(values):
                        sums[f, state, v] = sums.get((f, state, v), 0) + 1
        cols = list(zip(*[(*k, n) for k, n in sums.items()], strict=True)) or [[], [], [], []]
        kinds = [pa.int32()] * 3 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["what", "state", "value", "n"])

    shape = "what int, state int, value int, n long"
    first = F.coalesce(F.col(turn) <= 0, F.lit(False))
    counts = src.select(code, F.col(text), first).mapInArrow(count, shape)
    # The next turn by number: an equi-join, so a long conversation needs no ordered window.
    now = src.select(F.col(conv).alias("c"), F.col(turn).alias("t"), code.alias("state"))
    then = src.select(F.col(conv).alias("c"), (F.col(turn) - 1).alias("t"), code.alias("value"))
    moves = now.join(then, ["c", "t"]).groupBy("state", "value").agg(F.count(F.lit(1)).alias("n"))
    begins = src.where(first).groupBy(code.alias("state")).agg(F.count(F.lit(1)).alias("n"))
    both = (
        counts.groupBy("what", "state", "value").agg(F.sum("n").alias("n"))
        .unionByName(moves.select(F.lit(-1).alias("what"), "state", "value", "n"))
        .unionByName(begins.select(F.lit(-2).alias("what"), "state", F.lit(0).alias("value"), "n"))
    )
    return Model.from_counts([tuple(r) for r in both.collect()])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Sorted rows by their first two columns, over batch borders."""
    key, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row[2:])
    if rows:
        yield key, rows


def _numbered(records: DataFrame) -> DataFrame:
    """Add ``nth``, from 0, by conversation in order of (turn, tie).

    Range-partitioned, so a conversation of any length spreads over tasks; a
    random last key splits even equal records, which are interchangeable. The
    rows are written before they are numbered: that key must not change.
    """
    order = ["conv_id", "turn", "tie", "salt"]
    dealt = records.withColumn("salt", F.rand(7)).repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "dealt")
    counts = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shift = counts.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    nth = F.row_number().over(W.partitionBy("conv_id", "part").orderBy("turn", "tie", "salt"))
    both = dealt.withColumn("nth", nth).join(shift, dealt["conv_id"].eqNullSafe(F.col("_c")) & (dealt["part"] == F.col("_p")))
    return both.withColumn("nth", F.col("nth") + F.col("shift") - 1)


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "tie")


def _values(rows: list[tuple]) -> tuple[np.ndarray, list[list[str]]]:
    seen = [features(text, opens) for _, _, text, opens, *_ in rows]
    return np.array([v for f in seen for v, _ in f]), [[rest for _, rest in f] for f in seen]


def format_chats(
    records: DataFrame,
    model: Model | None = None,
    conv: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """(conv_id, turn, part, role, n_lines, text, rendered): canonical turns.

    A record may hold several turns (parts from 0) if markers inside it start
    new ones. Roles depend on texts and order only. Null text is one empty
    line; null conversations form one conversation; null turns come first;
    equal turn numbers are ordered by text; repeated rows are repeated records.
    Conversations of more than ``block`` records are cut into blocks of that
    many, whatever their turn numbers: each block's transfer scores (states x
    states) are combined along the conversation, which gives the states at the
    blocks' borders, and each block is decoded between them: the path is a best
    one of the whole conversation and no task holds it all. Other columns are left out.
    """
    model = model or Model.from_counts([])
    src = records.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.xxhash64(text).alias("tie"),
        F.col(text).alias("text"),
        F.coalesce(F.col(turn) <= 0, F.lit(False)).alias("opens"),
    )
    sizes = src.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    long = materialize(sizes.select(F.col("conv_id").alias("_c")), "long")
    same = src["conv_id"].eqNullSafe(long["_c"])
    columns = ["conv_id", "block", "turn", "tie", "text", "opens"]
    many = _numbered(src.join(long, same, "left_semi")).withColumn("block", F.floor(F.col("nth") / block).cast("long")).select(columns)
    src = many.unionByName(src.join(long, same, "left_anti").withColumn("block", F.lit(0).cast("long")).select(columns))
    edges = materialize(_block_edges(_dealt(many), model), "edges")
    src = src.join(
        edges.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "entry", "leave"),
        src["conv_id"].eqNullSafe(F.col("_c")) & (src["block"] == F.col("_b")),
        "left",
    ).drop("_c", "_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "turn", "part", "role", "n_lines", "text", "rendered"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string()]
        out: list[tuple] = []
        for (c, _), rows in _groups(batches):
            values, lines = _values(rows)
            entry, leave = rows[0][4], rows[0][5]
            path = model.decode(values, model.start if entry is None else np.array(entry), None if leave is None else np.array(leave))
            at = 0
            for (t, *_), part in zip(rows, lines, strict=True):
                states = [STATES[s] for s in path[at : at + len(part)]]
                at += len(part)
                cuts = [k for k, (_, first) in enumerate(states) if first or k == 0] + [len(part)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    role, said = ROLES[states[a][0]], "\n".join(part[a:b]).strip()
                    out.append((c, t, k, role, b - a, said, TURN.format(role=role, text=said)))
            if len(out) >= 2048:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    shape = "conv_id long, turn long, part int, role string, n_lines int, text string, rendered string"
    return _dealt(src).mapInArrow(run, shape)


def _block_edges(blocks: DataFrame, model: Model) -> DataFrame:
    """(conv_id, block, entry, leave) of conversations with several blocks."""
    n = len(STATES)

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (c, b), rows in _groups(batches):
            m = model.transfer(_values(rows)[0]).ravel().tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int64()), pa.array([b], pa.int64()), pa.array([m], pa.list_(pa.float64()))], names=["conv_id", "block", "m"]
            )

    matrices = blocks.mapInArrow(transfers, "conv_id long, block long, m array<double>")

    def chain(key: tuple, t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("block").to_numpy())
        ms = [np.array(t.column("m")[int(i)].as_py()).reshape(n, n) for i in order]
        only = np.where(np.eye(n, dtype=bool), 0.0, -np.inf)
        entry, leave = zip(*[(only[first], only[last]) for first, last in model.borders(ms)], strict=True)
        return pa.table(
            {
                "conv_id": pa.array([key[0].as_py()] * len(ms), pa.int64()),
                "block": pa.array([t.column("block")[int(i)].as_py() for i in order], pa.int64()),
                "entry": pa.array([e.tolist() for e in entry], pa.list_(pa.float64())),
                "leave": pa.array([x.tolist() for x in leave], pa.list_(pa.float64())),
            }
        )

    return matrices.groupBy("conv_id").applyInArrow(chain, "conv_id long, block long, entry array<double>, leave array<double>")
