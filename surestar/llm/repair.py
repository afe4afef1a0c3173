"""Conversation structure repair by a rank-convergence parallel Viterbi search.

Rows of a conversation are kept, given another role, deleted, or stand after inserted turns, so that the roles read
``(system? (user assistant)+)?`` at the least cost. What a repair of the rest costs from each of four states (nothing kept, after the system
turn, after a user, after an assistant) is a vector; a row maps the vector behind it to the one before it. Rows are sorted over the whole
table into ranges, so a conversation may reach over many tasks. A task cuts its part of each conversation into pieces. All pieces run at
once, backwards, from speculative vectors; a piece whose vector behind differs from what the next piece gives by more than a constant runs again
until it differs from its own earlier vectors by a constant only, and passes go on until no piece is left. A range that lies
in one conversation first does this from the four unit vectors, which tells what it makes of any vector behind it; the ranges, one row each,
are stitched on the driver. The backward costs then say for each row and state which letter of the audit comes next.

The rows of a conversation are read once in order to write its audit and the digest of its repaired text, without keeping them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.llm.common import store, whole_groups

RE_ROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
PIECE_ROWS = 64

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after an inserted turn or one with a changed role, and what it costs to end in a state.
NEXT = np.array([USER, USER, ASSISTANT, USER])
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
#: State after a kept row by its initial (s, u, a, any other); -1 where it can't be kept.
KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]])
INITIALS = {"s": 0, "u": 1, "a": 2}
NAMES = {USER: "user", ASSISTANT: "assistant"}
_NEVER = np.int64(1 << 40)
_CAN_KEEP = KEPT >= 0
_KEEP_TO = np.maximum(KEPT, 0)

SPACE = r"\x20\x09-\x0D"
DELETED, KEEP, CHANGED = range(3)


@dataclass
class Rows:
    """Rows of a range in order: initials, whether the first of its copies may stay and what that costs, copies that go."""

    initial: np.ndarray
    keepable: np.ndarray
    extra: np.ndarray
    deletes: np.ndarray

    def options(self, at: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cost of deleting, keeping and changing the row in each state, given the vectors behind."""
        extra = self.extra[at, None]
        kept = np.take_along_axis(after, _KEEP_TO[self.initial[at]], axis=1) + extra
        kept = np.where(_CAN_KEEP[self.initial[at]], kept, _NEVER)
        return after + DELETE, kept, after[:, NEXT] + extra + RE_ROLE

    def before(self, at: np.ndarray, behind: np.ndarray) -> np.ndarray:
        """Vectors before the rows ``at``, given those behind them."""
        after = behind + DELETE * self.deletes[at, None]
        best = np.minimum.reduce(self.options(at, after))
        user, assistant = best[:, USER], best[:, ASSISTANT]
        closed = np.minimum(best, user[:, None] + INSERT)
        closed[:, USER] = np.minimum(user, assistant + INSERT)
        closed[:, :2] = np.minimum(closed[:, :2], assistant[:, None] + 2 * INSERT)
        return np.where(self.keepable[at, None], closed, after)


def parallel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which vectors differ by a constant only."""
    return ((x - x[:, :1]) == (y - y[:, :1])).all(axis=1)


def backward_costs(rows: Rows, segment: np.ndarray, ends: np.ndarray, piece: int = PIECE_ROWS) -> tuple[np.ndarray, np.ndarray, int]:
    """Vectors before and behind each row, each up to a constant, and the number of fix-up passes.

    ``segment`` numbers the conversations from 0 in order; ``ends`` holds the vector behind each one.
    """
    n = len(segment)
    starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, n))
    pieces = -(-sizes // piece)
    owner = np.repeat(np.arange(len(starts)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = starts[owner] + number * piece
    last = np.minimum(first + piece, starts[owner] + sizes[owner]) - 1
    final = np.append(owner[1:] != owner[:-1], True) if n else np.zeros(0, bool)
    before, behind = np.zeros((n, 4), np.int64), np.zeros((n, 4), np.int64)
    ran = np.zeros(n, bool)
    vector = np.where(final[:, None], ends[owner], 0) if n else np.zeros((0, 4), np.int64)
    lanes, passes = np.arange(len(owner)), 0
    while len(lanes):
        passes += 1
        at, now, low = last[lanes], vector[lanes], first[lanes]
        while len(at):
            behind[at] = now
            now = rows.before(at, now)
            go = ~(ran[at] & parallel(now, before[at]))
            before[at], ran[at] = now, True
            go &= at > low
            at, now, low = at[go] - 1, now[go], low[go]
        follows = np.where(final, 0, np.arange(len(owner)) + 1)
        given = np.where(final[:, None], vector, before[first[follows]])
        lanes = np.flatnonzero(~parallel(given, vector))
        vector[lanes] = given[lanes]
    return before, behind, passes


def audit_steps(rows: Rows, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """What the least audit does at each row in each state: inserted turns, the letter and the state after it, in a number of 8 bits a state."""
    every = np.arange(len(before))
    after = behind + DELETE * rows.deletes[:, None]
    fresh = rows.before(every, behind)  # with the constant of the vectors behind
    deleted, kept, changed = rows.options(every, after)
    go = rows.keepable[:, None] & (deleted != fresh)  # a row that has to go is deleted whatever the state
    inserted = go & (fresh[:, NEXT] + INSERT == fresh)
    letter = np.where(~go, DELETED, np.where(kept == fresh, KEEP, CHANGED))
    to = np.where(~go, np.arange(4), np.where(kept == fresh, _KEEP_TO[rows.initial], NEXT))
    turns, chosen, state = np.zeros_like(letter), letter, to
    at = np.broadcast_to(np.arange(4), letter.shape)
    for _ in range(2):
        more = np.take_along_axis(inserted, at, axis=1)
        turns, at = turns + more, np.where(more, NEXT[at], at)
    chosen, state = np.take_along_axis(letter, at, axis=1), np.take_along_axis(to, at, axis=1)
    codes = turns | chosen << 2 | state << 4
    return (codes << np.array([0, 8, 16, 24])).sum(axis=1)


def damage(rows: DataFrame) -> DataFrame:
    """The rows with faults put in by a checksum of conversation and turn; null texts and roles become one space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind, text = F.crc32(key) % 20, F.coalesce("text", blank)
    damaged = rows.select(
        "conv_id", "turn", kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
    ).where("kind != 0")
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return damaged.select("conv_id", "turn", "role", "text", F.explode(times)).drop("col")


def _marked(rows: DataFrame) -> DataFrame:
    """One row for equal rows of a turn: how many there are, which faults they have and whether the first may stay."""
    text = F.col("text")
    blank = ~text.rlike(f"[^{SPACE}]")
    truncated = ~text.rlike(rf"[.!?][{SPACE}]*\z")
    runs = rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"), blank.alias("blank"), truncated.alias("cut"))
    runs = runs.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count("*").alias("n"), F.bool_or("blank").alias("blank"), F.bool_or("cut").alias("cut")
    )
    said = runs.groupBy("conv_id", "role", "digest").agg(
        F.min("turn").alias("first_turn"), F.bool_or(F.col("turn").isNull()).alias("first_null")
    )
    said = said.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first_turn", "first_null")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    first = F.when(F.col("first_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first_turn"))
    return runs.join(said, same).select(
        "conv_id", "turn", "role", "digest", "n", "blank", (F.col("cut") & ~F.col("blank")).alias("cut"),
        (first & ~F.col("blank")).alias("keepable"),
    )


def _order() -> list[Column]:
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


def _of(pdf: pd.DataFrame) -> Rows:
    initial = pdf["role"].str[:1].map(INITIALS).fillna(3).to_numpy(np.int64)
    keepable = pdf["keepable"].to_numpy(bool)
    extra = np.where(pdf["cut"].to_numpy(bool), TRUNCATED, 0).astype(np.int64)
    return Rows(initial, keepable, extra, pdf["n"].to_numpy(np.int64) - keepable)


def _segments(pdf: pd.DataFrame) -> np.ndarray:
    conv = pdf["conv"].to_numpy()
    return np.cumsum(np.append(False, conv[1:] != conv[:-1])) if len(conv) else np.zeros(0, np.int64)


def _range_summaries(placed: DataFrame) -> pd.DataFrame:
    """Of each range its first and last conversation and the vector before its first row for five vectors behind the first conversation:
    that of an end and, where the range has no other conversation, the unit vectors."""
    units = np.where(np.eye(4, dtype=bool), 0, _NEVER)

    def summaries(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, "chunk"):
            conv = pdf["conv"].to_numpy()
            head = pdf[conv == conv[0]] if conv[0] != conv[-1] else pdf
            rows, one = _of(head), np.zeros(len(head), np.int64)
            ends = [END, *(units if conv[0] == conv[-1] else ())]
            found = [_exact(rows, one, end) for end in ends]
            yield pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "first": [conv[0]], "last": [conv[-1]], "vectors": [np.concatenate(found)]})

    schema = "chunk long, first long, last long, vectors array<long>"
    placed = placed.select("chunk", "place", "conv", "role", "n", "keepable", "cut")
    return placed.repartition("chunk").sortWithinPartitions("chunk", "place").mapInPandas(summaries, schema).toPandas()


def _exact(rows: Rows, segment: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Vector before the first row, with its constant: pieces know theirs only up to one, so it is taken from the costs of the steps."""
    before, behind, _ = backward_costs(rows, segment, end[None])
    fresh = rows.before(np.arange(len(segment)), behind)
    shift = fresh[:, 0] - behind[:, 0]  # what each row adds to the first component
    total = end[0] + shift.sum()
    return fresh[0] - fresh[0, 0] + total


def _stitched(summaries: pd.DataFrame) -> dict[int, list[int]]:
    """The vector behind the last conversation of each range, for ranges where it goes on in the next one. One step a range."""
    out: dict[int, list[int]] = {}
    following: tuple[int, np.ndarray] | None = None
    for row in summaries.sort_values("chunk", ascending=False).itertuples():
        vectors = np.asarray(row.vectors, np.int64).reshape(-1, 4)
        start = vectors[0]
        if following is not None and following[0] == row.last:
            behind = following[1]
            out[row.chunk] = (behind - behind.min()).tolist()
            if row.first == row.last:
                start = (vectors[1:] + behind[:, None]).min(axis=0)
        following = (row.first, start - start.min())
    return out


def _steps(placed: DataFrame, behind: dict[int, list[int]]) -> DataFrame:
    """The rows with ``steps``, what the audit does at each."""
    names = ["conv_id", "turn", "role", "digest", "n", "blank", "cut", "keepable"]

    def traced(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, "chunk"):
            rows, segment = _of(pdf), _segments(pdf)
            ends = np.tile(END, (segment[-1] + 1, 1))
            ends[-1] = behind.get(int(pdf["chunk"].iloc[0]), END)
            before, after, _ = backward_costs(rows, segment, ends)
            yield pd.DataFrame({"chunk": pdf["chunk"], "place": pdf["place"], "steps": audit_steps(rows, before, after)})

    narrow = placed.select("chunk", "place", "conv", "role", "n", "keepable", "cut")
    narrow = narrow.repartition("chunk").sortWithinPartitions("chunk", "place")
    steps = narrow.mapInPandas(traced, "chunk long, place long, steps long")
    return placed.join(steps, ["chunk", "place"]).select(*names, "steps")


class _Conversation:
    """What is known of a conversation while its rows pass."""

    def __init__(self) -> None:
        self.gaps = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.state, self.audit, self.written, self.digest = START, [], False, hashlib.sha256()
        self.first_turn = self.last_turn = self.initial = None
        self.turns, self.waiting = 0, None

    def write(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.written else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.written = True

    def insert(self) -> None:
        self.state = int(NEXT[self.state])
        self.audit.append("I")
        self.cost += INSERT
        self.write(NAMES[self.state], "")

    def row(self, turn, role: str, n: int, blank: bool, cut: bool, keepable: bool, steps: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        for times in (1, n - 1):  # before the first copy, then among the copies
            if self.initial is not None:
                self.illegal += times * (self.initial + role[:1] not in ("su", "ua", "au"))
            self.initial = role[:1]
        self.blank += n if blank else 0
        self.duplicate += 0 if blank else n - keepable
        self.truncated += keepable and cut
        code = steps >> (8 * self.state) & 255
        for _ in range(code & 3):
            self.insert()
        deleted = n
        if (code >> 2 & 3) != DELETED:
            kept = (code >> 2 & 3) == KEEP
            self.state, deleted = code >> 4 & 3, n - 1
            self.audit.append("K" if kept else "R")
            self.cost += (0 if kept else RE_ROLE) + (TRUNCATED if cut else 0)
            self.waiting = role if kept else NAMES[self.state]
        self.audit.append("D" * deleted)
        self.cost += DELETE * deleted

    def text(self, text: str) -> None:
        if self.waiting is not None:
            self.write(self.waiting, text)
            self.waiting = None

    def finished(self) -> tuple:
        while END[self.state]:
            self.insert()
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return (*map(int, counts), "".join(self.audit), self.digest.hexdigest())


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conv_id``, ``turn``, ``role`` and ``text``: its faults, what the cheapest repair costs, its audit, and the
    digest of the repaired ``role:text`` lines.

    Rows go by turn, null first, then by role and by the MD5 of the text; equal rows of a turn are adjacent. A null role or text is one space.
    A null ``conv_id`` is a conversation like any other. Audits take the least letter first where costs tie. Other columns are not read. An
    empty table gives no rows.
    """
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    sorted_rows = _marked(rows).repartitionByRange(*_order()).sortWithinPartitions(*_order())
    placed = store(sorted_rows.withColumns({
        "chunk": F.spark_partition_id().cast("long"),
        "place": F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)),
        "conv": F.xxhash64("conv_id"),
    }))
    marked = _steps(placed, _stitched(_range_summaries(placed)))
    id_type = rows.schema["conv_id"].dataType.simpleString()
    texts = rows.select(
        "conv_id", "turn", "role", F.md5("text").alias("digest"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("blank"),
        F.lit(False).alias("cut"), F.lit(False).alias("keepable"), F.lit(0).cast("long").alias("steps"), F.lit(1).alias("kind"), "text",
    )
    every = marked.withColumns({"kind": F.lit(0), "text": F.lit("")}).unionByName(texts)
    names = ["conv_id", "none", "turn", "no_turn", "role", "n", "blank", "cut", "keepable", "steps", "kind", "text"]

    def told(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, own = None, None
        for pdf in batches:
            done = []
            for conv_id, none, turn, no_turn, role, n, blank, cut, keepable, steps, kind, text in zip(*(pdf[c].tolist() for c in names)):
                if (conv_id, none) != own:
                    if current is not None:
                        done.append((*own, *current.finished()))
                    current, own = _Conversation(), (conv_id, none)
                if kind:
                    current.text(text)
                else:
                    current.row(None if no_turn else turn, role, n, blank, cut, keepable, steps)
            if done:
                yield pd.DataFrame(done, columns=columns)
        if current is not None:
            yield pd.DataFrame([(*own, *current.finished())], columns=columns)

    columns = ["conv_id", "none", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    schema = f"conv_id {id_type}, none boolean, " + ", ".join(f"{c} long" for c in columns[2:8]) + ", audit string, repaired_sha256 string"
    # Without nulls, pandas keeps whole numbers as they are.
    ordered = every.withColumn("conv", F.xxhash64("conv_id")).repartition("conv").sortWithinPartitions("conv", *_order(), "kind")
    filled = ordered.withColumns({
        "none": F.col("conv_id").isNull(), "conv_id": F.coalesce("conv_id", F.lit(0).cast(id_type)),
        "no_turn": F.col("turn").isNull(), "turn": F.coalesce("turn", F.lit(0).cast("long")),
    }).select(names)
    found = filled.mapInPandas(told, schema)
    return found.select(F.when(~F.col("none"), F.col("conv_id")).alias("conv_id"), *columns[2:])
