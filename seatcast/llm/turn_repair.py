"""Conversation structure repair at least cost, with Four-Russians block tables.

Rows of a conversation are kept, given another role, deleted, or empty turns are
inserted, so that the roles' initials read ``(s?(ua)+)?``.  Of the cheapest ways
the one whose letters (D delete, I insert, K keep, R rerole) are least in ASCII
order is taken.

A prefix of the repaired conversation is in one of four states (empty, after a
system, user or assistant turn), so a row changes a vector of four costs.
Vectors are normalised by the cost of "after assistant", which every state can
reach or wait for: "empty" is worth at most 3 more (a system row kept instead of
deleted) and "after system" nothing more, so costs above that are cut off there,
where they are strictly dominated and on no cheapest path.  That leaves a few
dozen vectors.  With ten kinds of row (no row; row that must go; initial s, u, a
or other, whole or truncated) every block of ``BLOCK`` rows is one of 10,000,
and a table holds the next vector and the added cost for each vector and block.
A conversation is read by one lookup a block.  Blocks are then expanded
backward into rows: the states on any cheapest path are marked, all ties
included, and a walk forward through marked states takes the least letter.

Rows go to a task by conversation and are sorted there by Spark, which spills:
first the marks of first occurrences and the rows without texts, from which the
edits follow, then the rows with texts, which are emitted or hashed as they
come.  So a task holds a few bytes a row of the conversation at hand, however
long its texts.  One task reads a conversation whole, because its SHA-256 can
only be taken in order.

Cases: order is by turn, nulls first, then by role and the SHA-256 of the text,
so ties and repeated rows have a place; null role or text counts as one space
(a blank row, to be deleted); a role whose initial is not s, u or a cannot be
kept; a null conv_id is a conversation of its own; a conversation without rows
gets zeros, an empty audit and the hash of nothing; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1      # costs
EMPTY, SYSTEM, USER, ASSISTANT = range(4)           # states
INITIALS = {"s": 0, "u": 1, "a": 2}
NO_ROW, MUST_GO, KINDS = 0, 1, 10
BLOCK = 4
FAR = 99
INSERTED = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {0: {EMPTY: SYSTEM}, 1: {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, 3: {}}
LEGAL = ("su", "ua", "au")
REPORT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")
TURNS = "conv_id bigint, position bigint, edit string, role string, text string"


def row_edits(kind: int) -> list[tuple[str, int, int, int]]:
    """(letter, from state, to state, cost) of every edit of a row of this kind."""
    if kind == NO_ROW:
        return [("", i, i, 0) for i in range(4)]
    edits = [("D", i, i, DELETE) for i in range(4)]
    if kind != MUST_GO:
        initial, cut = divmod(kind - 2, 2)
        edits += [("K", i, j, TRUNCATED * cut) for i, j in KEPT[initial].items()]
        edits += [("R", i, j, REROLE + TRUNCATED * cut) for i, j in INSERTED.items()]
    return edits


def normalised(costs) -> tuple[tuple[int, ...], int]:
    """The cost vector after any inserts, less its last entry, and that entry."""
    c = list(costs)
    for _ in range(2):
        for i, j in INSERTED.items():
            c[j] = min(c[j], c[i] + INSERT)
    base = c[ASSISTANT]
    c = [x - base for x in c]
    c[EMPTY], c[SYSTEM] = min(c[EMPTY], DELETE + 1), min(c[SYSTEM], 1)
    return tuple(c), base


class Tables:
    """Vectors, the step table of a row and the block table made from it."""

    def __init__(self, block: int = BLOCK):
        first, self.start = normalised([0, FAR, FAR, FAR])
        self.vectors, number, steps = [first], {first: 0}, []
        for v in self.vectors:                          # grows while new vectors turn up
            row = []
            for kind in range(KINDS):
                costs = [FAR] * 4
                for _, i, j, w in row_edits(kind):
                    costs[j] = min(costs[j], v[i] + w)
                after, base = normalised(costs)
                if after not in number:
                    number[after] = len(self.vectors)
                    self.vectors.append(after)
                row.append((number[after], base))
            steps.append(row)
        step = np.array(steps)
        self.next, self.added = step[:, :, 0], step[:, :, 1]
        after, added = self.next, self.added
        for _ in range(block - 1):                      # blocks of one row more
            added = (added[:, :, None] + self.added[after]).reshape(len(step), -1)
            after = self.next[after].reshape(len(step), -1)
        self.block, self.block_next, self.block_added = block, after.tolist(), added.tolist()
        self.row_next, self.row_added = self.next.tolist(), self.added.tolist()

    @cache
    def end(self, vector: int) -> tuple[int, int, int]:
        """Cheapest end (relative cost), and the masks of the states that are
        such an end and of those from which one is reached by inserts."""
        v = self.vectors[vector]
        best = min(v[EMPTY], v[ASSISTANT])
        ends = sum(1 << i for i in (EMPTY, ASSISTANT) if v[i] == best)
        return best, ends, self._with_inserts(vector, ends)

    def _with_inserts(self, vector: int, mask: int) -> int:
        v = self.vectors[vector]
        for _ in range(2):
            for i, j in INSERTED.items():
                if mask >> j & 1 and v[i] + INSERT == v[j]:
                    mask |= 1 << i
        return mask

    @cache
    def back(self, vector: int, kind: int, mask: int) -> int:
        """States before a row from which a cheapest path goes on to ``mask`` after it."""
        return self._with_inserts(vector, sum({1 << i for _, i, j, _ in self._on_path(vector, kind, mask)}))

    def _on_path(self, vector, kind, mask):
        v, after, added = self.vectors[vector], self.vectors[self.row_next[vector][kind]], self.row_added[vector][kind]
        return [e for e in row_edits(kind) if mask >> e[2] & 1 and v[e[1]] + e[3] == added + after[e[2]]]

    @cache
    def forward(self, vector: int, kind: int, before: int, after: int) -> dict[int, tuple[str, int]]:
        """For each marked state: the least letters up to this row's edit, and the state after it."""
        v, on_path, out = self.vectors[vector], self._on_path(vector, kind, after), {}
        for start in range(4):
            if before >> start & 1:
                letters, state = "", start
                while True:
                    choices = [(letter, j, True) for letter, i, j, _ in on_path if i == state]
                    j = INSERTED[state]
                    if before >> j & 1 and v[state] + INSERT == v[j]:
                        choices.append(("I", j, False))
                    letter, state, done = min(choices)
                    letters += letter
                    if done:
                        break
                out[start] = letters, state
        return out

    @cache
    def finish(self, vector: int) -> dict[int, str]:
        """For each state from which the end is reached: the inserts that are left."""
        _, ends, marked = self.end(vector)
        out = {}
        for start in range(4):
            if marked >> start & 1:
                state, letters = start, ""
                while not ends >> state & 1:
                    state, letters = INSERTED[state], letters + "I"
                out[start] = letters
        return out


@cache
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


class Reader:
    """Kinds of rows in, cheapest edits out.  Holds a byte a row and a vector a block."""

    def __init__(self, t: Tables):
        self.t, self.kinds, self.starts = t, bytearray(), []
        self.vector, self.cost, self.code, self.filled = 0, t.start, 0, 0

    def add(self, kind: int) -> None:
        self.kinds.append(kind)
        self.code, self.filled = self.code * KINDS + kind, self.filled + 1
        if self.filled == self.t.block:
            self._block()

    def _block(self) -> None:
        self.starts.append(self.vector)
        self.cost += self.t.block_added[self.vector][self.code]
        self.vector = self.t.block_next[self.vector][self.code]
        self.code = self.filled = 0

    def edits(self) -> tuple[int, bytes]:
        """(cost, letters): blocks are expanded from the last to the first, then read forward."""
        t = self.t
        while self.filled:
            self.add(NO_ROW)
        best, _, mask = t.end(self.vector)
        masks = bytearray(len(self.kinds) + 1)
        masks[-1] = mask
        for b in range(len(self.starts) - 1, -1, -1):
            vector, within = self.starts[b], []
            rows = self.kinds[b * t.block:(b + 1) * t.block]
            for kind in rows:
                within.append(vector)
                vector = t.row_next[vector][kind]
            for k in range(t.block - 1, -1, -1):
                mask = t.back(within[k], rows[k], mask)
                masks[b * t.block + k] = mask
        state, vector, letters = EMPTY, 0, bytearray()
        for p, kind in enumerate(self.kinds):
            more, state = t.forward(vector, kind, masks[p], masks[p + 1])[state]
            letters += more.encode()
            vector = t.row_next[vector][kind]
        return self.cost + best, bytes(letters + t.finish(vector)[state].encode())


class Conversation:
    """One conversation as its rows come: first without texts, then with them."""

    def __init__(self, conv_id):
        self.conv_id, self.reader, self.letters, self.at = conv_id, Reader(tables()), None, 0
        self.low = self.high = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = None
        self.marked = False          # the mark of a first occurrence was just read
        self.state, self.position = EMPTY, 0

    def light(self, turn, role, blank, truncated) -> None:
        if turn is not None and (self.high is None or turn != self.high):
            self.distinct += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        if blank:
            kind, self.blank = MUST_GO, self.blank + 1
        elif not self.marked:
            kind, self.duplicate = MUST_GO, self.duplicate + 1
        else:
            kind, self.truncated = 2 + 2 * INITIALS.get(initial, 3) + truncated, self.truncated + truncated
        self.marked = False
        self.reader.add(kind)

    def settle(self) -> None:
        if self.letters is None:
            self.cost, self.letters = self.reader.edits()
            self.reader = None

    def text(self, role, text):
        """Repaired turns (position, edit, role, text) up to this row."""
        self.settle()
        yield from self.inserts()
        letter, self.at = self.letters[self.at:self.at + 1].decode(), self.at + 1
        if letter == "D":
            return
        if letter == "R":
            role = self.named()
        else:
            self.state = KEPT[INITIALS[role[:1]]][self.state]
        yield self.turn(letter, role, text)

    def named(self) -> str:
        self.state = INSERTED[self.state]
        return "user" if self.state == USER else "assistant"

    def turn(self, *what):
        self.position += 1
        return (self.position - 1, *what)

    def inserts(self):
        self.settle()
        while self.letters[self.at:self.at + 1] == b"I":
            self.at += 1
            yield self.turn("I", self.named(), "")

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


def _stream(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Everything of a conversation in one task and in order: ``pass`` -1 its
    name, 0 its rows without texts, each first occurrence of a role and text
    with a mark (``kind`` 0) before it, 1 its rows with texts."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), role.alias("role"), text.alias("text"),
                       F.unhex(F.sha2(text, 256)).alias("tie"))
    none = {"turn": "bigint", "role": "string", "tie": "binary", "text": "string", "blank": "boolean", "truncated": "boolean"}

    def part(df, number, kind, **given):
        return df.select("conv_id", F.lit(number).alias("pass"),
                         *[given.get(c, F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in none.items()],
                         F.lit(kind).alias("kind"))

    name = part(ids.select(F.col("conv_id").cast("bigint")).distinct(), -1, 1)
    seen = rows.groupBy("conv_id", "role", "tie").agg(
        F.when(F.count("turn") == F.count(F.lit(1)), F.min("turn")).alias("turn"))
    light = part(rows, 0, 1, text=F.lit(None), blank=~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
                 truncated=~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"))
    all_of = name.unionByName(part(seen, 0, 0)).unionByName(light).unionByName(part(rows, 1, 1))
    return all_of.repartition("conv_id").sortWithinPartitions("conv_id", "pass", "turn", "role", "tie", "kind")


def _read(rows: DataFrame, ids: DataFrame, schema: str, begin, each, end) -> DataFrame:
    """Run ``each(state, turn)`` for every repaired turn and ``end(state, conversation)``
    for every conversation; both yield rows of ``schema``."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"bigint": pa.int64(), "string": pa.string()}
    form = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])

    def run(batches):
        out, held = [], 0
        for row in events(batches):
            out.append(row)
            held += 64 + sum(len(v) for v in row if isinstance(v, str))
            if held > 4 << 20:
                yield batch_of(out)
                out, held = [], 0
        yield batch_of(out)

    def batch_of(out):
        cols = list(zip(*out)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, form)], schema=form)

    def events(batches):
        now, state = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                cols = [c.to_pylist() for c in batch.slice(at, 256).columns]
                for conv_id, number, turn, role, _, text, blank, truncated, kind in zip(*cols):
                    if number < 0:
                        if now is not None:
                            yield from close(now, state)
                        now, state = Conversation(conv_id), begin()
                    elif number == 0:
                        if kind == 0:
                            now.marked = True
                        else:
                            now.light(turn, role, blank, truncated)
                    else:
                        for got in now.text(role, text):
                            yield from each(state, now, got)
        if now is not None:
            yield from close(now, state)

    def close(now, state):
        for got in now.inserts():
            yield from each(state, now, got)
        yield from end(state, now)

    return _stream(rows, ids).mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, position (from 0), edit (K, R or I), role, text."""
    return _read(rows, rows, TURNS, lambda: None, lambda _, now, got: [(now.conv_id, *got)], lambda _, now: [])


def audit(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Faults, cheapest edits and digest of every conversation of ``ids`` (of ``rows`` unless given)."""
    def each(sha, now, got):
        position, _, role, text = got
        sha.update(("\n" if position else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        return ()

    def end(sha, now):
        return [(now.conv_id, now.gaps(), now.blank, now.duplicate, now.truncated, now.illegal, now.cost,
                 now.letters.decode(), sha.hexdigest())]

    return _read(rows, rows if ids is None else ids, REPORT, hashlib.sha256, each, end)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with the faults that op12's contract puts in."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(given("conv_id"), F.lit(":"), given("turn")).cast("binary")) % 20
    text = F.when(how == 1, "").when(how == 2, F.translate(given("text"), ".!?", "")).otherwise(given("text"))
    role = F.when(how == 4, "user").otherwise(given("role"))
    times = F.when(how == 0, 0).when(how == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(1), times)).alias("copy")).drop("copy")
