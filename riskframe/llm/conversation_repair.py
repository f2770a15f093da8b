"""Conversation structure repair by a generalised LR parser with weighted edits.

The role grammar, over the initials of roles, is ``S -> (nothing) | P | s P``,
``P -> u a | P u a``: a conversation is empty, or an optional system row and then user and
assistant in turn.  A conversation's rows are the input; the cheapest edits make it a
sentence of the grammar:

====== ==== =====================================================================
edit   cost effect
====== ==== =====================================================================
Keep   0    the row stays
Rerole 3    the row stays, its role becomes user or assistant
Delete 4    the row goes; blank and duplicate rows must go
Insert 3    a row of user or assistant with an empty text, anywhere
====== ==== =====================================================================

A truncated row that stays adds 3.  The audit is the edits' initials in order; of the
cheapest repairs the one with the ASCII-least audit is taken.

A row's first fault counts: blank (no ``[^\\x20\\x09-\\x0D]``), duplicate (role and text seen
earlier in the conversation), truncated (last such character not one of ``.!?``).

The parser keeps a graph-structured stack: stacks are linked nodes (LR state, node below) that
share their lower parts, an edit is a shift of its symbol with all reductions that follow, and
stacks with the same top state are merged into the one of least (cost, audit).  What may still
follow depends on the top alone, so that loses nothing.

Rows are ordered by (turn, nulls first; role; SHA-256 of the text) and dealt to tasks by ranges
of that order, without their texts.  A conversation that spans tasks is parsed in each of them
from every top state that may be on the stack there; the parts are chained afterwards, so a
conversation of any length is parsed by many tasks.  Rows that agree in all four columns are
counted before anything is exchanged.  Then the audits meet the texts, in the same order, one
conversation after the other and row by row: nothing of a conversation but its audit is held.
(A digest over a whole repaired conversation, as the query wants it, is made in one task.)

Cases: a null role or text is one space, so such a text is blank; null turns come first and do
not count in ``gaps``; rows without a conversation id are one conversation; a conversation
without rows (all dropped) has zeros, an empty audit and nothing repaired; repeated rows are
duplicates of the first; rows of one turn are ordered by role, then by the digest of the text;
the length of texts does not matter; an empty table gives an empty result.  Other columns are
not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: Tokens of one parsing step; audits are spelled out in between.
STEP = 4096
#: Conversations up to this length are parsed once for each sequence of tokens.
SHORT = 64
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

# The LR tables of the grammar.  (state, symbol) -> state after a shift,
# state -> (symbols taken off by its reduction), (state below, after P) -> state.
_SHIFT = {(0, "s"): 3, (0, "u"): 4, (3, "u"): 4, (4, "a"): 6, (2, "u"): 7, (5, "u"): 7, (7, "a"): 8}
_REDUCE = {6: 2, 8: 3}
_AFTER_P = {0: 2, 3: 5}
_ACCEPT = (0, 2, 5)
#: For every top state that rows can leave behind, a stack that has it.
_STACKS = {0: (0, None), 3: (3, (0, None)), 2: (2, (0, None)), 5: (5, (3, (0, None))), 4: (4, (0, None)), 7: (7, (2, (0, None)))}

Stack = tuple
Path = tuple[int, int, int, str]


@lru_cache(maxsize=None)
def shifted(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a shift of ``symbol`` and the reductions it allows."""
    state = _SHIFT.get((stack[0], symbol))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in _REDUCE:
        below = stack
        for _ in range(_REDUCE[stack[0]]):
            below = below[1]
        stack = (_AFTER_P[below[0]], below)
    return stack


def _with_inserts(tops: dict[int, tuple]) -> dict[int, tuple]:
    """``tops`` (state -> (cost, rank, edits, stack)) and what inserted rows make of them."""
    todo, out = list(tops.values()), dict(tops)
    while todo:
        cost, rank, edits, stack = todo.pop()
        if out[stack[0]][:3] < (cost, rank, edits):
            continue
        for symbol in ROLES:
            more = shifted(stack, symbol)
            if more:
                new = (cost + INSERT, rank, edits + "I", more)
                if more[0] not in out or new[:3] < out[more[0]][:3]:
                    out[more[0]] = new
                    todo.append(new)
    return out


def _after_row(tops: dict[int, tuple], token: str) -> dict[int, tuple]:
    """One input row.  ``token``: the initial of its role (upper case: truncated), ``o`` any
    other initial, ``x`` a row that must go."""
    out: dict[int, tuple] = {}

    def put(cost: int, rank: int, edits: str, stack: Stack | None) -> None:
        if stack and (stack[0] not in out or (cost, rank, edits) < out[stack[0]][:3]):
            out[stack[0]] = (cost, rank, edits, stack)

    role = token.lower()
    for cost, rank, edits, stack in _with_inserts(tops).values():
        put(cost + DELETE, rank, edits + "D", stack)
        if role != "x":
            here = cost + (TRUNCATED if token != role else 0)
            put(here + KEEP, rank, edits + "K", shifted(stack, role))
            for symbol in ROLES:
                put(here + REROLE, rank, edits + "R", shifted(stack, symbol))
    return out


def parse(tokens: str, entry: int = 0) -> list[Path]:
    """(entry, exit, cost, audit) of the best edits of the rows for every top state they may leave,
    from a stack with top ``entry``.

    Within a step an audit is its rank among those at the step's last row, and the edits since.
    Audits at one row end with an edit of that row, so none is the beginning of another, and
    their order stays whatever follows.
    """
    ends = [(0, "", _STACKS[entry])]
    for a in range(0, len(tokens), STEP):
        ends.sort(key=lambda e: e[1])
        starts = [audit for _, audit, _ in ends]
        tops = {stack[0]: (cost, i, "", stack) for i, (cost, _, stack) in enumerate(ends)}
        links = {i: (None, str(i)) for i in range(len(ends))}
        for token in tokens[a:a + STEP]:
            found = sorted(_after_row(tops, token).values(), key=lambda t: t[1:3])
            links = {i: (links[rank], edits) for i, (_, rank, edits, _) in enumerate(found)}
            tops = {stack[0]: (cost, i, "", stack) for i, (cost, _, _, stack) in enumerate(found)}
        ends = []
        for cost, i, _, stack in tops.values():
            link, edits = links[i], []
            while link[0] is not None:
                edits.append(link[1])
                link = link[0]
            ends.append((cost, starts[int(link[1])] + "".join(reversed(edits)), stack))
    return [(entry, stack[0], cost, audit) for cost, audit, stack in ends]


_parse_short = lru_cache(maxsize=1 << 16)(parse)


def _paths(tokens: str, entries: tuple[int, ...]) -> list[Path]:
    one = _parse_short if len(tokens) <= SHORT else parse
    return [p for e in entries for p in one(tokens, e)]


def chained(parts: list[list[Path]]) -> tuple[int, str]:
    """(cost, audit) of a conversation from the paths of its parts, in order."""
    best = {0: (0, "")}
    for paths in parts:
        new: dict[int, tuple[int, str]] = {}
        for entry, leave, cost, audit in paths:
            if entry in best:
                c = (best[entry][0] + cost, best[entry][1] + audit)
                if leave not in new or c < new[leave]:
                    new[leave] = c
        best = new
    ranked = sorted(best, key=lambda s: best[s][1])
    tops = {s: (best[s][0], i, "", _STACKS[s]) for i, s in enumerate(ranked)}
    cost, rank, edits, _ = min((t for s, t in _with_inserts(tops).items() if s in _ACCEPT), key=lambda t: t[:3])
    return cost, best[ranked[rank]][1] + edits


# ----------------------------------------------------------------------------- rows
def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, times): the rows with nulls as one space, damaged by
    ``crc32("conv:turn") % 20``: 0 drops the row (0 times), 1 empties its text, 2 takes its
    ``[.!?]`` out, 3 repeats it, 4 makes it a user's."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col)).cast("binary")) % 20
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace(spaced(text_col), "[.!?]", "")).otherwise(spaced(text_col))
    return rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                       F.when(how == 4, "user").otherwise(spaced(role_col)).alias("role"), text.alias("text"),
                       F.when(how == 0, 0).when(how == 3, 2).otherwise(1).cast("long").alias("times"))


def undamaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, times) of rows as they are."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), spaced(role_col).alias("role"),
                       spaced(text_col).alias("text"), F.lit(1).cast("long").alias("times"))


def _said() -> Column:
    return F.unhex(F.sha2("text", 256))


def _judged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, said, fault, times, again): the different rows without their texts;
    ``again`` tells that role and text were there at an earlier turn."""
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "b").when(
        ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "t").otherwise("")
    some = rows.where("times > 0").select("conv", "turn", "role", _said().alias("said"), fault.alias("fault"), "times")
    some = some.groupBy("conv", "turn", "role", "said", "fault").agg(F.sum("times").alias("times"))
    first = some.groupBy(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("said").alias("_said")).agg(
        F.min(F.struct("turn")).alias("_first"))
    both = some.join(first, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("said") == F.col("_said")))
    return both.select("conv", "turn", "role", "said", "fault", "times", (~F.struct("turn").eqNullSafe(F.col("_first"))).alias("again"))


_PART = ("struct<lo:long,hi:long,turns:long,blank:long,duplicate:long,truncated:long,illegal:long,left:string,right:string,"
         "paths:array<struct<entry:int,leave:int,cost:long,audit:string>>>")


class _Part:
    """What one task has read of one conversation."""

    def __init__(self, conv, entries: tuple[int, ...]):
        self.conv, self.entries, self.tokens = conv, entries, []
        self.lo = self.hi = self.left = self.right = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, fault: str, times: int, again: bool) -> None:
        initial = role[:1]
        if turn is not None and turn != self.hi:
            self.lo, self.hi, self.turns = turn if self.lo is None else self.lo, turn, self.turns + 1
        if self.right is None:
            self.left = initial
        else:
            self.illegal += self.right + initial not in LEGAL
        self.illegal += times - 1
        self.right = initial
        token = initial if initial in ("s", "u", "a") else "o"
        if fault == "b":
            self.blank += times
            self.tokens.append("x" * times)
            return
        if again:
            self.duplicate += times
            self.tokens.append("x" * times)
            return
        self.duplicate += times - 1
        self.truncated += fault == "t"
        self.tokens.append((token.upper() if fault == "t" else token) + "x" * (times - 1))

    def row(self) -> dict:
        paths = [dict(zip(("entry", "leave", "cost", "audit"), p)) for p in _paths("".join(self.tokens), self.entries)]
        return {"conv": self.conv, "part": {
            "lo": self.lo, "hi": self.hi, "turns": self.turns, "blank": self.blank,
            "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "left": self.left,
            "right": self.right, "paths": paths}}


def _parts(rows: DataFrame) -> DataFrame:
    """(conv, seg, part): one row for each conversation and task that has rows of it."""
    judged = _judged(rows)
    order = ["conv", "turn", "role", "said"]
    judged = judged.repartitionByRange(*order).sortWithinPartitions(*order)
    conv_type = judged.schema["conv"].dataType.simpleString()
    schema = judged.sparkSession.createDataFrame([], f"conv {conv_type}, seg int, part {_PART}").schema
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, now, held = TaskContext.get().partitionId(), None, []
        for b in batches:
            for conv, turn, role, fault, times, again in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in (
                    "conv", "turn", "role", "fault", "times", "again")]):
                if now is None or conv != now.conv:
                    if now is not None:
                        held.append(now.row() | {"seg": seg})
                    # only the first conversation of a task may have begun in the one before
                    now = _Part(conv, tuple(_STACKS) if now is None else (0,))
                now.add(turn, role, fault, times, again)
            if len(held) >= 1000:
                yield pa.RecordBatch.from_pylist(held, arrow)
                held = []
        if now is not None:
            yield pa.RecordBatch.from_pylist(held + [now.row() | {"seg": seg}], arrow)
    return judged.select("conv", "turn", "role", "fault", "times", "again").mapInArrow(scan, schema)


def _joined(parts: list[dict]) -> dict:
    """The counts, cost and audit of a conversation from its parts, in order."""
    out = {c: sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated", "illegal")}
    turns = [p for p in parts if p["turns"]]
    shared = sum(a["hi"] == b["lo"] for a, b in zip(turns, turns[1:]))
    out["gaps"] = turns[-1]["hi"] - turns[0]["lo"] + 1 - (sum(p["turns"] for p in turns) - shared) if turns else 0
    out["illegal"] += sum(a["right"] + b["left"] not in LEGAL for a, b in zip(parts, parts[1:]))
    out["cost"], out["audit"] = chained([[(x["entry"], x["leave"], x["cost"], x["audit"]) for x in p["paths"]] for p in parts])
    return out


def _repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every row that is there after the edits."""
    stack, at = _STACKS[0], 0

    def next_role() -> str:
        return next(r for r in ROLES if shifted(stack, r))
    for role, text in rows:
        while audit[at] == "I":
            symbol = next_role()
            stack, at = shifted(stack, symbol), at + 1
            yield "I", ROLES[symbol], ""
        edit, at = audit[at], at + 1
        if edit != "D":
            symbol = role[:1] if edit == "K" else next_role()
            stack = shifted(stack, symbol)
            yield edit, role if edit == "K" else ROLES[symbol], text
    for _ in audit[at:]:
        symbol = next_role()
        stack = shifted(stack, symbol)
        yield "I", ROLES[symbol], ""


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, joined parts, iterator of its (role, text)) from rows in order: parts, then texts.
    The iterator has to be used up before the next conversation is asked for."""
    def flat():
        for b in batches:
            for a in range(0, b.num_rows, 256):
                yield from b.slice(a, 256).to_pylist()
    rows = flat()
    held = [next(rows, None)]

    def texts(conv):
        while held[0] is not None and held[0]["conv"] == conv:
            r = held[0]
            held[0] = next(rows, None)
            for _ in range(r["times"]):
                yield r["role"], r["text"]
    while held[0] is not None:
        conv, parts = held[0]["conv"], []
        while held[0] is not None and held[0]["conv"] == conv and held[0]["part"] is not None:
            parts.append(held[0]["part"])
            held[0] = next(rows, None)
        yield conv, _joined(parts) if parts else dict.fromkeys(COUNTS, 0) | {"audit": ""}, texts(conv)


def _ordered(rows: DataFrame) -> DataFrame:
    """Every conversation's parts and then its rows, in order, in one task."""
    parts = _parts(rows)
    kind = parts.schema["part"].dataType
    told = parts.select("conv", "seg", "part", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                        F.lit(None).cast("binary").alias("said"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("times"))
    texts = rows.select("conv", F.lit(None).cast("int").alias("seg"), F.lit(None).cast(kind).alias("part"), "turn", "role",
                        _said().alias("said"), "text", "times")
    both = told.union(texts).repartition("conv").sortWithinPartitions("conv", F.col("part").isNull(), "seg", "turn", "role", "said")
    return both.select("conv", "part", "role", "text", "times")


def repair(rows: DataFrame) -> DataFrame:
    """Of rows (conv, turn, role, text, times): per conversation conv, gaps, blank, duplicate,
    truncated, illegal, cost, audit and repaired_sha256 (of its repaired ``role:text``, joined
    by line feeds)."""
    conv_type = rows.schema["conv"].dataType.simpleString()
    fields = f"conv {conv_type}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    schema = rows.sparkSession.createDataFrame([], fields).schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, told, texts in _conversations(batches):
            digest, first = hashlib.sha256(), True
            for _, role, text in _repaired(told["audit"], texts):
                digest.update(b"" if first else b"\n")
                digest.update(role.encode() + b":" + text.encode())
                first = False
            out.append({"conv": conv, **told, "repaired_sha256": digest.hexdigest()})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)
    return _ordered(rows).mapInArrow(run, schema)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The rows (conv, position, edit, role, text) of the repaired conversations."""
    conv_type = rows.schema["conv"].dataType.simpleString()
    schema = rows.sparkSession.createDataFrame([], f"conv {conv_type}, position long, edit string, role string, text string").schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for conv, told, texts in _conversations(batches):
            for i, (edit, role, text) in enumerate(_repaired(told["audit"], texts)):
                out.append({"conv": conv, "position": i, "edit": edit, "role": role, "text": text})
                size += len(text) + 64
                if size >= 1 << 20:
                    yield pa.RecordBatch.from_pylist(out, arrow)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)
    return _ordered(rows).mapInArrow(run, schema)
