"""Repair of conversations' structure by weighted finite-state composition.

A conversation is an acceptor of its rows, an edit transducer keeps, reroles, deletes or inserts turns, and a second
acceptor has the grammar of roles, (s?(ua)+)?. Their composition is never built: a state of it is a row and one of four
grammar states, and its edges are made as the shortest path reaches them. Weights are (cost, labels) in lexicographic
order. A path's cost follows from its labels, so no path of equal cost is a proper beginning of another and the order
holds for what follows too. From a state each label leads to one state at most, so the least labels of all cheapest
paths are read off forwards from the costs to go, which are computed backwards over the topological order.

Rows are put in order by ranges of (conversation, turn), so that a long conversation lies in several tasks. Each task
cuts its rows into pieces. Conversations that one task holds as one piece are repaired from it. Those of several pieces
compose: a piece is a 4 x 4 matrix of costs between grammar states, matrices are multiplied backwards to costs to go at
the pieces' ends, each piece is then walked from all four states, and the walks are chained forwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_unique, materialise, slices

#: Rows and characters of a piece, at most; a longer row is a piece of its own.
PIECE_ROWS, PIECE_CHARS = 4096, 8 << 20

#: Costs of edits by label; a truncated row that stays costs TRUNCATED more.
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
#: Grammar states: at the start, after the system's, a user's, an assistant's turn. The first and last may be the end.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an inserted or reroled turn leads, and its role.
NEXT, ROLE = (USER, USER, ASSISTANT, USER), ("user", "user", "assistant", "user")
#: Where a kept row leads by the kind of its role: s, u and a by initial, e for an empty role, - for others (None: nowhere).
KEEP = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "e": (0, 1, 2, 3), "-": (None,) * 4}
LEGAL = {"su", "ua", "au"}
_FAR = 1 << 60

_BLANKS = " \t\n\x0b\x0c\r"


def _inserted(w: list[int]) -> list[int]:
    """Costs to go where turns may be inserted first. Two inserts that lead back cost and change nothing, so these are all."""
    user = min(w[USER], INSERT + w[ASSISTANT])
    return [min(w[START], INSERT + user), min(w[SYSTEM], INSERT + user), user, min(w[ASSISTANT], INSERT + w[USER])]


#: Costs to go where no row is left.
END = _inserted([0, _FAR, _FAR, 0])


def _before(kind: str, fault: str, after: list[int]) -> list[int]:
    """Costs to go before a row from those after it. fault: b(lank), d(uplicate), t(runcated) or a dot."""
    if fault in "bd":
        return _inserted([DELETE + x for x in after])
    more = TRUNCATED if fault == "t" else 0
    w = []
    for state, to in enumerate(KEEP[kind]):
        best = min(DELETE + after[state], REROLE + more + after[NEXT[state]])
        w.append(best if to is None else min(best, more + after[to]))
    return _inserted(w)


def costs_to_go(kinds: str, faults: str, end: list[int]) -> list[list[int]]:
    """Costs to go before each row, and at the end."""
    out = [end]
    for kind, fault in zip(reversed(kinds), reversed(faults)):
        out.append(_before(kind, fault, out[-1]))
    return out[::-1]


def matrix(kinds: str, faults: str) -> list[int]:
    """The least cost from each grammar state before the rows to each one after the last, by rows."""
    ends = [costs_to_go(kinds, faults, [0 if i == out else _FAR for i in range(4)])[0] for out in range(4)]
    return [min(ends[out][state], _FAR) for state in range(4) for out in range(4)]


def walk(kinds: str, faults: str, to_go: list[list[int]], state: int) -> tuple[str, int]:
    """The labels, D, I, K and R, of the least cheapest path over all rows, and the grammar state after the last."""
    labels, i = [], 0
    while i < len(kinds):
        cost, after, more = to_go[i][state], to_go[i + 1], TRUNCATED if faults[i] == "t" else 0
        to = KEEP[kinds[i]][state]
        if DELETE + after[state] == cost:
            labels.append("D")
        elif INSERT + to_go[i][NEXT[state]] == cost:
            labels.append("I")
            state = NEXT[state]
            continue
        elif to is not None and more + after[to] == cost:
            labels.append("K")
            state = to
        else:
            labels.append("R")
            state = NEXT[state]
        i += 1
    return "".join(labels), state


class Repaired:
    """One conversation's report and repaired turns, piece after piece."""

    def __init__(self, with_turns: bool):
        self.with_turns, self.turns, self.seq = with_turns, [], 0
        self.counts = dict.fromkeys("bdt", 0)
        self.illegal = self.distinct = self.cost = 0
        self.low = self.last = None
        self.kind = ""
        self.state = START
        self.audit: list[str] = []
        self.sha = hashlib.sha256()

    def _turn(self, label: str, role: str, text: str) -> None:
        self.sha.update((("\n" if self.seq else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        if self.with_turns:
            self.turns.append((self.seq, label, role, text))
        self.seq += 1

    def _new(self, label: str, text: str) -> None:
        self._turn(label, ROLE[self.state], text)
        self.state = NEXT[self.state]

    def add(self, piece: dict, labels: str) -> None:
        for turn in piece["turns"]:
            if turn is not None and turn != self.last:
                self.low = turn if self.low is None else self.low
                self.last = turn
                self.distinct += 1
        for kind, fault in zip(piece["kinds"], piece["faults"]):
            if fault != ".":
                self.counts[fault] += 1
            self.illegal += bool(self.kind) and self.kind + kind not in LEGAL
            self.kind = kind
        self.audit.append(labels)
        i = 0
        for label in labels:
            if label == "I":
                self.cost += INSERT
                self._new(label, "")
                continue
            role, text = piece["roles"][i], piece["texts"][i]
            if label == "D":
                self.cost += DELETE
            else:
                self.cost += TRUNCATED * (piece["faults"][i] == "t")
                if label == "K":
                    self._turn(label, role, text)
                    self.state = KEEP[piece["kinds"][i]][self.state]
                else:
                    self.cost += REROLE
                    self._new(label, text)
            i += 1

    def end(self) -> None:
        while self.state in (SYSTEM, USER):
            self.cost += INSERT
            self.audit.append("I")
            self._new("I", "")

    def report(self) -> tuple:
        gaps = 0 if self.low is None else self.last - self.low + 1 - self.distinct
        return (gaps, *self.counts.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "seq long, edit string, role string, text string"
_PIECE = "key string, part long, piece long, closed boolean, turns array<long>, roles array<string>, texts array<string>, kinds string, faults string, shas array<binary>"
_LISTS = ("turns", "roles", "texts", "kinds", "faults", "shas")


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], kind) for i, kind in enumerate(schema.types)], schema=schema)


def _schema(text: str, conv: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([("conv_id", conv)] + [(name, kinds[kind]) for name, kind in (x.split() for x in text.split(", "))])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts a task's rows, which are in order, into pieces. A conversation that begins and ends in the task is closed if it
    is one piece; its duplicates are known then."""
    part = TaskContext.get().partitionId()
    schema = None
    own: dict = {}
    n = chars = 0

    def piece(closed: bool) -> pa.RecordBatch:
        if closed:
            seen: set[bytes] = set()
            for i, sha in enumerate(own["shas"]):
                if own["faults"][i] != "b" and sha in seen:
                    own["faults"][i] = "d"
                seen.add(sha)
            own["shas"] = []
        lists = [own[x] for x in _LISTS]
        lists[3], lists[4] = "".join(lists[3]), "".join(lists[4])
        return _table([(own["conv"], own["key"], part, own["piece"], closed, *lists)], schema)

    def begin(conv, key: str, number: int, whole: bool) -> None:
        own.update({x: [] for x in _LISTS}, conv=conv, key=key, piece=number, whole=whole)

    for batch in batches:
        schema = schema or _schema(_PIECE, batch.schema.field("conv_id").type)
        for conv, key, turn, role, text, present, kind, fault, sha in zip(*(x.to_pylist() for x in batch.columns)):
            if not own or key != own["key"]:
                if own:
                    yield piece(own["whole"])
                begin(conv, key, 0, bool(own))
                n = chars = 0
            if not present:
                continue
            if n and (n >= PIECE_ROWS or chars + len(text) > PIECE_CHARS):
                yield piece(False)
                begin(conv, key, own["piece"] + 1, False)
                n = chars = 0
            for x, value in zip(_LISTS, (turn, role, text, kind, fault, sha)):
                own[x].append(value)
            n, chars = n + 1, chars + len(text)
    if own:
        yield piece(False)


def _emit(conv, done: Repaired) -> list[tuple]:
    return [(conv, *x) for x in done.turns] if done.with_turns else [(conv, *done.report())]


def _closed(batches: Iterator[pa.RecordBatch], with_turns: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 64):
        schema = _schema(TURNS if with_turns else REPORT, batch.schema.field("conv_id").type)
        rows: list[tuple] = []
        for piece in batch.to_pylist():
            done = Repaired(with_turns)
            kinds, faults = piece["kinds"], piece["faults"]
            done.add(piece, walk(kinds, faults, costs_to_go(kinds, faults, END), START)[0])
            done.end()
            rows += _emit(piece["conv_id"], done)
        yield _table(rows, schema)


_OPEN = pa.schema([("key", pa.string()), ("part", pa.int64()), ("piece", pa.int64()), ("kinds", pa.string()), ("faults", pa.string()), ("matrix", pa.list_(pa.int64()))])
_OPEN_SQL = "key string, part long, piece long, kinds string, faults string, matrix array<long>"


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their faults complete and their matrices."""
    for batch in slices(batches, 64):
        rows = []
        for key, part, piece, kinds, faults, again in zip(*(x.to_pylist() for x in batch.columns)):
            own = list(faults)
            for i in again or []:
                if own[i] != "b":
                    own[i] = "d"
            rows.append((key, part, piece, kinds, "".join(own), matrix(kinds, "".join(own))))
        yield _table(rows, _OPEN)


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces, each conversation's last first: costs to go at the piece's end in place of its matrix."""
    before, end = None, END
    for batch in slices(batches, 64):
        rows = []
        for key, part, piece, kinds, faults, own in zip(*(x.to_pylist() for x in batch.columns)):
            if key != before:
                before, end = key, END
            rows.append((key, part, piece, kinds, faults, end))
            end = [min(own[4 * i + j] + end[j] for j in range(4)) for i in range(4)]
        yield _table(rows, _OPEN)


_WALKED = pa.schema([("key", pa.string()), ("part", pa.int64()), ("piece", pa.int64()), ("faults", pa.string()), ("walks", pa.list_(pa.string()))])


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least cheapest path over each piece from each of the four grammar states."""
    for batch in slices(batches, 64):
        rows = []
        for key, part, piece, kinds, faults, end in zip(*(x.to_pylist() for x in batch.columns)):
            to_go = costs_to_go(kinds, faults, end)
            rows.append((key, part, piece, faults, [walk(kinds, faults, to_go, state)[0] for state in range(4)]))
        yield _table(rows, _WALKED)


def _chained(batches: Iterator[pa.RecordBatch], with_turns: bool) -> Iterator[pa.RecordBatch]:
    """Of pieces in order with their walks: each conversation's path. Texts pass by, none is held longer than its piece."""
    conv = key = done = schema = None
    for batch in slices(batches, 1):
        schema = _schema(TURNS if with_turns else REPORT, batch.schema.field("conv_id").type)
        for piece in batch.to_pylist():
            if piece["key"] != key:
                if done:
                    done.end()
                    yield _table(_emit(conv, done), schema)
                conv, key, done = piece["conv_id"], piece["key"], Repaired(with_turns)
            done.add(piece, piece["walks"][done.state])
            if with_turns:
                yield _table(_emit(conv, done), schema)
                done.turns = []
    if done:
        done.end()
        yield _table(_emit(conv, done), schema)


def repair(rows: DataFrame, present: Column | None = None, turns: bool = False) -> DataFrame:
    """The report of each conversation of rows (conv_id, turn, role, text), or with turns its repaired turns.

    Report: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Turns: conv_id, seq (from
    0), edit (K, R or I), role, text. Rows for which present does not hold only say that their conversation exists: one
    without other rows has zeros, an empty audit and no turns.

    Null roles and texts are one space; a null conv_id is a conversation like any other. A conversation's rows are in
    order of turn, nulls first, and where turns tie of role and a hash of the text, so equal rows are neighbours. Roles
    count by their first character; an empty role is neutral in the grammar and illegal beside any other. Texts and
    conversations may be of any length: rows are held a piece at a time. A long conversation is repaired in many tasks; the
    last step, SHA-256 over its turns, is one stream. An empty table gives no rows. Other columns are not read, whatever
    their names.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("role", "text"))
    initial, kept = F.substring(role, 1, 1), F.rtrim(text, F.lit(_BLANKS))
    own = rows.select(
        "conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), F.coalesce(present, F.lit(False)).alias("present") if present is not None else F.lit(True).alias("present"),
        F.when(initial.isin("s", "u", "a"), initial).when(initial == "", "e").otherwise("-").alias("kind"),
        F.when(kept == "", "b").when(F.substring(kept, -1, 1).isin(".", "!", "?"), ".").otherwise("t").alias("fault"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("sha"),
    ).withColumn("id", F.monotonically_increasing_id())
    order = ["key", F.asc_nulls_first("turn"), "role", "sha", "id"]
    own = own.repartitionByRange(*order).sortWithinPartitions(*order).drop("id")
    conv = rows.schema["conv_id"].dataType.simpleString()
    pieces = materialise(own.mapInArrow(_pieces, f"conv_id {conv}, {_PIECE}"))
    shape = f"conv_id {conv}, {TURNS if turns else REPORT}"
    closed = pieces.filter("closed").mapInArrow(lambda x: _closed(x, turns), shape)

    left = pieces.filter("NOT closed")
    place = ["key", "part", "piece"]
    each = materialise(left.select(*place, F.posexplode("shas").alias("i", "sha")))
    firsts = each.groupBy("key", "sha").agg(F.min(F.struct("part", "piece", "i")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select(F.struct("key", "sha").alias("both"), "first", "n")
    again = join_unique(each.withColumn("both", F.struct("key", "sha")), firsts, "both", each.count())
    again = again.filter(F.struct("part", "piece", "i") > F.col("first")).groupBy(*place).agg(F.collect_list("i").alias("again"))
    known = left.select(*place, "kinds", "faults").join(again, place, "left").mapInArrow(_matrices, _OPEN_SQL)
    ends = known.repartition("key").sortWithinPartitions("key", F.desc("part"), F.desc("piece")).mapInArrow(_backwards, _OPEN_SQL)
    walked = ends.repartition(*place).mapInArrow(_walks, "key string, part long, piece long, faults string, walks array<string>")
    whole = left.drop("faults", "shas", "closed").join(walked, place)
    chained = whole.repartition("key").sortWithinPartitions(*place).mapInArrow(lambda x: _chained(x, turns), shape)
    return closed.unionByName(chained)


def damage(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) with faults by crc32 of "conv_id:turn" modulo 20, nulls as one space, and present.

    0: the row goes (present is false), 1: its text goes, 2: its marks .!? go, 3: it is there twice, 4: its role is user.
    """
    string = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(string("conv_id"), F.lit(":"), string("turn")).cast("binary")) % 20
    damaged = rows.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(string("role")).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate(string("text"), ".!?", "")).otherwise(string("text")).alias("text"),
        (code != 0).alias("present"), F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return damaged.drop("copy")
