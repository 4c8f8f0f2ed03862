"""Conversation repair against enumeration of all edits, and the whole query against a plain version."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache
from pathlib import Path

import pytest
from llm_cases import CLASHING, rows_of, sentence
from pyspark.sql import functions as F

from cuesheet.llm import conversations
from cuesheet.llm.queries import QUERIES

SPACE = "\x20\t\n\x0b\x0c\r"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def faults_of(rows: list[tuple[str, str]]) -> str:
    seen, out = set(), ""
    for role, text in rows:
        own = text.strip(SPACE)
        out += "b" if not own else "d" if (role, text) in seen else "." if own[-1] in ".!?" else "t"
        seen.add((role, text))
    return out


def cheapest(rows: list[tuple[str, str]], faults: str) -> tuple[int, str, list[str]]:
    """All edits of all rows with up to two turns inserted at each place, tried one by one; initials by the pattern."""

    def short(initials: str) -> str | None:
        """What may still become the pattern, without whole pairs after the first; None if nothing may."""
        return re.sub(r"(ua)+(?=uau?$)", "", initials) if re.fullmatch(r"s?(ua)*u?", initials) else None

    @lru_cache(None)
    def best(i: int, so_far: str | None, inserted: int):
        if so_far is None:
            return None
        found = [(0, "", ())] if i == len(rows) and GRAMMAR.fullmatch(so_far) else []
        for role in ("user", "assistant") if inserted < 3 else ():
            if again := best(i, short(so_far + role[0]), inserted + 1):
                found.append((3 + again[0], "I" + again[1], (f"{role}:", again[2])))
        if i < len(rows):
            role, text = rows[i]
            more = 3 if faults[i] == "t" else 0
            options = [("D", 4, None)]
            if faults[i] not in "bd":
                options += [("K", more, role), ("R", 3 + more, "user"), ("R", 3 + more, "assistant")]
            for label, cost, new in options:
                if again := best(i + 1, short(so_far + (new or "")[:1]), 0):
                    found.append((cost + again[0], label + again[1], again[2] if new is None else (f"{new}:{text}", again[2])))
        return min(found, default=None)

    for i in range(len(rows), 0, -50):
        for so_far in ("", "s", "u", "su", "ua", "sua", "uau", "suau"):
            best(i, so_far, 0)
    cost, audit, lines = best(0, "", 0)
    out = []
    while lines:
        out.append(lines[0])
        lines = lines[1]
    return cost, audit, out


def plain(rows: list[tuple]) -> dict:
    """rows: (conv_id, turn, role, text, present), nulls already replaced but those of conv_id and turn."""
    convs: dict = defaultdict(list)
    for conv, turn, role, text, present in rows:
        convs[conv] += [(turn, role, text)] if present else []
    out = {}
    for conv, own in convs.items():
        sha = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], sha(*x[1:])))
        turns = {x for x, _, _ in own if x is not None}
        pairs = [x[1:] for x in own]
        faults = faults_of(pairs)
        initials = [x[:1] for x, _ in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, lines = cheapest(pairs, faults)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *(faults.count(x) for x in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def odd_conversations(rng: random.Random, n: int = 60) -> list[tuple]:
    """Nulls everywhere, roles of all kinds, ties, repeats, blanks, missing marks."""
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.choice([1, 2, 4, 6, 9])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "sys"])
            text = rng.choice([None, "", " \t", "yes", "no.", "Why?", sentence(rng, 5) + ".", sentence(rng, 3)])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), role, text))
            if rng.random() < 0.2:
                rows.append(rows[-1])
    return rows


def full(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x, True) for c, t, r, x in rows]


def got_of(df) -> dict:
    return {x[0]: tuple(x[1:]) for x in df.collect()}


SCHEMA = "conv_id long, turn long, role string, text string"


def test_paths_against_all_label_strings():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randrange(0, 4)
        kinds, faults = "".join(rng.choice("suae-") for _ in range(n)), "".join(rng.choice("..tbd") for _ in range(n))
        role = {"s": "sys", "u": "user", "a": "assistant", "e": "", "-": "tool"}
        want = cheapest([(role[x], str(i)) for i, x in enumerate(kinds)], faults)
        to_go = conversations.costs_to_go(kinds, faults, conversations.END)
        labels, state = conversations.walk(kinds, faults, to_go, conversations.START)
        tail = {conversations.SYSTEM: "II", conversations.USER: "I"}.get(state, "")
        assert (to_go[0][0], labels + tail) == want[:2]
        # Matrices of any two parts compose to the cost of the whole.
        for cut in range(n + 1):
            a, b = (conversations.matrix(kinds[x], faults[x]) for x in (slice(0, cut), slice(cut, n)))
            end = [min(b[4 * i + j] + conversations.END[j] for j in range(4)) for i in range(4)]
            assert min(a[j] + end[j] for j in range(4)) == to_go[0][0]


@pytest.mark.parametrize("piece", [1, 3, 4096])
def test_odd_rows(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE_ROWS", piece)
    rows = odd_conversations(random.Random(piece))
    df = spark.createDataFrame(rows, SCHEMA).withColumns({x: F.lit("x") for x in CLASHING}).repartition(3)
    got = conversations.repair(df)
    assert got.columns == ["conv_id", *(x.split()[0] for x in conversations.REPORT.split(", "))]
    want = plain(full(rows))
    assert got_of(got) == want and got.count() == len(want)
    turns = defaultdict(list)
    for conv, seq, edit, role, text in sorted((tuple(x) for x in conversations.repair(df, turns=True).collect()), key=lambda x: (repr(x[0]), x[1])):
        assert seq == len(turns[conv]) and edit in "KRI"
        turns[conv].append(f"{role}:{text}")
    for conv, report in want.items():
        assert hashlib.sha256("\n".join(turns[conv]).encode()).hexdigest() == report[-1]


def test_hot_long_and_empty(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE_ROWS", 16)
    monkeypatch.setattr(conversations, "PIECE_CHARS", 2000)
    rng = random.Random(9)
    hot = [(7, i // 2, rng.choice(["user", "assistant"]), rng.choice(["again.", sentence(rng, 4), sentence(rng, 9) + "!"])) for i in range(400)]
    rows = hot + odd_conversations(rng, 40) + [(1000, 0, "user", "x " * 60_000 + "."), (1000, 1, "assistant", "y " * 60_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got_of(conversations.repair(df)) == plain(full(rows))
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(empty).collect() == [] and conversations.repair(empty, turns=True).collect() == []
    gone = conversations.repair(df.withColumn("present", F.lit(False)), F.col("present"))
    assert set(got_of(gone).values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())} and gone.count() == df.select("conv_id").distinct().count()


def damaged(rows) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if code == 1 else re.sub(r"[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text, code != 0)] * (2 if code == 3 else 1)
    return out


def test_damage(spark):
    rows = odd_conversations(random.Random(4), 80)
    got = conversations.damage(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(got) == sorted(damaged(rows), key=repr)


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="needs the test tables")
def test_query(spark):
    rows = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = got_of(QUERIES["op13_conversation_repair"](spark, "/root/testdata/sf0.01"))
    assert got == plain(damaged(rows)) and got.keys() == {x[0] for x in rows}
