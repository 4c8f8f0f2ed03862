"""Mixing: targets by brute force, words kept by rounding, expected copies, and the whole query."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from pathlib import Path

import pytest
from llm_cases import COLUMNS, rows_of, sentence
from pyspark.sql import functions as F

from cuesheet.llm import mixing
from cuesheet.llm.queries import QUERIES

NAMES = ["doc_id", "size", "source_size", "target", "taken"]


def words(text: str | None) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight = {x: weights[i % len(weights)] for i, x in enumerate(names)}
    fixed: dict = {}
    while True:
        left = sum(sizes.values()) - sum(fixed.values())
        free = sum(weight[x] for x in names if x not in fixed)
        target = fixed | {x: left * weight[x] / free for x in names if x not in fixed}
        above = [x for x in names if target[x] > most * sizes[x] and x not in fixed]
        if not above:
            return target
        fixed |= {x: most * sizes[x] for x in above}


def hold(rows: list[tuple], got: list[tuple], most=3):
    """rows: (doc_id, text, source)."""
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
        largest[source] = max(largest[source], words(text))
    want = brute_targets(sizes, most=most)
    left = defaultdict(list)
    for doc, size, source_size, target, taken in got:
        assert taken % max(size, 1) == 0 and 0 <= taken <= most * size
        left[doc, size].append((source_size, target, taken))
    taken = defaultdict(int)
    for doc, text, source in rows:
        near = next(x for x in left[doc, words(text)] if x[0] == sizes[source] and abs(x[1] - want[source]) < 1e-6 * max(want[source], 1))
        left[doc, words(text)].remove(near)
        taken[source] += near[2]
        if near[1]:
            assert abs(near[2] - near[1] / near[0] * words(text)) < words(text) + 1e-6
    assert not any(left.values())
    for source, total in taken.items():
        assert abs(total - want[source]) <= largest[source] / 2 + 1e-6


def test_settle_keeps_words_and_expectations():
    rng = random.Random(5)
    for q in (0.0, 0.1, 0.5, 0.93, 1.0):
        sizes = sorted((rng.randrange(1, 50) for _ in range(12)), reverse=True) + [1]
        ups = [0.0] * len(sizes)
        for seed in range(3000):
            took, at, left = mixing.settle(sizes, q, random.Random(seed))
            assert set(took) <= {0, 1} and (at < 0 or 0 <= left <= 1 and took[at] == 0)
            assert sum(w * x for w, x in zip(sizes, took)) + (sizes[at] * left if at >= 0 else 0) == pytest.approx(q * sum(sizes))
            for i, x in enumerate(took):
                ups[i] += left if i == at else x
        assert max(abs(x / 3000 - q) for x in ups) < 0.05
    assert mixing.settle([7], 0.25, rng) == ([0], 0, 0.25)


def test_pair_ends_one():
    ups = [0.0, 0.0]
    for seed in range(3000):
        p, q = mixing.pair((10, 0.3), (4, 0.6), random.Random(seed))
        assert 10 * p + 4 * q == pytest.approx(5.4) and (p in (0.0, 1.0) or q in (0.0, 1.0))
        ups = [ups[0] + p, ups[1] + q]
    assert ups[0] / 3000 == pytest.approx(0.3, abs=0.02) and ups[1] / 3000 == pytest.approx(0.6, abs=0.04)


def test_odd_rows(clashing, empty):
    rows = [(x["doc_id"], x["text"], x["source"]) for x in clashing.collect()]
    rows += [(1, "one word less", None), (2, None, "none at all"), (3, "x " * 700, None), (4, "é Z", "Z"), (5, "a b c", "é")]
    docs = clashing.select("doc_id", "text", "source", "key", "n", "id").unionByName(clashing.sparkSession.createDataFrame(rows[-5:], "doc_id long, text string, source string"), allowMissingColumns=True)
    got = mixing.mix(docs)
    assert got.columns == NAMES
    hold(rows, [tuple(x) for x in got.collect()])
    assert rows_of(got) == rows_of(mixing.mix(docs.repartition(7)))
    assert mixing.mix(empty).collect() == []
    assert rows_of(mixing.mix(docs.filter("text is null or text = ''")), "taken") == [(0,)] * docs.filter("text is null or text = ''").count()


def test_blocks_tree_and_hot_source(spark, monkeypatch):
    for name, value in (("BLOCK", 8), ("FAN", 4), ("HELD", 16)):
        monkeypatch.setattr(mixing, name, value)
    rng = random.Random(3)
    rows = [(i, sentence(rng, rng.choice([0, 1, 3, 9, 40])), "hot" if i % 3 else f"s{i % 11}") for i in range(900)]
    rows += [(None, "the same row again", "hot")] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = [tuple(x) for x in mixing.mix(docs).collect()]
    hold(rows, got)
    # Words that the leaves keep and the tree's pairs pass on: only the last document of a source may be off.
    assert abs(sum(x[4] for x in got) - sum(x[1] for x in got)) <= 20 * 12
    monkeypatch.setattr(mixing, "FAN", 1024)
    assert len(mixing.mix(docs, weights=(1,), most=1).filter("taken <> size").collect()) == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="needs the test tables")
def test_query(spark):
    got = QUERIES["op11_mixing"](spark, "/root/testdata/sf0.001")
    rows = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source").collect()]
    hold(rows, [tuple(x) for x in got.select(NAMES).collect()])
    assert COLUMNS and got.filter(F.col("taken") > 3 * F.col("size")).count() == 0
