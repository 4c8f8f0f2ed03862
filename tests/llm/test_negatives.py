"""Hard negatives against a plain version with whole numbers, and the query against its SQL."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from llm_cases import CLASHING
from pyspark.sql import functions as F

from cuesheet.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=50, k=5, m=3, low=50, high=95):
    kept = []
    for vec, own, label in rows:
        if label is None or own is None or any(x is None or not math.isfinite(x) for x in own):
            continue
        kept.append((vec, [math.floor(256 * float(np.float32(x))) for x in own], label))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    last = lambda x: (x is None, x or 0)
    for i, (vec, own, label) in enumerate(kept):
        if vec is None or vec % every:
            continue
        scored = [(-dot(own, other), last(v), v, c == label) for j, (v, other, c) in enumerate(kept) if j != i]
        scored.sort(key=lambda x: x[:2])
        for s, _, positive, _ in [x for x in scored if x[3]][:k]:
            fits = [(-t, v) for t, _, v, alike in scored if not alike and low * -s <= 100 * -t <= high * -s][:m]
            out += [(vec, positive, n + 1, v, -s, t) for n, (t, v) in enumerate(fits)]
    return sorted(out, key=repr)


def got(df, every=50, **options):
    out = negatives.hard_negatives(df, F.col("vec_id") % every == 0, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(x) for x in out.collect()), key=repr)


def vectors(rng: random.Random, n: int, d: int, labels: int, hot: float = 0.3):
    """Clusters by label, many copies of one vector, one label with a third of all rows."""
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(labels)]
    one = [rng.gauss(0, 1) for _ in range(d)]
    rows = []
    for i in range(n):
        label = 0 if rng.random() < hot else rng.randrange(labels)
        own = one if i % 9 == 0 else [x + rng.gauss(0, 0.8) for x in centres[label]]
        rows.append((i, own, label))
    return rows


@pytest.mark.parametrize("tiles", [False, True])
def test_against_plain(spark, monkeypatch, tiles):
    if tiles:
        for name, value in (("ROWS_BYTES", 8 * 6 * 90), ("ANCHORS_BYTES", 8 * 6 * 20), ("ANCHOR_BLOCK", 7), ("ROW_BLOCK", 16)):
            monkeypatch.setattr(negatives, name, value)
    rng = random.Random(6)
    rows = vectors(rng, 700, 6, 5)
    rows += [(None, [1.0] * 6, 1), (None, [0.5] * 6, 2), (10, rows[10][1], 3), (20, rows[21][1], None), (30, None, 1), (31, [1.0, None, 2.0, 1.0, 1.0, 1.0], 1)]
    rows += [(40, [float("nan")] * 6, 1), (41, [float("inf")] * 6, 1), (50, [], 2), (60, [3.0, -1.0], 2), (70, [-2.0] * 6, 9), (80, rows[80][1], 0), (80, rows[80][1], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({x: F.lit("x") for x in CLASHING if x != "id"}).repartition(3)
    assert got(df, every=10) == plain(rows, every=10)


def test_large_components_and_small_tables(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, 1.0]) * 2.0 ** rng.randrange(24, 31), float(rng.randrange(9)), 1.0], i % 3) for i in range(40)]
    rows = [(i, [x if abs(x) < 2**22 else x / 2**8 for x in own], label) for i, own, label in rows]
    assert got(spark.createDataFrame(rows, SCHEMA), every=5) == plain(rows, every=5)
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(0, [1.0], 1)], SCHEMA)) == []
    assert got(spark.createDataFrame([(0, [0.0], 1), (1, [0.0], 1), (2, [0.0], 2)], SCHEMA)) == [(0, 1, 1, 2, 0, 0)]
    huge = [(0, [1e30], 1), (1, [1e30], 1), (2, [1e30], 2)]
    assert got(spark.createDataFrame(huge, SCHEMA)) == []


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for scale in (1, 10**4, 10**7):
        x = rng.integers(-scale, scale, (60, 16)) * np.r_[np.full(4, 20), np.full(12, 1)]
        rotation = negatives.Rotation((x.T @ x).astype(float))
        turned, rest = rotation.turn(x)
        exact = x @ x.T
        for k, own in zip(rotation.steps, rest):
            part = turned[:, :k] @ turned[:, :k].T
            assert k < 16 and (np.abs(part - exact) <= np.outer(own, own)).all()
