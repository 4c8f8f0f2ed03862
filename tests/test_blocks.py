"""Order-dependent operators over blocks of one long recording."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cuesheet.operators import blocks, scan


def greedy(times, epsilon, strict=True):
    kept = []
    for t in sorted(times):
        if not kept or (t - kept[-1] > epsilon if strict else t - kept[-1] >= epsilon):
            kept.append(t)
    return kept


@pytest.mark.parametrize("strict", [True, False])
def test_maps_of_blocks_compose(strict):
    rng = random.Random(1)
    for _ in range(200):
        epsilon = rng.choice([0.1, 0.2, 0.3, 1.0])
        times = sorted(round(rng.uniform(0, 8), 1) for _ in range(rng.randrange(1, 60)))
        want = greedy(times, epsilon, strict)
        last = None
        for block in range(5):
            own = np.unique([x for x in times if 2 * block <= x < 2 * block + 2])
            if not len(own):
                continue
            upto, result = blocks.spacing(own, epsilon, strict)
            before = [x for x in want if x < own[0]]
            assert last == (before[-1] if before else None)
            if last is None:
                last = result[0]
            else:
                at = blocks.beyond(np.array(upto), last, epsilon, strict)
                last = result[at] if at < len(result) else last
        assert last == want[-1]


@pytest.mark.parametrize("strict", [True, False])
def test_one_long_recording_in_many_blocks(spark, strict):
    rng = random.Random(2)
    rows = [(1, round(rng.uniform(0, 900), 2), i, "x") for i in range(6000)] + [(1, round(i * 0.15, 2), 10_000 + i, "x") for i in range(2000)]
    rows += [(2, 5.0, i, "x") for i in range(5)] + [(3, None, 0, "x"), (3, float("nan"), 1, "x")]
    df = spark.createDataFrame(rows, "video_id long, timestamp double, seq long, block string")
    got = scan.keep_spaced(df, 0.2, strict=strict, width=7.0)
    assert got.columns == df.columns
    own = [x for x in rows if x[0] == 1]
    assert sorted(x["timestamp"] for x in got.filter("video_id = 1").collect()) == greedy([x[1] for x in own], 0.2, strict)
    assert [(x["seq"], x["timestamp"]) for x in got.filter("video_id > 1").collect()] == [(0, 5.0)]
    first = {}
    for _, t, seq, _ in own:
        first[t] = min(seq, first.get(t, seq))
    assert all(x["seq"] == first[x["timestamp"]] for x in got.filter("video_id = 1").collect())


def test_recordings_are_spread_over_tasks(spark):
    df = spark.range(40_000).select(F.lit(1).alias("video_id"), (F.col("id") / 10).alias("timestamp"), F.col("id").alias("seq"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = scan.keep_spaced(df, 0.25, width=100.0).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(parts) > 1 and sum(x["count"] for x in parts) == 13_334


HASHED = "video_id long, timestamp double, seq long, frame_path string, hash_hi long, hash_lo long, level double"


def frames(kind: str) -> list[tuple]:
    """islands: pauses part the recording. still: one picture all the time, so what is kept has a phase. random: a few pictures."""
    rng = random.Random(kind)
    rows, t = [], 0.0
    for i in range(600):
        t += {"islands": rng.choice([0.3, 0.5, 4.0]), "still": 0.7, "random": rng.choice([0.2, 0.4])}[kind]
        picture = {"islands": rng.randrange(3), "still": 0, "random": rng.randrange(6)}[kind]
        own = (None, None) if rng.random() < 0.05 else (picture * 4097, picture * 77)
        rows.append((1, round(t, 2), i, f"f{i}", *own, rng.choice([0.0, 0.0, 1.0])))
    return rows + [(2, 1.0, 0, "g0", 5, 5, 0.0), (2, 1.5, 1, "g1", 5, 5, 0.0)]


@pytest.mark.parametrize("kind", ["islands", "still", "random"])
@pytest.mark.parametrize("delta", [False, True])
def test_suppression_by_blocks_is_the_scan(spark, monkeypatch, kind, delta):
    df = spark.createDataFrame(frames(kind), HASHED)
    more = {"delta": lambda row, kept: abs(row["level"] - kept["level"]), "delta_columns": ("level",)} if delta else {}
    whole = sorted(map(tuple, scan.suppress_near_duplicates(df, 2.0, 6, **more).collect()), key=repr)
    monkeypatch.setattr(scan, "LONG", 10)
    monkeypatch.setattr(scan, "BLOCK", 25.0)
    parts = scan.suppress_near_duplicates(df, 2.0, 6, **more)
    assert sorted(map(tuple, parts.collect()), key=repr) == whole
    assert {x[7] for x in whole} == {"kept", "dropped"}


def test_places_and_order_statistics(spark, monkeypatch):
    from cuesheet.operators import frames as policy
    from cuesheet.operators import report

    monkeypatch.setattr(policy, "BLOCK", 3.0)
    rng = random.Random(8)
    times = [(v, rng.choice([round(rng.uniform(0, 40), 1), 5.0]), i) for v in range(3) for i in range([1, 6, 170][v])]
    df = spark.createDataFrame([(*x, "z") for x in times] + [(5, None, 0, "z")], "video_id long, timestamp double, seq long, place string")
    for most in (1, 5, 50):
        want = []
        for v in range(3):
            own = sorted(x for x in times if x[0] == v)
            want += own[:: max(1, len(own) // most)][:most]
        got = policy.systematic_sample(df, most)
        assert got.columns == df.columns and sorted(tuple(x)[:3] for x in got.filter("video_id < 5").collect()) == sorted(want)
    segs = spark.createDataFrame([(v, 1.0, 1.0 + t) for v, t, _ in times] + [(7, 1.0, None)], "video_id long, start double, end double")
    got = {x["video_id"]: (x["segment_count"], x["p95_segment_duration_sec"]) for x in report.p95_durations(segs).collect()}
    for v in range(3):
        own = sorted(1.0 + t - 1.0 for x, t, _ in times if x == v)
        assert got[v] == (len(own), own[int(0.95 * (len(own) - 1))])
    assert got[7] == (1, None)


def test_a_wrong_end_makes_no_more_buckets_than_there_are(spark):
    from cuesheet.operators import align

    segs = spark.createDataFrame([(1, 0, 0.0, 1e9, "x"), (1, 1, -1e9, -1e8, "x"), (2, 0, 0.0, 1e9, "x")], "video_id long, seq long, start double, end double, b string")
    shots = spark.createDataFrame([(1, i, float(i * 7)) for i in range(40)], "video_id long, seq long, timestamp double")
    pairs = align.in_range_pairs(segs, shots, 10.0)
    assert pairs.columns == [*segs.columns, "frame"] and pairs.count() == 40
