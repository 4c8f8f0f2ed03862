"""Scene changes over ranges of decoded frames."""

from __future__ import annotations

import random

import pytest

from cuesheet.operators import scenes

SCHEMA = "video_id long, timestamp double, seq long, image struct<height: int, width: int, data: binary>"


def shots(n: int, levels) -> list[tuple]:
    return [(1, i / 2, i, (4, 5, bytes([levels[i]]) * 20)) for i in range(n)] + [(2, 0.0, 0, (4, 5, bytes(20))), (3, None, 0, (4, 5, bytes(20))), (3, 1.0, 1, None)]


def plain(levels) -> list[float]:
    changes = [0.0] + [abs(a - b) * 100 / 256 for a, b in zip(levels, levels[1:])]
    return [min(c, abs(c - p)) / 100 for p, c in zip([0.0, *changes], changes)]


@pytest.mark.parametrize("ordered", [False, True])
def test_scores_over_ranges(spark, monkeypatch, ordered):
    monkeypatch.setattr(scenes, "BLOCK", 7.0)
    rng = random.Random(4)
    levels = [rng.choice([0, 10, 100, 200, 255]) for _ in range(60)]
    df = spark.createDataFrame(shots(60, levels), SCHEMA)
    df = df.coalesce(1).sortWithinPartitions("video_id", "timestamp") if ordered else df.repartition(5)
    changes = scenes.image_changes(df, ordered)
    got = {(x["video_id"], x["seq"]): x["score"] for x in scenes.scene_scores(changes).collect()}
    assert [got.pop((1, i)) for i in range(60)] == pytest.approx(plain(levels)) and got == {(2, 0): 0.0}


def test_threshold_is_strict_and_sizes_may_differ(spark):
    rows = [(1, 0.0, 0, (2, 2, bytes(4))), (1, 1.0, 1, (2, 2, bytes([64] * 4))), (1, 2.0, 2, (1, 3, bytes([64] * 3))), (1, 3.0, 3, (0, 0, b""))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [x["score"] for x in scenes.scene_changes(df, 0.2).collect()] == [0.25]
    assert scenes.scene_changes(df, 0.25).collect() == []
    assert scenes.scene_changes(df.limit(0)).collect() == []
