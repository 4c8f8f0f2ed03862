from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cuesheet.operators import scenes

SCHEMA = "video_id long, seq long, image struct<height: int, width: int, data: binary>"


def test_deltas_across_parts(spark):
    rows = [(k, i, (2, 2, bytes([(i * 37 + k) % 256] * 4))) for k in range(3) for i in range(40)]
    rows += [(7, 0, None), (7, 1, (1, 1, b"a")), (7, 2, (0, 0, b"")), (8, 0, (2, 2, bytes(4))), (8, 1, (1, 3, bytes([51] * 3)))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {(x["video_id"], x["seq"]): x["delta"] for x in scenes.pixel_deltas(df).collect()}
    level = lambda k, i: (i * 37 + k) % 256
    want = {(k, i): abs(level(k, i) - level(k, i - 1)) / 255 if i else 0.0 for k in range(3) for i in range(40)}
    assert got == pytest.approx(want | {(7, 0): 0.0, (7, 1): 0.0, (7, 2): 0.0, (8, 0): 0.0, (8, 1): 0.2})
    assert scenes.pixel_deltas(df.limit(0)).collect() == []


def test_frames_are_in_ranges_before_they_are_decoded(spark):
    seen = []

    def decode(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.withColumn("image", F.struct(F.lit(1).alias("height"), F.lit(1).alias("width"), F.lit(b"a").alias("data")))

    frames = spark.createDataFrame([(1, 0), (1, 1)], "video_id long, seq long")
    assert [x["delta"] for x in scenes.pixel_deltas(frames, decode=decode).collect()] == [0.0, 0.0]
    assert "RepartitionByExpression" in seen[0] and "Sort" in seen[0]
