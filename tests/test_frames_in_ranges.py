"""Frames that are decoded where they are needed: no image is shuffled, few are held at a time."""

from __future__ import annotations

import pyarrow as pa

from cuesheet.operators import scenes
from cuesheet.scratch import BATCH_ROWS



def test_only_a_parts_first_and_last_image_are_handed_on():
    n = 60
    shape = [("height", pa.int32()), ("width", pa.int32()), ("data", pa.binary())]
    own = pa.array([{"height": 1, "width": 1, "data": bytes([i])} for i in range(n)], pa.struct(shape))
    batch = pa.RecordBatch.from_arrays([pa.array([i // 2 for i in range(n)]), pa.array(range(n)), own], ["video_id", "seq", "image"])
    out = pa.Table.from_batches(scenes._in_ranges(iter([batch.slice(0, 7), batch.slice(7)]), scenes._change)).to_pylist()
    assert [x["seq"] for x in out if x["image"]] == [0, n - 1] and [x["seq"] for x in out if x["open"]] == [0]
    assert [x["change"] for x in out] == [None if i % 2 == 0 else 100 / 256 for i in range(n)]


def test_batches_of_images_are_small(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    scenes.image_changes(spark.createDataFrame([], "video_id long, timestamp double, seq long, image struct<height: int, width: int, data: binary>"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == BATCH_ROWS
