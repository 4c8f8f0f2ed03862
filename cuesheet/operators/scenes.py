"""Scene changes over a table of decoded frames, in which images are compared where they are.

Frames are in ranges of (recording, time), as a table of them is stored. A task compares each image with the one before
in its range; of each range only the first and the last image are handed on, to be compared across ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import scratch_root, small_batches, tasks
from .blocks import previous, with_block
from .images import IMAGE, difference, ratio

#: A change is in percent of 256 levels, and from which score on a frame is a scene change.
LEVELS, THRESHOLD = 256, 0.25
#: Seconds of the blocks in which a frame's change is compared with the one before.
BLOCK = 600.0


def _change(before: dict, now: dict) -> float:
    """The mean difference of two images' pixels over their common size, in percent of LEVELS; 0 if one is empty."""
    total, n = difference(before, now)
    return float(total) * 100.0 / n / LEVELS if n else 0.0


def _in_ranges(batches: Iterator[pa.RecordBatch], measure: Callable[[dict, dict], float]) -> Iterator[pa.RecordBatch]:
    """Of rows in order, an image the last of their columns: each one's change, null for a recording's first row in the task.

    The image stays with the task's first row, marked as open, and its last one: no others have neighbours elsewhere.
    """
    held: tuple | None = None
    schema, n = None, 0

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], kind) for i, kind in enumerate(schema.types)], schema=schema)

    for batch in batches:
        if schema is None:
            n = batch.num_columns - 1
            schema = pa.schema([*(batch.schema.field(i) for i in range(n)), ("change", pa.float64()), ("open", pa.bool_()), batch.schema.field(n).with_nullable(True)])
        rows = []
        for *own, image in zip(*(x.to_pylist() for x in batch.columns)):
            if held:
                rows.append((*held[:-1], held[-1] if held[-2] else None))
            change = measure(held[-1], image) if held and held[0] == own[0] else None
            held = (*own, change, held is None, image)
        yield out(rows)
    if held:
        yield out([held])


def compared(frames: DataFrame, order: list[str], measure: Callable[[dict, dict], float], ordered: bool = False, decode: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """video_id, order's columns, change of frames: measure of the image before and its own, null for a recording's first frame.

    frames have images, or decode adds them to rows that are in ranges of (video_id, order) by then, so that no image is
    shuffled but two for each part. ordered: each part of frames is such a range, in order, as in a table written so.
    """
    spark = frames.sparkSession
    scratch_root(spark)
    small_batches(spark)
    keys = ["video_id", *order]
    own = frames if ordered else frames.repartitionByRange(tasks(spark), *keys).sortWithinPartitions(*keys)
    own = (decode(own) if decode else own).select(*keys, "image")
    kinds = ", ".join(f"`{x}` {frames.schema[x].dataType.simpleString()}" for x in keys)
    shape = ", ".join(x.replace(" ", ": ") for x in IMAGE.split(", "))
    marked = own.mapInArrow(lambda x: _in_ranges(x, measure), f"{kinds}, change double, open boolean, image struct<{shape}>").checkpoint()
    edges = marked.filter("image IS NOT NULL OR open").withColumn("before", F.lag(F.struct("image")).over(Window.partitionBy("video_id").orderBy(*order)))

    @F.pandas_udf("double")
    def across(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
        return pd.Series([measure(x, y) for x, y in zip(a.to_dict("records"), b.to_dict("records"))], dtype="float64")

    joined = edges.filter("open").select(*keys, F.when(F.col("before").isNotNull(), across("before.image", "image")).alias("change"))
    return marked.filter("NOT open").select(*keys, "change").unionByName(joined)


def image_changes(frames: DataFrame, ordered: bool = False, decode: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """video_id, timestamp, seq, change of frames (video_id, timestamp, seq, image): null for a recording's first frame.

    ordered, decode: see compared. Frames without a time or an image go.
    """

    def with_images(own: DataFrame) -> DataFrame:
        return (decode(own) if decode else own).filter("image.data IS NOT NULL")

    return compared(frames.filter("timestamp IS NOT NULL"), ["timestamp", "seq"], _change, ordered, with_images)


def pixel_deltas(frames: DataFrame, ordered: bool = False, decode: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """video_id, seq, delta: images.ratio of each frame (video_id, seq, image) and the one before by seq; 0 for the first."""
    return compared(frames, ["seq"], ratio, ordered, decode).select("video_id", "seq", F.coalesce("change", F.lit(0.0)).alias("delta"))


def scene_scores(changes: DataFrame) -> DataFrame:
    """changes with score, 0 to 1: the lesser of a frame's change and how much it differs from the change before; 0 for the first."""
    blocked = with_block(changes, "timestamp", BLOCK, "block")
    compared = previous(blocked, "video_id", "block", ["timestamp", "seq"], F.coalesce("change", F.lit(0.0)), "last")
    own = F.coalesce("change", F.lit(0.0))
    score: Column = F.least(own, F.abs(own - F.coalesce("last", F.lit(0.0))), F.lit(100.0)) / 100.0
    return compared.withColumn("score", score).drop("last", "block")


def scene_changes(frames: DataFrame, threshold: float = THRESHOLD, ordered: bool = False, decode: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """video_id, timestamp, seq, score of the frames whose score is above threshold, not at it."""
    return scene_scores(image_changes(frames, ordered, decode)).filter(F.col("score") > threshold).select("video_id", "timestamp", "seq", "score")
