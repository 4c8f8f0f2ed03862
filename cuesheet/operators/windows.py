"""Tumbling windows over a recording's segments, frames and events.

A window is [k * width, (k + 1) * width). A frame or event is in the window of its time; a segment is in each window
that it overlaps: end > window start and start < window end, so one without length on an edge is in none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..functions.text import strip


def _check(width: float) -> None:
    if width <= 0:
        raise ValueError("the width of windows must be over 0")


def segment_members(segments: DataFrame, width: float = 45.0) -> DataFrame:
    """segments with a row for each window_ix that they are in."""
    _check(width)
    first = F.greatest(F.lit(0).cast("long"), F.floor(F.col("start") / width))
    # The last window starts before the end; a segment that ends on an edge is not in the window from there on.
    last = F.ceil(F.col("end") / width) - 1
    last = F.when(F.col("end") > F.col("start"), last).otherwise(F.when(F.col("end") > first * width, first))
    return segments.withColumn("__last", last).filter(F.col("__last") >= first).withColumn("window_ix", F.explode(F.sequence(first, F.col("__last")))).drop("__last")


def point_members(points: DataFrame, width: float = 45.0, ts: str = "timestamp") -> DataFrame:
    """points, those of time 0 or later, with their window_ix."""
    _check(width)
    return points.filter(F.col(ts) >= 0).withColumn("window_ix", F.floor(F.col(ts) / width))


def key_frames(frames: DataFrame, width: float = 45.0) -> DataFrame:
    """Each window's best frame: by quality, length of its text, confidence; of equal ones the first in seq."""
    members = point_members(frames, width)
    rank = F.struct(F.coalesce("quality_score", F.lit(0.0)).alias("a"), F.length(strip(F.coalesce("ocr_text", F.lit("")))).alias("b"), F.coalesce("avg_conf", F.lit(-1.0)).alias("c"), (-F.col("seq")).alias("d"))
    shape = F.struct("seq", "timestamp", "frame_path", "ocr_text", "avg_conf", "ocr_provider", "quality_score")
    return members.groupBy("video_id", "window_ix").agg(F.max_by(shape, rank).alias("key_frame"))


def build_windows(segments: DataFrame, frames: DataFrame, events: DataFrame | None = None, width: float = 45.0) -> DataFrame:
    """Every window of a recording that has a segment, frame or event.

    Returns video_id, window_ix, window_start, window_end, transcript_text (stripped texts that are not blank, joined
    by spaces in order of seq), segments, frames and events (arrays of structs in order of seq), key_frame,
    speakers_present, asr_providers, ocr_providers (sorted). Of frames their seq and six fields stay. A recording whose largest time is 0 has no windows. Lists
    are bounded by what a window of its width holds.
    """
    key = ["video_id", "window_ix"]
    late = [segments.select("video_id", F.col("end").alias("t")), frames.select("video_id", F.col("timestamp").alias("t"))]
    if events is not None:
        late.append(events.select("video_id", F.col("timestamp").alias("t")))
    times = late[0]
    for x in late[1:]:
        times = times.union(x)
    timed = times.groupBy("video_id").agg(F.max("t").alias("m")).filter("m > 0").select("video_id")

    brief = [x for x in ("timestamp", "frame_path", "ocr_text", "avg_conf", "ocr_provider", "quality_score") if x in frames.columns]
    frames = frames.select("video_id", "seq", *brief)

    def listed(members: DataFrame, name: str, *more) -> DataFrame:
        shape = F.struct("seq", *[x for x in members.columns if x not in ("video_id", "window_ix", "seq")])
        return members.groupBy(*key).agg(F.array_sort(F.collect_list(shape), lambda a, b: F.when(a["seq"] < b["seq"], -1).when(a["seq"] > b["seq"], 1).otherwise(0)).alias(name), *more)

    distinct = lambda x: F.sort_array(F.collect_set(F.when(F.col(x) != "", F.col(x))))
    out = listed(segment_members(segments, width), "segments", distinct("speaker").alias("speakers_present"), distinct("asr_provider").alias("asr_providers"))
    out = out.join(listed(point_members(frames, width), "frames", distinct("ocr_provider").alias("ocr_providers")), key, "full")
    out = out.join(key_frames(frames, width), key, "left")
    if events is not None:
        out = out.join(listed(point_members(events, width), "events"), key, "full")
    spoken = F.filter(F.transform("segments", lambda x: strip(F.coalesce(x["text"], F.lit("")))), lambda x: x != "")
    empty = F.array().cast("array<string>")
    return out.join(timed, "video_id", "left_semi").withColumns(
        {
            "window_start": round_to(F.col("window_ix") * width, 3),
            "window_end": round_to((F.col("window_ix") + 1) * width, 3),
            "transcript_text": F.coalesce(F.array_join(spoken, " "), F.lit("")),
            **{x: F.coalesce(x, empty) for x in ("speakers_present", "asr_providers", "ocr_providers")},
        }
    )
