"""Streaming forms of the windows: by event time, with late rows bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..functions.text import strip
from ..operators.windows import point_members, segment_members


def streaming_windows(points: DataFrame, width: str = "45 seconds", late: str = "2 minutes", kind: str = "kind") -> DataFrame:
    """points: video_id, at (TIMESTAMP), and what kind of point it is. A row for each recording, window and kind.

    State is one row of counts for each open window; a window closes, and in append mode is emitted, when the
    watermark passes its end.
    """
    grouped = points.withWatermark("at", late).groupBy("video_id", F.window("at", width).alias("w"), F.col(kind).alias("kind"))
    out = grouped.agg(F.count("*").alias("n"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    return out.select("video_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "kind", "n", "first_at", "last_at")


def streaming_build_windows(segments: DataFrame, frames: DataFrame, events: DataFrame, width: float = 45.0, late: str = "2 minutes") -> DataFrame:
    """As operators.windows.build_windows, over streams of segments, frames and events; emits a window once, when it is whole.

    A segment is dealt to each window that it overlaps. Within a window its time is its start or the window's, so a window
    is whole when the watermark passes its end: late has to cover how long after it begins a segment may come, which is its
    length at least. Members that come later are dropped. State is the members of the open windows. Segments need video_id,
    seq, start, end, speaker, text, asr_provider; frames video_id, seq, timestamp, frame_path, ocr_text, avg_conf,
    ocr_provider, quality_score; events video_id, seq, timestamp, event_type, payload. width is a multiple of a millisecond.
    """
    seconds = lambda x: F.timestamp_millis(F.floor(x * 1000).cast("long"))
    spoken = segment_members(segments, width)
    parts = {
        "segments": (spoken, F.greatest(F.col("start"), F.col("window_ix") * width), ["seq", "start", "end", "speaker", "text", "asr_provider"]),
        "frames": (point_members(frames, width), F.col("timestamp"), ["seq", "timestamp", "frame_path", "ocr_text", "avg_conf", "ocr_provider", "quality_score"]),
        "events": (point_members(events, width), F.col("timestamp"), ["seq", "timestamp", "event_type", "payload"]),
    }
    rows = None
    for name, (members, at, columns) in parts.items():
        own = members.select("video_id", "window_ix", seconds(at).alias("at"), F.struct(*columns).alias(name))
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)

    def listed(name: str) -> Column:
        # A struct's first field is seq, which orders the list; nulls are what other members lack.
        return F.sort_array(F.collect_list(name)).alias(name)

    distinct = lambda x: F.sort_array(F.collect_set(F.when(F.col(x) != "", F.col(x))))
    rank = F.struct(F.coalesce("frames.quality_score", F.lit(0.0)).alias("a"), F.length(strip(F.coalesce("frames.ocr_text", F.lit("")))).alias("b"), F.coalesce("frames.avg_conf", F.lit(-1.0)).alias("c"), (-F.col("frames.seq")).alias("d"))
    grouped = rows.withWatermark("at", late).groupBy("video_id", "window_ix", F.window("at", f"{round(width * 1000)} milliseconds").alias("w"))
    out = grouped.agg(
        *(listed(x) for x in parts),
        F.max_by("frames", F.when(F.col("frames").isNotNull(), rank)).alias("key_frame"),
        distinct("segments.speaker").alias("speakers_present"), distinct("segments.asr_provider").alias("asr_providers"), distinct("frames.ocr_provider").alias("ocr_providers"),
    )
    said = F.filter(F.transform("segments", lambda x: strip(F.coalesce(x["text"], F.lit("")))), lambda x: x != "")
    return out.select(
        "video_id", "window_ix", round_to(F.col("window_ix") * width, 3).alias("window_start"), round_to((F.col("window_ix") + 1) * width, 3).alias("window_end"),
        F.array_join(said, " ").alias("transcript_text"), *parts, "key_frame", "speakers_present", "asr_providers", "ocr_providers",
    )
