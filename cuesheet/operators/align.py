"""Alignment of transcript segments with frames: scored interval joins, nearest and as-of joins.

Segments: video_id, seq, start, end, and more. Frames: video_id, seq, timestamp, frame_path, ocr_provider,
quality_score, and more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..names import fresh

LEAST_GAP = 1e-6


def overlap_distance(start: Column, end: Column, ts: Column) -> Column:
    """How far a point is outside an interval."""
    return F.greatest(start - ts, ts - end, F.lit(0.0))


def attach_score(start: Column, end: Column, ts: Column, quality: Column, max_gap: float) -> Column:
    """Half for how near the frame is to the segment, 0.3 for how near to its middle, 0.2 for the frame's quality."""
    gap = max(max_gap, LEAST_GAP)
    near = 1.0 - F.least(F.lit(1.0), overlap_distance(start, end, ts) / gap)
    middle = 1.0 - F.least(F.lit(1.0), F.abs(ts - (start + end) / 2.0) / gap)
    return near * 0.5 + middle * 0.3 + F.coalesce(quality, F.lit(0.0)) * 0.2


def in_range_pairs(segments: DataFrame, frames: DataFrame, max_gap: float = 10.0, bucket: float | None = None) -> DataFrame:
    """Pairs of a segment and a frame in [start - max_gap, end + max_gap]: the segment's columns, frame (a struct).

    Time is cut into buckets: a segment goes to each that its range meets, a frame to its own, and recording and
    bucket are the join's keys, so a long recording is spread over many tasks. A segment has no buckets before the first
    or after the last frame of its recording, so one with a wrong end has no more than there are.
    """
    width = bucket or max(2 * max_gap, 10.0)
    b, first, last = fresh(segments.columns + ["frame"], "b", "first", "last")
    low, high = F.floor((F.col("start") - max_gap) / width), F.floor((F.col("end") + max_gap) / width)
    right = frames.filter("timestamp is not null").select("video_id", F.floor(F.col("timestamp") / width).alias(b), F.struct(*[x for x in frames.columns if x != "video_id"]).alias("frame"))
    ends = right.groupBy("video_id").agg(F.min(b).alias(first), F.max(b).alias(last))
    left = segments.filter("start is not null and end >= start").join(ends, "video_id").filter((low <= F.col(last)) & (high >= F.col(first)))
    left = left.withColumn(b, F.explode(F.sequence(F.greatest(low, F.col(first)), F.least(high, F.col(last))))).drop(first, last)
    inside = F.col("frame.timestamp").between(F.col("start") - max_gap, F.col("end") + max_gap)
    return left.join(right, ["video_id", b]).filter(inside).drop(b)


def top_candidates(segments: DataFrame, frames: DataFrame, max_gap: float = 10.0, k: int = 3) -> DataFrame:
    """Each segment's k (1 at least) best frames in range: its columns, frame, score, rank from 1.

    By falling score, then quality; of equal ones the earlier frame comes first, then the smaller seq.
    """
    scored = in_range_pairs(segments, frames, max_gap).withColumn("score", attach_score(F.col("start"), F.col("end"), F.col("frame.timestamp"), F.col("frame.quality_score"), max_gap))
    order = [F.desc("score"), F.desc(F.coalesce("frame.quality_score", F.lit(0.0))), "frame.timestamp", "frame.seq"]
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("video_id", "seq").orderBy(*order)))
    return ranked.filter(F.col("rank") <= max(1, int(k)))


def prev_next(segments: DataFrame, frames: DataFrame, bucket: float = 300.0) -> DataFrame:
    """Each segment with the last frame before its middle (prev) and the first at or after it (next), as structs.

    Both tables are put in one order of time, in which a segment's middle comes before a frame of the same time; of
    frames of one time the largest seq is prev and the smallest is next. Frames without a time are none of them.

    Time is cut into buckets, each ordered by itself, so a long recording is spread over tasks. What is before and
    after a bucket comes from the first and last frame of the others, a row a bucket.
    """
    shape = F.struct(*[x for x in frames.columns if x != "video_id"])
    points = frames.filter("timestamp is not null").select("video_id", F.col("timestamp").alias("__t"), F.lit(1).alias("__kind"), F.col("seq").alias("__seq"), shape.alias("__frame"), F.lit(None).cast(segments.drop("video_id").schema).alias("__segment"))
    middles = segments.select("video_id", ((F.col("start") + F.col("end")) / 2.0).alias("__t"), F.lit(0).alias("__kind"), F.col("seq").alias("__seq"), F.lit(None).cast(points.schema["__frame"].dataType).alias("__frame"), F.struct(*[x for x in segments.columns if x != "video_id"]).alias("__segment"))
    both = points.unionByName(middles).withColumn("__b", F.floor(F.col("__t") / bucket))
    past = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("video_id", "__b")
    prev = F.last("__frame", ignorenulls=True).over(past(own.orderBy("__t", "__kind", "__seq")))
    # Read backwards, the first frame ahead is the last one seen.
    following = F.last("__frame", ignorenulls=True).over(past(own.orderBy(F.desc("__t"), F.desc("__kind"), F.desc("__seq"))))
    inside = both.withColumns({"prev": prev, "next": following}).filter("__kind = 0")
    at = F.when(F.col("__kind") == 1, F.struct("__t", "__seq"))
    edges = both.groupBy("video_id", "__b").agg(F.min_by("__frame", at).alias("__first"), F.max_by("__frame", at).alias("__last"))
    buckets = Window.partitionBy("video_id")
    carried = edges.select("video_id", "__b", F.last("__last", ignorenulls=True).over(past(buckets.orderBy("__b"))).alias("__before"), F.last("__first", ignorenulls=True).over(past(buckets.orderBy(F.desc("__b")))).alias("__after"))
    found = inside.join(carried, ["video_id", "__b"], "left")
    return found.select("video_id", "__segment.*", F.coalesce("prev", "__before").alias("prev"), F.coalesce("next", "__after").alias("next"))


def nearest(segments: DataFrame, frames: DataFrame, max_gap: float = 10.0) -> DataFrame:
    """Each segment with the frame nearest to its middle, if within max_gap: its columns, frame, score.

    Of two equally near the earlier; of frames of one time the smallest seq.
    """
    # For equal times prev must be the smallest seq as well, so one frame stands for each time.
    first = F.row_number().over(Window.partitionBy("video_id", "timestamp").orderBy("seq"))
    (n,) = fresh(frames.columns, "n")
    single = frames.withColumn(n, first).filter(F.col(n) == 1).drop(n)
    middle = (F.col("start") + F.col("end")) / 2.0
    placed = prev_next(segments, single).withColumns({"__p": middle - F.col("prev.timestamp"), "__q": F.col("next.timestamp") - middle})
    frame = F.when(F.col("__q").isNull() | (F.col("__p") <= F.col("__q")), F.col("prev")).otherwise(F.col("next"))
    gap = F.least("__p", "__q")
    within = F.coalesce(gap <= max_gap, F.lit(False))
    return placed.select(*segments.columns, F.when(within, frame).alias("frame"), F.when(within, 1.0 - F.least(F.lit(1.0), gap / max(max_gap, LEAST_GAP))).alias("score"))


def build_dataset(segments: DataFrame, frames: DataFrame, max_gap: float = 10.0, k: int = 3, mode: str = "overlap_topk") -> DataFrame:
    """Every segment with its attached frame, the candidates and the frames before and after its middle.

    Frames with ocr (full_text, crops: their records) or with ocr_text give frame_ocr_text too, and with ocr frame_ocr_crops.
    """
    key = ["video_id", "seq"]
    if mode == "overlap_topk":
        best = top_candidates(segments.select(*key, "start", "end"), frames, max_gap, k)
    elif mode == "nearest":
        best = nearest(segments.select(*key, "start", "end"), frames, max_gap).filter("frame is not null").withColumn("rank", F.lit(1))
    else:
        raise ValueError(f"unknown mode: {mode}")
    brief = F.struct("rank", *(F.col(f"frame.{x}") for x in ("timestamp", "frame_path", "ocr_provider", "quality_score")), round_to(F.col("score"), 4).alias("attach_score"))
    lists = best.groupBy(*key).agg(F.sort_array(F.collect_list(brief)).alias("c"), F.min_by("frame", "rank").alias("attached"))  # k at most
    joined = prev_next(segments, frames).join(lists, key, "left")
    some = F.col("attached").isNotNull()
    candidates = F.transform("c", lambda x: x.dropFields("rank"))
    said = {}
    if "ocr" in frames.columns:
        said = {"frame_ocr_text": F.col("attached.ocr.full_text"), "frame_ocr_crops": F.col("attached.ocr.crops")}
    elif "ocr_text" in frames.columns:
        said = {"frame_ocr_text": F.col("attached.ocr_text")}
    return joined.select(
        *segments.columns,
        *(F.col(f"attached.{x}").alias(y) for x, y in (("timestamp", "frame_timestamp"), ("frame_path", "frame_path"), ("ocr_provider", "ocr_provider"))),
        *(column.alias(name) for name, column in said.items()),
        F.coalesce(candidates, F.array().cast(joined.select(candidates.alias("c")).schema["c"].dataType)).alias("frame_candidates"),
        F.col("prev").alias("frame_prev"),
        F.col("next").alias("frame_next"),
        F.coalesce(F.get("c", F.lit(0))["attach_score"], F.lit(0.0)).alias("attach_score"),
        F.when(some, "candidate_attached").otherwise("no_in_range_candidate").alias("attach_reason"),
    )
