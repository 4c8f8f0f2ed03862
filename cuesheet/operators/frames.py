"""Frame policy: which points in time of a recording have a frame.

Frames: video_id, timestamp (seconds), seq (input order), and more. Recordings: video_id, duration.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..names import fresh
from ..scratch import scratch_root
from .blocks import placed
from .scan import are_short, keep_spaced

#: Distance from a recording's end at which its last frame is wanted.
END_OFFSET = 0.5


def sample_grid(videos: DataFrame, interval: float = 15.0) -> DataFrame:
    """A row each interval seconds of a recording: video_id, timestamp, source, original_index (from 1)."""
    n = F.ceil(F.col("duration") / interval).cast("long")
    rows = videos.filter("duration > 0").select("video_id", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("i"))
    return rows.select("video_id", round_to(F.col("i") * interval, 3).alias("timestamp"), F.lit("sample").alias("source"), (F.col("i") + 1).cast("int").alias("original_index"))


#: Seconds of the blocks in which a recording's frames are numbered.
BLOCK = 600.0


def _in_order(df: DataFrame, key: str, ts: str, seq: str, name: str) -> DataFrame:
    """df with each row's place in its recording, from 1; rows without a time come first."""
    (block,) = fresh(df.columns, "block")
    t = F.col(ts).cast("double")
    return placed(df.withColumn(block, F.when(t.isNull(), -(2**62)).when(F.isnan(t), 2**62).otherwise(F.floor(t / BLOCK))), key, block, [ts, seq], name).drop(block)


def systematic_sample(df: DataFrame, most: int = 5, key: str = "video_id", ts: str = "timestamp", seq: str = "seq") -> DataFrame:
    """Every k-th row of each key with k = max(1, n div most), the first most of these."""
    place, n = fresh(df.columns, "place", "n")
    sizes = df.groupBy(key).agg(F.count("*").alias(n))
    numbered = _in_order(df, key, ts, seq, place).join(sizes, key)
    step, i = F.greatest(F.lit(1), F.expr(f"`{n}` div {most}")), F.col(place) - 1
    return numbered.filter((i % step == 0) & (i / step < most)).select(*df.columns)


def merge_entries(df: DataFrame, epsilon: float = 0.2, short: bool = False) -> DataFrame:
    """Frames more than epsilon apart, numbered from 1 by original_index. short: as in keep_spaced."""
    kept = keep_spaced(df, epsilon, short=short)
    if short:
        return kept.withColumn("original_index", F.row_number().over(Window.partitionBy("video_id").orderBy("timestamp", "seq")).cast("long"))
    return _in_order(kept.drop("original_index"), "video_id", "timestamp", "seq", "original_index")


def merge_legacy(df: DataFrame, min_gap: float = 0.05) -> DataFrame:
    """As merge_entries, but a distance of exactly min_gap is enough."""
    return keep_spaced(df, min_gap, strict=False)


def union_frames(*frames: DataFrame) -> DataFrame:
    """All frames; ties in time go by the order of the arguments, then by seq."""
    placed = [x.withColumn("__from", F.lit(i)) for i, x in enumerate(frames)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed)
    order = Window.partitionBy("video_id").orderBy("__from", "seq")
    return both.withColumn("seq", F.row_number().over(order).cast("long")).drop("__from")


def lookup_points(points: DataFrame) -> DataFrame:
    """Points at which frames are fetched: no negative ones, rounded to milliseconds, each once."""
    return points.filter("timestamp >= 0").select("video_id", round_to(F.col("timestamp"), 3).alias("timestamp")).distinct()


def required_anchors(frames: DataFrame, videos: DataFrame, epsilon: float = 0.2) -> DataFrame:
    """0 and duration - 0.5 of each recording, where no frame that keep_spaced keeps is within epsilon."""
    ends = videos.filter("duration > 0").select("video_id", F.explode(F.array(F.lit(0.0), F.greatest(F.lit(0.0), F.col("duration") - END_OFFSET))).alias("anchor"))
    kept = keep_spaced(frames.select("video_id", "timestamp", "seq"), epsilon).select("video_id", "timestamp")
    missing = ends.join(kept, (ends["video_id"] == kept["video_id"]) & (F.abs(ends["anchor"] - kept["timestamp"]) <= epsilon), "left_anti")
    return missing.select("video_id", round_to(F.col("anchor"), 3).alias("timestamp"))


def gap_fill(frames: DataFrame, videos: DataFrame, max_gap: float = 15.0, epsilon: float = 0.2, ends: bool = True, short: bool = False) -> DataFrame:
    """Points that leave no gap over max_gap between a recording's frames, its start and its end (if ends).

    After frames within epsilon are merged, a gap gets points each max_gap from its start on, as long as they are
    before its end less epsilon. A recording without frames or ends gets 0. short: as in keep_spaced.
    """
    if max_gap <= 0:
        return videos.select("video_id", F.lit(0.0).alias("timestamp")).limit(0)
    points = frames.select("video_id", "timestamp", F.col("seq").cast("long"))
    if ends:
        virtual = F.array(F.lit(0.0), F.greatest(F.lit(0.0), F.col("duration") - END_OFFSET))
        points = points.unionByName(videos.filter("duration > 0").select("video_id", F.explode(virtual).alias("timestamp"), F.lit(2**62).alias("seq")))
    kept = keep_spaced(points, epsilon, short=short)
    gaps = kept.withColumn("until", F.lead("timestamp").over(Window.partitionBy("video_id").orderBy("timestamp", "seq"))).filter(F.col("until") - F.col("timestamp") > max_gap)
    n = F.floor((F.col("until") - F.col("timestamp")) / max_gap).cast("long")
    filled = gaps.select("video_id", "until", "timestamp", F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("k")).withColumn("at", F.col("timestamp") + F.col("k") * max_gap)
    fill = filled.filter(F.col("at") < F.col("until") - epsilon).select("video_id", round_to(F.col("at"), 3).alias("timestamp"))
    if not ends:
        empty = videos.filter("duration > 0").join(frames.select("video_id").distinct(), "video_id", "left_anti")
        fill = fill.unionByName(empty.select("video_id", F.lit(0.0).alias("timestamp")))
    # Filled points of neighbouring gaps are at least max_gap apart, so merging them again matters only below epsilon.
    if max_gap <= epsilon:
        fill = keep_spaced(fill.withColumn("seq", F.lit(0)), epsilon).drop("seq")
    return fill


def pair_by_position(files: DataFrame, stamps: DataFrame) -> DataFrame:
    """The k-th file of a recording with the k-th time stamp; where there is none, k - 1. Both have video_id, k from 1."""
    paired = files.join(stamps.select("video_id", "k", F.col("timestamp").alias("__t")), ["video_id", "k"], "left")
    return paired.withColumn("timestamp", round_to(F.coalesce("__t", (F.col("k") - 1).cast("double")), 3)).drop("__t")


def backfill(kept: DataFrame, videos: DataFrame, fetch, suppress, max_gap: float = 15.0, rounds: int = 3, epsilon: float = 0.05) -> DataFrame:
    """Fills gaps that deduplication left, in a fixed number of rounds at most.

    fetch(points) returns frames at points (video_id, timestamp); suppress(frames) marks near-duplicates in status.
    Each round merges the fetched frames in at epsilon and deduplicates again; frames that it drops are marked by
    dropped_phase. Rounds stop when there is nothing to fill. Returns kept and dropped frames. What a round is given and
    what it merges is worked out once, as both are read several times.
    """
    scratch_root(kept.sparkSession)
    kept = kept.checkpoint()
    dropped = None
    for k in range(1, rounds + 1):
        short = are_short(kept)
        found = fetch(gap_fill(kept, videos, max_gap, short=short)).checkpoint()
        if found.isEmpty():
            break
        own = [x for x in kept.columns if x in found.columns]
        merged = merge_entries(union_frames(kept.select(own), found.select(own)), epsilon, short).checkpoint()
        marked = suppress(merged).checkpoint()
        kept = marked.filter("status = 'kept'").withColumn("dropped_phase", F.lit(None).cast("string"))
        lost = marked.filter("status = 'dropped'").withColumn("dropped_phase", F.lit(f"gap_backfill_round_{k}"))
        dropped = lost if dropped is None else dropped.unionByName(lost)
    return kept if dropped is None else kept.unionByName(dropped, allowMissingColumns=True)
