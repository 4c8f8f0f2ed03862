"""Quality report of a recording's run, and the gates that it passes or not."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..functions.text import strip
from .blocks import value_at

#: The gates' targets. Name, column of the report, comparison, target.
GATES = (
    ("attach_rate", ">=", 0.85),
    ("p95_segment_duration_sec", "<=", 30.0),
    ("max_gap_sec", "<=", 15.0),
    ("tail_gap_sec", "<=", 15.0),
    ("ocr_nonempty_rate", ">=", 0.98),
    ("low_quality_rate", "<=", 0.15),
    ("provider_error_count", "<=", 0.0),
)
LOW_QUALITY = 0.55
#: Seconds of a bucket in which durations are counted before one of them is looked for.
DURATION_BUCKET = 0.1


def coverage(frames: DataFrame, videos: DataFrame) -> DataFrame:
    """video_id, kept_frames, max_gap_sec (from 0, between frames and to the end), tail_gap_sec; not rounded."""
    gap = F.col("timestamp") - F.lag("timestamp", 1, 0.0).over(Window.partitionBy("video_id").orderBy("timestamp"))
    own = frames.withColumn("gap", gap).groupBy("video_id").agg(F.count("*").alias("n"), F.max("gap").alias("gap"), F.max("timestamp").alias("last"))
    tail = F.greatest(F.lit(0.0), F.col("duration") - F.col("last"))
    return videos.join(own, "video_id", "left").select(
        "video_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("kept_frames"),
        F.when(F.col("n").isNull(), F.col("duration")).otherwise(F.greatest(F.lit(0.0), F.col("gap"), tail)).alias("max_gap_sec"),
        F.when(F.col("n").isNull(), F.col("duration")).otherwise(tail).alias("tail_gap_sec"),
    )


def p95_durations(segments: DataFrame) -> DataFrame:
    """video_id, segment_count, p95_segment_duration_sec: of n sorted durations the one at floor(0.95 (n - 1)), from 0."""
    d = segments.select("video_id", (F.col("end") - F.col("start")).alias("d"))
    return value_at(d, "video_id", "d", 0.95, DURATION_BUCKET).select("video_id", F.col("n").alias("segment_count"), F.col("value").alias("p95_segment_duration_sec"))


def attach_rates(dataset: DataFrame) -> DataFrame:
    """video_id, dataset_records, attached_records, attach_rate of a dataset with frame_path."""
    attached = F.count_if(F.coalesce(F.col("frame_path"), F.lit("")) != "")
    return dataset.groupBy("video_id").agg(F.count("*").alias("dataset_records"), attached.alias("attached_records"), (attached / F.count("*")).alias("attach_rate"))


def ocr_stats(frame_ocr: DataFrame) -> DataFrame:
    """Counts over frames (text, quality_score, n_errors, fallback_used, providers: an array of the candidates').

    retry_invocations counts all candidates but one of each frame, and so counts a frame's crops too.
    """
    n = F.count("*")
    nonempty = F.count_if(strip(F.coalesce("text", F.lit(""))) != "")
    low = F.count_if(F.coalesce("quality_score", F.lit(0.0)) < LOW_QUALITY)
    candidates = F.coalesce(F.size("providers"), F.lit(0))
    return frame_ocr.groupBy("video_id").agg(
        n.alias("frame_records"),
        (nonempty / n).alias("ocr_nonempty_rate"),
        (low / n).alias("low_quality_rate"),
        F.count_if(F.coalesce("n_errors", F.lit(0)) > 0).alias("provider_error_count"),
        F.count_if(F.coalesce("fallback_used", F.lit(False))).alias("fallback_used_count"),
        F.sum(F.greatest(F.lit(0), candidates - 1)).cast("long").alias("retry_invocations"),
        F.sum(F.coalesce(F.size(F.filter("providers", lambda x: x == "azure")), F.lit(0))).cast("long").alias("azure_candidate_count"),
    )


def quality_report(videos: DataFrame, kept_frames: DataFrame, segments: DataFrame, dataset: DataFrame, frame_ocr: DataFrame, window_seconds: float = 45.0) -> DataFrame:
    """One row a recording: the figures above, rounded; where there is nothing to count, 0."""
    parts = [coverage(kept_frames, videos), p95_durations(segments), attach_rates(dataset), ocr_stats(frame_ocr)]
    out = videos.select("video_id", round_to(F.col("duration"), 3).alias("duration_seconds"), F.lit(window_seconds).alias("window_seconds"))
    for x in parts:
        out = out.join(x, "video_id", "left")
    digits = {"max_gap_sec": 3, "tail_gap_sec": 3, "p95_segment_duration_sec": 3, "attach_rate": 4, "ocr_nonempty_rate": 4, "low_quality_rate": 4}
    counts = [x for x in out.columns if x not in digits and x not in ("video_id", "duration_seconds", "window_seconds")]
    return out.withColumns({**{x: round_to(F.coalesce(x, F.lit(0.0)), n) for x, n in digits.items()}, **{x: F.coalesce(x, F.lit(0).cast("long")) for x in counts}})


def evaluate_gates(report: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """A row for each recording and gate: video_id, name, observed, operator, target, passed.

    targets override the gates' own; one of 0 counts as not given. The comparison is of what the report has.
    """
    wanted = targets or {}
    rows = F.array(*(F.struct(F.lit(name).alias("name"), F.col(name).cast("double").alias("observed"), F.lit(op).alias("operator"), F.lit(float(wanted.get(name) or target)).alias("target")) for name, op, target in GATES))
    out = report.select("video_id", F.inline(rows))
    passed = F.when(F.col("operator") == ">=", F.col("observed") >= F.col("target")).otherwise(F.col("observed") <= F.col("target"))
    return out.select("video_id", "name", round_to(F.col("observed"), 4).alias("observed"), "operator", round_to(F.col("target"), 4).alias("target"), passed.alias("passed"))


def run_counts(videos: DataFrame, segments: DataFrame, utterances: DataFrame, kept_frames: DataFrame) -> DataFrame:
    """What a run says of itself: video_id, segments, speaker_rows (rows of utterances), speakers (distinct ones), frames."""
    count = lambda x, name, *more: x.groupBy("video_id").agg(F.count("*").alias(name), *more)
    out = videos.select("video_id")
    for x in (count(segments, "segments"), count(utterances, "speaker_rows", F.count_distinct("speaker").alias("speakers")), count(kept_frames, "frames")):
        out = out.join(x, "video_id", "left")
    return out.na.fill(0, ["segments", "speaker_rows", "speakers", "frames"])


def failed_gates(gates: DataFrame) -> DataFrame:
    """name, n: the gates that some recordings failed, and how many."""
    return gates.filter("not passed").groupBy("name").agg(F.count("*").alias("n"))


def enforce(gates: DataFrame) -> None:
    """Raises if a gate failed, naming the failed gates."""
    failed = [f"{x['name']} ({x['n']})" for x in failed_gates(gates).orderBy("name").collect()]
    if failed:
        raise ValueError("quality gates failed, with the number of recordings: " + ", ".join(failed))
