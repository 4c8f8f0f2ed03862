"""Parameters that follow from a probe of a recording, and the choice of providers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import one_decimal
from ..functions.text import strip

#: What holds without tuning, and without a probe of text.
DEFAULTS = {"periodic_interval_seconds": 15.0, "max_frame_gap_seconds": 15.0, "ocr_scale": 2.0, "ocr_crops": "preset", "dedupe_time_gap_sec": 2.0, "dedupe_hash_threshold": 6}
NO_TEXT_LENGTH, NO_TEXT_CONFIDENCE, NO_WORD_CONFIDENCE = 200.0, 70.0, 50.0


def probe_rates(videos: DataFrame, scenes: DataFrame, samples: DataFrame) -> DataFrame:
    """videos (video_id, duration) with scene_changes_per_minute, avg_text_length and avg_ocr_confidence.

    scenes: video_id of each scene frame. samples: video_id, text, conf (null where no word had one) of the frames
    whose text was read.
    """
    changes = scenes.groupBy("video_id").agg(F.count("*").alias("n"))
    read = samples.groupBy("video_id").agg(F.avg(F.length(F.coalesce("text", F.lit("")))).alias("length"), F.avg(F.coalesce("conf", F.lit(NO_WORD_CONFIDENCE))).alias("conf"))
    rate = F.coalesce("n", F.lit(0)) / F.greatest(F.col("duration") / 60.0, F.lit(0.01))
    out = videos.join(changes, "video_id", "left").join(read, "video_id", "left")
    return out.withColumns({"scene_changes_per_minute": rate, "avg_text_length": F.coalesce("length", F.lit(NO_TEXT_LENGTH)), "avg_ocr_confidence": F.coalesce("conf", F.lit(NO_TEXT_CONFIDENCE))}).drop("n", "length", "conf")


def probe(videos: DataFrame, streams: DataFrame, audio: DataFrame, sampled: DataFrame, scenes: DataFrame, read: DataFrame) -> DataFrame:
    """A recording's probe: its streams, how many frames were sampled and changed scene, and how much text these have.

    videos: video_id, duration; those without a duration over 0 raise. streams: video_id, line of its video stream (as
    parse_stream_line reads it). audio: video_id, line for its audio streams, of which one that is not blank counts.
    sampled, scenes: video_id of each frame. read: video_id, text, conf of the frames whose text was read.
    """
    some = F.when(F.col("duration") > 0, F.col("duration")).otherwise(F.raise_error(F.concat(F.lit("no duration: "), F.col("video_id").cast("string"))).cast("double"))
    sizes = streams.select("video_id", parse_stream_line(F.col("line")).alias("s")).select("video_id", "s.*")
    heard = audio.groupBy("video_id").agg(F.max(strip(F.coalesce("line", F.lit(""))) != "").alias("has_audio"))
    count = lambda x, name: x.groupBy("video_id").agg(F.count("*").alias(name))
    rates = probe_rates(videos.select("video_id", "duration"), scenes.select("video_id"), read)
    out = rates.withColumn("duration", some)
    unknown = F.struct(F.lit(1920).alias("width"), F.lit(1080).alias("height"), F.lit(30.0).alias("fps"))
    for x in (sizes, heard, count(sampled, "sample_frame_count"), count(scenes, "scene_frame_count")):
        out = out.join(x, "video_id", "left")
    known = {x: F.coalesce(F.col(x), unknown[x]) for x in ("width", "height", "fps")}
    zero = {x: F.coalesce(F.col(x), F.lit(0).cast("long")) for x in ("sample_frame_count", "scene_frame_count")}
    return out.withColumns({**known, **zero, "has_audio": F.coalesce("has_audio", F.lit(False))}).withColumnRenamed("duration", "duration_seconds")


#: The reasons for tuned parameters.
REASONS = {
    "high_rate": "high scene rate (%s/min)", "some_rate": "moderate scene rate (%s/min)", "low_rate": "low scene rate (%s/min)",
    "low_res": "low res (%dp)", "middle_res": "HD (%dp)", "high_res": "high res (%dp)",
    "sparse": "sparse text detected", "dense": "dense text detected",
    "long": "long video (>30min)", "short": "short video (<2min)", "standard": "standard duration",
}


def tune(probes: DataFrame) -> DataFrame:
    """probes (duration, height, scene_changes_per_minute, avg_text_length) with the tuned parameters and reasons."""
    rate, duration, height = F.col("scene_changes_per_minute"), F.col("duration"), F.col("height")
    base = F.when(rate > 6, 5.0).when(rate > 2, 10.0).otherwise(20.0)
    short = F.when(duration < 120, F.greatest(F.lit(3.0), F.least(base, F.lit(5.0)))).otherwise(base)
    interval = F.when(duration > 1800, F.greatest(short, F.lit(15.0))).otherwise(short)
    said = lambda x, *values: F.format_string(REASONS[x], *values)
    long_or_short = lambda a, b, c: F.when(duration > 1800, a).when(duration < 120, b).otherwise(c)
    sparse = F.col("avg_text_length") < 100
    return probes.withColumns(
        {
            "periodic_interval_seconds": interval,
            "frame_policy": F.lit("hybrid"),
            "max_frame_gap_seconds": interval,
            "ocr_scale": F.when(height < 720, 3.0).when(height <= 1080, 2.0).otherwise(1.5),
            "ocr_crops": F.when(sparse, "none").otherwise("preset"),
            "dedupe_time_gap_sec": long_or_short(3.0, 1.5, 2.0),
            "dedupe_hash_threshold": long_or_short(8, 5, 6),
            "frame_reason": F.when(rate > 6, said("high_rate", one_decimal(rate))).when(rate > 2, said("some_rate", one_decimal(rate))).otherwise(said("low_rate", one_decimal(rate))),
            "scale_reason": F.when(height < 720, said("low_res", height)).when(height <= 1080, said("middle_res", height)).otherwise(said("high_res", height)),
            "crops_reason": F.when(sparse, REASONS["sparse"]).otherwise(REASONS["dense"]),
            "dedup_reason": long_or_short(REASONS["long"], REASONS["short"], REASONS["standard"]),
        }
    )


def compare_with_defaults(tuned: DataFrame) -> DataFrame:
    """A row for each recording and parameter: video_id, parameter, default, tuned, changed, as text."""
    rows = F.array(*(F.struct(F.lit(x).alias("parameter"), F.lit(str(y)).alias("default_value"), F.col(x).cast("string").alias("tuned_value")) for x, y in DEFAULTS.items()))
    return tuned.select("video_id", F.inline(rows)).withColumn("changed", F.col("default_value") != F.col("tuned_value"))


def provider_stack(assemblyai: Column, google: Column, azure: Column) -> Column:
    """The providers in use where these can be reached."""
    return F.struct(
        F.when(assemblyai, "assemblyai").otherwise("whisper").alias("transcribe_provider"),
        F.when(google, "google").otherwise("tesseract").alias("ocr_provider"),
        F.when(google & azure, "azure").otherwise("none").alias("ocr_fallback_provider"),
    )


def parse_stream_line(line: Column) -> Column:
    """width, height, fps from "width,height,num/den"; 1920, 1080 and 30 where one can't be read; fps within 0.1 to 240."""
    parts = F.split(F.trim(line), ",")
    part = lambda i: F.get(parts, F.lit(i))
    whole = F.size(parts) >= 3
    rate = F.split(part(2), "/")
    num, den = F.get(rate, F.lit(0)).try_cast("double"), F.get(rate, F.lit(1)).try_cast("double")
    fps = F.when(F.size(rate) == 1, num).when(den == 0, 30.0).otherwise(F.try_divide(num, den))
    known = lambda x, default: F.coalesce(F.when(whole, x), F.lit(default))
    return F.struct(known(part(0).try_cast("int"), 1920).alias("width"), known(part(1).try_cast("int"), 1080).alias("height"), F.greatest(F.lit(0.1), F.least(F.lit(240.0), known(fps, 30.0))).alias("fps"))
