"""Recognised text of frames: boxes by passes by providers, put together to one record a frame.

A frame is asked for box by box, in one or two passes; the better pass of a box stays. The texts of a frame's boxes
make its text, under which it is scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quality import with_quality
from ..functions.text import labelled_text
from ..scratch import tasks
from .candidates import better_pass, mean_confidence
from .crops import crop_boxes

KEY = ["video_id", "seq"]


def crop_requests(frames: DataFrame, passes: list[int], mode: str = "preset", manual: list[str] | None = None) -> DataFrame:
    """What is asked of a provider: a row for each frame (video_id, seq, width, height), box and pass (name, box, place, psm).

    passes: the modes of segmentation, one or two; a second one that equals the first is left out. Frames are dealt out
    by their key before they are taken apart, so that a frame's boxes and passes are where they are put together again.
    """
    boxes = crop_boxes(frames.repartition(tasks(frames.sparkSession), *KEY), mode, manual)
    asked = F.array(*map(F.lit, dict.fromkeys(passes)))
    names = ["FULL", "TOP", "LEFT", "MAIN", "BOTTOM", *(f"MANUAL_{i:02d}" for i in range(1, len(manual or []) + 1))]
    place = F.array_position(F.array(*map(F.lit, names)), F.col("name")).cast("int")
    return boxes.select("*", place.alias("place"), F.explode(asked).alias("psm"))


def better_crops(answers: DataFrame, first: int) -> DataFrame:
    """Of each box's passes (text, avg_conf, psm) the better: the second only if its compact text is longer."""
    shape = F.struct("text", "avg_conf", "psm", "box", "place")
    both = answers.groupBy(*KEY, "name").agg(F.first(F.when(F.col("psm") == first, shape), ignorenulls=True).alias("a"), F.first(F.when(F.col("psm") != first, shape), ignorenulls=True).alias("b"))
    best = F.when(F.col("a").isNull(), F.col("b")).when(F.col("b").isNull(), F.col("a")).otherwise(better_pass(F.col("a"), F.col("b")))
    return both.select(*KEY, "name", best.alias("best")).select(*KEY, "name", "best.text", "best.avg_conf", F.col("best.psm").alias("psm_used"), "best.box", "best.place")


def frame_records(answers: DataFrame, first: int, provider: str = "tesseract", meta: Column | None = None) -> DataFrame:
    """One record a frame: video_id, seq, ocr_provider, provider_meta, ocr (full_text, avg_conf, crops), quality, candidates.

    answers: video_id, seq, name, box, place, psm, text, avg_conf (null where no word had one). A box's record has its
    own score, the frame's score is of the labelled text and the mean of its boxes' confidences. A frame has as many
    boxes as it was asked for, so the list is short.
    """
    scored = with_quality(better_crops(answers, first))
    crop = F.struct("place", "name", "box", "text", "avg_conf", "psm_used", "quality_score", "quality_flags", "quality_metrics")
    frames = scored.groupBy(*KEY).agg(F.sort_array(F.collect_list(crop)).alias("crops"))
    whole = frames.select(*KEY, F.transform("crops", lambda x: x.dropFields("place")).alias("crops"))
    said = whole.withColumns({"text": labelled_text(F.transform("crops", lambda x: F.struct(x["name"].alias("name"), x["text"].alias("text")))), "avg_conf": mean_confidence(F.transform("crops", lambda x: x["avg_conf"]))})
    out = with_quality(said)
    return out.select(
        *KEY,
        F.lit(provider).alias("ocr_provider"),
        (meta if meta is not None else F.struct(F.lit(first).alias("psm"))).alias("provider_meta"),
        F.struct(F.col("text").alias("full_text"), "avg_conf", "crops").alias("ocr"),
        "quality_score",
        "quality_flags",
        "quality_metrics",
        F.lit(False).alias("fallback_used"),
        F.array(F.struct(F.lit(provider).alias("provider"), "quality_score")).alias("provider_candidates"),
    )
