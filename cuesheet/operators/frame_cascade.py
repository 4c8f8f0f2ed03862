"""Frames recognised box by box by providers in turn: each is asked only for the boxes that are weak so far.

A stage's answers are scored and written to the checkpoint folder, so that no provider is asked twice for a box when a
later step is run again. A box carries its candidates along, so stages need no join and no shuffle; a box that is
settled leaves the loop. The boxes' records are then folded into a record for each frame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quality import with_quality
from ..functions.text import strip
from ..scratch import scratch_root
from .candidates import QUALITY_THRESHOLD, mean_confidence
from .frame_ocr import KEY

METRICS = (
    "struct<text_len:int,token_count:int,word_count:int,lexicality:double,weird_token_ratio:double,long_joined_ratio:double,structure_score:double,"
    "confidence_score:double,lexical_score:double,structural_score:double>"
)
CANDIDATE = f"struct<provider:string,variant:string,text:string,avg_conf:double,error:string,quality_score:double,quality_flags:array<string>,quality_metrics:{METRICS},meta:string>"


@dataclass(frozen=True)
class Stage:
    """ask: from requests to the same rows, all their columns, and text, avg_conf, error and, if it likes, meta (a string).

    fallback: a box whose best candidate comes from this stage has used the fallback.
    """

    provider: str
    variant: str
    ask: Callable[[DataFrame], DataFrame]
    fallback: bool = False


def is_weak(candidate: Column, threshold: float) -> Column:
    return (F.coalesce(candidate["error"], F.lit("")) != "") | (F.coalesce(candidate["quality_score"], F.lit(0.0)) < threshold)


def best_of(candidates: Column) -> Column:
    """The best of an array of candidates: by score, length, confidence, then the first."""
    rank = F.transform(candidates, lambda c, i: F.struct(F.coalesce(c["quality_score"], F.lit(0.0)), F.length(F.coalesce(c["text"], F.lit(""))), F.coalesce(c["avg_conf"], F.lit(0.0)), -i))
    return F.get(candidates, -F.array_max(rank)["col4"])


def cascade_boxes(requests: DataFrame, stages: list[Stage], threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """requests' rows, one for each box, with candidates (in the order asked), best and fallback_used.

    The first stage is asked for all boxes, each later one for those whose best candidate so far has an error or
    scores below threshold. requests may have any columns besides text, avg_conf, error, meta, candidates, best and those
    of text quality; stages hand them on. Null texts count as empty.
    """
    scratch_root(requests.sparkSession)
    own = requests.columns
    left = requests.withColumn("candidates", F.array().cast(f"array<{CANDIDATE}>"))
    settled = None
    for k, stage in enumerate(stages):
        answers = stage.ask(left)
        answers = answers.withColumns({"text": F.coalesce("text", F.lit("")), "meta": F.col("meta").cast("string") if "meta" in answers.columns else F.lit(None).cast("string")})
        scored = with_quality(answers)
        new = F.struct(F.lit(stage.provider).alias("provider"), F.lit(stage.variant).alias("variant"), "text", F.col("avg_conf").cast("double").alias("avg_conf"), F.col("error").cast("string").alias("error"), "quality_score", "quality_flags", "quality_metrics", "meta")
        asked = scored.select(*own, F.concat("candidates", F.array(new.cast(CANDIDATE))).alias("candidates")).checkpoint()
        last = k == len(stages) - 1
        weak = F.lit(False) if last else is_weak(best_of(F.col("candidates")), threshold)
        done = asked.filter(~weak)
        settled = done if settled is None else settled.unionByName(done)
        left = asked.filter(weak)
    names = [x.variant for x in stages if x.fallback]
    return settled.withColumn("best", best_of(F.col("candidates"))).withColumn("fallback_used", F.col("best.variant").isin(names) if names else F.lit(False))


def last_by(names: Column, values: Column) -> Column:
    """A map of arrays' items in which of equal names the last wins."""
    keys = F.array_distinct(names)
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(F.arrays_zip(names.alias("n"), values.alias("v")), lambda x: x["n"] == k), -1)["v"]))


def cascade_records(boxes: DataFrame, provider: str = "google", settings: dict | None = None) -> DataFrame:
    """One record a frame of cascade_boxes' rows (video_id, seq, place, name, box, candidates, best, fallback_used).

    video_id, seq, ocr_provider, provider_meta (settings as given, errors, and per_crop_errors, in which the last error of
    a name wins), ocr (full_text, avg_conf, crops, each with its candidates), the score of the labelled text,
    fallback_used if any box used it, and provider_candidates, those of all boxes in order. A frame has as many boxes as it
    was asked for, so its lists are short.
    """
    best = F.col("best")
    crop = F.struct(
        "place", "name", "box", best["text"].alias("text"), best["avg_conf"].alias("avg_conf"), F.lit(None).cast("int").alias("psm_used"), best["error"].alias("error"),
        *(best[x].alias(x) for x in ("quality_score", "quality_flags", "quality_metrics")), "fallback_used", F.col("candidates").alias("provider_candidates"),
    )
    frames = boxes.groupBy(*KEY).agg(F.transform(F.sort_array(F.collect_list(crop)), lambda x: x.dropFields("place")).alias("crops"))
    said = F.filter("crops", lambda x: x["text"] != "")
    text = strip(F.array_join(F.transform(said, lambda x: F.concat(F.lit("["), x["name"], F.lit("]\n"), x["text"])), "\n\n"))
    failed = F.filter("crops", lambda x: F.coalesce(x["error"], F.lit("")) != "")
    frames = frames.withColumns({"text": text, "avg_conf": mean_confidence(F.transform("crops", lambda x: x["avg_conf"])), "errors": F.transform(failed, lambda x: F.struct(x["name"].alias("crop"), x["error"].alias("error")))})
    out = with_quality(frames)
    meta = F.struct(*(F.lit(v).alias(k) for k, v in (settings or {}).items()), "errors", last_by(F.transform("errors", lambda x: x["crop"]), F.transform("errors", lambda x: x["error"])).alias("per_crop_errors"))
    return out.select(
        *KEY,
        F.lit(provider).alias("ocr_provider"),
        meta.alias("provider_meta"),
        F.struct(F.col("text").alias("full_text"), "avg_conf", "crops").alias("ocr"),
        "quality_score",
        "quality_flags",
        "quality_metrics",
        F.exists("crops", lambda x: x["fallback_used"]).alias("fallback_used"),
        F.flatten(F.transform("crops", lambda x: x["provider_candidates"])).alias("provider_candidates"),
    )


def for_report(records: DataFrame) -> DataFrame:
    """Frame records as report.ocr_stats and quality_report read them."""
    return records.select(
        "video_id", F.col("ocr.full_text").alias("text"), "quality_score", F.size("provider_meta.errors").alias("n_errors"), "fallback_used",
        F.transform("provider_candidates", lambda x: x["provider"]).alias("providers"),
    )
