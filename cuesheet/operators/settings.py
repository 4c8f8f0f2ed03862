"""A run's settings: what is given goes before what was tuned, that before the profile's, and that before the defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The settings that have a meaning for data, and what holds where nothing else does.
DEFAULTS = {
    "frame_policy": "hybrid", "scene_threshold": 0.25, "periodic_interval_seconds": 15.0, "max_frame_gap_seconds": 15.0, "always_include_start_end": True,
    "transcribe_provider": "whisper", "segment_max_seconds": 25.0, "segment_silence_gap_seconds": 0.6, "segment_min_seconds": 3.0,
    "ocr_provider": "tesseract", "ocr_fallback_provider": "azure", "ocr_lang": "eng", "ocr_scale": 2.0, "ocr_threshold": "adaptive", "ocr_denoise": True, "ocr_sharpen": True,
    "ocr_crops": "preset", "ocr_quality_threshold": 0.55, "dedupe_time_gap_sec": 2.0, "dedupe_hash_threshold": 6, "dedupe_preserve_transitions": True, "dedupe_transition_gap_seconds": 2.5,
    "align_max_gap_seconds": 10.0, "align_topk": 3, "align_mode": "overlap_topk", "window_seconds": 45.0, "enforce_quality": False,
}
#: What a profile sets.
PROFILES = {
    "local_safe": {"transcribe_provider": "whisper", "ocr_provider": "tesseract", "ocr_fallback_provider": "none"},
    "quality_first": {"transcribe_provider": "assemblyai", "ocr_provider": "google", "ocr_fallback_provider": "azure"},
}
DEFAULT_PROFILE = "quality_first"
CHOICES = {
    "frame_policy": ("scene_only", "hybrid"), "transcribe_provider": ("whisper", "assemblyai"), "ocr_provider": ("tesseract", "google"), "ocr_fallback_provider": ("none", "azure"),
    "ocr_crops": ("none", "preset"), "align_mode": ("nearest", "overlap_topk"),
}


def _of_profile(name: str, profile: Column) -> Column | None:
    own = [(k, v[name]) for k, v in PROFILES.items() if name in v]
    if not own:
        return None
    out = F.when(profile == own[0][0], F.lit(own[0][1]))
    for k, v in own[1:]:
        out = out.when(profile == k, F.lit(v))
    return out


def effective_settings(runs: DataFrame, tuned: DataFrame | None = None, key: str = "video_id") -> DataFrame:
    """key, profile and every setting of each run.

    runs: key, profile (null: the default profile) and columns of settings that are given, null where not. tuned: key
    and columns of settings, as tuning.tune returns them; a run that it has is of the profile auto. A value that is none
    of a setting's choices raises.
    """
    given = [x for x in runs.columns if x in DEFAULTS]
    rows = runs.select(key, F.coalesce("profile", F.lit(DEFAULT_PROFILE)).alias("profile"), F.struct(*given, F.lit(None).alias("_")).alias("given"))
    own = [] if tuned is None else [x for x in tuned.columns if x in DEFAULTS]
    if own:
        rows = rows.join(tuned.select(key, F.struct(*own).alias("tuned")), key, "left")
    out = {}
    for name, default in DEFAULTS.items():
        layers = [F.col(f"given.{name}")] * (name in given) + [F.col(f"tuned.{name}")] * (name in own)
        profile = _of_profile(name, F.col("profile"))
        value = F.coalesce(*layers, *([profile] if profile is not None else []), F.lit(default))
        if name in CHOICES:
            bad = F.raise_error(F.concat(F.lit(f"not a value of {name}: "), value)).cast("string")
            value = F.when(value.isin(*CHOICES[name]), value).otherwise(bad)
        out[name] = value
    auto = F.when(F.col("tuned").isNotNull(), F.lit("auto")).otherwise(F.col("profile")) if own else F.col("profile")
    return rows.select(key, auto.alias("profile"), *(v.alias(k) for k, v in out.items()))
