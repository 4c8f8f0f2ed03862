"""Providers of recognition, transcription and decoding.

These call programs or services outside Spark, so a provider is a function over Arrow batches that runs on the
executors, or a table of answers made before. Errors are data: a provider answers with an error column, and a task
that is run again asks again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..names import fresh
from ..scratch import scratch_root

#: name -> provider
REGISTRY: dict[str, Provider] = {}


@dataclass(frozen=True)
class Provider:
    """ask: from requests, a table with key columns, to the same rows with the columns of answers."""

    name: str
    ask: Callable[[DataFrame], DataFrame]


def register(name: str, ask: Callable[[DataFrame], DataFrame]) -> Provider:
    REGISTRY[name] = Provider(name, ask)
    return REGISTRY[name]


def precomputed(name: str, answers: DataFrame, key: list[str]) -> Provider:
    """A provider whose answers are a table; requests without one get an error."""

    def ask(requests: DataFrame) -> DataFrame:
        (known,) = fresh(requests.columns + answers.columns, "known")
        joined = requests.join(answers.withColumn(known, F.lit(True)), key, "left")
        missing = F.when(F.col(known).isNull(), F.lit("no answer"))
        error = F.coalesce("error", missing) if "error" in answers.columns else missing
        return joined.withColumn("error", error).drop(known)

    return register(name, ask)


def by_batches(name: str, function: Callable, schema: str) -> Provider:
    """A provider that maps an iterator of Arrow batches of requests to one of answers, as DataFrame.mapInArrow does."""
    return register(name, lambda requests: requests.mapInArrow(function, schema))


def ask_in_turn(requests: DataFrame, first: Provider, then: Provider, is_weak: Callable[[], F.Column]) -> DataFrame:
    """Answers of first, and for the requests whose answer is weak those of then as well.

    The weak ones are filtered before the second provider runs: inside CASE a Python function would run for all rows.
    first's answers are written to the checkpoint folder, so that they are not asked for twice.
    """
    scratch_root(requests.sparkSession)
    answered = first.ask(requests).checkpoint()
    weak = answered.filter(is_weak()).select(*requests.columns)
    return answered.withColumn("asked", F.lit(first.name)).unionByName(then.ask(weak).withColumn("asked", F.lit(then.name)), allowMissingColumns=True)


def fallback_segments(videos: DataFrame, segments: DataFrame, texts: DataFrame) -> DataFrame:
    """A segment over all of a recording for those with a text (texts: video_id, text) but no segment."""
    bare = videos.join(segments.select("video_id").distinct(), "video_id", "left_anti").join(texts, "video_id")
    return bare.select("video_id", F.lit(0.0).alias("start"), F.col("duration").alias("end"), "text", F.lit("global_fallback").alias("split_reason"))
