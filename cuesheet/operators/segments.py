"""Transcript segments from timed words, and merging of short ones.

Utterances: video_id, utterance_id, start, end, text, speaker, confidence. Words: video_id, utterance_id, word_ix,
start, end, text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..functions.text import join_tokens, strip
from .scan import ordered_scan

#: Fixed value: how a token ends that ends a segment.
PUNCTUATION_END = "[.!?;:]$"


def normalise_utterances(raw: DataFrame) -> DataFrame:
    """raw: video_id, seq, start, end, text, speaker, confidence. Blank texts go; ids count from 1 in order of seq."""
    kept = raw.withColumn("text", strip(F.coalesce("text", F.lit("")))).filter("text <> ''")
    number = F.row_number().over(Window.partitionBy("video_id").orderBy("seq"))
    return kept.select("video_id", number.alias("utterance_id"), round_to(F.coalesce("start", F.lit(0.0)), 3).alias("start"), round_to(F.coalesce("end", F.lit(0.0)), 3).alias("end"), "text", "speaker", F.col("confidence").alias("speaker_confidence"))


def split_words(words: DataFrame, max_seconds: float = 25.0, silence: float = 0.6) -> DataFrame:
    """Cuts each utterance's words into chunks: video_id, utterance_id, chunk, start, end, text, split_reason.

    A chunk ends before a word after silence or more of it, before a word whose end is max_seconds or more after the
    chunk's start, and after a token that ends in punctuation; the last chunk is the tail. Blank words are left out.
    Silence and punctuation depend on neighbours only and cut islands; only max_seconds looks back to the chunk's
    start, which a scan over the words carries along.
    """
    own = words.withColumn("text", strip(F.coalesce("text", F.lit("")))).filter("text <> ''")
    by = Window.partitionBy("video_id", "utterance_id").orderBy("word_ix")
    gap = F.greatest(F.lit(0.0), F.col("start") - F.lag("end").over(by))
    silent = F.coalesce(gap >= silence, F.lit(False))
    pointed = F.coalesce(F.lag("text").over(by).rlike(PUNCTUATION_END), F.lit(False))
    own = own.withColumns({"__silent": silent, "__pointed": pointed, "__first": F.lag("text").over(by).isNull()})

    def step(state: dict, row: dict):
        cut = None
        if row["__first"] or row["__pointed"]:
            cut = "start"
        elif row["__silent"]:
            cut = "silence_gap"
        elif row["end"] - state["from"] >= max_seconds:
            cut = "max_duration"
        if cut:
            state["from"] = row["start"]
            state["chunk"] = 0 if row["__first"] else state["chunk"] + 1
        return (state["chunk"], cut)

    columns = ["start", "end", "__silent", "__pointed", "__first"]
    marked = ordered_scan(own, ["video_id", "utterance_id"], ["word_ix"], columns, dict, step, "chunk long, cut string")
    # The reason of a chunk is the cut that starts the next one; a cut after punctuation says so.
    chunks = marked.groupBy("video_id", "utterance_id", "chunk").agg(
        F.min_by("start", "word_ix").alias("start"),
        F.max_by("end", "word_ix").alias("end"),
        F.transform(F.sort_array(F.collect_list(F.struct("word_ix", "text"))), lambda x: x["text"]).alias("tokens"),
        F.min_by("cut", "word_ix").alias("cut"),
        F.max_by("text", "word_ix").alias("last"),
    )
    following = F.lead("cut").over(Window.partitionBy("video_id", "utterance_id").orderBy("chunk"))
    reason = F.when(F.col("last").rlike(PUNCTUATION_END), "punctuation").otherwise(F.coalesce(following, F.lit("tail")))
    return chunks.select("video_id", "utterance_id", "chunk", round_to(F.col("start"), 3).alias("start"), round_to(F.col("end"), 3).alias("end"), join_tokens(F.col("tokens")).alias("text"), reason.alias("split_reason"))


def split_utterances(utterances: DataFrame, words: DataFrame, max_seconds: float = 25.0, silence: float = 0.6) -> DataFrame:
    """Segments of utterances (as normalise_utterances returns them); one without words is a segment as it is.

    Columns: video_id, start, end, text, speaker, speaker_confidence, parent_utterance_id, split_reason, chunk.
    """
    chunks = split_words(words, max_seconds, silence)
    who = utterances.select("video_id", "utterance_id", "speaker", "speaker_confidence")
    said = chunks.join(who, ["video_id", "utterance_id"])
    with_words = words.select("video_id", "utterance_id", (strip(F.coalesce("text", F.lit(""))) != "").alias("some")).groupBy("video_id", "utterance_id").agg(F.max("some").alias("some"))
    whole = utterances.join(with_words, ["video_id", "utterance_id"], "left").filter("some is null or not some")
    whole = whole.withColumns({"split_reason": F.when(F.col("some").isNull(), "utterance_fallback").otherwise("empty_words_fallback"), "chunk": F.lit(0).cast("long")})
    columns = ["video_id", "start", "end", "text", "speaker", "speaker_confidence", F.col("utterance_id").alias("parent_utterance_id"), "split_reason", "chunk"]
    return said.select(*columns).unionByName(whole.select(*columns))


def merge_short(segments: DataFrame, order: list[str], min_seconds: float = 3.0, number: str | None = None) -> DataFrame:
    """Appends each segment shorter than min_seconds to the one before, if both have one speaker (null is one too).

    segments: video_id, start, end, text, speaker, split_reason and more, of which the first segment's stay; order:
    what sorts a recording's segments; number: a column to add with the place of each, from 1. The speaker of the merged segment before is always that of the segment before,
    so window functions find the groups.
    """
    by = Window.partitionBy("video_id").orderBy(*order)
    columns = [*segments.columns, *([F.col("__g").alias(number)] if number else [])]
    if min_seconds <= 0:
        return segments.withColumn("__g", F.row_number().over(by).cast("long")).select(*columns)
    lag = F.lag("speaker").over(by)
    fresh = (F.row_number().over(by) == 1) | (F.col("end") - F.col("start") >= min_seconds) | ~F.col("speaker").eqNullSafe(lag)
    placed = segments.withColumns({"__i": F.row_number().over(by), "__g": F.sum(fresh.cast("long")).over(by)})
    rest = [x for x in segments.columns if x not in ("video_id", "end", "text", "split_reason")]
    merged = placed.groupBy("video_id", "__g").agg(
        *(F.min_by(F.struct(x), "__i")[x].alias(x) for x in rest),
        F.max("end").alias("end"),
        F.transform(F.sort_array(F.collect_list(F.struct("__i", "text"))), lambda x: x["text"]).alias("__texts"),
        F.min_by("split_reason", "__i").alias("split_reason"),
        F.count("*").alias("__n"),
    )
    text = F.when(F.col("__n") == 1, F.get("__texts", F.lit(0))).otherwise(join_tokens(F.col("__texts")))
    reason = F.concat(F.coalesce("split_reason", F.lit("unknown")), F.repeat(F.lit("+merged_short"), (F.col("__n") - 1).cast("int")))
    return merged.withColumns({"text": text, "split_reason": F.when(F.col("__n") == 1, F.col("split_reason")).otherwise(reason)}).select(*columns)


def refine_segments(utterances: DataFrame, words: DataFrame, max_seconds: float = 25.0, silence: float = 0.6, min_seconds: float = 3.0, provider: str = "assemblyai") -> DataFrame:
    """Normalised utterances and their words as segments: split, in order of time, short ones merged, numbered from 1."""
    segments = split_utterances(utterances, words, max_seconds, silence)
    merged = merge_short(segments, ["start", "end", "parent_utterance_id", "chunk"], min_seconds, "segment_id")
    rounded = {"start": round_to(F.col("start"), 3), "end": round_to(F.col("end"), 3), "speaker_confidence": round_to(F.col("speaker_confidence").try_cast("double"), 4)}
    return merged.withColumns({**rounded, "asr_provider": F.lit(provider)}).drop("chunk")
