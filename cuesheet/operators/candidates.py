"""Choosing between the answers of several recognition providers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..functions.text import compact_length

QUALITY_THRESHOLD = 0.55


def best_candidate(candidates: DataFrame, key: list[str], seq: str = "seq") -> DataFrame:
    """Of each key's candidates (quality_score, text, avg_conf) the best: by score, length, confidence, then first."""
    rank = F.struct(F.coalesce("quality_score", F.lit(0.0)).alias("a"), F.length(F.coalesce("text", F.lit(""))).alias("b"), F.coalesce("avg_conf", F.lit(0.0)).alias("c"), (-F.col(seq)).alias("d"))
    rest = [x for x in candidates.columns if x not in key]
    return candidates.groupBy(*key).agg(F.max_by(F.struct(*rest), rank).alias("best")).select(*key, "best.*")


def better_pass(first: Column, second: Column) -> Column:
    """Of two passes (structs with text) the second only if its compact text is strictly longer."""
    return F.when(compact_length(F.coalesce(second["text"], F.lit(""))) > compact_length(F.coalesce(first["text"], F.lit(""))), second).otherwise(first)


def mean_confidence(confs: Column) -> Column:
    """The mean of an array's values that are neither null nor negative, with two decimals; null if there are none."""
    valid = F.filter(confs, lambda x: x.isNotNull() & (x >= 0))
    total = F.aggregate(valid, F.lit(0.0), lambda a, x: a + x)
    return round_to(F.try_divide(total, F.size(valid)), 2)


def to_percent(conf: Column) -> Column:
    """A confidence of 0 to 1 as 0 to 100; others as they are."""
    return F.when(conf <= 1.0, conf * 100.0).otherwise(conf)


def flatten_lines(blocks: Column) -> Column:
    """blocks[].lines[]{text, words[]{confidence}} as text (lines joined by line feeds) and avg_conf."""
    lines = F.flatten(F.transform(blocks, lambda b: F.coalesce(b["lines"], F.array().cast("array<struct<text:string,words:array<struct<confidence:double>>>>"))))
    text = F.array_join(F.transform(F.filter(lines, lambda x: F.coalesce(x["text"], F.lit("")) != ""), lambda x: x["text"]), "\n")
    words = F.flatten(F.transform(F.filter(lines, lambda x: x["words"].isNotNull()), lambda x: x["words"]))
    return F.struct(text.alias("text"), mean_confidence(F.transform(words, lambda w: to_percent(w["confidence"]))).alias("avg_conf"))


def flatten_pages(pages: Column) -> Column:
    """The mean of the confidences of all levels of pages[].blocks[].paragraphs[].words[].symbols[], each 0 to 100."""
    under = lambda xs, name: F.flatten(F.transform(F.filter(xs, lambda x: x[name].isNotNull()), lambda x: x[name]))
    levels = [pages]
    for name in ("blocks", "paragraphs", "words", "symbols"):
        levels.append(under(levels[-1], name))
    confs = F.concat(*(F.transform(x, lambda y: y["confidence"].cast("double")) for x in levels))
    return mean_confidence(F.transform(F.filter(confs, lambda x: x >= 0), to_percent))


def cascade(candidates: DataFrame, key: list[str], threshold: float = QUALITY_THRESHOLD, fallback: bool = True) -> DataFrame:
    """The outcome of asking providers in turn, over candidates that are all there: one row a key.

    candidates: key, variant (google_a, google_b, azure_read), provider, text, avg_conf, error, quality_score. b is
    asked if a fails or scores below the threshold; azure (with fallback) if the better of these does. Of those asked
    the best stays. Adds n_asked and fallback_used.
    """
    rank = lambda c, seq: F.struct(F.coalesce(c["quality_score"], F.lit(0.0)).alias("a"), F.length(F.coalesce(c["text"], F.lit(""))).alias("b"), F.coalesce(c["avg_conf"], F.lit(0.0)).alias("c"), F.lit(-seq).alias("d"))
    shape = F.struct(*[x for x in candidates.columns if x not in key])
    own = candidates.groupBy(*key).agg(*(F.first(F.when(F.col("variant") == v, shape), ignorenulls=True).alias(v) for v in ("google_a", "google_b", "azure_read")))
    weak = lambda c: (F.coalesce(c["error"], F.lit("")) != "") | (F.coalesce(c["quality_score"], F.lit(0.0)) < threshold)
    a, b, z = F.col("google_a"), F.col("google_b"), F.col("azure_read")
    own = own.withColumn("ask_b", weak(a) & b.isNotNull())
    own = own.withColumn("best", F.when(F.col("ask_b") & (rank(b, 1) > rank(a, 0)), b).otherwise(a)).withColumn("from_b", F.col("ask_b") & (rank(b, 1) > rank(a, 0)))
    own = own.withColumn("ask_z", F.lit(fallback) & weak(F.col("best")) & z.isNotNull())
    best_rank = F.when(F.col("from_b"), rank(F.col("best"), 1)).otherwise(rank(F.col("best"), 0))
    own = own.withColumn("use_z", F.col("ask_z") & (rank(z, 2) > best_rank))
    out = own.withColumn("best", F.when(F.col("use_z"), z).otherwise(F.col("best")))
    return out.select(*key, "best.*", (1 + F.col("ask_b").cast("int") + F.col("ask_z").cast("int")).alias("n_asked"), (F.col("use_z") & (F.col("best.provider") == "azure")).alias("fallback_used"))
