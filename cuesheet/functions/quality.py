"""Quality of recognised text: lexical metrics, a score from 0 to 1, and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..names import fresh
from .numbers import clamp01, conf_to_unit, round_to
from .text import SPACE_CLASS

#: Patterns of words, digits and punctuation, the weights of the scores, and the flags' limits.
WORD = r"[A-Za-z][A-Za-z'\-]*"
DIGITS = r"\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨"
PUNCTUATION = r".,:;!?()\[\]"
#: A token of up to 16 letters, and a full stop at most, is neither weird nor joined, whatever it is.
PLAIN_TOKEN = r"^\p{L}{1,16}\.?$"
#: A line with more than white space, from its first character on.
FULL_LINE = rf"[^{SPACE_CLASS}][^\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]*"
LOW_CONFIDENCE, LOW_LEXICALITY, MANY_JOINED, GARBLED = 0.65, 0.60, 0.08, 0.55


def _letters(token: Column) -> Column:
    return F.length(F.regexp_replace(token, r"[^\p{L}]", ""))


def _is_weird(token: Column) -> Column:
    odd = F.length(F.regexp_replace(token, rf"[\p{{L}}{DIGITS}_\-'.]", ""))
    return (_letters(token) == 0) | (odd / F.length(token) > 0.25)


def _is_joined(token: Column) -> Column:
    return (F.length(token) >= 18) & (_letters(token) / F.length(token) > 0.8) & ~token.rlike("[-_]")


def tokens_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), lambda x: x != "")


def text_counts(text: Column, tokens: Column) -> Column:
    """What is found in a text and its tokens: all that reads the text itself."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(
        F.size(tokens).alias("tokens"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
        F.filter(tokens, lambda x: ~x.rlike(PLAIN_TOKEN)).alias("odd"),
        F.regexp_count(text, F.lit(FULL_LINE)).alias("lines"),
        F.regexp_count(text, F.lit(f"[{PUNCTUATION}]")).alias("marks"),
        F.length(text).alias("length"),
        F.length(F.array_join(tokens, " ")).alias("compact"),
    )


def lexical_metrics(counts: Column) -> Column:
    """token_count, word_count, lexicality, weird_token_ratio, long_joined_ratio, structure_score, not rounded, from text_counts."""
    n = counts["tokens"]
    some = n > 0
    share = lambda count: clamp01(F.try_divide(count.cast("double"), n))
    density = F.least(F.lit(1.0), counts["marks"] / F.greatest(F.lit(1.0), counts["length"] / 24.0))
    structure = clamp01(F.least(F.lit(1.0), counts["lines"] / 16.0) * 0.45 + density * 0.55)
    return F.struct(
        n.alias("token_count"),
        F.when(some, counts["words"]).otherwise(0).alias("word_count"),
        F.when(some, share(counts["words"])).otherwise(0.0).alias("lexicality"),
        F.when(some, share(F.size(F.filter(counts["odd"], _is_weird)))).otherwise(1.0).alias("weird_token_ratio"),
        F.when(some, share(F.size(F.filter(counts["odd"], _is_joined)))).otherwise(0.0).alias("long_joined_ratio"),
        F.when(some, structure).otherwise(0.0).alias("structure_score"),
        counts["compact"].alias("text_len"),
    )


def score_text(metrics: Column, conf: Column) -> Column:
    """Score, flags and rounded metrics from lexical_metrics and the recogniser's confidence."""
    unit = conf_to_unit(conf)
    lexical = clamp01(metrics["lexicality"] * 0.65 + (1.0 - metrics["weird_token_ratio"]) * 0.25 + (1.0 - metrics["long_joined_ratio"]) * 0.10)
    size = metrics["text_len"]
    quality = F.when(size == 0, 0.0).otherwise(clamp01(unit * 0.45 + lexical * 0.40 + metrics["structure_score"] * 0.15))
    flags = F.array_compact(
        F.array(
            F.when(unit < LOW_CONFIDENCE, "low_confidence"),
            F.when(lexical < LOW_LEXICALITY, "low_lexicality"),
            F.when(metrics["long_joined_ratio"] > MANY_JOINED, "suspicious_joined_tokens"),
            F.when(quality < GARBLED, "garble_like"),
        )
    )
    return F.struct(
        round_to(quality, 4).alias("quality_score"),
        flags.alias("quality_flags"),
        F.struct(
            size.alias("text_len"),
            metrics["token_count"].alias("token_count"),
            metrics["word_count"].alias("word_count"),
            *(round_to(metrics[x], 4).alias(x) for x in ("lexicality", "weird_token_ratio", "long_joined_ratio", "structure_score")),
            round_to(unit, 4).alias("confidence_score"),
            round_to(lexical, 4).alias("lexical_score"),
            round_to(metrics["structure_score"], 4).alias("structural_score"),
        ).alias("quality_metrics"),
    )


def with_quality(df, text: str = "text", conf: str = "avg_conf"):
    """df with quality_score, quality_flags and quality_metrics of its text; columns of these names are replaced.

    Each step goes through a generator of one row, as projections on top of each other are merged by the optimizer,
    which would then run the patterns over the text again for each place that uses what they found. The text is split
    into tokens once; tokens are tested one by one.
    """
    once = lambda column, name: F.explode_outer(F.array(column)).alias(name)
    t, c, m, q = fresh(df.columns, "tokens", "counts", "metrics", "score")
    scored = df.select("*", once(tokens_of(F.col(text)), t))
    scored = scored.select("*", once(text_counts(F.col(text), F.col(t)), c)).drop(t)
    scored = scored.select("*", once(lexical_metrics(F.col(c)), m))
    scored = scored.select("*", once(score_text(F.col(m), F.col(conf)), q))
    return scored.withColumns({x: F.col(f"{q}.{x}") for x in ("quality_score", "quality_flags", "quality_metrics")}).drop(c, m, q)
