"""Text: white space, tokens, labels and time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import one_decimal

#: White space, token and line patterns with the meaning they have for Unicode strings.
EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
SPACES = r"(?U)[\s\x1c-\x1f]+"
TOKEN = r"(?U)[^\s\x1c-\x1f]+"
#: White space again, as a class of characters by itself, which is matched faster.
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_END = "\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85  ]"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, EDGE_SPACE, "")


def compact(x: Column) -> Column:
    """x with each run of white space as one space, and none at its ends."""
    return strip(F.regexp_replace(x, SPACES, " "))


def compact_length(x: Column) -> Column:
    return F.length(compact(x))


def tighten(x: Column) -> Column:
    """x without the spaces before closing punctuation and inside parentheses."""
    x = F.regexp_replace(x, r"(?U)\s+([,.;:!?])", "$1")
    x = F.regexp_replace(x, r"(?U)\(\s+", "(")
    return strip(F.regexp_replace(x, r"(?U)\s+\)", ")"))


def join_tokens(tokens: Column) -> Column:
    """An array of tokens as one text: blank ones out, joined by spaces, punctuation tightened."""
    return tighten(F.array_join(F.filter(F.transform(tokens, strip), lambda x: x != ""), " "))


def speaker_label(raw: Column, mode: str = "alpha") -> Column:
    """A diarisation label as a letter (alpha) or number (numeric); null if it is null or blank.

    alpha counts digits from 0 (0 is A, 26 is S26), numeric counts letters from 1.
    """
    x = strip(raw.cast("string"))
    letter, digits = x.rlike(r"^\p{L}$"), x.rlike(r"^\p{Nd}+$")
    if mode == "alpha":
        n = x.try_cast("int")
        named = F.when(letter, F.upper(x)).when(digits & n.between(0, 25), F.char(n + 65)).when(digits, F.concat(F.lit("S"), F.coalesce(n.cast("string"), x))).otherwise(F.upper(x))
    elif mode == "numeric":
        named = F.when(digits, x).when(letter, (F.ascii(F.upper(x)) - 64).cast("string")).otherwise(x)
    else:
        raise ValueError(f"unknown speaker label mode: {mode}")
    return F.when(x != "", named)


def srt_stamp(seconds: Column) -> Column:
    """HH:MM:SS,mmm; hours go on past 99."""
    ms = F.round(seconds.cast("decimal(30,12)") * 1000, 0).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3_600_000), F.floor(ms % 3_600_000 / 60_000), F.floor(ms % 60_000 / 1000), ms % 1000)


def file_stamp(seconds: Column) -> Column:
    """Seconds with three decimals, padded to ten characters by zeros."""
    return F.format_string("%010.3f", seconds)


def human_duration(seconds: Column) -> Column:
    minutes = F.floor(seconds / 60).cast("long")
    return (
        F.when(seconds < 60, F.concat(one_decimal(seconds), F.lit("s")))
        .when(minutes < 60, F.format_string("%dm %ss", minutes, F.bround(seconds % 60, 0).cast("long").cast("string")))
        .otherwise(F.format_string("%dh %dm", F.floor(minutes / 60), minutes % 60))
    )


#: Three-letter language codes and what they are passed on as.
LANGUAGE_HINTS = {"eng": "en", "spa": "es", "fra": "fr", "deu": "de"}


def language_hint(code: Column) -> Column:
    x = strip(code)
    hints = F.create_map(*(F.lit(y) for pair in LANGUAGE_HINTS.items() for y in pair))
    return F.when(x != "", F.coalesce(hints[F.lower(x)], x))


def labelled_text(crops: Column) -> Column:
    """An array of crops (name, text) as one text: [NAME] and the text of each that has some, with blank lines between."""
    named = F.filter(crops, lambda c: strip(F.coalesce(c["text"], F.lit(""))) != "")
    return strip(F.array_join(F.transform(named, lambda c: F.concat(F.lit("["), c["name"], F.lit("]\n"), strip(c["text"]))), "\n\n"))


def relative_path(path: Column, root: str) -> Column:
    """An absolute path under root relative to it; other paths as they are."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, len(base) + 1, 2**31 - 1)).when(path == root.rstrip("/"), F.lit(".")).otherwise(path)


def str2bool(x: Column) -> Column:
    """A switch written as text; raises for anything else."""
    y = F.lower(strip(x))
    bad = F.raise_error(F.concat(F.lit("not a switch: "), x)).cast("boolean")
    return F.when(y.isin("1", "true", "t", "yes", "y"), True).when(y.isin("0", "false", "f", "no", "n"), False).otherwise(bad)
