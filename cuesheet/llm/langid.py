"""Language identification of mixed-language texts.

A word is a run of letters. Its script, by ranges of code points, narrows the candidates to the languages that use the
script in the labelled sample; its score for each is the log probability of its letters, pairs and triples of letters.
Over a text's words the Viterbi algorithm with a penalty for switching finds the best labels, whose runs are spans.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

UNKNOWN = "und"
#: Labelled documents of each language that the model is fitted on, about: those of the smallest hashes of doc_id.
FITTED_PER_LANGUAGE = 3000
#: What a text must reach to be kept: the share of its letters that its language has, and by how many nats a letter its
#: words' languages must say more about them than an even guess over the tables. Strings of random letters reach 1 or less.
LEAST_SHARE, LEAST_GAIN = 0.4, 5.0
#: Places in the tables of letter groups, and what is added to each count.
BUCKETS = 1 << 15
ADDED = 0.3
#: Texts whose words are labelled together, which bounds a task's memory.
ROWS = 512
#: What a switch of language costs, in nats, and a word in a language that does not use its script.
SWITCH = 10.0
FOREIGN = 60.0
#: Share of a language's words in a script from which the script counts as its own.
OWN_SCRIPT = 0.01

#: First code points of ranges, and the script of the letters from there on.
SCRIPTS = (
    (0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, "other"),
    (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "other"), (0xB80, "tamil"), (0xC00, "other"), (0xE00, "thai"), (0xE80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"),
    (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
    (0x20000, "han"), (0x32000, "other"),
)
_STARTS = np.array([x for x, _ in SCRIPTS])
_NAMES = sorted({x for _, x in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(x) for _, x in SCRIPTS])

_NARROW = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ÿ]+")
_WIDE = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def _pattern(text: str):
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _WIDE
    return _NARROW


def words_of(text: str) -> list[str]:
    """The words of a text, in lower case."""
    return [x.lower() for x in _WIDE.findall(text)] if _pattern(text) is _WIDE else _NARROW.findall(text.lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return ((x ^ (x >> np.uint64(33))) % np.uint64(BUCKETS)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the letter groups of words (none of them empty), the first group of each word, and the words' scripts."""
    points = np.frombuffer(("\2" + "\2".join(words) + "\2").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    middle = np.flatnonzero(points[1:-1] != 2) + 1
    a, b, c = points[middle - 1], points[middle], points[middle + 1]
    groups = np.stack([_mix(b), _mix(a << np.uint64(21) | b | np.uint64(1 << 43)), _mix((a << np.uint64(42)) ^ (b << np.uint64(21)) ^ c ^ np.uint64(1 << 63))], axis=1)
    first = np.flatnonzero(a == 2)
    scripts = _SCRIPT[np.searchsorted(_STARTS, b[first].astype(np.int64), side="right") - 1]
    return groups, first, scripts


@dataclass
class Model:
    """languages, log probabilities of letter groups (BUCKETS by languages), and which languages use each script."""

    languages: list[str]
    logs: np.ndarray
    uses: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        """Words by languages: log probabilities."""
        groups, first, scripts = features(words)
        each = self.logs[groups].sum(axis=1, dtype=np.float32)
        out = np.add.reduceat(each, first, axis=0)
        allowed = self.uses[scripts]
        # A script that no language uses says nothing.
        return np.where(allowed | ~allowed.any(axis=1, keepdims=True), out, out - FOREIGN)


def is_held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows that the model never learns from: crc32 of the identifier as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = FITTED_PER_LANGUAGE) -> Model:
    """Learns from the rows of docs (doc_id, text, lang) that are not held out and have text and lang.

    All languages of these rows are learned, each from about per_language rows: those of the smallest hashes of
    doc_id, so repeated rows are drawn together. The model has BUCKETS numbers for each language. Without labelled rows
    it has no languages.
    """
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    labelled = labelled.filter(~is_held_out() & F.col("lang").isNotNull())
    sizes = {x["lang"]: x["n"] for x in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(_NAMES), 0), bool))
    share = F.create_map(*(F.lit(y) for lang in languages for y in (lang, min(1.0, per_language / sizes[lang]))))
    sampled = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < F.coalesce(share[F.col("lang")], F.lit(0.0)) * 1_000_003)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups_of = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        scripts_of = np.zeros((len(languages), len(_NAMES)), dtype=np.int64)
        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch.column("text"))):
                if words := words_of(text):
                    groups, _, scripts = features(words)
                    k = languages.index(lang)
                    groups_of[k] += np.bincount(groups.ravel(), minlength=BUCKETS)
                    scripts_of[k] += np.bincount(scripts, minlength=len(_NAMES))
        both = np.concatenate([groups_of, scripts_of], axis=1)
        k, place = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(place), pa.array(both[k, place])], ["k", "place", "n"])

    rows = sampled.select("lang", "text").mapInArrow(count, "k long, place long, n long").groupBy("k", "place").agg(F.sum("n").alias("n")).toPandas()
    both = np.zeros((len(languages), BUCKETS + len(_NAMES)))
    both[rows["k"], rows["place"]] = rows["n"]
    counts, scripts = both[:, :BUCKETS], both[:, BUCKETS:]
    logs = np.log(counts + ADDED) - np.log(counts.sum(axis=1, keepdims=True) + ADDED * BUCKETS)
    uses = scripts > OWN_SCRIPT * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(languages, np.ascontiguousarray(logs.T, dtype=np.float32), np.ascontiguousarray(uses.T))


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word. scores: words by labels, text after text; lengths: words of each text.

    The texts take their steps together, the longest first; a tie keeps the label, and the earlier label wins.
    """
    n, labels = scores.shape
    rank = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[rank]
    sizes = lengths[rank]
    active = np.searchsorted(-sizes, -np.arange(1, sizes.max(initial=0) + 1), side="right")
    step = np.repeat(np.arange(len(active)), active)
    begins = np.cumsum(active) - active
    place = starts[np.arange(n) - begins[step]] + step
    ordered = scores[place].astype(np.float64)
    came = np.empty((n, labels), dtype=np.uint8 if labels < 256 else np.int32)
    own = np.arange(labels)
    value = np.zeros((len(lengths), labels))
    for t, (at, m) in enumerate(zip(begins.tolist(), active.tolist())):
        now = value[:m]
        if t:
            best = now.argmax(axis=1)
            other = now[np.arange(m), best] - switch
            leave = other[:, None] > now
            came[at : at + m] = np.where(leave, best[:, None], own)
            now[:] = np.where(leave, other[:, None], now)
        now += ordered[at : at + m]
    label = value.argmax(axis=1)
    out = np.empty(n, dtype=np.int64)
    for t in range(len(active) - 1, -1, -1):
        at, m = begins[t], active[t]
        out[at : at + m] = label[:m]
        if t:
            label[:m] = came[np.arange(at, at + m), label[:m]]
    back = np.empty(n, dtype=np.int64)
    back[place] = out
    return back


def _labelled(model: Model, words: list[list[str]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each word of each text the place in model.languages of its label, and its score under that."""
    lengths = np.array([len(x) for x in words], dtype=np.int64)
    flat = [y for x in words for y in x]
    if not flat or not model.languages:
        return [np.zeros(len(x), dtype=np.int64) for x in words], [np.zeros(len(x)) for x in words]
    codes, distinct = pd.factorize(np.array(flat, dtype=object))
    scores = model.scores(list(distinct))
    labels = viterbi(scores[codes], lengths)
    cuts = np.cumsum(lengths)[:-1]
    return np.split(labels, cuts), np.split(scores[codes, labels], cuts)


def label_words(model: Model, words: list[list[str]]) -> list[np.ndarray]:
    """The place in model.languages of each word of each text."""
    return _labelled(model, words)[0]


def _verdict(model: Model, words: list[str], labels: np.ndarray) -> tuple[str, float]:
    if not words or not model.languages:
        return UNKNOWN, 0.0
    letters = np.bincount(labels, weights=np.fromiter(map(len, words), dtype=np.float64, count=len(words)), minlength=len(model.languages))
    best = int(letters.argmax())
    return model.languages[best], float(letters[best] / letters.sum())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs (doc_id, text).

    lang_pred is the language whose spans have the most letters (of several, the first in order), score their share;
    a text that is null or has no letters is und, with score 0, and so is every text if there were no labels to learn
    from. A null identifier is not held out. Each row is read by itself, so repeated rows give repeated results; an
    empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, ROWS):
            words = [words_of(x) for x in texts(batch.column("text"))]
            out = [_verdict(model, x, y) for x, y in zip(words, label_words(model, words))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), is_held_out().alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and spans of every row of docs (doc_id, text): an array of lang, start, end (code points, end exclusive).

    A span is a language's run of words. Null and empty texts, texts without letters, and all texts if there were no
    labels to learn from, have none. Each row is read by itself, so repeated rows and ties in doc_id give a row each;
    texts of any length are read whole; an empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            places = [[(m[0].lower(), *m.span()) for m in _pattern(x).finditer(x)] for x in texts(batch.column("text"))]
            out = []
            for own, labels in zip(places, label_words(model, [[x[0] for x in own] for own in places])):
                runs: list[dict] = []
                for (_, start, end), label in zip(own, labels if model.languages else []):
                    lang = model.languages[label]
                    if runs and runs[-1]["lang"] == lang:
                        runs[-1]["end"] = end
                    else:
                        runs.append({"lang": lang, "start": start, "end": end})
                out.append(runs)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(find, "doc_id long, spans array<struct<lang: string, start: long, end: long>>")


def keep_identified(docs: DataFrame, model: Model, languages: list[str] | None = None, least_share: float = LEAST_SHARE, least_gain: float = LEAST_GAIN) -> DataFrame:
    """The rows of docs whose text is in one of the languages (None: all that were learned), with all their columns.

    A text stays if its language is one of these, has least_share of its letters or more, and its words, each under
    the label that the Viterbi path gives it, gain least_gain nats a letter or more over an even guess; so random
    strings and texts in languages that were not learned go. Null, empty and other texts without letters go always. If
    there were no labels to learn from, all texts with letters stay. Each row is judged by itself, whatever its
    doc_id, so repeated rows stay or go together; texts of any length are judged whole; of languages with as many
    letters the first in order counts. An empty table stays empty. Columns may have any names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    even = 3 * math.log(BUCKETS)

    @F.pandas_udf("boolean")
    def stays(column: pd.Series) -> pd.Series:
        model, out = shared.value, []
        for at in range(0, len(column), ROWS):
            words = [words_of(x or "") for x in column.iloc[at : at + ROWS]]
            for own, labels, scores in zip(words, *_labelled(model, words)):
                if not own or not model.languages:
                    out.append(bool(own))
                    continue
                lang, share = _verdict(model, own, labels)
                gain = float(scores.sum()) / sum(map(len, own)) + even
                out.append((languages is None or lang in languages) and share >= least_share and gain >= least_gain)
        return pd.Series(out, dtype=bool)

    return docs.filter(stays(F.col("text").cast("string")))
