"""Token counts of a unigram model by dynamic programming over a trie of pre-tokens.

A text's pre-tokens are its runs without white space, each after a word mark. A pre-token's tokens are the pieces of
the best-scored way to cut it, and of equally good ways of the one with fewest pieces. The distinct pre-tokens of a
batch form a trie, which is walked depth first (in sorted order); each of its nodes gets its forward score once, from
those of the nodes above, whichever and however many pre-tokens go through it. The counts at terminal nodes are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

MARK = "▁"
#: Texts whose pre-tokens form a trie, at most: batches may be smaller.
ROWS = 512
#: Pre-tokens whose counts are remembered; as many again may be.
REMEMBERED = 300_000


def read_scores(path: str) -> dict[str, float]:
    """The pieces of a vocabulary file with log probabilities by Zipf's law over the file's order of pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(x(i) for x in special)]
    total = math.log(sum(1 / (k + 1) for k in range(len(pieces))))
    return {x: -math.log(k + 1) - total for k, x in enumerate(pieces)}


class Counter:
    """Counts tokens of pre-tokens; a code point in no piece is cut into its UTF-8 bytes, each scored below all pieces."""

    def __init__(self, scores: dict[str, float]):
        self.byte = min(scores.values(), default=0.0) - 10
        #: The ends of pieces, with the scores of those that are pieces: what is in none of them ends the look back.
        self.ends: dict[str, float | None] = {x[i:]: None for x in scores for i in range(1, len(x))}
        self.ends.update(scores)
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def learn(self, words: set[str]) -> None:
        """Adds the counts of the words that are new, in one walk of their trie; afterwards known has all words."""
        if len(self.known) + len(words) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older, ends = self.known, self.older, self.ends
        new = []
        for word in words - known.keys():
            if word in older:
                known[word] = older[word]
            else:
                new.append(word)
        before = ""
        # The forward scores and token counts of the nodes from the root to the word before.
        best, count = [0.0], [0]
        for word in sorted(new):
            text = MARK + word
            shared = 0
            for x, y in zip(before, text):
                if x != y:
                    break
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(text) + 1):
                size = len(text[end - 1].encode("utf-8", "surrogatepass"))
                top, fewest = best[end - 1] + size * self.byte, count[end - 1] + size
                for start in range(end - 1, -1, -1):
                    score = ends.get(text[start:end], 1.0)
                    if score is None:
                        continue
                    if score > 0:
                        break
                    score += best[start]
                    if score > top or score == top and count[start] + 1 < fewest:
                        top, fewest = score, count[start] + 1
                best.append(top)
                count.append(fewest)
            known[word] = count[-1]
            before = text

    def count(self, batch: list[str]) -> list[tuple[int, int]]:
        """Tokens and pre-tokens of each text."""
        words = [x.split() for x in batch]
        self.learn({y for x in words for y in x})
        known = self.known
        return [(sum([known[y] for y in x]), len(x)) for x in words]


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, n_pretokens of every row of docs (doc_id, text).

    path: a vocabulary file. Texts that are null, empty or white space have no tokens. Each row is counted by itself, so
    repeated rows and ties in doc_id give a row each; texts of any length are counted whole; an empty table gives no
    rows. Other columns are not read, whatever their names.
    """
    scores = docs.sparkSession.sparkContext.broadcast(read_scores(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(scores.value)
        for batch in slices(batches, ROWS):
            out = counter.count(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["doc_id", "n_tokens", "n_pretokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "doc_id long, n_tokens long, n_pretokens long")
