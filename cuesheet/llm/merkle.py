"""Document fingerprints: Merkle trees over sections, paragraphs and the pieces of paragraphs.

A text's lines are its paragraphs; blank lines end sections, and so does every paragraph whose hash has two low zero
bits where a section has several, so long texts without blank lines have sections too. A paragraph's leaves are its
sentences, in pieces of LEAF code points at most. Each node's digest is over its children's, so two trees have one root
exactly if the texts are equal, and two unequal trees are compared by going down their differing branches only.

The fingerprint writes the tree out: the root in full, the digests of sections, paragraphs and leaves cut short, and
each leaf's length. Likeness, equality and the places of edits follow from two fingerprints alone.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

LEAF = 100
#: Bytes of the digests that the fingerprint has of inner nodes and leaves.
SHORT = 4

_LEAVES = re.compile(rf"[^.!?]{{0,{LEAF - 1}}}[.!?]+\s*|[^.!?]{{1,{LEAF}}}")
_digest = xxhash.xxh3_128_digest

#: A leaf: its short digest in hexadecimal and its length in code points.
Leaf = tuple[str, int]
#: Paragraphs of a section, each with its short digest and leaves, and the section's own short digest.
Section = tuple[str, list[tuple[str, list[Leaf]]]]


def tree(text: str) -> tuple[str, list[Section]]:
    """The root, in hexadecimal, and the sections of a text's tree."""
    sections: list[Section] = []
    roots: list[bytes] = []
    own: list[tuple[str, list[Leaf]]] = []
    digests: list[bytes] = []

    def end_section() -> None:
        if own:
            digest = _digest(b"S" + b"".join(digests))
            roots.append(digest)
            sections.append((digest[:SHORT].hex(), own.copy()))
            own.clear()
            digests.clear()

    for line in text.split("\n"):
        pieces = _LEAVES.findall(line)
        leaves = [_digest(x) for x in pieces]
        digest = _digest(b"P" + b"".join(leaves))
        own.append((digest[:SHORT].hex(), [(x[:SHORT].hex(), len(y)) for x, y in zip(leaves, pieces)]))
        digests.append(digest)
        if not line.strip() or digest[0] & 3 == 0:
            end_section()
    end_section()
    return _digest(b"D" + b"".join(roots)).hex(), sections


def write(root: str, sections: list[Section]) -> str:
    return "|".join([root, *(f"{s}:" + "/".join(f"{p}=" + ",".join([f"{x}{n:x}" for x, n in leaves]) for p, leaves in paragraphs) for s, paragraphs in sections)])


def read(fingerprint: str) -> tuple[str, list[Section]]:
    root, *sections = fingerprint.split("|")
    out: list[Section] = []
    for s in sections:
        digest, _, rest = s.partition(":")
        own = []
        for p in rest.split("/"):
            name, _, leaves = p.partition("=")
            own.append((name, [(x[: 2 * SHORT], int(x[2 * SHORT :], 16)) for x in leaves.split(",") if x]))
        out.append((digest, own))
    return root, out


def _weight(sections: list[Section]) -> int:
    return sum(n for _, paragraphs in sections for _, leaves in paragraphs for _, n in leaves)


def _apart(a: list, b: list) -> tuple[list, list]:
    """The items of a and of b without those that both have; items are (digest, ...), repeats count."""
    both = Counter(x[0] for x in a) & Counter(x[0] for x in b)
    out = []
    for items in (a, b):
        left, own = both.copy(), []
        for x in items:
            if left[x[0]] > 0:
                left[x[0]] -= 1
            else:
                own.append(x)
        out.append(own)
    return out[0], out[1]


def likeness(a: tuple[str, list[Section]], b: tuple[str, list[Section]]) -> float:
    """The share of two trees' code points in leaves that they share, 0 to 1; 1 exactly if the roots are equal."""
    if a[0] == b[0]:
        return 1.0
    total = _weight(a[1]) + _weight(b[1])
    if not total:
        return 0.0
    sections = _apart(a[1], b[1])
    paragraphs = _apart(*([p for _, own in x for p in own] for x in sections))
    leaves = _apart(*([leaf for _, own in x for leaf in own] for x in paragraphs))
    # Trees that differ are never quite alike, not even if their leaves are the same in another order.
    return min(1 - sum(n for x in leaves for _, n in x) / total, 1 - 1e-9)


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """Where, in code points of a, the leaves are that b lacks: (start, end) of the differing branches of a."""
    (root, own), (other, theirs) = read(a), read(b)
    if root == other:
        return []
    there = Counter(x for _, paragraphs in theirs for _, leaves in paragraphs for x, _ in leaves)
    sections = Counter(s for s, _ in theirs)
    out: list[tuple[int, int]] = []
    at = 0
    for s, paragraphs in own:
        same = sections[s] > 0
        sections[s] -= same
        for _, leaves in paragraphs:
            for x, n in leaves:
                if there[x] > 0:
                    there[x] -= 1
                elif not same:
                    out = out[:-1] + [(out[-1][0], at + n)] if out and out[-1][1] == at else [*out, (at, at + n)]
                at += n
            at += 1
    return out


def fingerprint(text: str) -> str:
    return write(*tree(text))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint of every row of docs (doc_id, text); null is the empty text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in own], pa.int64()), pa.array([fingerprint(x) for x in own], pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sign, "doc_id long, n_chars long, fingerprint string")


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


#: Bytes of texts of a chunk, about: what a task compares, and holds of it only two texts at a time.
CHUNK_BYTES = 32 << 20
#: Code points of a text that part rows of one doc_id.
PART_BY = 32


def compare_with_edited(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Every row of docs (doc_id, text) against an edited text and the next document.

    Documents follow each other by falling doc_id, after the last the first; rows that share a doc_id by rising text,
    those without one come last. A document alone is its own next. The edited text has the last floor(n_chars / 2)
    code points replaced by the first as many, or all, of the next document. Null is the empty text; texts of any
    length are read whole; repeated rows get a row each. An empty table gives no rows. Other columns are not read,
    whatever their names. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next (the likeness to the edited text's and the next document's tree).

    Ranges of this order are chunks of about chunk_bytes, whose texts meet in one shuffle; rows of one doc_id are parted
    by the beginnings of their texts. A copy of the first document of each range goes to the range before it, so that
    tasks need nothing of each other.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rising, so that bounds can be looked up: the larger identifier first, and those without one last.
    rank = F.coalesce(-F.col("doc_id"), F.lit(2**63 - 1))
    place = docs.select(rank.alias("rank"), F.substring(F.coalesce("text", F.lit("")), 1, PART_BY).alias("begin"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    total = place.agg(F.sum("size")).first()[0] or 0
    partitions = max(1, -(-total // chunk_bytes))
    spark = docs.sparkSession
    partitions = max(partitions, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (1 << 20))), 1)
    # Spark's own range partitioner cuts the order; a row per range comes back.
    ranges = place.repartitionByRange(partitions, "rank", "begin").groupBy(F.spark_partition_id()).agg(F.min(F.struct("rank", "begin")).alias("low"), F.max(F.struct("rank", "begin")).alias("high"))
    bounds = sorted((tuple(x["low"]), tuple(x["high"])) for x in ranges.collect())
    lows = [x for x, _ in bounds]
    # The first rows of a range are copied to the range before it.
    before = {low: (k - 1) % len(bounds) for k, low in enumerate(lows)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            keys = list(zip(batch.column("rank").to_pylist(), batch.column("begin").to_pylist()))
            chunk = [bisect.bisect_right(lows, x) - 1 for x in keys]
            far = [i for i, x in enumerate(keys) if x in before]
            rows = pa.array([*range(len(keys)), *far], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*chunk, *(before[keys[i]] for i in far)], pa.int32()), pa.array([False] * len(keys) + [True] * len(far)), *(batch.column(x).take(rows) for x in ("rank", "doc_id", "text"))],
                ["chunk", "far", "rank", "doc_id", "text"],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        done = None
        for batch in slices(batches):
            out = []
            for chunk, far, doc, text in zip(*(batch.column(x).to_pylist() for x in ("chunk", "far", "doc_id", "text"))):
                if far and chunk == done:
                    continue
                text = text or ""
                own = tree(text)
                if last is not None:
                    doc_before, before, tree_before = last
                    half = len(before) // 2
                    edited = before[: len(before) - half] + text[:half]
                    edited_tree = tree(edited)
                    out.append((doc_before, len(before), hashlib.sha256(edited.encode()).hexdigest(), write(*tree_before), write(*edited_tree), likeness(tree_before, edited_tree), likeness(tree_before, own)))
                last, done = (None, chunk) if far else ((doc, text, own), done)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate([pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()])], [x.split()[0] for x in RESULT.split(", ")])

    dealt = docs.select(rank.alias("rank"), F.substring(F.coalesce("text", F.lit("")), 1, PART_BY).alias("begin"), "doc_id", "text").mapInArrow(deal, "chunk int, far boolean, rank long, doc_id long, text string")
    ordered = dealt.repartitionById(max(1, len(bounds)), "chunk").sortWithinPartitions("chunk", "far", "rank", F.coalesce("text", F.lit("")))
    return ordered.mapInArrow(compare, RESULT)
