"""Near-duplicates by SimHash, with candidates from Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. At most two of the bits of a linked pair differ, so
by the pigeonhole principle one of the three segments is the same in both, and the next segment differs in two bits
at most. The next segment, as a word of 23 bits, is decoded by the perfect binary Golay code [23, 12, 7], and so are
the 23 words one bit away from it: one or six codeword indices. Words at distance two or less share an index, as the
word between them decodes to it from either side. A key is a segment's place, its bits, and an index of the next.

Keys of few fingerprints are joined and their pairs verified. For the fingerprints of larger keys the links come from
the words between: all that are at most one bit from the same word are within two bits of each other, and link to
the smallest of them. That is exact and takes 65 rows a fingerprint, however many fingerprints a key has.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_KEYS, join_unique, key_filter, materialise, may_hold, slices, utf8
from .components import connected_components
from .near_copies import alike_groups

SEED = 42
SHINGLE = 3
MAX_BITS = 2
#: (shift, width) of each segment.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, the generator polynomial of the Golay code.
GOLAY = 0b101011100011
#: Fingerprints of a key up to which its pairs are joined.
MAX_PAIRED = 32
#: Shingles whose bits are counted at a time.
COUNTED = 8192


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles: a bit is 1 if it is set in over half the hashes; 0 if there is no word."""
    parts = text.lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), SEED)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1)
    starts = [0, *ends[:-words].tolist()]
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype=">u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), COUNTED):
        counts += np.unpackbits(hashes[at : at + COUNTED].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, digests: bool = False) -> DataFrame:
    """doc_id, fp (a signed 64-bit number), and digest (of the text) if asked for, of each row of docs (doc_id, text)."""
    own = ["doc_id", "digest"] if digests else ["doc_id"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(x) for x in utf8(batch.column("text"))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*map(batch.column, own), pa.array(fps)], [*own, "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _digest().alias("digest")).select("text", *own)
    return rows.mapInArrow(sign, ", ".join(f"{x} long" for x in [*own, "fp"]))


def _digest() -> F.Column:
    """What tells rows of the same doc_id apart: a hash of the text."""
    return F.xxhash64(F.col("text").cast("string"))


@cache
def golay_table() -> np.ndarray:
    """The index of the codeword next to each word of 23 bits, from the code's generator polynomial."""
    codewords = np.zeros(1, dtype=np.uint32)
    for k in range(12):
        codewords = np.concatenate([codewords, codewords ^ np.uint32(GOLAY << k)])
    table = np.empty(1 << 23, dtype=np.uint16)
    index = np.arange(len(codewords), dtype=np.uint16)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            table[codewords ^ np.uint32(sum(1 << b for b in bits))] = index
    return table


def golay_indices(words: np.ndarray) -> np.ndarray:
    """For each word of 23 bits the indices of its own decoding and of the words one bit away: words by 24, with repeats."""
    near = np.concatenate([[0], 1 << np.arange(23)]).astype(np.uint32)
    return golay_table()[words.astype(np.uint32)[:, None] ^ near]


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and the place in fps of each; a fingerprint has a key once at most."""
    bits = fps.view(np.uint64)
    cut = [((bits >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64) for shift, width in SEGMENTS]
    keys, places = [], []
    for i in range(3):
        index = np.sort(golay_indices(cut[(i + 1) % 3]), axis=1).astype(np.int64)
        new = np.ones(index.shape, dtype=bool)
        new[:, 1:] = index[:, 1:] != index[:, :-1]
        place, column = np.nonzero(new)
        keys.append((i << 34) | (cut[i][place] << 12) | index[place, column])
        places.append(place)
    return np.concatenate(keys), np.concatenate(places)


def golay_key_rows(fps: DataFrame) -> DataFrame:
    """key, fp for each key of each row of fps (fp)."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            own = batch.column("fp").to_numpy(zero_copy_only=False)
            key, place = golay_keys(own)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own[place])], ["key", "fp"])

    return fps.select("fp").mapInArrow(keys, "key long, fp long")


def links_between(fps: DataFrame) -> DataFrame:
    """u, v: links that connect the distinct fps (fp) at MAX_BITS differing bits or fewer, all of them true links.

    Not every linked pair has a row, but the components are those of all linked pairs.
    """
    total = fps.count()
    rows = materialise(golay_key_rows(fps))
    sizes = materialise(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    large = sizes.filter(F.col("n") > MAX_PAIRED)
    huge = F.broadcast(large.filter(F.col("n") > max(MAX_PAIRED, total // HOT_KEYS)).select("key"))  # at most HOT_KEYS times the keys of a fingerprint

    few = materialise(rows.join(huge, "key", "left_anti").join(sizes.filter(F.col("n") <= MAX_PAIRED).select("key"), "key", "left_semi"))
    a, b = few.select("key", F.col("fp").alias("u")), few.select("key", F.col("fp").alias("v"))
    pairs = a.join(b, "key").filter(F.expr(f"u > v and bit_count(u ^ v) <= {MAX_BITS}")).select("u", "v")

    dense = rows.join(huge, "key", "left_semi").unionByName(rows.join(huge, "key", "left_anti").join(large.select("key"), "key", "left_semi"))
    between = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    middle = materialise(dense.select("fp").distinct().select("fp", F.explode(between).alias("m")))
    hubs = middle.groupBy("m").agg(F.min("fp").alias("v"), F.count("*").alias("n")).filter("n > 1").select("m", "v")
    stars = middle.join(hubs, "m").filter("fp <> v").select(F.col("fp").alias("u"), "v")
    return pairs.union(stars).distinct()


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """u, v: pairs of nodes (node, fp; a node once) whose fingerprints differ in MAX_BITS bits or fewer, by Golay keys.

    They connect all such nodes: those of one fingerprint to the smallest of them, and these as in links_between.
    """
    total = nodes.count()
    distinct = materialise(nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("n")))
    alone = join_unique(nodes, distinct, "fp", total).filter("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    u, v = (distinct.select(F.col("fp").alias(x), F.col("first").alias(f"{x}_node")) for x in "uv")
    across = links_between(distinct).join(u, "u").join(v, "v")
    return alone.union(across.select(F.greatest("u_node", "v_node"), F.least("u_node", "v_node")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row of docs (doc_id, text) with its component: doc_id, fingerprint, component_id, component_size (rows).

    Documents link if their fingerprints differ in MAX_BITS bits or fewer; component_id is the smallest doc_id that
    can be reached. Texts that are null, empty or without words have fingerprint 0 and link like any others. Rows that
    repeat a doc_id count as documents of their own; rows without one belong to components but never name them, and a
    component of such rows alone has a null component_id. An empty table gives no rows; other columns are not read.
    """
    out = _components(materialise(fingerprints(docs), compact=True))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size")


def _components(own: DataFrame) -> DataFrame:
    """own (doc_id, fp, and more) with component_id and component_size."""
    total = own.count()
    distinct = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    roots = materialise(connected_components(links_between(distinct)))
    named = materialise(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root")))
    best = named.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("component_size"), F.count("*").alias("k"))
    labels = materialise(join_unique(named, materialise(best), "root", total, n="k"))
    return join_unique(own, labels, "fp", total)


def drop_near_copies(docs: DataFrame, words: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """The rows of docs that stay, with all their columns: one document, of the smallest doc_id, for each component.

    Documents link by their fingerprints of three words, or, where a similarity is given, if that of their sets of
    shingles of so many words is as high: pairs by fingerprints are verified first, then the rest by other keys. Each row goes by its own component, also where rows without a doc_id or of
    the same doc_id are in others. Rows without a doc_id stay where their component has no row with one. Rows that
    repeat a doc_id in one component stay or go together: exact deduplication comes first.
    """
    if similarity is None:
        own = _components(materialise(fingerprints(docs, digests=True)))
    else:
        own = alike_groups(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest"), F.col("text").cast("string").alias("text")), words, similarity, fingerprint, fingerprint_pairs)
    gone = materialise(own.filter("doc_id <> component_id or (doc_id is null and component_id is not null)").select(F.col("doc_id").alias("id"), "digest", F.xxhash64("doc_id", "digest").alias("key")).distinct())
    # Most rows stay where they are: only those that may be gone are compared.
    may_be_gone = may_hold(key_filter(gone), docs.sparkSession)
    keyed = docs.select(F.struct(*[docs[x] for x in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), _digest().alias("digest"))
    passing = may_be_gone(F.xxhash64("id", "digest"))
    met = keyed.filter(passing).join(gone.drop("key"), keyed["id"].eqNullSafe(gone["id"]) & (keyed["digest"] == gone["digest"]), "left_anti")
    return keyed.filter(~passing).select("row.*").unionByName(met.select("row.*"))
