"""Documents whose sets of word shingles are alike, to the last pair: the near-dedup stage's links.

The first candidates are those of fingerprints, which the caller finds (simhash.py); their pairs are verified, and what
they link is compared no more. But at a similarity of 0.8 fingerprints differ in about 10 of 64 bits, some in 18, and no
key of such a radius parts documents. So the rest comes from prefixes. Shingles are put in one order, common ones last.
Two sets of similarity s or more share a shingle among the first n - ceil(s n) + 1 of each, so documents meet at the
shingles of their prefixes, and each pair is verified by its whole sets.

Of many documents most have too many shingles of their own to be like any other: a document can miss so many shingles of
another one at most, and its prefix has one more. So a share of all shingles, chosen by their hashes, is counted first, and
a document of which more are in no other than it can miss is left out, with its text. What is left is ordered by what
other such documents have: own shingles, then those of several, then common ones.

Only shingles that several prefixes have are kept; they are found by their hashes, sorted and packed by each task. At
such a shingle each document is first compared with one of them, the hub. A hub that is itself much edited is unlike
many of a large group of near copies; where many stay apart, each document is compared with a few that have most of
such shingles, in rounds. Then those outside the largest component that came of it are compared with all others there.
Pairs of one component need no link, so this is exact, and a large group of copies takes a few rows a document. Shingles
at which many documents stay apart, and all others of a document that has the most of these, go to the end of the order,
and prefixes are taken anew: a group's text or a common passage is then last as a whole, and documents of which too much
else is their own don't meet. Any order that is the same for all documents is right, so a filter says which these are.

Documents that share a passage meet at each of its shingles, but need to be compared at the first that both have only.
So each carries the last few shingles before the one it meets others at, and two with one of these in common don't meet.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KeyFilter, clean_up, join_unique, key_filter, mark, materialise, may_hold, release, slices, utf8
from .components import connected_components

SEED = 42
#: Bytes of words that are hashed together, and of the pieces of a text in which they are, about.
WORD_BYTES, PIECE = 32, 1 << 18
_GAP = re.compile(rb"[ \t\n\r\x0b\x0c]")
#: From how many documents on those are left out that can't be like any other, of 256 hashes those looked at for it, and
#: the bits of each in the filters of what is repeated, which many hashes are in and which may let some others through.
MANY_DOCS, CHOSEN, PLACES = 2000, 96, 1
#: Documents that common shingles are first learned from, about; how often they have one; how many are sent out at most.
SAMPLED, COMMON, MOST_COMMON = 10_000, 5, 100_000
#: Documents that stay apart at a shingle from which it goes to the end of the order, how often prefixes are taken, and
#: from how many pairs for each document of the table a further time pays.
APART, ROUNDS, MANY_PAIRS = 32, 3, 256
#: Classes of nodes that each give a shingle a hub in a round, rounds of such hubs at most, and from how many pairs for
#: each document of the table, at shingles where more than APART stay apart, a round pays.
HUBS, HUB_ROUNDS, CROWDED = 4, 2, 16
#: Shingles before the one at which documents meet that each carries there.
BEFORE = 16
#: Hashes of a shard, about, in which tasks' packed hashes meet, and the bits of a hash that are packed.
SHARD, PACKED_BITS = 1 << 19, 48


_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([x]), SEED) for x in range(256)], dtype=np.uint64)
_POWERS = np.cumprod(np.full(WORD_BYTES, 0x9E3779B97F4A7C15, dtype=np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word of text.lower().split(), in its order: of short words all at once, of longer ones one by one."""
    text = text.lower()
    out, at = [np.empty(0, np.uint64)], 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        out.append(_word_hashes(text[at:end]))
        at = end
    return np.concatenate(out)


def _word_hashes(piece: bytes) -> np.ndarray:
    raw = np.frombuffer(piece, dtype=np.uint8)
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    brief = lengths <= WORD_BYTES
    letters, n = raw[inside], lengths[brief]
    if not brief.all():
        letters = letters[np.repeat(brief, lengths)]
    out = np.empty(len(starts), dtype=np.uint64)
    if len(n):
        first = np.cumsum(n) - n
        own = np.add.reduceat(_BYTES[letters] * _POWERS[np.arange(len(letters)) - np.repeat(first, n)], first)
        out[brief] = (own ^ (own >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    for k in np.flatnonzero(~brief).tolist():
        out[k] = xxhash.xxh3_64_intdigest(piece[starts[k] : starts[k] + lengths[k]], SEED)
    return out


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """Hashes of the different word shingles of a text, sorted; a text of fewer words is one shingle.

    A shingle's hash is mixed from its words' hashes in their order, so each word is hashed, not each shingle.
    """
    own = word_hashes(text)
    if len(own) <= words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(text.lower().split()), SEED)], dtype=np.uint64).view(np.int64)
    n = len(own) - words + 1
    mixed = own[:n].copy()
    for i in range(1, words):
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed += own[i : i + n]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    mixed = np.sort(mixed.view(np.int64))
    new = np.ones(n, dtype=bool)
    new[1:] = mixed[1:] != mixed[:-1]
    return mixed[new]


def short(hashes: np.ndarray) -> np.ndarray:
    """The first PACKED_BITS bits of hashes."""
    return (hashes.view(np.uint64) >> np.uint64(64 - PACKED_BITS)).view(np.int64)


def room_for_others(size: int, similarity: float) -> int:
    """The shingles of a prefix: one more than a set of this size can have that one as similar has not."""
    return size - math.ceil(similarity * size - 1e-9) + 1


def node_of(hashes: np.ndarray) -> int:
    """One number for a set of shingles."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED) - (1 << 63)


def sketch(hashes: np.ndarray) -> bytes:
    """How many hashes of a set begin with each pattern of some bits, about four for each: a byte each, a 32nd of the set.

    None where a count has no room in a byte, which is possible for chosen hashes only.
    """
    bits = max(4, (len(hashes) // 4).bit_length())
    counts = np.bincount((hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def may_be_alike(a: bytes, b: bytes, similarity: float) -> bool:
    """False only if sets with these sketches can't be as similar: they share no more than the lesser counts."""
    if not a or not b:
        return True
    x, y = (np.frombuffer(z, dtype=np.uint8).astype(np.int64) for z in (a, b))
    if len(x) < len(y):
        x, y = y, x
    x = x.reshape(len(y), -1).sum(axis=1)
    shared = np.minimum(x, y).sum()
    return bool(shared >= similarity * (x.sum() + y.sum() - shared) - 1e-9)


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))


def _common(docs: DataFrame, words: int, total: int) -> KeyFilter:
    """The shingles, by their first bits, that several documents of a sample of bounded size have."""
    sampled = docs.filter(F.pmod(F.xxhash64("digest", "doc_id"), F.lit(1_000_003)) < min(1.0, SAMPLED / max(total, 1)) * 1_000_003)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            sets = [shingle_hashes(x, words) for x in utf8(batch.column("text"))]
            key, n = np.unique(short(np.concatenate([np.empty(0, np.int64), *sets])), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    rows = sampled.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON)
    return key_filter(materialise(rows.orderBy(F.desc("n"), "key").limit(MOST_COMMON)))


def _prefixes(docs: DataFrame, words: int, similarity: float, late: list[KeyFilter], sign: Callable[[bytes], int] | None = None) -> DataFrame:
    """doc_id, digest, node, size, sketch, keys: each document's first shingles, those in more of the late filters coming later.

    The late filters are of hashes' first bits. Where sign is given, fp is what it makes of each text, as a signed number.
    """
    more = ["fp long"] if sign is not None else []
    shared = docs.sparkSession.sparkContext.broadcast([(x.words, x.places) for x in late])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [KeyFilter(*x) for x in shared.value]
        for batch in slices(batches):
            own = utf8(batch.column("text"))
            sets = [shingle_hashes(x, words) for x in own]
            flat = np.concatenate([np.empty(0, np.int64), *sets])
            weight = np.sum([x.may_hold(short(flat)) for x in filters], axis=0, dtype=np.int64) if filters else np.zeros(len(flat), np.int64)
            sizes = np.array([len(x) for x in sets], dtype=np.int64)
            # One sort for the batch: by document, then weight, then hash.
            owner = np.repeat(np.arange(len(sets)), sizes)
            order = np.lexsort((flat, weight, owner))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            first = np.array([room_for_others(n, similarity) for n in sizes.tolist()], dtype=np.int64)
            kept = flat[order[place < np.repeat(first, sizes)]]
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(first)]).astype(np.int32)), pa.array(kept))
            nodes = np.array([node_of(x) for x in sets], dtype=np.int64)
            columns = {"doc_id": batch.column("doc_id"), "digest": batch.column("digest"), "node": pa.array(nodes), "size": pa.array(sizes.astype(np.int32)), "sketch": pa.array([sketch(x) for x in sets], pa.binary()), "keys": keys}
            if sign is not None:
                columns["fp"] = pa.array(np.array([sign(x) for x in own], dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "digest", "text").mapInArrow(cut, ", ".join(["doc_id long, digest long, node long, size int, sketch binary, keys array<long>", *more]))


def pack(values: np.ndarray) -> bytes:
    """Sorted numbers as differences of one to seven bytes, each with its low bits first and a high bit where one follows."""
    left = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    parts = np.zeros((len(left), 7), dtype=np.uint8)
    used = np.zeros((len(left), 7), dtype=bool)
    more = np.ones(len(left), dtype=bool)
    for k in range(7):
        used[:, k] = more
        after = more & (left > 127)
        parts[:, k] = (left & np.uint64(127)).astype(np.uint8) | (after.astype(np.uint8) << 7)
        left, more = left >> np.uint64(7), after
    return parts[used].tobytes()


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(raw < 128)
    if not len(ends):
        return np.empty(0, np.uint64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.cumsum(np.add.reduceat((raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64), starts), dtype=np.uint64)


def _keys_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("keys").flatten().to_numpy(zero_copy_only=False)


def repeated_keys(prefixes: DataFrame, total: int, column: str = "keys", read: Callable[[pa.RecordBatch], np.ndarray] = _keys_of) -> DataFrame:
    """key: the first PACKED_BITS bits of the hashes that several prefixes have, and by chance of few others.

    total: hashes in all prefixes, about. read: the hashes of a batch of column. A task sends a hash twice at most, so no
    hash is hot.
    """
    shards = 1
    while shards * SHARD < total:
        shards *= 2
    low = PACKED_BITS - shards.bit_length() + 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in slices(batches):
            held.append(read(batch))
            n += len(held[-1])
            if n > 2 * SHARD:
                yield packed(held)
                held, n = [], 0
        yield packed(held)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        own = np.sort(short(np.concatenate([np.empty(0, np.int64), *held])).view(np.uint64))
        twice = np.ones(len(own), dtype=bool)
        twice[2:] = own[2:] != own[:-2]
        own = own[twice]
        cuts = np.searchsorted(own, np.arange(1, shards, dtype=np.uint64) << np.uint64(low)) if shards > 1 else []
        parts = [(k, pack(x)) for k, x in enumerate(np.split(own, cuts)) if len(x)]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int64()), pa.array([x for _, x in parts], pa.binary())], ["shard", "data"])

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        own = np.sort(np.concatenate([unpack(x) for x in group["data"]]))
        return pd.DataFrame({"key": np.unique(own[1:][own[1:] == own[:-1]]).view(np.int64)})

    return prefixes.select(column).mapInArrow(send, "shard long, data binary").groupBy("shard").applyInPandas(meet, "key long")


def may_be_like_others(docs: DataFrame, words: int, similarity: float) -> tuple[DataFrame, DataFrame, int]:
    """The rows of docs that may be as similar to another, doc_id and digest of those that are not, and the shingles of the first.

    Of a share of the shingles it is found which are in one row only. A row of which more are than it can miss is alone;
    rows of one set never are. Each row is in one of the two tables.
    """
    spark = docs.sparkSession
    began = mark(spark)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_hashes(x, words) for x in utf8(batch.column("text"))]
            columns = [pa.array([len(x) for x in sets], pa.int32()), _lists([x[(x & 255) < CHOSEN] for x in sets])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), *columns], ["doc_id", "digest", "size", "keys"])

    chosen = materialise(docs.select("doc_id", "digest", "text").mapInArrow(choose, "doc_id long, digest long, size int, keys array<long>"))
    repeated = key_filter(materialise(repeated_keys(chosen, chosen.agg(F.sum(F.size("keys"))).first()[0] or 0)), most_places=PLACES)
    shared = spark.sparkContext.broadcast((repeated.words, repeated.places))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filtered = KeyFilter(*shared.value)
        for batch in slices(batches, 1024):
            counts = batch.column("keys").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(counts)), counts)
            own = np.bincount(owner[~filtered.may_hold(short(_keys_of(batch)))], minlength=len(counts))
            room = [room_for_others(n, similarity) for n in batch.column("size").to_pylist()]
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("doc_id", "digest", "size")), pa.array(own < room)], ["doc_id", "digest", "size", "may"])

    row = F.xxhash64("doc_id", "digest")
    judged = materialise(chosen.mapInArrow(judge, "doc_id long, digest long, size int, may boolean").withColumn("row", row))
    clean_up(spark, began, mark(spark) - 1)
    passing = may_hold(key_filter(judged.filter("may"), "row"), spark)
    # Both sides by the same filter, which lets few others through: no text is shuffled.
    left = materialise(docs.filter(passing(row)))
    sided = materialise(judged.select("doc_id", "digest", "size", passing("row").alias("left")))
    return left, sided.filter("not left").select("doc_id", "digest"), sided.filter("left").agg(F.sum("size")).first()[0] or 0


def _rows(prefixes: DataFrame, repeated: KeyFilter) -> DataFrame:
    """key, node, size, at (the place in the prefix), once for each set and each of its keys that may be repeated."""
    shared = prefixes.sparkSession.sparkContext.broadcast((repeated.words, repeated.places))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = KeyFilter(*shared.value)
        for batch in slices(batches, 1024):
            keys = batch.column("keys").flatten().to_numpy(zero_copy_only=False)
            counts = batch.column("keys").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)
            kept = own.may_hold(short(keys))
            columns = [np.repeat(batch.column(x).to_numpy(zero_copy_only=False), counts)[kept] for x in ("node", "size")]
            yield pa.RecordBatch.from_arrays([pa.array(keys[kept]), *map(pa.array, columns), pa.array(at[kept].astype(np.int32))], ["key", "node", "size", "at"])

    return prefixes.select("node", "size", "keys").mapInArrow(pick, "key long, node long, size int, at int").distinct()


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, hashes of the rows of docs that wanted (row) has, and of few others."""
    made = key_filter(wanted, "row")
    asked = docs.sparkSession.sparkContext.broadcast((made.words, made.places))

    # The filter is asked by the function that reads: a filter of its own would have a second Python worker in each task.
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = KeyFilter(*asked.value)
        for batch in slices(batches):
            batch = batch.filter(pa.array(own.may_hold(batch.column("row").to_numpy(zero_copy_only=False))))
            sets = [shingle_hashes(x, words) for x in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([node_of(x) for x in sets], pa.int64()), _lists(sets)], ["node", "hashes"])

    return docs.select(F.xxhash64("doc_id", "digest").alias("row"), "text").mapInArrow(read, "node long, hashes array<long>")


def _verified(pairs: DataFrame, prefixes: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (u, v) of nodes that are as similar as asked.

    Sketches rule out most of those that are not. Of the others the texts of one document for each node are read again.
    """
    spark = docs.sparkSession
    began = mark(spark)
    pairs = materialise(pairs.distinct())
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    few = may_hold(key_filter(nodes, "node"), spark)
    found = prefixes.filter(few(F.col("node"))).groupBy("node").agg(F.min_by(F.struct(F.xxhash64("doc_id", "digest").alias("row"), "sketch"), F.struct("digest", "doc_id")).alias("one"))
    known = materialise(found.select("node", "one.*").join(nodes, "node", "left_semi"))

    @F.pandas_udf("boolean")
    def possible(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([may_be_alike(x, y, similarity) for x, y in zip(a, b)], dtype=bool)

    # The pairs of a hub may be many, its set is one: joined on v, which is the hub, hot keys are dealt apart.
    degree = pairs.groupBy("v").agg(F.count("*").alias("n"))
    sketches = known.join(degree, F.col("node") == F.col("v")).select("v", "n", F.col("sketch").alias("b"))
    met = join_unique(pairs.join(known.select(F.col("node").alias("u"), F.col("sketch").alias("a")), "u"), sketches, "v", pairs.count())
    pairs = materialise(met.filter(possible("a", "b")).select("u", "v"))
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    wanted = materialise(known.select("node", "row").join(nodes, "node", "left_semi"))
    bodies = materialise(_sets(docs, wanted, words))
    # Rows that repeat a doc_id and a text are read all; few others that no pair needs are too.
    n, distinct = bodies.join(wanted.select("node"), "node", "left_semi").agg(F.count("*"), F.count_distinct("node")).first()
    if n > distinct:
        bodies = materialise(bodies.dropDuplicates(["node"]))
    degree = bodies.join(pairs.groupBy("v").agg(F.count("*").alias("n")), F.col("node") == F.col("v")).select("v", "n", F.col("hashes").alias("b"))
    here = pairs.join(bodies.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u")
    both = join_unique(here, degree, "v", pairs.count(), width="b")

    @F.pandas_udf("long")
    def common(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)], dtype="int64")

    counted = both.select("u", "v", common("a", "b").alias("both"), (F.size("a") + F.size("b")).alias("sum"))
    out = materialise(counted.filter(F.col("both") >= similarity * (F.col("sum") - F.col("both")) - 1e-9).select("u", "v"))
    clean_up(spark, began, mark(spark) - 1)
    return out


def _crowded_rows(placed: DataFrame, crowded: DataFrame) -> DataFrame:
    """key, node, size, at, root of the rows of placed at the keys of crowded (key, all: rows of the key), and known: how many of these keys the node has."""
    rows = placed.select("key", "node", "size", "at", "root")
    own = materialise(join_unique(rows, crowded.select("key", "all"), "key", placed.count(), n="all"))
    return materialise(own.join(own.groupBy("node").agg(F.count("*").alias("known")), "node"))


def hub_pairs(known: DataFrame, crowded: DataFrame, used: DataFrame | None, fits: Callable[[str, str], str]) -> DataFrame:
    """u, v: for each node HUBS nodes at most of other components that it meets at the keys of crowded and fits there.

    known: as _crowded_rows gives it. v is a hub: of each class of nodes the one with the most of these keys of those that
    a key has, and among these of the fewest shingles before, as what is little edited is like the most of a group. No node
    of used is one.
    """
    free = known if used is None else known.join(used, "node", "left_anti")
    of_class = F.pmod(F.xxhash64("node"), F.lit(HUBS))
    hubs = free.groupBy("key").agg(*[F.max(F.when(of_class == i, F.struct("known", (-F.col("at") / F.col("size")).alias("early"), "node", "size", "at", "root"))).alias(f"hub{i}") for i in range(HUBS)])
    met = join_unique(known, materialise(hubs.join(crowded.select("key", "all"), "key")), "key", known.count(), n="all")
    fit = [fits("known", f"hub{i}").replace("known.", "") for i in range(HUBS)]
    best = materialise(met.groupBy("node").agg(*[F.max(F.when(F.expr(f"root <> hub{i}.root and {fit[i]}"), F.col(f"hub{i}"))).alias(f"hub{i}") for i in range(HUBS)]))
    pairs = [best.filter(f"hub{i} is not null").selectExpr("node as u", f"hub{i}.node as v") for i in range(HUBS)]
    return reduce(DataFrame.union, pairs)


def _short(key: str) -> Column:
    return F.shiftrightunsigned(key, 64 - PACKED_BITS).alias(key)


def whole_texts(known: DataFrame, prefixes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """key: all shingles, by their first bits, of the nodes with the most keys of those that each key of known has, and few others."""
    nodes = known.groupBy("key").agg(F.max(F.struct("known", -F.col("at") / F.col("size"), "node")).alias("hub")).select("hub.node").distinct()
    wanted = prefixes.join(materialise(nodes), "node", "left_semi").groupBy("node").agg(F.min(F.xxhash64("doc_id", "digest")).alias("row"))
    return _sets(docs, materialise(wanted), words).select(F.explode("hashes").alias("key")).select(_short("key")).distinct()


def first_meetings(placed: DataFrame, apart: DataFrame, fits: Callable[[str, str], str]) -> DataFrame:
    """u, v, seldom more than once each: nodes in different components that fit at the first key that both have.

    placed: key, node, size, at, hub, root, a row for each node and key; apart: key, all (rows of the key), top, for keys
    at which nodes stay outside top.root. Of two such nodes, or one of them and another, neither is the key's hub. Of the
    keys that two nodes have in common only the first counts: keys whose BEFORE ones before, of those in apart, have one
    in common come later.
    """
    own = join_unique(placed, apart.select("key", "all", "top"), "key", placed.count(), n="all")
    last = Window.partitionBy("node").orderBy("at").rowsBetween(-BEFORE, -1)
    own = own.withColumn("before", F.collect_list("key").over(last)).filter("node <> hub.node")
    own = materialise(own.selectExpr("key", "node", "size", "at", "root", "before", "root <> top.root as outside"))
    once = "(a.node > b.node or not b.outside) and not arrays_overlap(a.before, b.before)"
    met = own.filter("outside").alias("a").join(own.alias("b"), "key").filter(f"a.root <> b.root and {fits('a', 'b')} and {once}")
    return met.selectExpr("greatest(a.node, b.node) as u", "least(a.node, b.node) as v")


def signed_links(prefixes: DataFrame, docs: DataFrame, words: int, similarity: float, candidates: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node, root of the components of what candidates finds among nodes (node, fp): pairs (u, v) of which those count that are as similar."""
    spark = docs.sparkSession
    began = mark(spark)
    nodes = materialise(prefixes.groupBy("node").agg(F.min("fp").alias("fp")))
    roots = materialise(connected_components(_verified(candidates(nodes), prefixes, docs, words, similarity)))
    clean_up(spark, began, mark(spark) - 1)
    return roots


def alike_groups(docs: DataFrame, words: int, similarity: float, sign: Callable[[bytes], int] | None = None, candidates: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """doc_id, digest, component_id of every row of docs (doc_id, digest, text).

    Rows link if the Jaccard similarity of their sets of word shingles is this or more. component_id is the smallest
    doc_id that can be reached, null where no row reached has one. Texts without words are all alike. sign and
    candidates: a fingerprint of a text, and pairs of nodes by these, as in signed_links; both or neither. They change
    which pairs are compared, not the result.
    """
    spark, every = docs.sparkSession, docs.count()
    alone, late, links = None, [], None
    if every >= MANY_DOCS:
        docs, alone, hashes = may_be_like_others(docs, words, similarity)
        of_texts = lambda batch: np.concatenate([np.empty(0, np.int64), *[shingle_hashes(x, words) for x in utf8(batch.column("text"))]])
        late = [key_filter(materialise(repeated_keys(docs, hashes, "text", of_texts)), most_places=PLACES)]
    total = docs.count()
    release(spark)
    late.append(_common(docs, words, total))
    # The first shingle that two sets share leaves room for as many more as they need.
    alike = f"least({{0}}.size, {{1}}.size) >= {similarity} * greatest({{0}}.size, {{1}}.size) - 1e-9"
    enough = f"least({{0}}.size - {{0}}.at, {{1}}.size - {{1}}.at) >= {similarity / (1 + similarity)} * ({{0}}.size + {{1}}.size) - 1e-6"
    fits = lambda a, b: f"{alike} and {enough}".format(a, b)
    # What a node needs to fit any other of its key, whose smallest size is least.
    room = f"size - at >= {similarity / (1 + similarity)} * (size + greatest(least, {similarity} * size)) - 1e-6"
    for k in range(ROUNDS):
        began = mark(spark)
        prefixes = materialise(_prefixes(docs, words, similarity, late, None if k else sign))
        if not k and candidates is not None:
            roots = signed_links(prefixes, docs, words, similarity, candidates)
            links = roots.filter("node <> root").selectExpr("node as u", "root as v")
            release(spark)
        hashes = prefixes.agg(F.sum(F.size("keys"))).first()[0] or 0
        rows = materialise(_rows(prefixes, key_filter(materialise(repeated_keys(prefixes, hashes)))))
        release(spark)
        hubs = rows.groupBy("key").agg(F.min(F.struct("node", "size", "at")).alias("hub"), F.count("*").alias("n")).filter("n > 1")
        met = materialise(join_unique(rows, materialise(hubs), "key", rows.count()))
        stars = met.filter(f"node <> hub.node and {fits('met', 'hub')}".replace("met.", "")).selectExpr("node as u", "hub.node as v")
        if links is not None:
            # What is linked already is not compared again.
            own, other = (links.select(F.col("u").alias(x), F.col("v").alias(f"{x}_root")) for x in "uv")
            known = materialise(stars.distinct()).join(own, "u", "left").join(other, "v", "left")
            stars = known.filter("coalesce(u_root, u) <> coalesce(v_root, v)").select("u", "v")
        found = _verified(stars, prefixes, docs, words, similarity)
        links = found if links is None else links.union(found)
        used = None
        for j in range(HUB_ROUNDS + 1):
            release(spark)
            start = mark(spark)
            roots = materialise(connected_components(links))
            links = roots.filter("node <> root").selectExpr("node as u", "root as v")
            if j:
                clean_up(spark, before, until)
            placed = materialise(met.join(roots, "node", "left").select("key", "node", "size", "at", "hub", F.coalesce("root", "node").alias("root")))
            counted = placed.groupBy("key", "root").agg(F.count("*").alias("n"), F.min("size").alias("least")).groupBy("key").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n"), F.min("least").alias("least"))
            counted = materialise(counted)
            rest = join_unique(placed, counted, "key", placed.count()).filter(f"root <> top.root and node <> hub.node and {room}")
            apart = materialise(rest.groupBy("key").agg(F.count("*").alias("n")).join(counted.select("key", F.col("n").alias("all"), "top"), "key"))
            crowded = apart.filter(F.col("n") > APART)
            many = (crowded.agg(F.sum(F.col("n") * F.col("all"))).first()[0] or 0) > CROWDED * every
            if j == HUB_ROUNDS or not many:
                break
            pairs = materialise(hub_pairs(_crowded_rows(placed, crowded), crowded, used, fits))
            found = _verified(pairs, prefixes, docs, words, similarity)
            if found.isEmpty():
                break
            # Of this round only its links and hubs are read again.
            before, until = start, mark(spark)
            tried = pairs.select(F.col("v").alias("node")).distinct()
            used = materialise(tried if used is None else used.union(tried).distinct())
            links = links.union(found)
        if k + 1 == ROUNDS or not many and (apart.agg(F.sum(F.col("n") * F.col("all"))).first()[0] or 0) <= MANY_PAIRS * every:
            break
        later = whole_texts(_crowded_rows(placed, crowded), prefixes, docs, words).union(crowded.select(_short("key")))
        late.append(key_filter(materialise(later.distinct())))
        # Of this round only its links are read again.
        links = materialise(links)
        clean_up(spark, began, mark(spark) - 1)
    links = links.union(_verified(first_meetings(placed, apart, fits), prefixes, docs, words, similarity))
    release(spark)
    roots = connected_components(links)
    nodes = materialise(prefixes.groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    named = materialise(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    best = materialise(named.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("k")))
    labels = materialise(join_unique(named, best, "root", total, n="k").select("node", "n", "component_id"))
    out = join_unique(prefixes.select("doc_id", "digest", "node"), labels, "node", total).select("doc_id", "digest", "component_id")
    return out if alone is None else out.union(alone.withColumn("component_id", F.col("doc_id")))
