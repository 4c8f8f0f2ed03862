"""Line deduplication by arrays that a sharded minimal perfect hash indexes.

A line's key is the line without white space (x20, x09 to x0D) at both ends and with A-Z lower-cased, as a 128-bit
hash. The distinct hashes of keys that several documents hold go to shards by their first bits; each shard gets a
minimal perfect hash, and under it an array of fingerprints (the other half of the hash) and one of document counts.
Documents probe the arrays line by line: a fingerprint that differs says that the key is not there.

The arrays are broadcast while they are small. Beyond that the lines' hashes are sent to the shards, and what must go
comes back to the documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices, utf8

SPACE = b" \t\n\x0b\x0c\r"
#: Keys that fewer documents hold are not indexed.
INDEXED_FROM = 2
SHARD_KEYS = 1 << 16
#: Bytes of arrays, as they are in a Python worker's memory, up to which they are broadcast.
MAX_BROADCAST = 64 << 20
#: Room for each key on a level of the perfect hash.
ROOM = 1.5
#: Entries of a task's counts before they are handed on.
MEMTABLE = 200_000


def line_hashes(text: bytes, least: int) -> list[bytes]:
    """The hash of each line's key, empty for keys of fewer than least code points."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(SPACE).lower()
        short = len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least
        out.append(b"" if short else xxhash.xxh3_128_digest(key))
    return out


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: on each level a key alone in its place stays, the others go on.

    A key's value is the number of places taken before its own. Limasset et al., Fast and scalable minimal perfect
    hashing for massive key sets, 2017. A level is bits in words of 64, with the number of bits set before each word.
    """

    def __init__(self, levels: list[tuple[int, np.ndarray]]):
        self.levels = levels
        self.ranks, before = [], 0
        for _, words in levels:
            counts = np.bitwise_count(words).astype(np.int64)
            ends = np.cumsum(counts)
            self.ranks.append((before + ends - counts).astype(np.uint32))
            before += int(ends[-1])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = max(1, int(ROOM * len(left)))
            at = (_mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
            taken = np.bincount(at, minlength=-(-size // 64) * 64) == 1
            levels.append((size, np.packbits(taken, bitorder="little").view("<u8")))
            left = left[~taken[at]]
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key; -1, or any value, for keys that were not there."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, ((size, words), ranks) in enumerate(zip(self.levels, self.ranks)):
            at = _mix(keys[left], level) % np.uint64(size)
            word, bit = words[at >> np.uint64(6)], np.uint64(1) << (at & np.uint64(63))
            hit = (word & bit) != 0
            out[left[hit]] = ranks[at[hit] >> np.uint64(6)] + np.bitwise_count(word[hit] & (bit[hit] - np.uint64(1))).astype(np.int64)
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        return b"".join(size.to_bytes(8, "little") + words.tobytes() for size, words in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        levels, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at : at + 8], "little")
            words = np.frombuffer(data, "<u8", -(-size // 64), at + 8)
            levels.append((size, words))
            at += 8 + words.nbytes
        return cls(levels)


def _halves(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(hashes), dtype="<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


class Shard:
    """The arrays of one shard: fingerprints and document counts in the order of the perfect hash."""

    def __init__(self, seed: int, perfect: PerfectHash, prints: np.ndarray, counts: np.ndarray):
        self.seed, self.perfect, self.prints, self.counts = seed, perfect, prints, counts

    @staticmethod
    def _keys(low: np.ndarray, high: np.ndarray, seed: int) -> np.ndarray:
        return _mix(low + _mix(high, seed), seed)

    @classmethod
    def build(cls, hashes: list[bytes], counts: np.ndarray) -> Shard:
        """Over distinct hashes."""
        low, high = _halves(hashes)
        seed = 0
        while len(np.unique(keys := cls._keys(low, high, seed))) < len(hashes):
            seed += 1
        perfect = PerfectHash.build(keys)
        at = perfect.find(keys)
        made = cls(seed, perfect, np.empty_like(high), np.empty_like(counts))
        made.prints[at], made.counts[at] = high, counts
        return made

    def count(self, hashes: list[bytes]) -> np.ndarray:
        """The documents that hold each key, 0 for keys that are not indexed."""
        low, high = _halves(hashes)
        at = self.perfect.find(self._keys(low, high, self.seed))
        if not len(self.counts):
            return np.zeros(len(hashes), dtype=np.int64)
        return np.where((at >= 0) & (self.prints[at] == high), self.counts[at].astype(np.int64), 0)


def _memtable(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["hash", "n"])


def count_lines(docs: DataFrame, least: int) -> DataFrame:
    """hash, n: each key's hash and the documents that hold it; counts are summed in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in slices(batches):
            for text in utf8(batch.column("text")):
                held.update(set(line_hashes(text, least)))
            if len(held) > MEMTABLE:
                yield _memtable(held)
                held.clear()
        yield _memtable(held)

    rows = docs.select(F.col("text").cast("string")).mapInArrow(count, "hash binary, n long")
    return rows.filter("length(hash) > 0").groupBy("hash").agg(F.sum("n").alias("n"))


def _shard_of(shards: int) -> F.Column:
    return F.expr(f"cast(conv(hex(substring(hash, 1, 3)), 16, 10) as bigint) * {shards} div {1 << 24}")


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """shard, seed, perfect, prints, counts: the arrays of each shard over counts (hash, n)."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        made = Shard.build(group["hash"].tolist(), group["n"].to_numpy(dtype=np.int64))
        n = np.minimum(made.counts, 2**32 - 1).astype("<u4")
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "seed": [made.seed], "perfect": [made.perfect.to_bytes()], "prints": [made.prints.tobytes()], "counts": [n.tobytes()]})

    return counts.withColumn("shard", _shard_of(shards)).groupBy("shard").applyInPandas(build, "shard long, seed long, perfect binary, prints binary, counts binary")


def _load(row) -> Shard:
    return Shard(int(row["seed"]), PerfectHash.from_bytes(bytes(row["perfect"])), np.frombuffer(row["prints"], "<u8"), np.frombuffer(row["counts"], "<u4"))


def _drop(texts: list[bytes], gone: list[list[bool]]) -> list[list]:
    kept = [b"\n".join(x for x, out in zip(text.split(b"\n"), drop) if not out) for text, drop in zip(texts, gone)]
    return [[len(x) for x in gone], [sum(x) for x in gone], [x.decode() for x in kept]]


RESULT = "doc_id long, n_lines long, n_dropped long, kept string"


def _arrow(doc_id: pa.Array, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([doc_id, pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])


def _probe_broadcast(docs: DataFrame, index: DataFrame, shards: int, min_docs: int, least: int) -> DataFrame:
    arrays = docs.sparkSession.sparkContext.broadcast(index.toPandas().to_dict("records"))
    loaded: dict[int, dict[int, Shard]] = {}

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not loaded:
            loaded[0] = {int(x["shard"]): _load(x) for x in arrays.value}
        index = loaded[0]
        for batch in slices(batches):
            texts = utf8(batch.column("text"))
            hashes = [line_hashes(x, least) for x in texts]
            flat = [x for own in hashes for x in own]
            asked = np.flatnonzero(np.fromiter(map(len, flat), dtype=np.int64, count=len(flat)))
            first = np.frombuffer(b"".join(flat[i][:3] for i in asked), dtype=np.uint8).reshape(-1, 3).astype(np.int64)
            shard = ((first[:, 0] << 16 | first[:, 1] << 8 | first[:, 2]) * shards) >> 24
            gone = np.zeros(len(flat), dtype=bool)
            for k in np.unique(shard):
                if int(k) in index:
                    at = asked[shard == k]
                    gone[at] = index[int(k)].count([flat[i] for i in at]) >= min_docs
            ends = np.cumsum([0, *map(len, hashes)])
            yield _arrow(batch.column("doc_id"), _drop(texts, [gone[a:b].tolist() for a, b in zip(ends, ends[1:])]))

    return docs.mapInArrow(probe, RESULT)


#: Lines that meet a shard's arrays at a time where these are not broadcast.
LINES_AT_A_TIME = 1 << 20


def _probe_shuffled(docs: DataFrame, index: DataFrame, shards: int, min_docs: int, least: int) -> DataFrame:
    """As _probe_broadcast, for arrays of any size: hashes go to the shards, dealt over copies of a shard that many ask."""
    docs = materialise(docs.withColumn("entry", F.monotonically_increasing_id()))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = [sorted({x for x in line_hashes(text, least) if x}) for text in utf8(batch.column("text"))]
            entry = np.repeat(batch.column("entry").to_numpy(zero_copy_only=False), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([pa.array(entry), pa.array([y for x in own for y in x], pa.binary())], ["entry", "hash"])

    asked = materialise(docs.select("text", "entry").mapInArrow(hashes, "entry long, hash binary").withColumn("shard", _shard_of(shards)))
    copies = asked.groupBy("shard").agg((F.count("*") / F.lit(LINES_AT_A_TIME)).cast("long").alias("more"))
    dealt = asked.join(F.broadcast(copies), "shard").withColumn("copy", F.pmod(F.xxhash64("entry"), F.col("more") + 1)).select("shard", "copy", "entry", "hash")
    arrays = index.join(F.broadcast(copies), "shard").select("*", F.explode(F.sequence(F.lit(0), F.col("more"))).alias("copy")).drop("more")

    def probe(lines: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if lines.empty or shard.empty:
            return lines[["entry", "hash"]].iloc[:0]
        return lines.loc[_load(shard.iloc[0]).count(lines["hash"].tolist()) >= min_docs, ["entry", "hash"]]

    found = dealt.groupBy("shard", "copy").cogroup(arrays.groupBy("shard", "copy")).applyInPandas(probe, "entry long, hash binary")
    gone = found.groupBy("entry").agg(F.collect_list("hash").alias("gone"))  # no more than the document's lines

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch.column("text"))
            sets = [set(x or ()) for x in batch.column("gone").to_pylist()]
            yield _arrow(batch.column("doc_id"), _drop(texts, [[x in own for x in line_hashes(text, least)] for text, own in zip(texts, sets)]))

    return docs.join(gone, "entry", "left").select("doc_id", "text", "gone").mapInArrow(drop, RESULT)


def drop_common_lines(docs: DataFrame, min_docs: int = 10, least: int = 1, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Every row of docs (doc_id, text) without its common lines: doc_id, n_lines, n_dropped, kept.

    A text is split at line feeds; null and the empty text are one empty line. A key of at least least code points
    that at least min_docs (2 or more) rows hold loses all its lines everywhere; the other lines stay in order. A row
    counts once for a key however often it has the line, and rows that repeat a doc_id, a text or both count each. Texts
    of any length are read whole. An empty table gives no rows. Other columns of docs are not read, whatever their names.
    """
    if min_docs < INDEXED_FROM or least < 1:
        raise ValueError(f"min_docs must be {INDEXED_FROM} or more, least 1 or more")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = materialise(count_lines(docs, least).filter(F.col("n") >= INDEXED_FROM))
    shards = max(1, -(-counts.count() // SHARD_KEYS))
    index = materialise(build_index(counts, shards))
    # The arrays are used as they are; a word of the perfect hash has four more bytes, for what is set before it.
    size = index.agg(F.sum(F.length("perfect") * 1.5 + F.length("prints") + F.length("counts"))).first()[0] or 0
    probe = _probe_broadcast if size <= max_broadcast else _probe_shuffled
    return probe(docs, index, shards, min_docs, least)
