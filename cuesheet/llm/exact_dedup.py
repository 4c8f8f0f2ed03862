"""Exact deduplication by a log-structured merge index of text digests.

A task's memtable maps digests to the identifier that stays and the number of rows; when it is full or the task ends it
is flushed as a sorted run; a table's splits are added in turn, a share of them a run. Compaction merges runs by ranges
of digests to one entry each. Every run has a filter of its digests: a lookup asks a run for those digests only that
pass its filter. So of digests that are once in their run only those meet the other runs that a filter there lets
through. Rows whose digest is no hit (no other row has it) are answered without meeting the index, as the hits' filter
does not let them pass; the texts of hits are compared byte by byte.

Texts are equal if they are the same after A-Z are lower-cased; null is the empty text.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, KeyFilter, join_unique, key_filter, materialise, may_hold, slices, utf8

#: Entries of a task's memtable.
MEMTABLE = 200_000
#: Runs that an index has at most before they are merged.
FANOUT = 4
#: Runs that a table's splits are added in; beyond FANOUT of them the first ones are merged on the way.
RUNS = 6


def _normalised(column: pa.Array) -> list[bytes]:
    return utf8(pc.ascii_lower(column))


def _sha(column: pa.Array) -> list[bytes]:
    return [hashlib.sha256(x).digest() for x in _normalised(column)]


def _key(sha: str = "sha") -> F.Column:
    """What a digest is in filters: its first eight bytes."""
    return F.conv(F.hex(F.substring(F.rpad(F.col(sha), F.lit(8), F.lit(b"\0")), 1, 8)), 16, -10).cast("long")


def _keys(sha: list[bytes]) -> np.ndarray:
    """The same for a list of digests."""
    return np.frombuffer(b"".join(x[:8].ljust(8, b"\0") for x in sha), dtype=">i8").astype(np.int64)


def _pair(ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """What an identifier and a digest are in filters."""
    return (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64) ^ keys


def _lowered(text: F.Column) -> F.Column:
    """The normalised text, for rows that are few: Python is faster for whole tables."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def signed(docs: DataFrame, key_bytes: int = 32) -> DataFrame:
    """doc_id, key, sha (of the normalised text), entry_id of each row of docs (doc_id, text).

    key is the first key_bytes bytes of sha; fewer than 32 serve tests of colliding digests.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            sha = _sha(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x[:key_bytes] for x in sha], pa.binary()), pa.array(sha, pa.binary())], ["doc_id", "key", "sha"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sign, "doc_id long, key binary, sha binary")
    return materialise(rows.withColumn("entry_id", F.monotonically_increasing_id()), compact=True)


def _extreme(keep: str, doc: str, entry: str):
    """The entry that stays; a null identifier stays only among nulls."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be largest or smallest")
    null = NULL_ID if keep == "largest" else 2**63 - 1
    best = (F.max if keep == "largest" else F.min)(F.struct(F.coalesce(doc, F.lit(null)).alias("id"), F.col(entry).alias("entry")))
    return F.struct(F.nullif(best["id"], F.lit(null)).alias("id"), best["entry"].alias("entry"))


ENTRY = "key binary, keep_id long, keep_entry long, n long"


def flush(rows: DataFrame, keep: str = "largest", most: int = MEMTABLE) -> DataFrame:
    """The memtables of rows (doc_id, key, entry_id): key, keep_id, keep_entry, n, sorted by key in each run."""
    largest = keep == "largest"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[bytes, list] = {}

        def flushed() -> pa.RecordBatch:
            own = sorted(table.items())
            table.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in own], pa.binary()), *(pa.array([x[i] for _, x in own], pa.int64()) for i in range(3))], ["key", "keep_id", "keep_entry", "n"]
            )

        for batch in batches:
            for doc, key, entry in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "key", "entry_id"))):
                held = table.get(key)
                if held is None:
                    table[key] = [doc, entry, 1]
                    continue
                held[2] += 1
                # A known identifier goes before an unknown one, then the extreme one, of one identifier the extreme entry.
                if (doc is not None, *((doc or 0, entry) if largest else (-(doc or 0), -entry))) > (held[0] is not None, *((held[0] or 0, held[1]) if largest else (-(held[0] or 0), -held[1]))):
                    held[:2] = doc, entry
            if len(table) >= most:
                yield flushed()
        yield flushed()

    return rows.select("doc_id", "key", "entry_id").mapInArrow(run, ENTRY)


def merge(runs: DataFrame, keep: str = "largest", by: tuple[str, ...] = ("key",)) -> DataFrame:
    """Runs merged to one entry per digest, by ranges of digests, in order: by, keep_id, keep_entry, n."""
    ranges = runs.repartitionByRange(*by).sortWithinPartitions(*by)
    merged = ranges.groupBy(*by).agg(_extreme(keep, "keep_id", "keep_entry").alias("best"), F.sum("n").alias("n"))
    return merged.select(*by, F.col("best.id").alias("keep_id"), F.col("best.entry").alias("keep_entry"), "n")


@dataclass
class MergeIndex:
    """Runs with their filters. add flushes rows as a run, and merges the runs if they have become too many."""

    keep: str = "largest"
    fanout: int = FANOUT
    runs: list[tuple[DataFrame, KeyFilter]] = field(default_factory=list)

    def _append(self, run: DataFrame) -> None:
        self.runs.append((run, key_filter(run.select(_key("key").alias("key")))))

    def add(self, rows: DataFrame) -> None:
        """Adds rows (doc_id, key, entry_id)."""
        self._append(materialise(merge(flush(rows, self.keep), self.keep)))
        if len(self.runs) > self.fanout:
            self.compact()

    def compact(self) -> None:
        together = self.runs[0][0]
        for run, _ in self.runs[1:]:
            together = together.unionByName(run)
        self.runs.clear()
        self._append(materialise(merge(together, self.keep)))

    def find(self, keys: DataFrame) -> DataFrame:
        """The entries of keys (key, each once) that the index has: a run is asked for what passes its filter."""
        out = None
        for run, made in self.runs:
            asked = keys.filter(may_hold(made, keys.sparkSession)(_key("key"))).join(run, "key")
            out = asked if out is None else out.unionByName(asked)
        return keys.sparkSession.createDataFrame([], ENTRY) if out is None else merge(out, self.keep)

    def repeated(self) -> DataFrame:
        """The entries of digests that several rows have, in whatever runs: what is once in its run is looked up in the others' filters."""
        out = None
        for run, own in self.runs:
            several = F.col("n") > 1
            for _, made in self.runs:
                if made is not own:
                    several |= may_hold(made, run.sparkSession)(_key("key"))
            some = run.filter(several)
            out = some if out is None else out.unionByName(some)
        return (out if len(self.runs) == 1 else merge(out, self.keep)).filter("n > 1")


def hit_texts(docs: DataFrame, hits: KeyFilter, key_bytes: int = 32) -> DataFrame:
    """The normalised texts of docs whose digest may be a hit (the filter lets all hits through): doc_id, key, sha, body."""
    passing = docs.sparkSession.sparkContext.broadcast((hits.words, hits.places))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    @F.arrow_udf("boolean")
    def may(text: pa.Array) -> pa.Array:
        return pa.array(KeyFilter(*passing.value).may_hold(_keys([x[:key_bytes] for x in _sha(text)])))

    near = rows.filter(may("text")).select("doc_id", F.encode(_lowered(F.col("text")), "UTF-8").alias("body"))
    signed = near.withColumn("sha", F.unhex(F.sha2("body", 256)))
    return signed.select("doc_id", F.substring("sha", 1, key_bytes).alias("key"), "sha", "body")


def exact_groups(docs: DataFrame, keep: str = "largest", key_bytes: int = 32, runs: int = 1) -> DataFrame:
    """Every row of docs (doc_id, text) with its group of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    keep: which identifier of a group stays, the largest or the smallest. keep_id is null if no row of the group has
    one. Exactly one row of each group has kept set, also where rows repeat an identifier or have none (a null
    identifier stays only in a group of nulls), so of ties one row stays, whichever. An empty table gives no rows.
    Texts of any length are read whole. Other columns of docs are not read, whatever their names.

    runs: how many runs the rows' digests are added in, by the splits that they are read in; the result is the same.
    A digest under which the comparison finds two different texts is split by the texts themselves.
    """
    spark = docs.sparkSession
    rows = signed(docs, key_bytes)
    index = MergeIndex(keep)
    for k in range(runs):
        index.add(rows if runs == 1 else rows.filter(F.shiftright("entry_id", 33) % runs == k))
    hits = materialise(index.repeated())
    hit_filter = key_filter(hits.select(_key("key").alias("key")))
    passes = may_hold(hit_filter, spark)(_key("key"))

    bodies = hit_texts(docs, hit_filter, key_bytes)
    compared = bodies.groupBy("key").agg(F.min("body").alias("low"), F.max("body").alias("high"))
    split = materialise(compared.filter("low <> high").select("key"))

    digest = F.lower(F.hex("sha")).alias("text_sha256")
    alone = rows.filter(~passes).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest)
    near = materialise(rows.filter(passes), compact=True)
    met = join_unique(near, hits.withColumn("group_size", F.col("n")), "key", near.count(), "left")
    if not split.isEmpty():
        met = met.join(split, "key", "left_anti")
    # What passes the filter by chance has no entry among the hits.
    single = F.col("group_size").isNull()
    out = alone.unionByName(met.select("doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), (single | F.coalesce(F.col("entry_id") == F.col("keep_entry"), F.lit(False))).alias("kept"), digest))
    if split.isEmpty():
        return out
    own = materialise(bodies.join(split, "key", "left_semi").withColumn("entry_id", F.monotonically_increasing_id()))
    apart = own.groupBy("key", "body").agg(_extreme(keep, "doc_id", "entry_id").alias("best"), F.count("*").alias("group_size"))
    parted = own.join(apart, ["key", "body"]).select("doc_id", F.col("best.id").alias("keep_id"), "group_size", (F.col("entry_id") == F.col("best.entry")).alias("kept"), digest)
    return out.unionByName(parted)


def drop_exact_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever their names.

    Of equal texts (null is the empty one) the row of the largest, or smallest, identifier stays; of rows that have
    both identifier and text in common, one. An empty table gives no rows; texts of any length are compared whole.
    Only rows that may be copies, or repeat an identifier and a text, are moved; the others stay in their tasks.
    """
    groups = materialise(exact_groups(docs, keep).filter("group_size > 1").select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "text_sha256", "kept"))
    pairs = materialise(groups.groupBy("id", "text_sha256").agg(F.max("kept").alias("stays"), F.count("*").alias("n")).filter("n > 1 or not stays"))

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _keys([bytes.fromhex(x[:16]) for x in batch.column("text_sha256").to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(_pair(batch.column("id").to_numpy(zero_copy_only=False), keys))], ["key"])

    made = key_filter(materialise(pairs.select("id", "text_sha256").mapInArrow(paired, "key long")))
    passing = docs.sparkSession.sparkContext.broadcast((made.words, made.places))

    @F.arrow_udf("boolean")
    def may(ids: pa.Array, text: pa.Array) -> pa.Array:
        return pa.array(KeyFilter(*passing.value).may_hold(_pair(ids.to_numpy(zero_copy_only=False), _keys(_sha(text)))))

    own_id, text = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), F.col("text").cast("string")
    keyed = docs.select(F.struct(*[docs[x] for x in docs.columns]).alias("row"), own_id.alias("id"), text.alias("text")).withColumn("may", may("id", "text"))
    met = keyed.filter("may").select("row", "id", F.sha2(F.encode(_lowered(F.col("text")), "UTF-8"), 256).alias("text_sha256"))
    # What passes by chance is no pair and has one row; rows of a pair are copies of each other but for other columns.
    one = Window.partitionBy("id", "text_sha256").orderBy("text_sha256")
    left = met.join(pairs.select("id", "text_sha256", "stays"), ["id", "text_sha256"], "left").filter("stays is null or stays")
    return keyed.filter("not may").select("row.*").unionByName(left.withColumn("at", F.row_number().over(one)).filter("at = 1").select("row.*"))
