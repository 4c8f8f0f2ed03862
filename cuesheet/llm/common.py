"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuesheet import ship
from cuesheet.scratch import scratch_root

#: At most so many keys can each hold more than 1/HOT_KEYS of all rows, so a table of them is small at any input size.
HOT_KEYS = 2000
#: Items or characters of the one column of such a row that may be long, so the table of hot keys has a bound in bytes too.
HOT_WIDTH = 4096

#: Documents handed to Python at a time; a text is never split over two batches.
ROWS_PER_CHUNK = 256

#: Rows of a batch in Parquet's reader and between Spark and Python, which both hold batches whole: texts can be long.
BATCH_ROWS = 512

NULL_ID = -(2**63)


def prepare(spark: SparkSession) -> None:
    """Sends the package to the executors and sets the session's batches to BATCH_ROWS rows, if they are larger.

    Small results of a shuffle are put together by their size, not dealt over all cores: the operators have many such
    steps, each of which would write a file and start a task for each core.
    """
    ship(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    for key in ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
            spark.conf.set(key, str(BATCH_ROWS))


#: Folders of tables that materialise wrote, by application.
_written: dict[str, list[str]] = {}


def materialise(df: DataFrame, compact: bool = False) -> DataFrame:
    """Writes df as Parquet under the shared folder and reads it back, which cuts its lineage.

    compact: for narrow results of a scan, which are put together to few files instead of one for each split. The table
    stays until clean_up, as what is made from it may still be read.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/cuesheet/{uuid.uuid4().hex}"
    (df.hint("rebalance") if compact else df).write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def mark(spark: SparkSession) -> int:
    """How many tables this application has written so far, for clean_up."""
    return len(_written.get(spark.sparkContext.applicationId, []))


def clean_up(spark: SparkSession, since: int = 0, until: int | None = None) -> int:
    """Deletes the tables that materialise wrote in this application after the first since ones (up to until).

    For callers that have stored an operator's result, and for loops whose earlier tables nothing reads any more.
    Returns the number of tables deleted.
    """
    own = _written.get(spark.sparkContext.applicationId, [])
    gone = [i for i in range(len(own))[since:until] if own[i]]
    for i in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(own[i])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        own[i] = ""
    return len(gone)


def release(spark: SparkSession) -> None:
    """Lets the driver drop what nothing refers to any more: plans, broadcasts, and the shuffle files behind them."""
    gc.collect()
    spark._jvm.System.gc()


#: Bits of a key filter for each key, and of any filter at most (32 MB, which is what is broadcast); a fuller one lets more through.
BITS_PER_KEY, MAX_FILTER_BITS = 10, 1 << 28


class KeyFilter:
    """A Bloom filter of 64-bit keys: may_hold is true for all keys that are in it and for few others."""

    def __init__(self, words: np.ndarray, places: int):
        self.words, self.places = words, places

    @staticmethod
    def at(keys: np.ndarray, bits: int, places: int) -> np.ndarray:
        """Where the filter holds each key: keys by places."""
        x = keys.view(np.uint64)
        return np.stack([((x ^ (x >> np.uint64(29 + i))) * np.uint64(0x9E3779B97F4A7C15 + 2 * i) >> np.uint64(20)) & np.uint64(bits - 1) for i in range(places)], axis=1)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        at = self.at(keys, 64 * len(self.words), self.places)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def key_filter(keys: DataFrame, key: str = "key", most_places: int = 4) -> KeyFilter:
    """The filter of a column of longs without nulls. Only its bits, which are bounded, come to the driver.

    most_places: bits of a key at most. Fewer are made faster and let more other keys through: of 1 a tenth at 10 bits a key.
    """
    n = keys.count()
    bits = 1 << 12
    while bits < min(MAX_FILTER_BITS, BITS_PER_KEY * n):
        bits *= 2
    places = max(1, min(most_places, round(0.69 * bits / max(n, 1))))

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = KeyFilter.at(batch.column(0).to_numpy(zero_copy_only=False), bits, places).ravel()
            masks = np.left_shift(np.uint64(1), at & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).view(np.int64)), pa.array(masks)], ["word", "mask"])

    words = np.zeros(bits // 64, dtype=np.int64)
    if len(words) > CHUNK:
        chunks = keys.select(key).mapInArrow(lambda x: _marked(x, bits, places), "chunk long, at binary").groupBy("chunk").applyInPandas(_put_together, "chunk long, words binary")
        for chunk, data in chunks.toPandas().itertuples(index=False):
            words[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(data, dtype=np.int64)
    else:
        rows = keys.select(key).mapInArrow(marks, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
        words[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64)
    return KeyFilter(words.view(np.uint64), places)


#: Words of a filter that are put together by one task and come to the driver as one value, and keys of a task marked at a time.
CHUNK, MARKED = 1 << 13, 1 << 18


def _marked(batches: Iterator[pa.RecordBatch], bits: int, places: int) -> Iterator[pa.RecordBatch]:
    """chunk, at: the places of a filter's bits in each of its chunks, of MARKED keys at a time or more, each once."""

    def end() -> pa.RecordBatch:
        at = np.unique(KeyFilter.at(np.concatenate([np.empty(0, np.int64), *held]), bits, places).ravel())
        chunk = (at >> np.uint64(6)) // np.uint64(CHUNK)
        starts = np.flatnonzero(np.diff(chunk, prepend=chunk[:1] + np.uint64(1)))
        own = np.split((at % np.uint64(64 * CHUNK)).astype(np.uint32), starts[1:])
        return pa.RecordBatch.from_arrays([pa.array(chunk[starts].astype(np.int64)), pa.array([x.tobytes() for x in own[: len(starts)]], pa.binary())], ["chunk", "at"])

    held, n = [], 0
    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False))
        n += len(held[-1])
        if n >= MARKED:
            yield end()
            held, n = [], 0
    yield end()


def _put_together(group: pd.DataFrame) -> pd.DataFrame:
    own = np.zeros(64 * CHUNK, dtype=bool)
    for data in group["at"]:
        own[np.frombuffer(data, dtype=np.uint32)] = True
    return pd.DataFrame({"chunk": group["chunk"].iloc[:1], "words": [np.packbits(own, bitorder="little").tobytes()]})


def may_hold(made: KeyFilter, spark: SparkSession) -> Callable[[Column], Column]:
    """made as a function of a column of longs; only these go to Python, whatever else a row holds."""
    shared = spark.sparkContext.broadcast((made.words, made.places))

    @F.pandas_udf("boolean")
    def probe(keys: pd.Series) -> pd.Series:
        return pd.Series(KeyFilter(*shared.value).may_hold(keys.to_numpy(np.int64)))

    return probe


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_PER_CHUNK) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches into smaller ones, so that the Python objects of few texts live at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts(column: pa.Array) -> list[str]:
    """The strings of a column, null as the empty string."""
    return [x or "" for x in column.to_pylist()]


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as none."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def join_unique(left: DataFrame, right: DataFrame, key: str, total: int, how: str = "inner", n: str = "n", width: str | None = None) -> DataFrame:
    """left joined with right, which has one row per key and in column n the key's number of rows in left.

    Keys of more than total / HOT_KEYS rows are at most HOT_KEYS, so these rows of right are broadcast and the
    rows of a hot key stay where they are; the others meet in a shuffle in which no key is large. width: a column of
    right that may be long; hot rows in which it has more than HOT_WIDTH items or characters are not broadcast but left
    to the shuffle, whose large partitions Spark splits. how: inner or left. n is dropped.
    """
    most = max(total // HOT_KEYS, 1)
    is_hot = F.col(n) > most
    if width is not None:
        size = F.size(width) if right.schema[width].dataType.typeName() == "array" else F.coalesce(F.length(width), F.lit(0))
        is_hot &= size <= HOT_WIDTH
    hot = right.filter(is_hot).drop(n)
    cold = right.filter(~is_hot).drop(n)
    here = left.join(F.broadcast(hot), key)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return here.unionByName(rest)


class Memo(dict):
    """A function's values by argument. The last most arguments or more are remembered, twice as many at most."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
