"""Operators whose decision on a row depends on decisions on rows before it."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..names import fresh
from .blocks import last_kept_before, replay, true_entries, with_block

#: Frames of a recording from which on its blocks of so many seconds are run side by side.
LONG, BLOCK = 20_000, 600.0


def ordered_scan(df: DataFrame, key: str | list[str], order: list, columns: list[str], start: Callable, step: Callable, schema: str) -> DataFrame:
    """Runs step over the rows of each key in order, and adds what it returns to them.

    start() makes a key's state; step(state, row) returns the new columns' values, with row a dict of columns. schema
    lists the new columns. Rows stream through a task in key order, so memory holds one key's state and one batch,
    not the key's rows; the state is what bounds a long recording. Only columns are read in Python; the others pass by.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    keys = [key] if isinstance(key, str) else key
    added = StructType.fromDDL(schema)
    names = added.names
    kinds = [x.type for x in to_arrow_schema(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            owners = zip(*(batch.column(x).to_pylist() for x in keys))
            values = zip(*(batch.column(x).to_pylist() for x in columns))
            out = []
            for own, rest in zip(owners, values):
                if own != current:
                    current, state = own, start()
                out.append(step(state, dict(zip(columns, rest))))
            arrays = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])

    ordered = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return ordered.mapInArrow(run, StructType([*df.schema.fields, *added.fields]))


def numbered(df: DataFrame, by: str, width: int, name: str) -> DataFrame:
    """df with each row's place, from 1, in the order of a column of whole numbers without repeats.

    Rows are ordered in ranges of width numbers; what is before a range comes from the ranges' counts, a row a range.
    """
    counts = df.groupBy(F.expr(f"{by} div {width}").alias("__b")).agg(F.count("*").alias("__n"))
    before = counts.select("__b", F.coalesce(F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    placed = df.withColumn("__b", F.expr(f"{by} div {width}")).withColumn("__i", F.row_number().over(Window.partitionBy("__b").orderBy(by)))
    return placed.join(before, "__b").withColumn(name, F.col("__i") + F.col("__before")).drop("__b", "__i", "__before")


def numbered_as_read(rows: DataFrame, name: str) -> DataFrame:
    """rows of a file's scan (and what maps or explodes them) with their place in it, from 1: nothing is shuffled."""
    low = (1 << 33) - 1
    placed = rows.withColumn("__id", F.monotonically_increasing_id())
    counts = placed.groupBy(F.shiftright("__id", 33).alias("__p")).agg(F.count("*").alias("__n"))
    before = counts.select("__p", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # a row for each split of the file
    own = placed.withColumns({"__p": F.shiftright("__id", 33), "__i": F.col("__id").bitwiseAND(F.lit(low)) + 1})
    return own.join(F.broadcast(before), "__p").withColumn(name, F.col("__i") + F.col("__before")).drop("__p", "__i", "__before", "__id")


def keep_spaced(df: DataFrame, epsilon: float = 0.2, key: str = "video_id", ts: str = "timestamp", seq: str = "seq", strict: bool = True, width: float | None = None, short: bool = False) -> DataFrame:
    """Rows whose ts is more than epsilon after the last row kept of their key; the first row of a key stays.

    With strict False a distance of exactly epsilon is enough. Ties in ts go by seq. The last row kept is compared,
    not the row before: 0, 0.15 and 0.3 with 0.2 keep 0 and 0.3. Rows without a time don't stay.

    A block of width seconds maps the last time kept before it to the last one kept in it. These maps are small, are
    composed over a recording's blocks, and each block is then run from the time it gets: tasks are blocks, not recordings.
    short: recordings are known to be so, and are scanned in one task each, in one shuffle. The result is the same.
    """
    (block,) = fresh(df.columns, "block")
    keep = fresh(df.columns, "keep")[0]
    rows = with_block(df, ts, width or max(600.0, 1000 * epsilon), block)

    def step(state: list, row: dict):
        t, last = row[ts], state[0]
        kept = last is None or (t - last > epsilon if strict else t - last >= epsilon)
        if kept:
            state[0] = t
        return (kept,)

    if short:
        marked = ordered_scan(rows, key, [ts, seq], [ts], lambda: [None], step, f"`{keep}` boolean")
        return marked.filter(F.col(keep)).drop(keep, block)
    entries = last_kept_before(rows, key, block, ts, epsilon, strict)
    marked = replay(rows, entries, key, block, [ts, seq], [ts], lambda entry: [None if entry is None else float(entry)], step, f"`{keep}` boolean")
    return marked.filter(F.col(keep)).drop(keep, block)


def are_short(df: DataFrame, key: str = "video_id") -> bool:
    """Whether no key has more than LONG rows."""
    return (df.groupBy(key).count().agg(F.max("count")).first()[0] or 0) <= LONG


#: What is decided of a frame.
DECISION = "status string, duplicate_of string, hash_distance long, drop_blocked_reason string, candidate_delta_ratio double"


def suppression(time_gap: float, max_distance: int, transition_gap: float, transition_delta: float, delta: Callable | None) -> tuple[Callable, Callable]:
    """The rule of suppress_near_duplicates as settle(recent, t), the kept frames that still matter at t, and step(recent, row),
    which decides on a row (a dict) and appends it to recent if it is kept."""

    def settle(recent: list, t: float) -> list:
        return [x for x in recent if t - x["timestamp"] <= time_gap]

    def step(recent: list, row: dict):
        if row["hash_hi"] is None or row["hash_lo"] is None:
            return ("kept", None, None, None, None)
        t = row["timestamp"]
        while recent and t - recent[0]["timestamp"] > time_gap:
            recent.pop(0)
        for kept in reversed(recent):
            distance = (kept["hash_hi"] ^ row["hash_hi"]).bit_count() + (kept["hash_lo"] ^ row["hash_lo"]).bit_count()
            if distance <= max_distance:
                break
        else:
            recent.append(row)
            return ("kept", None, None, None, None)
        if delta is not None and t - kept["timestamp"] <= transition_gap:
            ratio = delta(row, kept)
            if ratio >= transition_delta:
                recent.append(row)
                return ("kept", kept["frame_path"], distance, "transition_preserved", round(ratio, 6))
        return ("dropped", kept["frame_path"], distance, None, None)

    return settle, step


def suppress_near_duplicates(
    df: DataFrame,
    time_gap: float = 2.0,
    max_distance: int = 6,
    preserve_transitions: bool = True,
    transition_gap: float = 2.5,
    transition_delta: float = 0.012,
    key: str = "video_id",
    delta: Callable | None = None,
    delta_columns: tuple[str, ...] = (),
) -> DataFrame:
    """Marks frames whose hash is close to that of a frame kept shortly before.

    df: key, timestamp, seq, frame_path, hash_hi, hash_lo (the hash's two 32-bit halves; null where the image can't be
    read), and delta_columns, which delta reads besides these. A frame is compared with the kept ones from the newest on, as
    long as they are no more than time_gap older; the first within max_distance bits is its duplicate, and the frame
    is dropped, unless transitions are preserved, it is no more than transition_gap older, and delta(row, kept) is at
    least transition_delta. Frames without a hash stay but are compared with no other. Adds status (kept or dropped),
    duplicate_of, hash_distance, drop_blocked_reason and candidate_delta_ratio.

    The state of a recording is the frames kept in the last time_gap seconds. Where a recording has more than LONG frames,
    recordings are cut into blocks of BLOCK seconds, which are run side by side (see blocks.true_entries); a pause of more
    than time_gap empties the state, so blocks after one need nothing from before.
    """
    columns = list(dict.fromkeys(["timestamp", "seq", "frame_path", "hash_hi", "hash_lo", *delta_columns]))

    settle, step = suppression(time_gap, max_distance, transition_gap, transition_delta, delta if preserve_transitions else None)
    schema = DECISION
    order = ["timestamp", "seq"]
    if are_short(df, key):
        return ordered_scan(df, key, order, columns, list, step, schema)
    (block,) = fresh(df.columns, "block")
    rows = with_block(df, "timestamp", max(BLOCK, 10 * time_gap), block)
    entries = true_entries(rows, key, block, order, columns, "timestamp", step, settle)
    return replay(rows, entries, key, block, order, columns, json.loads, step, schema).drop(block)
