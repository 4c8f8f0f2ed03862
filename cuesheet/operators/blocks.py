"""Order-dependent operators over blocks of time, so that one long recording is spread over tasks.

A block maps the state before its first row to the state after its last. Blocks tell this map for the states that can
come in, the maps are composed in order of time, a row a block, and each block is then run again from its own state.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..names import fresh
from ..scratch import scratch_root


def with_block(df: DataFrame, ts: str, width: float, name: str) -> DataFrame:
    """Rows that have a time, with their block of width seconds."""
    t = F.col(ts).cast("double")
    return df.filter(t.isNotNull() & ~F.isnan(t)).withColumn(name, F.floor(t / width).cast("long"))


def _types(schema: str) -> tuple[list[str], list[pa.DataType], list]:
    from pyspark.sql.pandas.types import to_arrow_schema

    own = StructType.fromDDL(schema)
    return own.names, [x.type for x in to_arrow_schema(own)], own.fields


def _together(df: DataFrame, key: str, block: str) -> DataFrame:
    """df shuffled so that a block's rows are in one task.

    By a hash of key and block, not by these themselves: sides of a union that are dealt by them already would be left
    where they are, and adaptive execution may change how one of them is dealt after that was decided.
    """
    return df.repartition(F.xxhash64(key, block))


def replay(df: DataFrame, entries: DataFrame, key: str, block: str, order: list, columns: list[str], begin: Callable, step: Callable, schema: str) -> DataFrame:
    """df with the columns that step(state, row) returns, each block from its state begin(entry).

    entries: key, block, entry (a string), a row for each block of df. It comes before the block's rows in the same shuffle,
    so rows are neither joined nor shuffled twice. A task holds one state and one batch.
    """
    entry, is_row = fresh(df.columns, "entry", "is_row")
    names, kinds, fields = _types(schema)
    marks = entries.select(F.col(key), F.col(block), F.col("entry").alias(entry), F.lit(False).alias(is_row))
    both = df.withColumns({entry: F.lit(None).cast("string"), is_row: F.lit(True)}).unionByName(marks, allowMissingColumns=True)
    placed = _together(both, key, block).sortWithinPartitions(key, block, is_row, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            real = batch.column(is_row)
            out = []
            values = zip(*(batch.column(x).to_pylist() for x in columns))
            for own, row, start, rest in zip(zip(batch.column(key).to_pylist(), batch.column(block).to_pylist()), real.to_pylist(), batch.column(entry).to_pylist(), values):
                if own != current:
                    current, state = own, begin(start)
                if row:
                    out.append(step(state, dict(zip(columns, rest))))
            kept = batch.filter(real)
            arrays = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *arrays], [*batch.schema.names, *names])

    return placed.mapInArrow(run, StructType([*both.schema.fields, *fields])).drop(entry, is_row)


# --- places and order statistics ----------------------------------------------------------------------------------


def placed(df: DataFrame, key: str, block: str, order: list, name: str) -> DataFrame:
    """df with each row's place, from 1, among its key's rows in order, of which block is the coarse part.

    Blocks are ordered by themselves; what is before one comes from the blocks' counts, a row a block. So a key with many
    rows is spread over tasks. Blocks are no nulls.
    """
    i, n, before = fresh(df.columns, "i", "n", "before")
    counts = df.groupBy(key, block).agg(F.count("*").alias(n))
    earlier = F.coalesce(F.sum(n).over(Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = df.withColumn(i, F.row_number().over(Window.partitionBy(key, block).orderBy(*order)))
    return own.join(counts.select(key, block, earlier.alias(before)), [key, block]).withColumn(name, F.col(i) + F.col(before)).drop(i, before)


def previous(df: DataFrame, key: str, block: str, order: list[str], value: Column, name: str) -> DataFrame:
    """df with the value of the row before in its key's order, of which block is the coarse part; null for the first.

    Within a block it is the neighbour's; a block's first row has it from the last row of the block before.
    """
    (edge,) = fresh(df.columns + [name], "edge")
    ends = df.groupBy(key, block).agg(F.max_by(F.struct(value.alias("v")), F.struct(*order)).alias(edge))
    ends = ends.select(key, block, F.lag(edge).over(Window.partitionBy(key).orderBy(block))["v"].alias(edge))
    first = F.row_number().over(Window.partitionBy(key, block).orderBy(*order)) == 1
    (is_first,) = fresh(df.columns + [name, edge], "is_first")
    own = df.withColumns({is_first: first, name: F.lag(value).over(Window.partitionBy(key, block).orderBy(*order))})
    joined = own.join(ends, [key, block])
    return joined.withColumn(name, F.when(F.col(is_first), F.col(edge)).otherwise(F.col(name))).drop(is_first, edge)


def value_at(df: DataFrame, key: str, value: str, share: float, width: float) -> DataFrame:
    """key, n (its rows), value: of a key's n sorted values the one at floor(share * (n - 1)), from 0; nulls come first.

    Values are counted in buckets of width; only the bucket that has the place is looked into, and its values are counted,
    not sorted, before that. Nothing orders all of a key's values.
    """
    bucket = F.floor(F.col(value) / width)
    rows = df.select(F.col(key), F.coalesce(bucket, F.lit(-(2**62))).alias("bucket"), F.col(value).alias("value"))

    def reached(counts: DataFrame, by: list[str], order: str, place) -> DataFrame:
        earlier = F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(F.asc_nulls_first(order)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        at = counts.withColumn("earlier", earlier).withColumn("at", place)
        return at.filter((F.col("earlier") <= F.col("at")) & (F.col("at") < F.col("earlier") + F.col("n"))).withColumn("at", F.col("at") - F.col("earlier"))

    counts = rows.groupBy(key, "bucket").agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy(key)))
    buckets = reached(counts, [key], "bucket", F.floor((F.col("total") - 1) * share)).select(key, "bucket", "at", "total")
    inside = rows.join(buckets, [key, "bucket"]).groupBy(key, "bucket", "value").agg(F.count("*").alias("n"), F.first("at").alias("place"), F.first("total").alias("total"))
    return reached(inside, [key], "value", F.col("place")).select(key, F.col("total").alias("n"), "value")


# --- greedy spacing -----------------------------------------------------------------------------------------------


def beyond(times: np.ndarray, last: float, epsilon: float, strict: bool) -> int:
    """The place of the first of sorted times that is far enough after last; their number if there is none."""
    far = (lambda t: t - last > epsilon) if strict else (lambda t: t - last >= epsilon)
    at = int(np.searchsorted(times, last + epsilon))
    # last + epsilon is rounded, as t - last is: the places differ by few.
    while at < len(times) and not far(times[at]):
        at += 1
    while at > 0 and far(times[at - 1]):
        at -= 1
    return at


def spacing(times: np.ndarray, epsilon: float, strict: bool) -> tuple[list[float], list[float]]:
    """A block's map from the last time kept before it to the last one kept: (upto, result).

    What is kept first is the first time far enough after the last one before; wherever it is, it is at most one epsilon
    after the block's first time. Chains from there fall together after few steps, so each step is made once, and
    neighbours with one result become one entry: upto has the last of their times.
    """
    results: dict[int, float] = {}
    first = beyond(times, times[0], epsilon, strict)
    upto, out = [], []
    for start in range(min(first, len(times) - 1) + 1):
        path, at = [], start
        while at < len(times) and at not in results:
            path.append(at)
            at = beyond(times, times[at], epsilon, strict) if epsilon > 0 or strict else at + 1
        end = results[at] if at < len(times) else float(times[path[-1]])
        results.update(dict.fromkeys(path, end))
        if out and out[-1] == end:
            upto[-1] = float(times[start])
        else:
            upto.append(float(times[start]))
            out.append(end)
    return upto, out


def _spacings(batches: Iterator[pa.RecordBatch], epsilon: float, strict: bool) -> Iterator[pa.RecordBatch]:
    """Of rows (key, block, time) in order: each block's map. A task holds the distinct times of one block."""
    held: list[float] = []
    current = schema = None

    def end() -> pa.RecordBatch:
        upto, out = spacing(np.array(held), epsilon, strict)
        return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip((*current, upto, out), schema.types)], schema=schema)

    for batch in batches:
        if schema is None:
            key, block = batch.schema.field(0), batch.schema.field(1)
            schema = pa.schema([key, block, ("upto", pa.list_(pa.float64())), ("result", pa.list_(pa.float64()))])
        for *own, t in zip(*(x.to_pylist() for x in batch.columns)):
            if own != current:
                if current is not None:
                    yield end()
                current, held = own, []
            if not held or t != held[-1]:
                held.append(t)
    if current is not None:
        yield end()


def _last_kept(batches: Iterator[pa.RecordBatch], epsilon: float, strict: bool) -> Iterator[pa.RecordBatch]:
    """Composes the blocks' maps in order: the last time kept before each block, as text."""
    current, last = object(), None
    for batch in batches:
        rows = []
        for key, block, upto, result in zip(*(x.to_pylist() for x in batch.columns)):
            if key != current:
                current, last = key, None
            rows.append((key, block, None if last is None else repr(last)))
            if last is None:
                last = result[0]
            else:
                at = beyond(np.array(upto), last, epsilon, strict)
                last = result[at] if at < len(result) else last
        kinds = [batch.schema.field(0).type, pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], kind) for i, kind in enumerate(kinds)], [*batch.schema.names[:2], "entry"])


def last_kept_before(df: DataFrame, key: str, block: str, ts: str, epsilon: float, strict: bool) -> DataFrame:
    """key, block, entry: the last time kept before each block of df, null where none is."""
    kind = df.schema[key].dataType.simpleString()
    times = df.select(key, block, F.col(ts).cast("double").alias("at")).repartition(key, block).sortWithinPartitions(key, block, "at")
    maps = times.mapInArrow(partial(_spacings, epsilon=epsilon, strict=strict), f"`{key}` {kind}, `{block}` long, upto array<double>, result array<double>")
    return maps.repartition(key).sortWithinPartitions(key, block).mapInArrow(partial(_last_kept, epsilon=epsilon, strict=strict), f"`{key}` {kind}, `{block}` long, entry string")


# --- states that are found out ------------------------------------------------------------------------------------


def _explored(batches: Iterator[pa.RecordBatch], columns: list[str], ts: str, step: Callable, settle: Callable) -> Iterator[pa.RecordBatch]:
    """Of blocks, each with its entries before its rows: entry, the first row's time and the state after the last row.

    All of a block's entries are run side by side over its rows, which stream by.
    """
    current, first, states = None, None, {}

    def end(schema: pa.Schema) -> pa.RecordBatch:
        rows = [(*current, entry, first, json.dumps(state)) for entry, state in states.items()] if first is not None else []
        kinds = [schema.field(0).type, pa.int64(), pa.string(), pa.float64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], kind) for i, kind in enumerate(kinds)], [*schema.names[:2], "entry", "first", "leaves"])

    schema = None
    for batch in batches:
        schema = batch.schema
        own = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        values = zip(*(batch.column(x).to_pylist() for x in columns))
        for key, entry, row, rest in zip(own, batch.column(2).to_pylist(), batch.column(3).to_pylist(), values):
            if key != current:
                if current is not None:
                    yield end(schema)
                current, first, states = key, None, {}
            if not row:
                states[entry] = json.loads(entry)
                continue
            own_row = dict(zip(columns, rest))
            first = own_row[ts] if first is None else first
            for state in states.values():
                step(state, own_row)
    if current is not None:
        # What a block leaves is settled by the next one's first row.
        yield end(schema)


def _composed(batches: Iterator[pa.RecordBatch], settle: Callable) -> Iterator[pa.RecordBatch]:
    """Of known maps in order of blocks: each block's true entry as far as it is known, and entries that are not known yet.

    kind: true, or wanted: an entry that some known state before may leave to the block, first those on the true path.
    """
    for group in _by_key(batches):
        true, before = None, []
        known = True
        rows = []
        for key, block, first, maps in group:
            if not before:
                true, coming = "[]", ["[]"]
            else:
                coming = list(dict.fromkeys(json.dumps(settle(json.loads(x), first)) for x in before))
                true = json.dumps(settle(json.loads(true), first)) if known else None
            if known:
                rows.append((key, block, true, "true"))
                if true not in maps:
                    known = False
            rows += [(key, block, x, "wanted") for x in coming if x not in maps]
            before = list(maps.values())
            true = maps.get(true) if known else None
        yield rows


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (key, block, entry, first, leaves) in order, as one list of (key, block, first, {entry: leaves}) for each key."""
    key, out = object(), []
    for batch in batches:
        for own, block, entry, first, leaves in zip(*(x.to_pylist() for x in batch.columns)):
            if own != key:
                if out:
                    yield out
                key, out = own, []
            if not out or out[-1][1] != block:
                out.append((own, block, first, {}))
            out[-1][3][entry] = leaves
    if out:
        yield out


def true_entries(df: DataFrame, key: str, block: str, order: list, columns: list[str], ts: str, step: Callable, settle: Callable) -> DataFrame:
    """key, block, entry: the state (JSON of a list) before each block of df, for a step whose state is such a list.

    settle(state, first) is what of a state matters to a block whose first row is at first. All blocks are run from an
    empty state at first, side by side. Where one leaves a state from which the next has not been run, that one is run
    from it as well, in all blocks at once, until the states from a recording's start on are known. As what happened long
    ago is forgotten, this takes few rounds: one where blocks are cut at a pause, two where states fall together, and as
    many as there are phases where rows repeat in a period. Each round completes one block of a recording at least.
    """
    scratch_root(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    narrow = df.select(key, block, *columns)
    entry, is_row = fresh(narrow.columns, "entry", "is_row")

    def explore(wanted: DataFrame) -> DataFrame:
        rows = narrow.join(wanted.select(key, block).distinct(), [key, block], "left_semi")
        marked = rows.select(key, block, F.lit(None).cast("string").alias(entry), F.lit(True).alias(is_row), *columns)
        marks = wanted.select(key, block, F.col("entry").alias(entry), F.lit(False).alias(is_row))
        placed = marked.unionByName(marks, allowMissingColumns=True)
        placed = _together(placed, key, block).sortWithinPartitions(key, block, is_row, *order)
        return placed.mapInArrow(lambda x: _explored(x, columns, ts, step, settle), f"`{key}` {kind}, `{block}` long, entry string, first double, leaves string").checkpoint()

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal own
            for batch in batches:
                own = batch.schema.field(0).type
                yield batch

        for rows in _composed(typed(), settle):
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((own, pa.int64(), pa.string(), pa.string()))], [key, block, "entry", "kind"])

    known = explore(df.select(key, block).distinct().withColumn("entry", F.lit("[]")))
    while True:
        found = known.repartition(key).sortWithinPartitions(key, block).mapInArrow(compose, f"`{key}` {kind}, `{block}` long, entry string, kind string").checkpoint()
        true = found.filter("kind = 'true'").select(key, block, "entry")
        # Blocks that have a true entry, and have been run from it.
        if known.select(key, block).distinct().count() == true.join(known, [key, block, "entry"]).count():
            return true
        known = known.unionByName(explore(found.filter("kind = 'wanted'").select(key, block, "entry")))
