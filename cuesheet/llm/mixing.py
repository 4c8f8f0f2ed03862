"""Mixing of sources to target weights by pivotal dependent rounding.

A source's documents all have the same fractional number of copies, its target over its size. The whole part is taken
as it is; the rest is a probability, which pivotal rounding makes 0 or 1 without changing the words that the source
takes. Two sides of a pair pass words to each other until one of them is integral: the one that gains is drawn so
that no document's expected copies change.

- In a block of about BLOCK documents of a source, the largest is paired with all smaller ones, which share one
  probability; then the next. So large documents are decided while there are many words to make up for them, and what
  stays fractional is one document of the block, in general one of the smallest.
- The blocks' residual documents go up a reduction tree: a node pairs those of FAN nodes below, two at a time, and
  passes one on. Each level is a shuffle of one row a node.
- A source's last document has nothing to be paired with and goes to the nearer whole number.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_unique, materialise

#: Documents of a source that are rounded together, about; so many nodes pass their residuals to one above.
BLOCK, FAN = 1024, 1024
#: Rows that a task holds: a block of more, as rows repeated in all columns are in one, is rounded in parts.
HELD = 32_768
#: Probabilities nearer to 0 or 1 count as integral.
NEAR = 1e-12

_ROW = "doc_id long, size long, source_size long, target double, copies long, rank long, node long, q double"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]


def settle(sizes: Sequence[int], q: float, rng: random.Random) -> tuple[list[int], int, float]:
    """Rounds documents of positive sizes, the largest first, that each have the probability q: 0 or 1 for each, the
    place of the one that stays fractional (-1: none) and its probability."""
    took, rest = [0] * len(sizes), sum(sizes)
    for i, w in enumerate(sizes):
        if q < NEAR:
            break
        if q > 1 - NEAR:
            took[i:] = [1] * (len(sizes) - i)
            break
        rest -= w
        up, down = min(w * (1 - q), q * rest), min(w * q, (1 - q) * rest)
        if not rest:
            return took, i, q
        if rng.random() * (up + down) < down:
            if up < w * (1 - q):
                return took, i, q + up / w
            took[i] = 1
            q -= up / rest
        else:
            if down < w * q:
                took[i + 1 :] = [1] * (len(sizes) - i - 1)
                return took, i, q - down / w
            q += down / rest
    return took, -1, 0.0


def pair(a: tuple[int, float], b: tuple[int, float], rng: random.Random) -> tuple[float, float]:
    """The probabilities of two fractional documents (size, probability) after words went from one to the other."""
    (w, p), (v, q) = a, b
    up, down = min(w * (1 - p), v * q), min(w * p, v * (1 - q))
    moved = up if rng.random() * (up + down) < down else -down
    p, q = p + moved / w, q - moved / v
    return tuple(float(round(x)) if abs(x - round(x)) < NEAR else x for x in (p, q))


def _out(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.float64()] + [pa.int64()] * 3 + [pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], kind) for i, kind in enumerate(kinds)], _NAMES)


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[tuple, int, list[tuple]]]:
    """Rows that follow each other and agree in rank and node, at most so many at a time, with the number of the part."""
    key, part, held = None, 0, []
    for batch in batches:
        for row in zip(*(x.to_pylist() for x in batch.columns)):
            if row[5:7] != key or len(held) >= most:
                if held:
                    yield key, part, held
                part = part + 1 if row[5:7] == key else 0
                key, held = row[5:7], []
            held.append(row)
    if held:
        yield key, part, held


def _leaves(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for (rank, node), part, held in _runs(batches, HELD):
        took, at, q = settle([x[1] for x in held], held[0][7], random.Random(f"{seed} leaf {rank} {node} {part}"))
        rows += [(*x[:4], x[4] + one, rank, node, None) for x, one in zip(held, took)]
        if at >= 0:
            rows[at - len(held)] = (*held[at][:7], q)
        if len(rows) > 8192:
            yield _out(rows)
            rows = []
    yield _out(rows)


def _joined(batches: Iterator[pa.RecordBatch], seed: int, last: bool) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    key = carry = None
    done = lambda x, q: (*x[:4], x[4] + int(q), *x[5:7], None)
    end = lambda x: done(x, round(x[7])) if last else x
    for batch in batches:
        for row in zip(*(x.to_pylist() for x in batch.columns)):
            if row[5:7] != key:
                if carry:
                    rows.append(end(carry))
                key, carry, rng = row[5:7], None, random.Random(f"{seed} node {row[5]} {row[6]}")
            if carry is None:
                carry = row
                continue
            both = [(*x[:7], q) for x, q in zip((carry, row), pair((carry[1], carry[7]), (row[1], row[7]), rng))]
            rows += [done(x, x[7]) for x in both if x[7] in (0.0, 1.0)]
            carry = next((x for x in both if x[7] not in (0.0, 1.0)), None)
        yield _out(rows)
        rows = []
    yield _out(rows + ([end(carry)] if carry else []))


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """key, source, rank, w, source_size, n, target of sizes (key, source, source_size, n), one row for each source.

    Sources in order of their names' code points, null last, take the weights in turn and share the sum of all sizes
    by them. No target is above most times the source's size; what is above is shared by weight again. Only sums come
    to the driver; a source's place is that in its range and the number of sources in the ranges before.
    """
    placed = materialise(sizes.repartitionByRange(F.isnull("source"), "source").sortWithinPartitions(F.isnull("source"), "source").withColumn("at", F.monotonically_increasing_id()))
    ranges = placed.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("own")).toPandas().sort_values("part")
    before = dict(zip(ranges["part"].tolist(), [0, *ranges["own"].cumsum().tolist()]))
    first = F.create_map(*(F.lit(x) for pair in before.items() for x in pair)) if before else F.create_map(F.lit(0), F.lit(0))
    table = F.array(*(F.lit(float(x)) for x in weights))
    ranked = placed.withColumn("rank", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + first[F.shiftright("at", 33)])
    ranked = ranked.withColumn("w", table[(F.col("rank") % len(weights)).cast("int")]).drop("at")
    total, weight = ranked.agg(F.sum("source_size"), F.sum("w")).first()
    level, capped = (total or 0) / (weight or 1), -1
    while True:
        above = F.col("w") * F.lit(level) > most * F.col("source_size")
        n, words, free = ranked.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, most * F.col("source_size"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("w"))), F.lit(0.0))).first()
        if n == capped or not free:
            break
        level, capped = (total - words) / free, n
    return ranked.withColumn("target", F.least(F.col("w") * F.lit(float(level)), most * F.col("source_size").cast("double")))


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of docs (doc_id, text, source).

    size: the number of words [^\\x20\\x09-\\x0D]+, null and empty texts have none. taken: the words that the mix takes
    from the row, whole copies, most at most. A source's sum of taken is its target, but for its last document: no
    more than half of that is added or missing. The same rows give the same result, however they are dealt out; of rows that
    agree in doc_id, source and text, which one is taken more often is not defined, as nothing tells them apart. Rows that
    repeat a doc_id, or have none, are documents of their own; null is a source like any other, the last. Texts of any
    length are counted whole. An empty table gives no rows. Other columns are not read, whatever their names.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), key.alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"), F.xxhash64("doc_id", text).alias("hash"),
    )
    own = materialise(own, compact=True)
    sizes = own.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = materialise(source_targets(sizes, weights, most))
    rows, largest = sources.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = sources.select("key", "rank", "source_size", "target", "n", F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1)).alias("blocks"), F.floor(copies).alias("copies"), (copies - F.floor(copies)).alias("q"))
    joined = join_unique(own.select("key", "doc_id", "size", "hash"), sources, "key", rows)
    joined = joined.withColumn("node", F.pmod("hash", "blocks"))
    open = (F.col("q") > 0) & (F.col("size") > 0)
    order = ["rank", "node", F.desc("size"), "doc_id"]
    whole = joined.filter(~open).select(*_NAMES[:4], "copies", "rank", "node", F.lit(None).cast("double").alias("q"))
    drawn = joined.filter(open).repartition("rank", "node").sortWithinPartitions(*order, "hash").select(*_NAMES)
    leaves = materialise(drawn.mapInArrow(lambda x: _leaves(x, seed), _ROW))
    parts, level = [whole, leaves.filter("q IS NULL")], leaves.filter("q IS NOT NULL")
    height = max(1, math.ceil(math.log(max(largest / BLOCK, 1), FAN) - 1e-9))
    for k in range(height):
        last = k == height - 1
        up = level.withColumn("node", F.lit(0).cast("long") if last else F.floor(F.col("node") / FAN))
        up = up.repartition("rank", "node").sortWithinPartitions(*order, "q").select(*_NAMES)
        joined_up = materialise(up.mapInArrow(lambda x, last=last: _joined(x, seed, last), _ROW))
        parts.append(joined_up.filter("q IS NULL"))
        level = joined_up.filter("q IS NOT NULL")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
