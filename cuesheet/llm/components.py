"""Connected components of an undirected graph, by alternating large-star and small-star steps.

Kiveris et al., Connected Components in MapReduce and Beyond, 2014. Each step is a shuffle of the links; no component
is gathered in one task or on the driver. Before a round each task contracts the links of its own part, a block of
bounded size at a time, to stars, which is a valid step on any subset of links and saves rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_up, join_unique, mark, materialise

#: Links that a task contracts at a time.
BLOCK = 200_000


def contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between each node and the smallest that these links reach from it, with the same components."""
    nodes, places = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = places[: len(u)], places[len(u) :]
    root = np.arange(len(nodes))
    while True:
        # Roots take the smallest root across a link; paths are halved until flat.
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    own = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[own], nodes[root[own]]


def _contracted(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            held.append(tuple(batch.column(x).to_numpy(zero_copy_only=False) for x in ("u", "v")))
            n += batch.num_rows
            if n >= BLOCK:
                yield _links(held)
                held, n = [], 0
        yield _links(held)

    return links.select("u", "v").mapInArrow(run, "u long, v long")


def _links(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u, v = contract(*(np.concatenate([x[i] for x in held] or [np.empty(0, np.int64)]) for i in range(2)))
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _stars(links: DataFrame, total: int) -> DataFrame:
    """For each node u of links (u, v): u, v and m, the smallest of u and its v."""
    best = links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
    return join_unique(links, best, "u", total)


def connected_components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """links (u, v), longs, in either direction; repeats and loops are allowed. Returns node, root (its smallest reachable node).

    A round writes two tables and deletes those before; fewer than BLOCK links are left to one task. Nulls and an empty table give no rows.
    """
    spark = links.sparkSession
    began = mark(spark)
    now = materialise(_contracted(links.filter("u <> v")).distinct())
    for _ in range(most_rounds):
        # Done if the links are stars: each node on the left once, and none of those on the right there.
        n, distinct = now.agg(F.count("*"), F.count_distinct("u")).first()
        if n == distinct and now.select(F.col("v").alias("u")).distinct().join(now.select("u"), "u", "left_semi").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
        if n < BLOCK:
            # Few links, however many rows the caller has: one block contracts them to stars.
            now = materialise(_contracted(now.coalesce(1)))
            clean_up(spark, began, mark(spark) - 1)
            continue
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialise(_stars(both, 2 * n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = _stars(large, n)
        kept = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        now = materialise(_contracted(kept).distinct())
        clean_up(spark, began, mark(spark) - 1)
    raise RuntimeError(f"no stars after {most_rounds} rounds")
