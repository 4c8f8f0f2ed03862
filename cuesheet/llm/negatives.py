"""Hard negatives of anchor vectors, by exact integer inner products after an orthogonal rotation.

Components are floored to integers. The eigenvectors of their second moments turn them so that the leading components
hold most of the energy. A product over the leading components and the norms of the rest bound a score from both sides;
pairs whose bounds rule them out are discarded before more is computed, those that are left add further components,
and what survives is decided by the integer product, so the result is exact whatever the rotation. Bounds
have slack for rounding.

Anchors meet rows in tiles of bounded size: each tile gives the best few of each of its anchors, and a top-k over tiles
ends it. The first pass finds an anchor's positives, the second its negatives for each positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Bytes of a tile's rows and of its anchors, as longs.
ROWS_BYTES, ANCHORS_BYTES = 16 << 20, 2 << 20
#: A table of more rows than this is dealt to several tiles, if there are cores for them.
FEW = 1024
#: Anchors and rows whose products are computed at a time.
ANCHOR_BLOCK, ROW_BLOCK = 256, 4096
#: Shares of the energy that the leading components of the two steps of bounds hold.
SHARES = (0.6, 0.9)

_LAST = np.iinfo(np.int64).max
_NONE = np.iinfo(np.int64).min


class Rotation:
    """An orthogonal matrix, and how many of its leading components the steps of bounds have."""

    def __init__(self, moments: np.ndarray):
        values, vectors = np.linalg.eigh(moments)
        self.matrix = vectors[:, ::-1]
        energy = np.cumsum(np.maximum(values[::-1], 0))
        d = len(energy)
        self.steps = [int(min(d, np.searchsorted(energy, x * energy[-1]) + 1)) if d and energy[-1] > 0 else d for x in SHARES]
        #: Added to the norms of the rest for each unit of a vector's norm: its square bounds the rounding of a product.
        self.slack = np.sqrt(64 * max(d, 1) * np.finfo(float).eps)

    def turn(self, vectors: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Turned vectors, and for each step bounds of the norms of what the step leaves out."""
        turned = vectors.astype(float) @ self.matrix
        squares = turned**2
        slack = self.slack * np.sqrt(squares.sum(axis=1))
        return turned, [np.sqrt(squares[:, k:].sum(axis=1)) + slack for k in self.steps]


class Side:
    """The rows of one side of a tile."""

    def __init__(self, table: pa.Table, rotation: Rotation):
        self.rid = table.column("rid").to_numpy()
        self.ids = table.column("vec_id").combine_chunks()
        self.sort_id = pc.fill_null(self.ids, int(_LAST)).to_numpy(zero_copy_only=False)
        self.label = table.column("label").to_numpy()
        self.vectors = dense(table.column("v").combine_chunks(), len(rotation.matrix))
        self.turned, self.rest = rotation.turn(self.vectors)
        self.peak = int(np.abs(self.vectors.astype(float)).max(initial=0))


def dense(column: pa.ListArray, d: int) -> np.ndarray:
    """Lists of longs as rows of d components; what shorter ones lack is zero."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(sizes), d), dtype=np.int64)
    out[np.arange(d) < sizes[:, None]] = flat
    return out


def products(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer products of pairs, exact; those beyond a long are its bounds."""
    if a.peak * b.peak * max(a.vectors.shape[1], 1) < 2**62:
        return np.concatenate([np.einsum("ij,ij->i", a.vectors[i[x : x + 65536]], b.vectors[j[x : x + 65536]]) for x in range(0, len(i), 65536)] or [np.empty(0, np.int64)])
    exact = [sum(int(x) * int(y) for x, y in zip(a.vectors[p], b.vectors[q])) for p, q in zip(i, j)]
    return np.array([min(max(x, int(_NONE)), int(_LAST)) for x in exact], dtype=np.int64)


def keep_best(found: list[np.ndarray], group: np.ndarray, b: Side, k: int) -> list[np.ndarray]:
    """Of columns (..., row, score) the k first rows of each group: higher scores, then smaller ids, then places."""
    row, score = found[-2], found[-1]
    order = np.lexsort((b.rid[row], b.sort_id[row], ~score, group))
    own = group[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.empty(0, np.int64)
    place = np.arange(len(own)) - np.repeat(starts, np.diff(np.r_[starts, len(own)]))
    return [x[order[place < k]] for x in found]


def survivors(a: Side, b: Side, rows: np.ndarray, cols: np.ndarray, low: np.ndarray, high: np.ndarray, allowed: Callable, rotation: Rotation) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the anchors rows and rows cols whose bounds meet [low, high] of their anchor, after both steps."""
    first, second = rotation.steps
    part = a.turned[rows, :first] @ b.turned[cols, :first].T
    rest = np.outer(a.rest[0][rows], b.rest[0][cols])
    i, j = np.nonzero((part + rest >= low[:, None]) & (part - rest <= high[:, None]) & allowed(rows, cols))
    part = part[i, j]
    left = low[i], high[i]
    i, j = rows[i], cols[j]
    keep = np.empty(len(i), dtype=bool)
    for x in range(0, len(i), 65536):
        at = slice(x, x + 65536)
        own = part[at] + np.einsum("ij,ij->i", a.turned[i[at], first:second], b.turned[j[at], first:second])
        rest = a.rest[1][i[at]] * b.rest[1][j[at]]
        keep[at] = (own + rest >= left[0][at]) & (own - rest <= left[1][at])
    return i[keep], j[keep]


def blocks(n: int, size: int) -> Iterator[np.ndarray]:
    for x in range(0, n, size):
        yield np.arange(x, min(x + size, n))


def best_alike(a: Side, b: Side, k: int, rotation: Rotation) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, rows and scores: for each anchor the k best other rows of its label in the tile."""
    found = [np.empty(0, np.int64)] * 3
    by_label = np.argsort(b.label, kind="stable")
    labels = b.label[by_label]
    for label in np.unique(a.label):
        own = np.flatnonzero(a.label == label)
        there = by_label[np.searchsorted(labels, label) : np.searchsorted(labels, label, "right")]
        for at in blocks(len(own), ANCHOR_BLOCK):
            rows = own[at]
            held = [np.empty(0, np.int64)] * 3
            for to in blocks(len(there), ROW_BLOCK):
                cut = np.full(len(a.rid), float(_NONE))
                if len(held[0]):
                    full, n = np.unique(held[0], return_counts=True)
                    worst = np.full(len(a.rid), float(_LAST))
                    np.minimum.at(worst, held[0], held[2].astype(float))
                    cut[full[n == k]] = worst[full[n == k]] * (1 - np.sign(worst[full[n == k]]) * 1e-12)
                i, j = survivors(a, b, rows, there[to], cut[rows], np.full(len(rows), np.inf), lambda x, y: a.rid[x][:, None] != b.rid[y], rotation)
                held = [np.concatenate(x) for x in zip(held, (i, j, products(a, b, i, j)))]
                held = keep_best(held, held[0], b, k)
            found = [np.concatenate(x) for x in zip(found, held)]
    return tuple(found)


def best_between(a: Side, b: Side, windows: list[list[tuple[int, int]]], k: int, rotation: Rotation) -> tuple[np.ndarray, ...]:
    """Anchors, numbers of windows, rows and scores: for each window of scores of an anchor (least, most) the k best rows of
    other labels in the tile."""
    most = max(map(len, windows), default=0)
    low, high = np.full((len(windows), most), _LAST), np.full((len(windows), most), _NONE)
    for i, own in enumerate(windows):
        for p, (x, y) in enumerate(own):
            if x <= y:
                low[i, p], high[i, p] = x, y
    found = [np.empty(0, np.int64)] * 4
    for rows in blocks(len(windows), ANCHOR_BLOCK):
        rows = rows[(low[rows] <= high[rows]).any(axis=1)]
        held = [np.empty(0, np.int64)] * 4
        # Short blocks first: what they find rules out most of what follows.
        starts = [0, *range(ROW_BLOCK // 8, len(b.rid), ROW_BLOCK)]
        for start, end in zip(starts, [*starts[1:], len(b.rid)]):
            need = low.copy()
            if len(held[0]):
                group = held[0] * most + held[1]
                full, n = np.unique(group, return_counts=True)
                worst = np.full(low.size, _LAST)
                np.minimum.at(worst, group, held[3])
                full = full[n == k]
                need.ravel()[full] = np.maximum(need.ravel()[full], worst[full])
            lowest, highest = need[rows].min(axis=1, initial=_LAST).astype(float), high[rows].max(axis=1, initial=_NONE).astype(float)
            lowest, highest = (x + y * np.abs(x) * 1e-12 for x, y in ((lowest, -1), (highest, 1)))
            i, j = survivors(a, b, rows, np.arange(start, end), lowest, highest, lambda x, y: a.label[x][:, None] != b.label[y], rotation)
            score = products(a, b, i, j)
            for p in range(most):
                fits = (need[i, p] <= score) & (score <= high[i, p])
                new = (i[fits], np.full(fits.sum(), p), j[fits], score[fits])
                held = [np.concatenate(x) for x in zip(held, new)]
            held = keep_best(held, held[0] * most + held[1], b, k)
        found = [np.concatenate(x) for x in zip(found, held)]
    return tuple(found)


def second_moments(rows: DataFrame, column: str = "v") -> np.ndarray:
    """The sum of outer products of all vectors, shorter ones as if filled up with zeros. A task sends one matrix at most."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((0, 0))
        for batch in batches:
            own = batch.column(0)
            d = int(max(np.diff(own.offsets.to_numpy()), default=0))
            x = dense(own, d).astype(float)
            if d > len(total):
                total = np.pad(total, (0, d - len(total)))
            total[:d, :d] += x.T @ x
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "x"])

    parts = rows.select(column).mapInArrow(sums, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    d = int(parts["i"].max()) + 1 if len(parts) else 0
    out = np.zeros((d, d))
    out[parts["i"], parts["j"]] = parts["x"]
    return (out + out.T) / 2


def _tiles(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, d: int, run: Callable, shape: str) -> DataFrame:
    """run(anchors, rows) of all tiles: each side is dealt evenly to groups of bounded size, each group to all of the other's."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    across = max(1, -(-n_rows * 8 * max(d, 1) // ROWS_BYTES), min(2 * cores, n_rows // FEW))
    down = max(1, -(-n_anchors * 8 * max(d, 1) // ANCHORS_BYTES))
    hashed = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n))
    to_all = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = anchors.select("*", hashed(down).alias("down"), to_all(across).alias("across"))
    right = rows.select("*", hashed(across).alias("across"), to_all(down).alias("down"))

    def tile(one: pa.Table, other: pa.Table) -> pa.Table:
        return run(one, other)

    return left.groupBy("down", "across").cogroup(right.groupBy("down", "across")).applyInArrow(tile, shape)


_ALIKE = "anchor long, rid long, vec_id long, score long"
_BETWEEN = "anchor long, anchor_id long, place int, positive_id long, positive_score long, rid long, vec_id long, score long"


def _arrow(columns: list, shape: str) -> pa.Table:
    return pa.table([pa.array(x, pa.int32() if kind == "int" else pa.int64()) for x, (_, kind) in zip(columns, (y.split() for y in shape.split(", ")))], names=[y.split()[0] for y in shape.split(", ")])


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows (vec_id, embedding, label).

    Components count as floor(256 * x), scores are inner products of these. An anchor's positives are the first
    positives other rows of its label; for each, the first negatives rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score are returned. Higher scores come first, ties by smaller vec_id, then
    rows without one; rows that repeat a vec_id are rows of their own, anchors too. Rows with a null label, a null vector or a
    null or non-finite component take no part. Of vectors of several lengths the shorter count as filled up with zeros,
    an empty one as all zeros. Components and scores beyond a long are its bounds. Anchors without a positive, or positives
    without a negative, and an empty table give no rows. Other columns are not read, whatever their names.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    clean = rows.select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    clean = materialise(clean.select("rid", "vec_id", "label", "anchor", F.transform("embedding", lambda x: F.floor(256 * x)).alias("v")), compact=True)
    rotation = Rotation(second_moments(clean))
    d = len(rotation.matrix)
    n_rows, n_anchors = clean.agg(F.count("*"), F.count_if("anchor")).first()
    own, all_rows = clean.filter("anchor").select("rid", "vec_id", "label", "v"), clean.select("rid", "vec_id", "label", "v")

    def alike(one: pa.Table, other: pa.Table) -> pa.Table:
        if not len(one) or not len(other):
            return _arrow([[]] * 4, _ALIKE)
        a, b = Side(one, rotation), Side(other, rotation)
        i, j, score = best_alike(a, b, positives, rotation)
        return _arrow([a.rid[i], b.rid[j], b.ids.take(pa.array(j)), score], _ALIKE)

    first = [F.desc("score"), F.asc_nulls_last("vec_id"), "rid"]
    found = _tiles(own, all_rows, n_anchors, n_rows, d, alike, _ALIKE)
    found = found.withColumn("place", F.row_number().over(Window.partitionBy("anchor").orderBy(*first))).filter(F.col("place") <= positives)
    found = found.groupBy(F.col("anchor").alias("rid")).agg(F.sort_array(F.collect_list(F.struct("place", F.col("vec_id").alias("id"), "score"))).alias("found"))
    asked = materialise(own.join(found, "rid"))

    def between(one: pa.Table, other: pa.Table) -> pa.Table:
        if not len(one) or not len(other):
            return _arrow([[]] * 8, _BETWEEN)
        a, b = Side(one, rotation), Side(other, rotation)
        own = one.column("found").to_pylist()
        # Scores s with low * positive <= 100 * s <= high * positive.
        windows = [[(max(-(-low * x["score"] // 100), int(_NONE)), min(high * x["score"] // 100, int(_LAST))) for x in y] for y in own]
        i, p, j, score = best_between(a, b, windows, negatives, rotation)
        which = [own[x][y] for x, y in zip(i, p)]
        return _arrow([a.rid[i], a.ids.take(pa.array(i)), [x["place"] for x in which], [x["id"] for x in which], [x["score"] for x in which], b.rid[j], b.ids.take(pa.array(j)), score], _BETWEEN)

    out = _tiles(asked, all_rows, n_anchors, n_rows, d, between, _BETWEEN)
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*first))).filter(F.col("rank") <= negatives)
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
