"""Boxes of an image that are recognised one by one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def box(x1, y1, x2, y2) -> Column:
    return F.struct(x1.cast("int").alias("x1"), y1.cast("int").alias("y1"), x2.cast("int").alias("x2"), y2.cast("int").alias("y2"))


def parse_box(raw: Column) -> Column:
    """"x1,y1,x2,y2" as a box; raises unless these are four whole numbers with x2 > x1 and y2 > y1."""
    parts = F.transform(F.split(raw, ","), lambda x: F.trim(x).try_cast("int"))
    right = (F.size(parts) == 4) & F.forall(parts, lambda x: x.isNotNull()) & (F.get(parts, F.lit(2)) > F.get(parts, F.lit(0))) & (F.get(parts, F.lit(3)) > F.get(parts, F.lit(1)))
    bad = F.raise_error(F.concat(F.lit("no box: "), raw))
    return F.when(F.coalesce(right, F.lit(False)), box(*(F.get(parts, F.lit(i)) for i in range(4)))).otherwise(bad.cast("struct<x1:int,y1:int,x2:int,y2:int>"))


def clip_box(b: Column, width: Column, height: Column) -> Column:
    """The part of a box within an image; null if none is left."""
    clipped = box(
        F.greatest(F.lit(0), F.least(width - 1, b["x1"])), F.greatest(F.lit(0), F.least(height - 1, b["y1"])),
        F.greatest(F.lit(1), F.least(width, b["x2"])), F.greatest(F.lit(1), F.least(height, b["y2"])),
    )
    return F.when((clipped["x2"] > clipped["x1"]) & (clipped["y2"] > clipped["y1"]), clipped)


#: Name and edges, as shares of width and height, of the preset boxes.
PRESET = (("TOP", 0.0, 0.0, 1.0, 0.20), ("LEFT", 0.0, 0.0, 0.25, 1.0), ("MAIN", 0.15, 0.15, 0.85, 0.85), ("BOTTOM", 0.0, 0.80, 1.0, 1.0))


def crop_boxes(images: DataFrame, mode: str = "preset", manual: list[str] | None = None) -> DataFrame:
    """A row for each box of each image (width, height): images' columns, name, box. FULL, the preset, then manual ones."""
    if mode not in ("none", "preset"):
        raise ValueError(f"unknown crop mode: {mode}")
    w, h = F.col("width"), F.col("height")
    share = lambda x, s: F.floor(x * s)
    boxes = [("FULL", box(F.lit(0), F.lit(0), w, h))]
    if mode == "preset":
        boxes += [(name, box(share(w, a), share(h, b), share(w, c), share(h, d))) for name, a, b, c, d in PRESET]
    boxes += [(f"MANUAL_{i:02d}", clip_box(parse_box(F.lit(x)), w, h)) for i, x in enumerate(manual or [], 1)]
    rows = F.array(*(F.struct(F.lit(name).alias("name"), b.alias("box")) for name, b in boxes))
    return images.select("*", F.inline(F.filter(rows, lambda x: x["box"].isNotNull())))
