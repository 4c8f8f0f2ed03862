"""JSON arrays of any length read in splits, as lines are, though their elements are not parted by lines.

A file is read in pieces that end at closing braces, so Spark splits it by ranges of bytes. Whether a brace is one of
the structure depends on all that is before it: on whether a string is open, and on how many objects and arrays are. A
split is a function of that state: its quotes flip the first part, and it changes the second by one amount if a string
is open where it starts, by another if none is. These functions, a row a split, are composed over a file; each split is
then looked at again from its own state. Pieces between two ends of elements are a fragment of the array, and parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import scratch_root

SPLIT = ["file", "block"]


def _count(x: Column, characters: str) -> Column:
    return F.length(x) - F.length(F.translate(x, characters, ""))


def _depth(bare: Column, opened: Column, closed: Column) -> Column:
    """By how much a piece and the brace after it change the depth, if a string is open before (opened) or after it (closed)."""
    whole = F.concat(F.when(opened, '"').otherwise(""), bare, F.when(closed, '"').otherwise(""))
    rest = F.regexp_replace(whole, '"[^"]*"', "")
    return _count(rest, "[{") - _count(rest, "]}") - F.when(closed, 0).otherwise(1)


def _before(amount: str) -> Column:
    """The sum of amount over what is earlier in a split."""
    return F.coalesce(F.sum(amount).over(Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _splits(amount: Column) -> Column:
    """The same over the splits of a file that are earlier, in a table with a row for each split."""
    return F.coalesce(F.sum(amount).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where the split starts), at (order in it), value: texts up to closing braces, which are left out."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")


def _with_ends(rows: DataFrame) -> DataFrame:
    """rows of pieces with ends: whether the brace after a piece ends an element of the outermost array; total: the file's depth."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # an escape is never cut by a closing brace
    looked = rows.withColumn("bare", bare).withColumn("quotes", _count(F.col("bare"), '"')).withColumn("earlier", _before("quotes"))
    odd = lambda x: x % 2 == 1
    both = [_depth(F.col("bare"), odd(F.col("earlier") + k), odd(F.col("earlier") + F.col("quotes") + k)).alias(f"depth{k}") for k in (0, 1)]
    seen = looked.select(*SPLIT, "at", "value", "quotes", odd(F.col("earlier") + F.col("quotes")).alias("flips"), *both)
    sums = seen.groupBy(*SPLIT).agg(*(F.sum(x).alias(x) for x in ("quotes", "depth0", "depth1")))
    sums = sums.withColumn("opened", odd(_splits(F.col("quotes")))).withColumn("own", F.when(F.col("opened"), F.col("depth1")).otherwise(F.col("depth0")))
    states = sums.select(*SPLIT, "opened", _splits(F.col("own")).alias("start"), F.sum("own").over(Window.partitionBy("file")).alias("total"))
    known = seen.join(states, SPLIT).withColumn("depth", F.when(F.col("opened"), F.col("depth1")).otherwise(F.col("depth0")))
    after = F.col("start") + _before("depth") + F.col("depth")
    return known.select(*SPLIT, "at", "value", "total", ((F.col("opened") == F.col("flips")) & (after == 1)).cast("int").alias("ends"))


def _running(rows: DataFrame, amount: str, name: str) -> DataFrame:
    """rows with the sum of amount over all that is earlier in the file."""
    sums = rows.groupBy(*SPLIT).agg(F.sum(amount).alias("own"))
    starts = sums.select(*SPLIT, _splits(F.col("own")).alias("start"))
    return rows.join(starts, SPLIT).withColumn(name, _before(amount) + F.col("start")).drop("start")


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """file, position (in its file, from 1), value (a variant) of each element of the JSON arrays in a file or folder.

    Elements may be of any kind; a file is read in splits, however long its lines are. An empty array has no rows; a
    file that is no JSON array raises, as does one that ends too early. Strings may hold braces, brackets and quotes.
    """
    scratch_root(spark)
    marked = _with_ends(pieces(spark, path)).checkpoint()
    numbered = _running(marked, "ends", "part")
    parts = numbered.groupBy("file", "part").agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("own"), F.max("ends").alias("ended"), F.max("total").alias("total"))
    text = F.concat(F.when(F.col("part") > 0, "[{}").otherwise(""), F.array_join("own.value", "}"), F.when(F.col("ended") == 1, "}]").otherwise(""))
    # The last piece has no brace after it, so one too many is counted in a file that is whole; the array is what it ends with.
    sound = F.when((F.col("total") == -1) & ((F.col("ended") == 1) | text.rlike(r"\]\s*$")), text).otherwise(F.raise_error(F.concat(F.lit("not a JSON array: "), F.col("file"))))
    parsed = F.parse_json(sound).cast("array<variant>")
    items = F.when(F.col("part") > 0, F.slice(parsed, 2, F.greatest(F.size(parsed) - 1, F.lit(0)))).otherwise(parsed)
    listed = parts.select("file", F.col("own")[0]["block"].alias("block"), F.col("own")[0]["at"].alias("at"), items.alias("items")).withColumn("n", F.size("items")).checkpoint()
    return _running(listed, "n", "earlier").select("file", "earlier", F.posexplode("items").alias("i", "value")).select("file", (F.col("earlier") + F.col("i") + 1).alias("position"), "value")
