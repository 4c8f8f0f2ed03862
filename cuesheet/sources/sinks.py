"""What a run writes: JSON, subtitles, and paths relative to the output's folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ..functions.text import relative_path, srt_stamp, strip


def srt_cues(segments: DataFrame, order: list[str]) -> DataFrame:
    """video_id, cue (from 1), lines: number, times and text of each segment."""
    number = F.row_number().over(Window.partitionBy("video_id").orderBy(*order))
    times = F.concat(srt_stamp(F.col("start")), F.lit(" --> "), srt_stamp(F.col("end")))
    return segments.select("video_id", number.alias("cue"), F.concat_ws("\n", number.cast("string"), times, strip(F.col("text"))).alias("lines"))


def write_srt(segments: DataFrame, order: list[str], path: str, shards: int | None = None) -> None:
    """A folder of text files for each recording, with its cues in order and a blank line after each.

    shards: the recordings' folders are put into so many folders, each written by one task. For many recordings: the
    driver then commits and lists these folders, not each recording's.
    """
    cues = srt_cues(segments, order)
    lines = cues.withColumn("lines", F.concat("lines", F.lit("\n")))
    if shards is None:
        folders, dealt = ["video_id"], lines.repartition("video_id")
    else:
        folders = ["shard", "video_id"]
        dealt = lines.withColumn("shard", F.pmod(F.xxhash64("video_id"), F.lit(shards)).cast("int")).repartition(shards, "shard")
    ordered = dealt.sortWithinPartitions(*folders, "cue")
    ordered.select(*folders, "lines").write.mode("overwrite").partitionBy(*folders).text(path)


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    """video_id, content: the recordings that write_srt wrote, each with one file."""
    return spark.read.text(path, wholetext=True).select(F.col("video_id").cast("long").alias("video_id"), F.col("value").alias("content"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """What write_json wrote; or, with lines False, JSON documents that go over several lines."""
    return spark.read.json(path, multiLine=not lines)


def relativize(df: DataFrame, root: str) -> DataFrame:
    """df with all strings in fields named *_path, at any depth, relative to root where they are under it."""

    def fix(column, kind, name):
        if isinstance(kind, StringType) and name.endswith("_path"):
            return relative_path(column, root)
        if isinstance(kind, StructType) and _has_path(kind):
            return F.when(column.isNotNull(), F.struct(*(fix(column[x.name], x.dataType, x.name).alias(x.name) for x in kind)))
        if isinstance(kind, ArrayType) and _has_path(kind):
            return F.transform(column, lambda x: fix(x, kind.elementType, ""))
        return column

    return df.select(*(fix(F.col(f"`{x.name}`"), x.dataType, x.name).alias(x.name) for x in df.schema))


def _has_path(kind) -> bool:
    if isinstance(kind, ArrayType):
        return _has_path(kind.elementType)
    return isinstance(kind, StructType) and any(x.name.endswith("_path") or _has_path(x.dataType) for x in kind)
