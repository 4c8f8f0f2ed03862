"""Time stamps in the log of a frame filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the pattern of a time stamp.
PTS = r"pts_time:([0-9eE+\-.]+)"


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """lines with pts, the seconds of those that have a readable time stamp; the others go."""
    own = lines.filter(F.col(column).contains("showinfo") & F.col(column).contains("pts_time:"))
    return own.withColumn("pts", F.nullif(F.regexp_extract(column, PTS, 1), F.lit("")).try_cast("double")).filter("pts is not null")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path))
