"""Where intermediate results go, and how tables are dealt out."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on one machine a temporary one.

    It is the session's checkpoint folder afterwards.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cuesheet-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """df dealt out evenly if it is read in fewer parts than there are cores, as a table of one small file is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Rows of a batch between Spark and Python where rows hold images, as both sides hold batches whole.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to BATCH_ROWS rows, if they are larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def tasks(spark: SparkSession) -> int:
    """Parts for rows that are small but take long: by size alone adaptive execution would put them together."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
