"""Session settings that the plans rely on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

BYTES_PER_SHUFFLE_PARTITION = 512 * 1024 * 1024
HASHED_PARTITION_BYTES = "64MB"


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Turn on adaptive execution and size the shuffles for the input.

    Skewed join partitions are split even if that costs another shuffle, because a
    key may hold a large part of all rows. The initial partition number follows the
    input size; adaptive execution merges partitions that turn out small. A join whose
    build side turns out to have only small partitions hashes them instead of sorting.
    """
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", HASHED_PARTITION_BYTES)
    if input_bytes is not None:
        base = int(conf.get("spark.sql.shuffle.partitions"))
        wanted = -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION)
        conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(base, wanted))
        )
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """Number of partitions that a shuffle starts with."""
    base = spark.conf.get("spark.sql.shuffle.partitions")
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    return int(spark.conf.get(key, None) or base)


def folder_bytes(spark: SparkSession, folder: str, tables: Sequence[str] = ()) -> int:
    """Total size of the files below ``folder``, or of the named Parquet tables in it, from
    the file system's summaries."""
    jvm = spark.sparkContext._jvm
    total = 0
    for name in [f"{folder}/{t}.parquet" for t in tables] or [folder]:
        path = jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        total += fs.getContentSummary(path).getLength()
    return total
