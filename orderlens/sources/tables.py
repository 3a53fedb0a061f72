"""The five raw tables, their declared types, and table readers and writers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

# Declared column types of the raw tables.
RAW_SCHEMAS = {
    "users": "user_id int, email string, signup_date date, country string, "
    "customer_segment string",
    "products": "product_id int, product_name string, category string, supplier_id int, "
    "cost decimal(10,2)",
    "orders": "order_id int, user_id int, order_date date, status string, "
    "total_amount decimal(10,2)",
    "order_items": "order_item_id int, order_id int, product_id int, quantity int, "
    "price decimal(10,2)",
    "returns": "return_id int, order_item_id int, return_date date, return_reason string, "
    "refund_amount decimal(10,2)",
}


TABLES = tuple(RAW_SCHEMAS)


class Shop:
    """The raw retail tables every plan starts from: ``users``, ``products``, ``orders``,
    ``order_items`` and ``returns``, each a DataFrame or a function that makes it. A plan
    touches only the tables it reads.

    ``lines`` may hold the joined item lines when they were written before, so that
    several marts share them."""

    def __init__(
        self, lines: DataFrame | None = None, **tables: DataFrame | Callable[[], DataFrame]
    ):
        if set(tables) != set(TABLES):
            raise TypeError(f"Shop needs exactly the tables {TABLES}")
        self.lines = lines
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def replace(self, **tables: DataFrame) -> Shop:
        """A shop with some tables exchanged, or with ``lines`` added."""
        return Shop(**{**self._tables, **tables})


def read_table(
    spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Read one table. CSV needs a schema (types are declared, never inferred) and
    fails on a malformed row instead of turning it into NULLs."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table needs a declared schema")
        return reader.option("header", True).option("mode", "FAILFAST").csv(path)
    return reader.format(fmt).load(path)


def stream_table(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """Stream of the Parquet table ``name`` in ``folder``, which may be a single file or a
    folder of part files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema)
    if fs.getFileStatus(path).isDirectory():
        return reader.parquet(f"{folder}/{name}.parquet")
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def read_shop(spark: SparkSession, folder: str, fmt: str = "csv", prefix: str = "raw_") -> Shop:
    """Read the five raw tables from ``folder/<prefix><name>.<fmt>``."""
    return Shop(
        **{
            name: read_table(spark, f"{folder}/{prefix}{name}.{fmt}", schema, fmt)
            for name, schema in RAW_SCHEMAS.items()
        }
    )


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    dynamic: bool = False,
) -> None:
    """Write a parquet table, optionally partitioned and clustered. ``dynamic`` overwrites only
    the partitions that ``df`` has rows of; they stay as they are if the write breaks off.

    ``rebalance`` groups the rows of a partition value into few files, and adaptive
    execution splits a partition value that holds too much for one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode)
    writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.partitionBy(*partition_by).parquet(path)


# A table that is replaced as a whole keeps its versions side by side, each in a folder of its
# own. Readers take the newest one that Spark has marked as complete, so the old rows can be
# read until the new ones are all there. The folder's owner expires old versions.


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the complete versions of a table, oldest first."""
    done = _glob(spark, f"{path}/version=*/_SUCCESS")
    return sorted(status.getPath().getParent().toString() for status in done)


def _glob(spark: SparkSession, pattern: str) -> list:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(fs.globStatus(path) or [])


def latest_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete version."""
    return max(versions(spark, path), default=None)


def latest_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version of a table."""
    folder = latest_folder(spark, path)
    return None if folder is None else spark.read.parquet(folder)


def write_version(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    name: str | None = None,
) -> None:
    """Write the next version of a table, which ``df`` may read, under its number or ``name``."""
    if name is None:
        newest = latest_folder(df.sparkSession, path)
        number = int(newest.rsplit("=")[-1].split("-")[0]) + 1 if newest else 1
        name = f"{number:012d}-{uuid.uuid4().hex}"
    folder = f"{path}/version={name}"
    write_table(df, folder, partition_by, sort_by)
    if partition_by and not _glob(df.sparkSession, f"{folder}/*=*"):
        # Without rows there is no partition, and so no file that holds the columns.
        df.limit(0).write.mode("overwrite").parquet(folder)


def write_bucketed(
    df: DataFrame,
    table: str,
    key: str,
    buckets: int,
    sort_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    path: str | None = None,
    compression: str = "snappy",
) -> DataFrame:
    """Save a catalog table bucketed on ``key``, so joins and groups on it need no shuffle, and
    partitioned for pruning; at ``path`` if it is given, else in the warehouse."""
    # One task per bucket writes its files, whatever the number of input tasks.
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
    writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, key).sortBy(*(sort_by or [key])).saveAsTable(table)
    return df.sparkSession.table(table)
