"""The shared folder for checkpoints and intermediate tables.

Work that must survive a lost executor is written to storage that all executors
see. The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
driver and executors are one process, may fall back to a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from orderlens.functions import packed, unpacked

# Spark's setting that removes the shuffle files of a job when the job ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """For jobs whose result is a table: their shuffle files are removed when they end, not when
    the driver happens to collect garbage, so the disk holds those of one job at a time."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def written(df: DataFrame, name: str, texts: Sequence[str] = ()) -> DataFrame:
    """The same rows, written once as a table in the shared folder. The lineage ends
    there, and a reader fetches only the columns it uses. Columns in ``texts`` lie there
    ``packed``."""
    folder = run_folder(df.sparkSession, name)
    stored = df.withColumns({column: packed(df[column]) for column in texts})
    with shuffles_dropped(df.sparkSession):
        stored.write.option("compression", "zstd").parquet(folder)
    out = df.sparkSession.read.schema(stored.schema).parquet(folder)
    return out.withColumns({column: unpacked(out[column]) for column in texts})
