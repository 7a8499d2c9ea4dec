"""Session settings that the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a caller may still override; none of them names a machine or a path.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Recording the call site of every column expression makes large plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("aislewatch")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("AISLEWATCH_DRIVER_MEMORY", "8g"))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def allow_repeated_keys(spark: SparkSession) -> None:
    """Let VARIANT keep the last value of a repeated JSON key instead of refusing the whole text."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


_own_folder: dict[str, str] = {}


def _shared_folder(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``; one of this machine only for a local master without that setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        sc = spark.sparkContext
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = _own_folder.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return configured.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: its rows are computed once.

    Executors may be lost, so iterative operators never keep their only copy in an executor's block store.
    """
    spark = df.sparkSession
    path = f"{_shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Inputs above this estimated size are split by Spark's own readers.
SPREAD_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores before a Python-heavy stage.

    Decided from the optimiser's estimate of the input's size alone, so no part of the plan runs here. A larger
    input, or one of unknown size, is returned as it is: its readers already split it.
    """
    if not hasattr(df, "_jdf"):  # no local optimiser to ask
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df if size > SPREAD_BYTES else df.repartition(df.sparkSession.sparkContext.defaultParallelism)


#: Rows of a part that a task aggregates or sorts as a whole.
PART_ROWS = 250_000


def parted(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Rows parted by key, with about ``PART_ROWS`` in a part, for ``rows`` of them in all.

    Parts that Spark sizes itself are measured by bytes as sent, and rows that are alike take many times that in a task.
    """
    return df.repartition(max(1, -(-rows // PART_ROWS)), *keys)
