"""Written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cohortac.session import scratch_path

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of about 8 MB and not 64, which each worker and its JVM hold more than
    once; a row over that is a batch of its own. A session that has a size of its own keeps it."""
    if spark.conf.get(BATCH_BYTES) in ("67108864b", "67108864", "64m"):
        spark.conf.set(BATCH_BYTES, "8m")


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of a query run in here when that query ends, and not when the driver happens to
    collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read again: its lineage
    ends there, and it survives the loss of any executor."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
