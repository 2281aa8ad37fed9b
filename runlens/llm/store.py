"""Cut lineage through the shared checkpoint folder; batch size of Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from runlens.session import checkpoint_dir


def saved(df: DataFrame) -> DataFrame:
    """The DataFrame, computed now and read from the folder that the cluster
    names in ``spark.checkpoint.dir`` (replicated by that store, so a lost
    executor costs nothing)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is planned inside gives its shuffle files back once its rows are
    saved or collected; else they stay until the driver happens to collect
    its garbage, and the shuffles of all steps lie on disk together."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def small_batches(df: DataFrame, rows: int = 1000) -> None:
    """Whole texts make default Arrow batches (10,000 rows) large: ask for
    smaller ones, unless the session sets its own size."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(key, "10000") == "10000":
        df.sparkSession.conf.set(key, str(rows))
