"""How rows are spread over tasks and files."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

SKEW_PERCENT = 30.0


def spread(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """Even spread over n tasks, or by columns."""
    return df.repartition(n, *columns)


def fewer(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle."""
    return df.coalesce(n)


def rows_per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n_rows"))


@contextmanager
def reused(df: DataFrame):
    """Keep a costly result while several queries read it, then free it.

    Partitions that do not fit go to disk, and lost ones are computed again.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def skew_report(df: DataFrame, key: str, limit: float = SKEW_PERCENT) -> DataFrame:
    """Rows per key with their share in percent; a key above the limit is flagged."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    share = F.round(F.col("n_rows") / counts.agg(F.sum("n_rows")).scalar() * 100, 1)
    return counts.withColumn("share_pct", share).withColumn("is_skewed", F.col("share_pct") > limit)
