"""Writing tables: layouts, appends, retention, stored aggregates.

Tables are Parquet folders or catalog tables. Partition folders are replaced one
by one with dynamic overwrite, so a rerun of a job repeats its own partitions
and nothing else.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.joins import full_on
from larkspur.operators.ordered import attach
from larkspur.session import cut
from larkspur.sources.files import Files
from larkspur.sources.tables import Stored


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with a header in each file; ``files`` moves the rows into so many."""
    (df if files is None else df.repartition(files)).write.csv(path, mode="overwrite", header=True)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.json(path, mode=mode)


def write_partitioned(df: DataFrame, path: str, *columns: str, mode: str = "overwrite") -> None:
    """A folder per value; rows of a value are brought together first, not written by every task."""
    df.hint("rebalance", *columns).write.parquet(path, mode=mode, partitionBy=list(columns))


def clustered(df: DataFrame, partition: str, *cluster: str) -> DataFrame:
    """Rows arranged for a partitioned write: sorted files, few per partition value.

    The rebalance lets adaptive execution join small values into one task and
    split a value that is too large for one.
    """
    return df.hint("rebalance", partition).sortWithinPartitions(partition, *cluster)


def write_clustered(df: DataFrame, path: str, partition: str, *cluster: str, mode="overwrite") -> None:
    clustered(df, partition, *cluster).write.parquet(path, mode=mode, partitionBy=[partition])


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace only the partitions that occur in ``df``."""
    df.write.option("partitionOverwriteMode", "dynamic").parquet(path, mode="overwrite", partitionBy=list(columns))


def overwrite(df: DataFrame, path: str) -> None:
    """Truncate and load."""
    df.write.parquet(path, mode="overwrite")


def append(df: DataFrame, path: str, partition: str = "_ingested_date", *cluster: str) -> None:
    """Append, creating the table when it is missing."""
    write_clustered(df, path, partition, *cluster, mode="append")


def with_audit(df: DataFrame, source: str, batch_id: str, at: str) -> DataFrame:
    """Ingest time, source, batch and ingest date of a load."""
    moment = F.lit(at).cast("timestamp")
    return df.withColumns(
        {
            "_ingested_at": moment, "_source": F.lit(source), "_batch_id": F.lit(batch_id),
            "_ingested_date": F.to_date(moment),
        }
    )


def ensure_table(spark: SparkSession, name: str, schema: str, partition: str | None = None, path: str | None = None) -> None:
    """Create a typed table when it is absent; leave an existing one alone."""
    layout = f" PARTITIONED BY ({partition})" if partition else ""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{layout}{place}")


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    place = {"path": path} if path else {}
    df.write.saveAsTable(name, mode="overwrite", format="parquet", **place)


def insert_into(df: DataFrame, name: str) -> None:
    """Append by column name, whatever the order of the columns in ``df``."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def expired(partition: str, as_of: Column, days: int) -> Column:
    return F.col(partition) < F.date_sub(as_of, days)


def retain(spark: SparkSession, path: str, partition: str, as_of: Column, days: int) -> DataFrame:
    """Rows of the partitions young enough to keep; the filter prunes the expired folders."""
    return spark.read.parquet(path).filter(~expired(partition, as_of, days))


def expire_partitions(spark: SparkSession, path: str, partition: str, as_of: Column, days: int) -> list[str]:
    """Drop the folders of a partitioned table whose date is more than ``days`` before ``as_of``; the others are not touched.

    Returns the dates that went. Rows without date stay. A reader that had listed the table before may miss files that it was still to read.
    """
    oldest = spark.range(1).select(F.date_sub(as_of, days).cast("string")).first()[0]
    files, gone = Files(spark, path), []
    for name in files.names():
        column, _, value = name.partition("=")
        if column == partition and re.fullmatch(r"\d{4}-\d\d-\d\d", value) and value < oldest:
            files.delete(name)
            gone.append(value)
    return gone


def refresh_aggregate(stored: DataFrame | None, source: DataFrame, keys, measures, partition: str, changed=None) -> DataFrame:
    """A stored aggregate after some partitions of its source changed.

    Only the changed partitions are aggregated again; ``changed`` holds their
    values (None means all of them). ``keys`` includes the partition column.
    """
    fresh = source if changed is None else source.filter(F.col(partition).isin(*changed))
    totals = fresh.groupBy(*keys).agg(*measures)
    if stored is None or changed is None:
        return totals
    return stored.filter(~F.col(partition).isin(*changed)).unionByName(totals)


def apply_changes(stored: DataFrame, changes: DataFrame, source: DataFrame, keys, sums: dict, lows: dict, highs: dict, sign: str = "_sign", count: str = "n") -> DataFrame:
    """A stored aggregate after rows were inserted into its source (``sign`` 1) or deleted from it (-1).

    ``sums``, ``lows`` and ``highs`` map the aggregate's columns to columns of the rows, which for sums are exact; ``count`` is the number of rows of a group. Counts
    and sums add. A smallest or largest value is looked up in ``source``, the rows as they are now, only for groups that lost a row which held it; a group without
    rows goes. Nulls in a summed column count as 0, and an updated row is a deleted and an inserted one.
    """
    keys = list(keys)
    came, went = F.col(sign) > 0, F.col(sign) < 0
    delta = changes.groupBy(*keys).agg(
        F.sum(sign).alias("_d_n"), *[F.sum(F.col(c) * F.col(sign)).alias(f"_d_{a}") for a, c in sums.items()],
        *[F.min(F.when(came, F.col(c))).alias(f"_in_{a}") for a, c in lows.items()], *[F.min(F.when(went, F.col(c))).alias(f"_out_{a}") for a, c in lows.items()],
        *[F.max(F.when(came, F.col(c))).alias(f"_in_{a}") for a, c in highs.items()], *[F.max(F.when(went, F.col(c))).alias(f"_out_{a}") for a, c in highs.items()],
    )
    both = cut(full_on(stored, delta, keys))
    zero = F.lit(0)
    lost = [F.col(f"_out_{a}") <= F.col(a) for a in lows] + [F.col(f"_out_{a}") >= F.col(a) for a in highs]
    left = F.coalesce(count, zero) + F.coalesce("_d_n", zero)
    touched = reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in lost], F.lit(False))
    marked = both.withColumns({"_touched": touched, count: left}).filter(F.col(count) > 0)
    exact = {a: (F.coalesce(a, zero) + F.coalesce(f"_d_{a}", zero)).cast(stored.schema[a].dataType).alias(a) for a in sums}
    moved = {a: F.least(a, f"_in_{a}").alias(a) for a in lows} | {a: F.greatest(a, f"_in_{a}").alias(a) for a in highs}
    kept = marked.filter(~F.col("_touched")).select(*keys, *[(exact | moved).get(c, F.col(c)) for c in stored.columns if c not in keys])
    # only the rows of touched groups are read again
    again = marked.filter("_touched").select(*keys, count, *exact.values())
    seen = attach(again.withColumn("_there", F.lit(1)).select(*keys, "_there"), source, keys).groupBy(*keys).agg(
        *[F.min(c).alias(a) for a, c in lows.items()], *[F.max(c).alias(a) for a, c in highs.items()]
    )
    return kept.unionByName(attach(again, seen, keys).select(*kept.columns))


def read_back(spark: SparkSession, path: str, expected: int, fmt: str = "parquet", **options) -> DataFrame:
    """Read what was written and compare the number of rows."""
    written = spark.read.format(fmt).options(**options).load(path)
    found = written.count()
    if found != expected:
        raise RuntimeError(f"{path} holds {found} rows, expected {expected}")
    return written


def merge_by_key(stored: DataFrame, changes: DataFrame, keys) -> DataFrame:
    """Stored rows with those of the same key replaced, and new keys added."""
    return stored.join(changes.select(*keys).distinct(), list(keys), "left_anti").unionByName(changes)


def save_merged(stored: Stored, changes: DataFrame, keys) -> DataFrame:
    """Merge into a stored table, as a new version of it."""
    return stored.change(lambda rows: merge_by_key(rows, changes, keys))
