"""Stream sinks that give each result once, even when a batch is repeated."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.sources.files import Files
from larkspur.sources.tables import Stored

AVAILABLE = {"availableNow": True}


def _batch_folder(df: DataFrame, folder: str, batch_id: int) -> None:
    """One folder per micro batch: a batch that runs again replaces its own folder."""
    df.write.parquet(f"{folder}/batch_id={batch_id}", mode="overwrite")


def append_to(stream: DataFrame, folder: str, state: str, trigger: dict = AVAILABLE):
    """Append rows of a stream without aggregates to a folder."""
    return (
        stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", state)
        .outputMode("append").trigger(**trigger).start()
    )


def insert_to(stream: DataFrame, table: str, state: str, trigger: dict = AVAILABLE):
    """Append rows of a stream to a table that must exist already."""
    if not stream.sparkSession.catalog.tableExists(table):
        raise ValueError(f"no table {table}")
    return (
        stream.writeStream.option("checkpointLocation", state).outputMode("append").trigger(**trigger).toTable(table)
    )


def _stream_id(spark: SparkSession, state: str) -> str:
    """The id that the stream of a checkpoint folder keeps over restarts."""
    return json.loads(Files(spark, state).read_text("metadata"))["id"]


def updates_to(stream: DataFrame, folder: str, keys, state: str, trigger: dict = AVAILABLE, newest=()):
    """Keep the current rows of a stream of new and corrected ones in a table that ``latest`` reads.

    The last row of a key stands, or the first by ``newest`` if that is given. The table takes each batch as one change, numbered by
    stream and batch: a batch that is repeated changes nothing.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        Stored(spark, folder, keys, newest).upsert(df, _stream_id(spark, state), batch_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", state).outputMode("update").trigger(**trigger).start()


def latest(spark: SparkSession, folder: str, keys, newest=()) -> DataFrame:
    """Current rows of an ``updates_to`` folder; how many batches have made them doesn't matter."""
    return Stored(spark, folder, keys, newest).read()


def route_to(stream: DataFrame, routes: dict, state: str, trigger: dict = AVAILABLE):
    """Write one stream to several folders.

    ``routes`` maps a folder to the function that picks its rows. The batch is
    computed once and kept while it is written.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        kept = df.persist()
        try:
            for folder, pick in routes.items():
                _batch_folder(pick(kept), folder, batch_id)
        finally:
            kept.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(**trigger).start()


def finish(query) -> None:
    """Wait for a stream that reads what is there and stops."""
    query.awaitTermination()


def stored_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).drop("batch_id")


def count_batches(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))
