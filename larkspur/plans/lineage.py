"""Row counts of each hop between tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

SCHEMA = (
    "run_id string, task_name string, source_table string, target_table string, transform_type string, "
    "rows_in long, rows_out long, pipeline_run_id string, created_at timestamp"
)


class Hop:
    """Counts the rows that enter and leave one transformation while it is written.

    The counts ride along with the job itself; no extra pass is made.
    """

    def __init__(self, task: str, source: str, target: str, kind: str):
        self.names = (task, source, target, kind)
        self._in, self._out = Observation(f"in-{uuid.uuid4()}"), Observation(f"out-{uuid.uuid4()}")

    def entering(self, df: DataFrame) -> DataFrame:
        return df.observe(self._in, F.count(F.lit(1)).alias("rows"))

    def leaving(self, df: DataFrame) -> DataFrame:
        return df.observe(self._out, F.count(F.lit(1)).alias("rows"))

    def record(self, spark, pipeline_run_id: str, at) -> DataFrame:
        """The log row; call it after the write has run."""
        row = (str(uuid.uuid4()), *self.names, self._in.get["rows"], self._out.get["rows"], pipeline_run_id, at)
        return spark.createDataFrame([row], SCHEMA)


def flows(log: DataFrame) -> DataFrame:
    """Rows moved per pair of tables, with the number of hops and runs."""
    return log.groupBy("source_table", "target_table").agg(
        F.sum("rows_out").alias("total_rows"), F.count(F.lit(1)).alias("hops"),
        F.count_distinct("pipeline_run_id").alias("runs"),
    )
