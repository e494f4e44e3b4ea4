"""Session settings, table access and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. All are SQL settings, so they can be
# applied to a session somebody else started.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Python workers take batches by size, whatever the length of the rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # the state of streams lives on disk, so it may exceed memory
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: Shuffled bytes that adaptive execution should give one task; a few times as many stand in a sort of short rows.
TASK_BYTES = 16 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def build_session(app: str = "larkspur", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session, and a bound to the bytes of a task unless it has a smaller one."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    size = re.fullmatch(r"(\d+)([bkmgt]?)b?", spark.conf.get(_ADVISORY).strip().lower())
    if size is None or int(size[1]) * _UNITS[size[2]] > TASK_BYTES:
        spark.conf.set(_ADVISORY, str(TASK_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names, or a scratch one in local tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    scratch = tempfile.mkdtemp(prefix="larkspur-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the files.

    Used where a result feeds several branches that must see the same rows, and
    where an expensive prefix would otherwise be computed more than once. The
    files outlive an executor, are columnar (each branch reads only the columns
    it uses) and have a known size, which helps the planner choose joins.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cuts/{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
