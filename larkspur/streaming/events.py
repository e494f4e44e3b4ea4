"""Event streams: parse, validate, enrich, window.

Every function takes a batch or a streaming frame. Event time must be TIMESTAMP,
since watermarks do not accept the zone-less type.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from larkspur.functions.numbers import half_up
from larkspur.functions.text import masked_id
from larkspur.operators.rows import map_values

# Fields of an admission message.
ADMISSION_SCHEMA = (
    "event_type string, patient_id string, hospital_id string, hospital_name string, state string, hospital_type string, "
    "condition string, severity string, is_emergency boolean, timestamp string, event_id string"
)

# Severity scores and the surge threshold.
SEVERITY_SCORES = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
SURGE_ABOVE = 5


def read_files(spark: SparkSession, folder: str, schema, pattern: str | None = None, fmt: str = "parquet", per_batch: int | None = None):
    """A stream of the files that appear in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(folder)


def read_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """A stream of JSON texts from a topic; needs the Kafka connector on the cluster."""
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return source.load().select(F.col("value").cast("string").alias("raw"), "timestamp")


def parse(messages: DataFrame, schema: str, required=("hospital_id", "severity"), raw: str = "raw") -> DataFrame:
    """Decode JSON text and name the first thing wrong with it in ``error`` (null for a valid event)."""
    parsed = messages.withColumn("_e", F.from_json(raw, f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))
    error = F.when(F.col("_e").isNull() | F.col("_e._corrupt").isNotNull(), F.lit("parse_error"))
    for name in required:
        error = error.when(F.coalesce(F.col(f"_e.{name}"), F.lit("")) == "", F.lit(f"missing_{name}"))
    fields = parsed.select("_e.*").columns
    return parsed.withColumn("error", error).select(
        *[c for c in messages.columns if c not in fields], *[F.col(f"_e.{f}").alias(f) for f in fields if f != "_corrupt"], "error"
    )


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error")


def dead_letters(parsed: DataFrame, raw: str = "raw") -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select(raw, "error")


def enrich(events: DataFrame, salt: str, version: str, processed_at=None) -> DataFrame:
    """Severity score, masked patient id, critical flag, processing time, version."""
    return events.withColumns(
        {
            "severity_score": map_values("severity", SEVERITY_SCORES, 1),
            "patient_id_masked": masked_id(F.coalesce("patient_id", F.lit("")), salt, 10),
            "is_critical": F.coalesce(F.col("severity") == "CRITICAL", F.lit(False)),
            "processed_at": F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp"),
            "pipeline_version": F.lit(version),
        }
    )


def window_stats(
    events: DataFrame, key: str, at: str, length: str = "5 minutes", slide: str | None = None, late: str | None = None,
    sample=(), surge_above: int = SURGE_ABOVE,
) -> DataFrame:
    """Per key and window: counts, mean severity, surge flag and reason.

    ``late`` is how far an event may trail the newest one and still correct its
    window. ``sample`` columns come from the earliest event of the window. All
    aggregates combine, so a busy key is summed up before it is shuffled.
    """
    source = events.withWatermark(at, late) if late else events
    total = F.count(F.lit(1))
    stats = source.groupBy(F.window(at, length, slide), key).agg(
        total.alias("total_admissions"),
        F.count_if("is_critical").alias("critical_count"),
        F.count_if(F.col("severity") == "HIGH").alias("high_count"),
        half_up(F.avg("severity_score"), 2).alias("avg_severity_score"),
        *[F.min_by(c, at).alias(c) for c in sample],
    )
    surge = F.col("total_admissions") > surge_above
    reason = F.concat(F.col("total_admissions").cast("string"), F.lit(" admissions in window"))
    return stats.select(
        key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *sample,
        "total_admissions", "critical_count", "high_count", "avg_severity_score", surge.alias("is_surge"),
        F.when(surge, reason).otherwise(F.lit("")).alias("surge_reason"),
    )


def dedupe(events: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """First event per id, remembering ids for as long as repeats may arrive."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def newest_per_key(events: DataFrame, key: str, at: str, tie: str, late: str, keep: str, parts: int = 1) -> DataFrame:
    """Update stream of the newest event per key, by (``at``, ``tie``): a row each time a newer one arrives.

    What is remembered of a key is where its newest event stands, and only until the watermark, which trails the newest event by ``late``, is
    ``keep`` past it. After that any event the watermark lets in is newer. A batch's events of a key reach the state in Arrow batches, never
    all at once; ``parts`` gives a hot key so many states, whose updates the reader settles (``latest`` with the same order).
    Events without time are left out.
    """
    columns = events.columns
    kind = events.schema[tie].dataType.simpleString()
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)

    def newest(_, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, row = (tuple(state.get) if state.exists else None), None
        for batch in batches:
            last = batch.sort_values(["_at", tie]).tail(1)
            place = (int(last["_at"].iloc[0]), last[tie].iloc[0])
            if best is None or place > best:
                best, row = place, last
        if row is not None:
            state.update((best[0], best[1].item() if hasattr(best[1], "item") else best[1]))
        state.setTimeoutTimestamp(max(best[0] // 1000 + keep_ms, state.getCurrentWatermarkMs() + 1))
        if row is not None:
            yield row[columns]

    timed = events.filter(F.col(at).isNotNull()).withWatermark(at, late)
    known = timed.withColumns({"_at": F.unix_micros(at), "_part": F.pmod(F.xxhash64(at, tie), F.lit(parts))})
    return known.groupBy(key, "_part").applyInPandasWithState(newest, events.schema, f"at long, tie {kind}", "update", GroupStateTimeout.EventTimeTimeout)


def valid_prices(quotes: DataFrame, source: str, version: str) -> DataFrame:
    """Quotes with all fields and a positive price, rounded and stamped."""
    price, change, volume = F.col("usd"), F.col("usd_24h_change"), F.col("usd_24h_vol")
    return quotes.filter(change.isNotNull() & volume.isNotNull() & (price > 0)).select(
        "coin", half_up(price, 2).alias("price_usd"), half_up(volume, 2).alias("volume_24h"),
        half_up(change, 4).alias("change_24h_pct"), "ingested_at", F.lit(source).alias("source"),
        F.lit(version).alias("pipeline_version"),
    )


def as_report(stats: DataFrame, computed_at=None) -> DataFrame:
    """Window statistics with their bounds as text in UTC and the time of computation."""
    form = "yyyy-MM-dd HH:mm:ss 'UTC'"
    now = F.current_timestamp() if computed_at is None else F.lit(computed_at).cast("timestamp")
    return stats.withColumns(
        {
            "window_start": F.date_format("window_start", form), "window_end": F.date_format("window_end", form),
            "computed_at": F.date_format(now, form),
        }
    )
