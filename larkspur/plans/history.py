"""Versioned history of a table (slowly changing dimension, type 2).

Validity is half open: ``valid_from`` <= t < ``valid_to``; the current version
has no ``valid_to``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import surrogate_key
from larkspur.operators.ordered import row_number
from larkspur.plans.staging import age_bucket
from larkspur.sources.tables import Stored

VALIDITY = ["scd_id", "updated_at", "valid_from", "valid_to"]


def first_snapshot(source: DataFrame, key: str, at: str) -> DataFrame:
    """All rows as current versions."""
    now = F.lit(at).cast("timestamp")
    return source.select(
        "*", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(at))).alias("scd_id"), now.alias("updated_at"),
        now.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"),
    )


def snapshot(history: DataFrame, source: DataFrame, key: str, tracked, at: str, hard_deletes: bool = True) -> DataFrame:
    """History after looking at the source once more.

    A changed tracked column closes the open version and starts a new one; a key
    that is gone is closed (unless ``hard_deletes`` is off); a change of other
    columns alone leaves the open version as it is. Running twice on the same
    source changes nothing. Open versions meet the source in one full join, and
    each pair yields the one or two rows that follow from it.
    """
    now = F.lit(at).cast("timestamp")
    columns = history.columns
    fresh = first_snapshot(source, key, at).select(*columns)
    opened = history.filter(F.col("valid_to").isNull()).select(F.struct(*columns).alias("old"))
    arrived = fresh.select(F.struct(*columns).alias("new"))
    pairs = opened.join(arrived, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")

    changed = reduce(lambda a, b: a | b, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked])
    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    ends = had & ((has & changed) | (~has & F.lit(hard_deletes)))
    closed = F.struct(*[(now if c == "valid_to" else F.col(f"old.{c}")).alias(c) for c in columns])
    kept = F.when(ends, closed).when(had, F.col("old"))
    started = F.when(has & (~had | changed), F.col("new"))
    live = pairs.select(F.inline(F.array_compact(F.array(kept, started))))
    return history.filter(F.col("valid_to").isNotNull()).unionByName(live)


def save(history: DataFrame, stored: Stored) -> DataFrame:
    """Store the history as a new version of its table, from whose rows it may be made; returns the stored rows."""
    return stored.replace(history)


def look(stored: Stored, source: DataFrame, key: str, tracked, at: str, hard_deletes: bool = True) -> DataFrame:
    """Bring a stored history up to date with its source: the first look fills the table."""
    if not stored.exists():
        return save(first_snapshot(source, key, at), stored)
    return stored.change(lambda rows: snapshot(rows, source, key, tracked, at, hard_deletes))


def dimension(history: DataFrame, key: str = "customer_id") -> DataFrame:
    """Versions with a surrogate key, a current flag and a counter per key."""
    numbered = row_number(history, [key], ["valid_from", "scd_id"], "_version_num")
    return numbered.withColumns(
        {
            "customer_version_sk": surrogate_key(key, "scd_id"),
            "age_bucket": age_bucket(),
            "_is_current": F.col("valid_to").isNull(),
        }
    ).withColumnsRenamed(
        {"valid_from": "_valid_from", "valid_to": "_valid_to", "scd_id": "_scd_id", "updated_at": "_updated_at"}
    )


def current(history: DataFrame) -> DataFrame:
    """The versions that are valid now, as the dimension has them but for their numbers."""
    return history.filter(F.col("valid_to").isNull()).withColumn("age_bucket", age_bucket())


def dimension_increment(history: DataFrame, stored: DataFrame, key: str = "customer_id") -> DataFrame:
    """Versions of the keys touched since the stored dimension was built, numbered over their whole history."""
    newest = stored.agg(F.coalesce(F.max("_updated_at"), F.lit("2000-01-01").cast("timestamp"))).scalar()
    since = F.greatest("updated_at", F.coalesce("valid_to", "updated_at"))
    touched = history.filter(since > newest).select(key).distinct()
    return dimension(history.join(touched, key, "left_semi"), key)


def merge_increment(stored: DataFrame, increment: DataFrame, key: str = "customer_id") -> DataFrame:
    """Stored dimension with the touched keys replaced."""
    return stored.join(increment.select(key).distinct(), key, "left_anti").unionByName(increment, allowMissingColumns=True)


def multi_version(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Full history of the keys that have more than one version, in order."""
    several = dim.filter(F.col("_version_num") > 1).select(key)
    stamp = "yyyy-MM-dd HH:mm:ss"
    return (
        dim.join(several, key, "left_semi")
        .withColumns({"valid_from": F.date_format("_valid_from", stamp), "valid_to": F.date_format("_valid_to", stamp)})
        .orderBy(key, "_version_num")
    )
