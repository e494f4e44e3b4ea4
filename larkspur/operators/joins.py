"""Joins that need more than ``df.join``."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def natural(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all shared column names; nulls never match."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared columns")
    return left.join(right, shared, how)


def not_in(left: DataFrame, name: str, right: DataFrame, right_name: str) -> DataFrame:
    """``x NOT IN (subquery)`` with its null rules, as an ordinary anti join.

    A null in the subquery leaves no rows, a null on the left is dropped unless
    the subquery is empty. Catalyst's own form has to broadcast the subquery.
    """
    values = right.select(F.col(right_name).alias("_v"))
    facts = values.agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_v").isNull()).alias("nulls"))
    ).scalar()
    kept = left.join(values, F.col(name) == F.col("_v"), "left_anti").withColumn("_f", facts)
    passes = (F.col("_f.rows") == 0) | ((F.col("_f.nulls") == 0) & F.col(name).isNotNull())
    return kept.filter(passes).drop("_f")


#: Cells of a range join for each shuffle partition, and in all; a quantile per cell is what the driver holds.
CELLS_PER_PARTITION = 16
MAX_CELLS = 4096


def _number(df: DataFrame, name: str) -> Column:
    """A double that is never smaller where the value is larger."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    raise TypeError(f"{name} is of type {kind.simpleString()}; dates, timestamps and numbers have ranges")


def _binned(df: DataFrame, splits: list[float], places: dict) -> DataFrame:
    """Adds, per name of ``places``, the number of the bin that holds a value."""
    if len(splits) < 3:
        return df.withColumns({alias: F.lit(0) for alias in places})
    columns = {f"_x{alias}": value for alias, value in places.items()}
    made = Bucketizer(splitsArray=[splits] * len(places), inputCols=list(columns), outputCols=list(places), handleInvalid="skip").transform(df.withColumns(columns))
    return made.withColumns({alias: F.col(alias).cast("int") for alias in places}).drop(*columns)


def range_join(points: DataFrame, ranges: DataFrame, point: str, start: str, end: str, cells: int | None = None) -> DataFrame:
    """Points joined to the ranges that hold them, both ends included.

    The points' own quantiles cut their axis into bins of about as many points each, and a bin that holds more, as one frequent value does, is dealt to several
    cells. A range is copied to the cells of the bins it touches, all of whose points it holds but at its ends: so the copies are few against the rows that come out.
    Cell numbers are the equality key of the join; the exact bounds are checked after it. Nulls and ranges that end before they begin match nothing.
    Neither side has to fit in memory. The driver holds ``cells`` quantiles and counts.
    """
    spark = points.sparkSession
    cells = min(cells or int(spark.conf.get("spark.sql.shuffle.partitions")) * CELLS_PER_PARTITION, MAX_CELLS)
    known = points.filter(F.col(point).isNotNull())
    at = _number(points, point)
    steps = ", ".join(f"{i / cells}D" for i in range(1, cells)) or "0.5D"
    total, found = known.select(at.alias("_x")).agg(F.count(F.lit(1)), F.expr(f"percentile_approx(_x, array({steps}), 10000)")).first()
    splits = [float("-inf"), *sorted(set(found or [])), float("inf")]
    placed = _binned(known, splits, {"_bin": at})
    sizes = dict(map(tuple, placed.groupBy("_bin").count().collect()))
    parts = [max(1, -(-sizes.get(b, 0) * cells // max(total, 1))) for b in range(len(splits) - 1)]
    # numbers of a bin's first cell
    first = [sum(parts[:b]) for b in range(len(parts))]
    told = lambda values, b: F.element_at(F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>"), F.col(b) + 1)
    spread = placed.withColumn("_cell", told(first, "_bin") + (F.monotonically_increasing_id() % told(parts, "_bin")).cast("int")).drop("_bin")
    copied = _binned(ranges.filter(F.col(start) <= F.col(end)), splits, {"_low": _number(ranges, start), "_high": _number(ranges, end)})
    touched = F.sequence(told(first, "_low"), told(first, "_high") + told(parts, "_high") - 1)
    joined = spread.join(copied.withColumn("_cell", F.explode(touched)).drop("_low", "_high"), "_cell")
    return joined.filter(F.col(point).between(F.col(start), F.col(end))).drop("_cell")


def as_of_version(
    facts: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str = "valid_from", valid_to: str = "valid_to"
) -> DataFrame:
    """Facts with the version of their key that was valid at the time of the fact."""
    renamed = versions.withColumnRenamed(key, "_key")
    held = (F.col(at) >= F.col(valid_from)) & (F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to)))
    return facts.join(renamed, (F.col(key) == F.col("_key")) & held, "left").drop("_key")


def star_join(fact: DataFrame, dimensions, fallbacks: dict | None = None) -> DataFrame:
    """Left join a fact to several dimensions.

    ``dimensions`` is a list of (frame, fact key, dimension key). ``fallbacks``
    maps an output name to the columns to try in turn.
    """
    joined = reduce(
        lambda df, d: df.join(d[0], df[d[1]] == d[0][d[2]], "left") if d[1] != d[2] else df.join(d[0], d[1], "left"),
        dimensions, fact,
    )
    for name, choices in (fallbacks or {}).items():
        joined = joined.withColumn(name, F.coalesce(*choices))
    return joined


def full_on(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Full outer join with one copy of the keys; null keys match each other."""
    marked = right.select([F.col(k).alias(f"_r_{k}") for k in keys] + [c for c in right.columns if c not in keys])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    joined = left.join(marked, condition, "full")
    others = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    return joined.select(*[F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in keys], *others)
