"""Ordered operators that stay spread over the cluster.

A window sends every row of one partition key to one task. That is the right
plan while no key is large. When a key (or a whole table, for a window without
keys) holds more rows than one task should hold, the rows are range-partitioned by key
and order and cut into segments of at most that many rows; the window then runs per segment
and what happened in the earlier segments of a key is added from their sums. Results
are the same either way.

``order`` is a list of column names, ``"-name"`` meaning descending. Nulls sort
first ascending and last descending, as in Spark. Where the docstring says so,
the order has to be total (end it with a unique column).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.session import cut

ROWS_PER_TASK = 2_000_000
#: Bytes of rows that a window should hold in one task, by the row's width; several windows in a row hold as much each.
BYTES_PER_TASK = 128 << 20
#: Keys that a percentile may bracket; the others take the general way.
MAX_HOT_KEYS = 1_000
TRACKED_KEYS = 20_000
#: Rows that a task sorts at least.
SORT_ROWS = 100_000


def _parse(order):
    return [(name.lstrip("-"), not name.startswith("-")) for name in order]


def _names(order):
    return [name for name, _ in _parse(order)]


def sort_columns(order):
    return [F.col(name).asc() if up else F.col(name).desc() for name, up in _parse(order)]


def plain_window(keys, order):
    window = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return window.orderBy(*sort_columns(order)) if order else window


def row_width(schema: T.StructType) -> int:
    """About how many bytes a sorted row takes: a word for each column, three more for text and four more for nested ones, and two for its place."""
    more = {T.StringType: 3, T.BinaryType: 3, T.DecimalType: 2, T.ArrayType: 4, T.MapType: 4, T.StructType: 4}
    return 8 * (2 + sum(1 + more.get(type(f.dataType), 0) for f in schema))


def rows_per_task(df: DataFrame, max_rows: int | None) -> int:
    """Rows that a task should hold: as many as asked for, or else as settings say, and fewer if they are wide."""
    if max_rows is not None:
        return max_rows
    rows = int(df.sparkSession.conf.get("spark.larkspur.rowsPerTask", str(ROWS_PER_TASK)))
    return max(1, min(rows, BYTES_PER_TASK // row_width(df.schema)))


def _same(left: DataFrame, right: DataFrame, names) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def attach(df: DataFrame, small: DataFrame, names) -> DataFrame:
    """Left join on null-safe equality, keeping the columns of ``df`` once."""
    renamed = small.select([F.col(c).alias(f"_r_{c}") if c in names else F.col(c) for c in small.columns])
    condition = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_r_{n}")) for n in names])
    return df.join(renamed, condition, "left").drop(*[f"_r_{n}" for n in names])


def measure(df: DataFrame, keys, max_rows: int | None = None) -> tuple[int, int]:
    """Rows of the largest key, or a number it doesn't exceed, and of the table.

    The rows of a table that fits a task as a whole are merely counted. Several windows over one stored table can share an answer,
    passed as their ``measured``; of that for some keys, the second number serves windows without keys.
    """
    total = df.count()
    if not keys or total <= rows_per_task(df, max_rows):
        return total, total
    row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n"), F.sum("_n")).first()
    return row[0] or 0, row[1] or 0


def hot_groups(df: DataFrame, keys, max_rows: int):
    """Keys with more than ``max_rows`` rows and at least 1/1000 of the table, with their counts.

    For shortcuts only, whose results do not depend on it. The second condition bounds the list: there can be at most 1,000 such keys.
    A sketch of frequent keys finds the candidates in one scan without a shuffle
    of the keys; it tracks enough of them to miss no key above a thousandth, and
    its counts are never too low. Only candidates are then counted exactly.
    """
    if not keys:
        total = df.count()
        return [Row(_n=total, _total=total)] if total > max_rows else []
    hashed = F.xxhash64(*keys)
    frequent = F.expr(f"approx_top_k(_h, {2 * MAX_HOT_KEYS}, {TRACKED_KEYS})")
    total, found = (
        df.select(hashed.alias("_h")).agg(F.count(F.lit(1)).alias("total"), frequent.alias("found")).first()
    )
    limit = max(max_rows, total // MAX_HOT_KEYS)
    candidates = [item["item"] for item in found or [] if item["count"] > limit]
    if not candidates:
        return []
    counts = df.filter(hashed.isin(*candidates)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > limit).withColumn("_total", F.lit(total)).collect()


def segments(df: DataFrame, keys, order, max_rows: int | None = None, measured: tuple[int, int] | None = None):
    """Add ``_seg``: ascending slice numbers of at most ``max_rows`` rows each, in the order of the keys and ``order``.

    Returns ``None`` when no key has more rows than that. Range partitions are sorted by their tasks, which may spill, and
    cut by position; they are written, since sampled bounds may differ if computed again.
    """
    max_rows = rows_per_task(df, max_rows)
    largest, total = measured or measure(df, keys, max_rows)
    if largest <= max_rows:
        return None
    parts = -(-total // max(max_rows, SORT_ROWS))
    by = [*(F.col(k).asc() for k in keys), *sort_columns(order)]
    placed = df.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    part, position = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    return cut(placed.withColumn("_seg", F.shiftleft(part, 33) + F.floor(position / max_rows)).drop("_at"))


def prefix_sums(df: DataFrame, keys, order, sums: dict, max_rows: int | None = None, measured: tuple[int, int] | None = None) -> DataFrame:
    """Running sums per key, current row included. The order has to be total.

    ``sums`` maps output names to columns that are never null; ``measured`` is what ``measure`` said, if it was asked before.
    """
    return running(df, keys, order, sums, F.sum, lambda own, before: own + F.coalesce(before, F.lit(0)), max_rows, measured)


def running(df: DataFrame, keys, order, values: dict, total, plus, max_rows: int | None = None, measured: tuple[int, int] | None = None) -> DataFrame:
    """Running aggregates ``total`` of ``values``, current row included; ``plus`` puts a segment's own and the earlier segments' together. The order has to be total."""
    keys = list(keys)
    cut_rows = segments(df, keys, order, max_rows, measured)
    frame = (Window.unboundedPreceding, Window.currentRow)
    if cut_rows is None:
        window = plain_window(keys, order).rowsBetween(*frame)
        return df.select("*", *[total(c).over(window).alias(a) for a, c in values.items()])

    by_segment = [*keys, "_seg"]
    earlier = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    # a row per key and segment: keys without a segment border inside have one
    before = (
        cut_rows.groupBy(*by_segment)
        .agg(*[total(c).alias(f"_s_{a}") for a, c in values.items()])
        .select(*by_segment, *[total(f"_s_{a}").over(earlier).alias(f"_o_{a}") for a in values])
    )
    window = plain_window(by_segment, order).rowsBetween(*frame)
    local = cut_rows.select("*", *[total(c).over(window).alias(f"_l_{a}") for a, c in values.items()])
    joined = attach(local, before, by_segment)
    return joined.select(
        *df.columns,
        *[plus(F.col(f"_l_{a}"), F.col(f"_o_{a}")).alias(a) for a in values],
    )


def row_number(df: DataFrame, keys, order, alias="row_number", max_rows=None, measured=None) -> DataFrame:
    """Row number per key. The order has to be total."""
    return prefix_sums(df, keys, order, {alias: F.lit(1)}, max_rows, measured).withColumn(
        alias, F.col(alias).cast("long")
    )


def _by_value(df: DataFrame, keys, order, extra, sums, finish, max_rows, stored=None) -> DataFrame:
    """Work on distinct (key, order value) rows, then join the answer back.

    Ties collapse before the shuffle, so even one value held by a third of the
    table is a single row here.
    """
    by = list(dict.fromkeys([*keys, *_names(order)]))
    values = (df if stored is None else stored).groupBy(*by).agg(*extra)
    numbered = finish(prefix_sums(values, keys, order, sums, max_rows))
    return attach(df, numbered, by)


def _large(df: DataFrame, keys, max_rows, measured=None) -> bool:
    return (measured or measure(df, keys, max_rows))[0] > rows_per_task(df, max_rows)


def rank(df: DataFrame, keys, order, alias="rank", max_rows=None, measured=None, stored=None) -> DataFrame:
    """Rank with gaps; ties share a rank. ``stored`` has the same rows as ``df``, which may be made from it, and is read for their values."""
    keys = list(keys)
    if not _large(df, keys, max_rows, measured):
        return df.withColumn(alias, F.rank().over(plain_window(keys, order)).cast("long"))
    return _by_value(
        df, keys, order, [F.count(F.lit(1)).alias("_n")], {"_upto": F.col("_n")},
        lambda v: v.withColumn(alias, F.col("_upto") - F.col("_n") + 1).drop("_n", "_upto"), max_rows, stored,
    )


def dense_rank(df: DataFrame, keys, order, alias="dense_rank", max_rows=None) -> DataFrame:
    """Rank without gaps."""
    keys = list(keys)
    if not _large(df, keys, max_rows):
        return df.withColumn(alias, F.dense_rank().over(plain_window(keys, order)).cast("long"))
    return _by_value(
        df, keys, order, [F.count(F.lit(1)).alias("_n")], {alias: F.lit(1)},
        lambda v: v.withColumn(alias, F.col(alias).cast("long")).drop("_n"), max_rows,
    )


def running_sum(df: DataFrame, keys, order, value: str, alias="running_sum", max_rows=None) -> DataFrame:
    """Cumulative sum with the default frame: rows with equal order values get the same sum."""
    keys = list(keys)
    if not _large(df, keys, max_rows):
        return df.withColumn(alias, F.sum(value).over(plain_window(keys, order)))
    extra = [F.coalesce(F.sum(value), F.lit(0)).alias("_v"), F.count(value).alias("_c")]

    def finish(values):
        # a sum of nothing but nulls is null
        return values.withColumn(alias, F.when(F.col("_seen") > 0, F.col(alias))).drop("_v", "_c", "_seen")

    return _by_value(df, keys, order, extra, {alias: F.col("_v"), "_seen": F.col("_c")}, finish, max_rows)


def neighbour(df: DataFrame, keys, order, value: str, offset: int, alias: str, max_rows=None, measured=None) -> DataFrame:
    """Value ``offset`` rows back (negative: ahead). The order has to be total."""
    keys = list(keys)
    measured = measured or measure(df, keys, max_rows)
    if measured[0] <= rows_per_task(df, max_rows):
        return df.withColumn(alias, F.lag(value, offset).over(plain_window(keys, order)))
    numbered = cut(prefix_sums(df, keys, order, {"_at": F.lit(1).cast("long")}, max_rows, measured))
    other = numbered.select(*keys, (F.col("_at") + offset).alias("_at"), F.col(value).alias(alias))
    return attach(numbered, other, [*keys, "_at"]).drop("_at")


def rolling(df: DataFrame, keys, order, back: int, columns: dict, max_rows=None, measured=None) -> DataFrame:
    """Aggregates over the ``back`` rows before each row of its key, without the row itself. The order has to be total.

    ``columns`` maps output names to aggregates. A large key is cut into blocks by position; the last rows of a block are
    copied to the next one, whose first rows look back at them, so each row is in two tasks at most.
    """
    keys, limit = list(keys), rows_per_task(df, max_rows)
    measured = measured or measure(df, keys, max_rows)
    if measured[0] <= limit:
        window = plain_window(keys, order).rowsBetween(-back, -1)
        return df.select("*", *[c.over(window).alias(a) for a, c in columns.items()])
    size = max(limit, back)
    numbered = cut(prefix_sums(df, keys, order, {"_at": F.lit(1).cast("long")}, max_rows, measured))
    place = F.col("_at") - 1
    own = numbered.withColumns({"_block": F.floor(place / size), "_lent": F.lit(False)})
    lent = numbered.filter(place % size >= size - back).withColumns({"_block": F.floor(place / size) + 1, "_lent": F.lit(True)})
    window = Window.partitionBy(*keys, "_block").orderBy("_at").rowsBetween(-back, -1)
    found = own.unionByName(lent).select("*", *[c.over(window).alias(a) for a, c in columns.items()])
    return found.filter(~F.col("_lent")).drop("_at", "_block", "_lent")


def ntile(df: DataFrame, n: int, order, alias="ntile", max_rows=None, measured=None) -> DataFrame:
    """Equal-size buckets over the whole table. The order has to be total."""
    measured = measured or measure(df, [], max_rows)
    numbered = row_number(df, [], order, "_at", max_rows, measured)
    return numbered.withColumn("_rows", F.lit(measured[1])).withColumn(
        alias, tile_number(F.col("_at"), F.col("_rows"), n)
    ).drop("_at", "_rows")


def tile_number(position: Column, rows: Column, n: int) -> Column:
    """Bucket of a 1-based position: the first ``rows % n`` buckets get one row more."""
    small = F.floor(rows / n)
    extra = rows % n
    in_large = F.ceil(position / (small + 1))
    in_small = extra + F.ceil((position - extra * (small + 1)) / F.greatest(small, F.lit(1)))
    return F.when(position <= extra * (small + 1), in_large).otherwise(in_small).cast("int")


def _position(q: float, total: Column) -> Column:
    return F.lit(q) * (total - 1)


def _brackets(df: DataFrame, keys, hot, q: float) -> DataFrame:
    """Per hot key, two values around the quantile and the number of rows below the lower one.

    The values come from a mergeable sketch a thousandth to either side; should
    the wanted rows lie outside all the same, that key gets open bounds.
    """
    spark = df.sparkSession
    ends = [max(q - 0.001, 0.0), min(q + 0.001, 1.0)]
    fields = [df.schema[k] for k in keys]
    if keys:
        names = F.broadcast(spark.createDataFrame([tuple(r[k] for k in keys) for r in hot], T.StructType(fields)))
        rows = df.join(names, _same(df, names, keys), "left_semi")
    else:
        rows = df
    sketch = F.percentile_approx("_v", ends, 10_000)
    # at most 1,000 keys from here on
    near = rows.groupBy(*keys).agg(sketch.alias("_e")).select(*keys, F.col("_e")[0].alias("_from"), F.col("_e")[1].alias("_to"))
    kinds = [T.StructField(n, T.DoubleType()) for n in ("_from", "_to")]
    fixed = spark.createDataFrame(near.collect(), T.StructType(fields + kinds))
    sides = _bounded(rows, fixed, keys).groupBy(*keys, "_from", "_to").agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(F.col("_v") < F.col("_from")).alias("_below"),
        F.count_if(F.col("_v").between(F.col("_from"), F.col("_to"))).alias("_inside"),
    )
    at = _position(q, F.col("_all"))
    good = (F.floor(at) >= F.col("_below")) & (F.ceil(at) < F.col("_below") + F.col("_inside"))
    low, high = F.lit(float("-inf")), F.lit(float("nan"))  # NaN sorts last
    checked = sides.select(
        *keys, F.when(good, F.col("_from")).otherwise(low).alias("_from"), F.when(good, F.col("_to")).otherwise(high).alias("_to"),
        F.when(good, F.col("_below")).otherwise(F.lit(0)).cast("long").alias("_below"),
    )
    return spark.createDataFrame(checked.collect(), checked.schema)


def _bounded(df: DataFrame, bounds: DataFrame, keys) -> DataFrame:
    if keys:
        return attach(df, F.broadcast(bounds), keys)
    one = bounds.select(F.struct("*").alias("_b")).scalar()
    return df.withColumn("_b", one).select("*", "_b.*").drop("_b")


def percentile(df: DataFrame, keys, value: str, q: float, alias="percentile", max_rows=None) -> DataFrame:
    """Exact interpolated quantile per key.

    Distinct values are counted with map-side combining and numbered by running
    count; the one or two around the wanted position are kept. Of a hot key only
    the rows in a narrow bracket around the quantile take part, the rows below
    are merely counted.
    """
    keys = list(keys)
    clean = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    sizes = F.count(F.lit(1))
    totals = clean.groupBy(*keys).agg(sizes.alias("_total")) if keys else clean.agg(sizes)
    hot = hot_groups(clean, keys, rows_per_task(df, max_rows))
    if hot:
        bounds = _brackets(clean, keys, hot, q)
        inside = F.col("_from").isNull() | ((F.col("_v") >= F.col("_from")) & (F.col("_v") <= F.col("_to")))
        band = _bounded(clean, bounds, keys).filter(inside).drop("_from", "_to")
    else:
        band = clean.withColumn("_below", F.lit(0))
    counts = band.groupBy(*keys, "_v").agg(sizes.alias("_n"), F.coalesce(F.max("_below"), F.lit(0)).alias("_below"))
    running = prefix_sums(counts, keys, ["_v"], {"_upto": F.col("_n")}, max_rows)
    running = running.withColumn("_upto", F.col("_upto") + F.col("_below"))
    placed = attach(running, totals, keys) if keys else running.withColumn("_total", totals.scalar())
    at = _position(q, F.col("_total"))
    near = placed.withColumn("_lo", F.floor(at)).withColumn("_hi", F.ceil(at)).withColumn("_part", at - F.floor(at))

    def holds(position):
        return (F.col("_upto") > F.col(position)) & (F.col("_upto") - F.col("_n") <= F.col(position))

    low = F.max(F.when(holds("_lo"), F.col("_v")))
    high = F.max(F.when(holds("_hi"), F.col("_v")))
    return (
        near.filter(holds("_lo") | holds("_hi"))
        .groupBy(*keys)
        .agg(low.alias("_low"), high.alias("_high"), F.max("_part").alias("_part"))
        .select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias(alias))
    )


def with_totals(df: DataFrame, keys, totals: dict) -> DataFrame:
    """Group totals on every row, without a window.

    The aggregate is combined before its shuffle; the join back is a broadcast
    when the totals are small and a skew-splitting sort-merge join otherwise.
    """
    keys = list(keys)
    sums = [c.alias(a) for a, c in totals.items()]
    if not keys:
        whole = df.agg(F.struct(*sums).alias("_t")).scalar()
        return df.withColumn("_t", whole).select("*", *[F.col(f"_t.{a}").alias(a) for a in totals]).drop("_t")
    return attach(df, df.groupBy(*keys).agg(*sums), keys)


def top_per_group(df: DataFrame, keys, order, n: int, alias="rank") -> DataFrame:
    """Rows at the first ``n`` ranks of each key, ties included.

    Spark limits each group on the map side before shuffling, so a hot key
    sends only its candidates.
    """
    return df.withColumn(alias, F.rank().over(plain_window(keys, order))).filter(F.col(alias) <= n)


def first_per_group(df: DataFrame, keys, order) -> DataFrame:
    """The first row per key. The order has to be total to be repeatable."""
    return (
        df.withColumn("_first", F.row_number().over(plain_window(keys, order)))
        .filter(F.col("_first") == 1)
        .drop("_first")
    )
