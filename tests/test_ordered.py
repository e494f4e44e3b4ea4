"""Segmented windows against Spark's own windows, on data where some keys hold most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.operators import ordered

LIMIT = 40  # rows per task, so that the large keys are cut


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(900).select(
        F.col("id"),
        F.when(F.col("id") < 400, "hot").when(F.col("id") < 700, F.lit(None)).otherwise((F.col("id") % 37).cast("string")).alias("k"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919) % 50).alias("v"),
        F.when(F.col("id") % 3 == 0, 5).otherwise((F.col("id") * 31) % 20).alias("tied"),
    )
    return ordered.cut(base)


def same(a, b):
    a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


KEYS = [["k"], []]
ORDERS = [["v", "id"], ["-tied", "-id"]]


@pytest.mark.parametrize("keys", KEYS)
@pytest.mark.parametrize("order", ORDERS)
def test_row_number_and_neighbours(rows, keys, order):
    window = ordered.plain_window(keys, order)
    same(
        ordered.row_number(rows, keys, order, "n", LIMIT),
        rows.withColumn("n", F.row_number().over(window).cast("long")),
    )
    same(ordered.neighbour(rows, keys, order, "v", 2, "w", LIMIT), rows.withColumn("w", F.lag("v", 2).over(window)))
    same(ordered.neighbour(rows, keys, order, "v", -1, "w", LIMIT), rows.withColumn("w", F.lead("v").over(window)))


@pytest.mark.parametrize("keys", KEYS)
@pytest.mark.parametrize("order", [["tied"], ["-v"]])
def test_ranks_and_running_sum(rows, keys, order):
    window = ordered.plain_window(keys, order)
    same(ordered.rank(rows, keys, order, "r", LIMIT), rows.withColumn("r", F.rank().over(window).cast("long")))
    same(ordered.dense_rank(rows, keys, order, "r", LIMIT), rows.withColumn("r", F.dense_rank().over(window).cast("long")))
    some = rows.withColumn("w", F.when(F.col("tied") > 3, F.col("id")))
    same(ordered.running_sum(some, keys, order, "w", "s", LIMIT), some.withColumn("s", F.sum("w").over(window)))


@pytest.mark.parametrize("keys", KEYS)
@pytest.mark.parametrize("back", [1, 7, 55])
@pytest.mark.parametrize("limit", [10, 10_000])
def test_rolling(rows, keys, back, limit):
    """Also where a frame reaches over more rows than a task should hold."""
    window = ordered.plain_window(keys, ["v", "id"]).rowsBetween(-back, -1)
    columns = {"m": F.avg("tied"), "s": F.stddev_samp("tied"), "n": F.count("v"), "low": F.min("id")}
    rounded = lambda df: df.withColumns({"m": F.round("m", 9), "s": F.round("s", 9)})
    found = ordered.rolling(rows, keys, ["v", "id"], back, columns, limit)
    same(rounded(found), rounded(rows.select("*", *[c.over(window).alias(a) for a, c in columns.items()])))


def test_rolling_spreads_one_key(spark):
    table = spark.range(5_000).withColumn("k", F.lit("only"))
    blocks = ordered.rolling(table, ["k"], ["id"], 3, {"m": F.avg("id")}, 100)
    assert "_block" in blocks._jdf.queryExecution().toString() and blocks.columns == ["id", "k", "m"]
    assert blocks.filter("id >= 3 AND m <> id - 2").isEmpty() and blocks.count() == 5_000


def jobs_of(spark, group, make):
    spark.sparkContext.setJobGroup(group, group)
    try:
        made = make()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), made
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_few_jobs_before_the_result(spark, rows):
    """A table that fits a task is counted, and no more."""
    rank_jobs, _ = jobs_of(spark, "rank", lambda: ordered.rank(rows, ["k"], ["tied"]))
    shared = ordered.measure(rows, [])
    tile_jobs, _ = jobs_of(spark, "tiles", lambda: [ordered.ntile(rows, 5, [c, "id"], measured=shared) for c in ("v", "tied", "id")])
    assert rank_jobs <= 2 and tile_jobs == 0
    assert ordered.measure(rows, ["k"]) == (900, 900) and ordered.measure(rows, ["k"], 500) == (400, 900)


@pytest.mark.parametrize("n", [1, 7, 2000])
def test_ntile(rows, n):
    order = ["tied", "id"]
    expected = rows.withColumn("b", F.ntile(n).over(ordered.plain_window([], order)))
    same(ordered.ntile(rows, n, order, "b", LIMIT), expected)


@pytest.mark.parametrize("keys", KEYS)
@pytest.mark.parametrize("q", [0.0, 0.37, 1.0])
def test_percentile(rows, keys, q):
    found = ordered.percentile(rows, keys, "v", q, "p", LIMIT).withColumn("p", F.round("p", 9))
    expected = rows.filter("v IS NOT NULL").groupBy(*keys).agg(F.round(F.percentile("v", q), 9).alias("p"))
    same(found, expected)


def test_percentile_of_spread_values(spark):
    """Enough distinct values for the bracket to leave most rows out, and a key of many equal ones."""
    base = ordered.cut(
        spark.range(60_000).select(
            F.when(F.col("id") % 3 == 0, "even").when(F.col("id") % 3 == 1, "flat").otherwise((F.col("id") % 97).cast("string")).alias("k"),
            F.when(F.col("id") % 3 == 1, 5.0).otherwise(F.rand(3) * 1000).alias("v"),
        )
    )
    for keys in KEYS:
        for q in (0.0, 0.123, 0.999):
            found = ordered.percentile(base, keys, "v", q, "p", 2_000).withColumn("p", F.round("p", 9))
            expected = base.groupBy(*keys).agg(F.round(F.percentile("v", q), 9).alias("p"))
            same(found, expected)
    hot = ordered.hot_groups(base, ["k"], 2_000)
    inside = ordered._brackets(base.withColumnRenamed("v", "_v"), ["k"], hot, 0.5)
    assert sorted(r.k for r in inside.collect()) == ["even", "flat"]
    wide = inside.filter("k = 'even'").first()
    assert base.filter("k = 'even'").filter(F.col("v").between(wide._from, wide._to)).count() < 200


def test_segments_stay_within_the_limit(rows):
    cut_rows = ordered.segments(rows, ["k"], ["v", "id"], LIMIT)
    assert cut_rows.groupBy("_seg").count().agg(F.max("count")).first()[0] <= LIMIT
    assert cut_rows.count() == rows.count()


def test_a_large_table_and_a_key_that_is_a_small_part_of_it(spark):
    table = spark.range(400_000).select("id", F.when(F.col("id") < 1_500, -1).otherwise(F.col("id") % 9_000).alias("k"))
    cut_rows = ordered.segments(table, ["k"], ["id"], 100)
    assert cut_rows.groupBy("_seg").count().agg(F.max("count")).first()[0] <= 100
    assert cut_rows.filter("k = -1").select("_seg").distinct().count() >= 15
    numbered = ordered.row_number(table, ["k"], ["id"], "n", 100).filter("k = -1")
    assert numbered.filter("n <> id + 1").isEmpty() and numbered.count() == 1_500


def test_no_hot_key_keeps_the_plain_window(rows):
    assert ordered.segments(rows, ["k"], ["id"], 10_000) is None
    plan = ordered.row_number(rows, ["k"], ["id"], "n", 10_000)._jdf.queryExecution().toString()
    assert "Window" in plan and "Join" not in plan


def test_totals_and_top(rows):
    window = Window.partitionBy("k")
    same(ordered.with_totals(rows, ["k"], {"t": F.sum("v")}), rows.withColumn("t", F.sum("v").over(window)))
    same(
        ordered.first_per_group(rows, ["k"], ["-v", "id"]),
        rows.withColumn("n", F.row_number().over(ordered.plain_window(["k"], ["-v", "id"]))).filter("n = 1").drop("n"),
    )
