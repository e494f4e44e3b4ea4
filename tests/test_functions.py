"""Known answers for scalar functions and reshaping."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larkspur.functions import dates as d
from larkspur.functions import nested, numbers, text
from larkspur.operators import aggregates, calendar, ordered, rows, sets


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_surrogate_key(spark):
    df = spark.createDataFrame(
        [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)], "p string, q string, r string"
    )
    found = df.select(text.surrogate_key("p"), text.surrogate_key("p", "q", "r")).collect()
    assert [tuple(r) for r in found] == [
        ("0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
    ]


def test_title(spark):
    found = column(spark, ["york-CITY", "o'NEIL street", "a_b.c d", "", None], "string", text.title("x"))
    assert found == ["York-City", "O'neil Street", "A_B.C D", "", None]


def test_regex_position(spark):
    words = ["abc 12 x 345", "none", None]
    assert column(spark, words, "string", text.regex_position("x", "[0-9]+")) == [5, 0, None]
    assert column(spark, words, "string", text.regex_position("x", "[0-9]+", occurrence=2)) == [10, 0, None]
    assert column(spark, words, "string", text.regex_position("x", "[0-9]+", position=7)) == [10, 0, None]
    assert column(spark, words, "string", text.regex_position("x", "ABC", flags="i")) == [1, 0, None]


def test_urls(spark):
    urls = [
        "www.google.co.uk?utm_source=google&utm_medium=cpc", "http://shop.example.com/2018/01/how-to/",
        "https://www.example.com/2018/01/01/blog", "android-app://m.example.com/",
        "docs.example.com/2021/01/01/index.js?utm_source=google", "http://shop.example.com/a/?utm_source=", None,
    ]
    assert column(spark, urls, "string", text.url_host("x")) == [
        "www.google.co.uk", "shop.example.com", "www.example.com", "m.example.com", "docs.example.com", "shop.example.com", None,
    ]
    assert column(spark, urls, "string", text.url_path("x"))[:3] == ["", "2018/01/how-to/", "2018/01/01/blog"]
    assert column(spark, urls, "string", text.url_parameter("x", "utm_source")) == ["google", None, None, None, "google", None, None]


def test_safe_arithmetic(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(numbers.safe_add("a", "b", "c")).collect()] == [6, 4, 2, 0]
    df = spark.createDataFrame([(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(numbers.safe_subtract("a", "b", "c")).collect()] == [0, 1, -2, 0]
    df = spark.createDataFrame([(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, 5)], "a int, b int")
    assert [r[0] for r in df.select(numbers.safe_divide("a", "b")).collect()] == [None, 2.0, None, None, None, 0.0]
    with pytest.raises(ValueError):
        numbers.safe_add()


def test_half_up(spark):
    assert column(spark, [313810.05 / 6, 2.675, -2.675, 1.005], "double", numbers.half_up("x", 2)) == [52301.68, 2.68, -2.68, 1.01]


def test_haversine(spark):
    place = [F.lit(v) for v in (48.864716, 2.349014, 52.379189, 4.899431)]
    miles, km = spark.range(1).select(numbers.haversine(*place), numbers.haversine(*place, unit="km")).first()
    assert (round(miles), round(km)) == (267, 430)
    with pytest.raises(ValueError):
        numbers.haversine(*place, unit="m")


def test_width_bucket(spark):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0]
    bucket = F.width_bucket("x", F.lit(200000.0), F.lit(600000.0), F.lit(4))
    assert column(spark, amounts, "double", bucket) == [0, 1, 2, 2, 3, 3, 4, 5]


def test_json(spark):
    payloads = ['{"a": 1, "b": {"c": 2}, "d": [1, 2], "e": "[x]"}', "broken", None]
    assert column(spark, payloads, "string", nested.json_scalar("x", "$.a")) == ["1", None, None]
    assert column(spark, payloads, "string", nested.json_scalar("x", "$.b")) == [None, None, None]
    assert column(spark, payloads, "string", nested.json_scalar("x", "$.d")) == [None, None, None]
    assert column(spark, payloads, "string", nested.json_scalar("x", "$.e")) == ["[x]", None, None]
    assert column(spark, payloads, "string", nested.json_array("x", "$.d")) == [["1", "2"], None, None]


def test_dates(spark):
    days = [dt.date(2020, 11, 29), dt.date(2020, 12, 1)]

    def each(expression):
        return column(spark, days, "date", expression)

    assert each(d.day_name("x", short=False)) == ["Sunday", "Tuesday"]
    assert each(d.day_name("x")) == ["Sun", "Tue"]
    assert each(d.day_of_week("x", iso=False)) == [1, 3]
    assert each(d.day_of_week("x")) == [7, 2]
    assert each(F.dayofyear("x")) == [334, 336]
    assert each(d.week_start("x")) == [dt.date(2020, 11, 29)] * 2
    assert each(d.week_end("x")) == [dt.date(2020, 12, 5)] * 2
    assert each(d.week_of_year("x")) == [48, 48]
    assert each(d.iso_week_start("x")) == [dt.date(2020, 11, 23), dt.date(2020, 11, 30)]
    assert each(d.iso_week_end("x")) == [dt.date(2020, 11, 29), dt.date(2020, 12, 6)]
    assert each(F.weekofyear("x")) == [48, 49]
    assert each(d.month_name("x", short=False)) == ["November", "December"]
    assert each(d.months_away("x", -1)) == [dt.date(2020, 10, 1), dt.date(2020, 11, 1)]
    assert each(d.period_end("x", "quarter")) == [dt.date(2020, 12, 31)] * 2
    assert each(d.periods_since("x", F.lit(dt.date(2021, 1, 1)), "month")) == [2, 1]
    assert column(spark, [1623076520], "long", d.from_epoch("x")) == [dt.datetime(2021, 6, 7, 14, 35, 20)]
    assert column(spark, [1623076520], "long", d.to_epoch(d.from_epoch("x"))) == [1623076520]


def test_zones_and_rounding(spark):
    moment = [dt.datetime(2021, 6, 7, 14, 35, 20)]
    assert column(spark, moment, "timestamp", d.convert_timezone("x", "America/Los_Angeles")) == [dt.datetime(2021, 6, 7, 7, 35, 20)]
    assert column(spark, moment, "timestamp", d.round_to_day("x")) == [dt.datetime(2021, 6, 8)]
    winter = [dt.datetime(2021, 1, 7, 2, 0)]
    assert column(spark, winter, "timestamp", d.today_in("America/Los_Angeles", "x")) == [dt.date(2021, 1, 6)]


def test_pivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    wide = aggregates.pivot(df, ["size"], "color", ["red", "blue", "blue's"], slugs=True)
    assert wide.columns == ["size", "red", "blue", "blues"]
    assert {tuple(r) for r in wide.collect()} == {("S", 1, 1, 1), ("M", 1, 0, 0)}
    most = aggregates.pivot(df, ["size"], "color", ["red"], agg="count", compare="!=", otherwise=None, prefix="not_")
    assert {tuple(r) for r in most.collect()} == {("S", 2), ("M", 0)}


def test_unpivot(spark):
    df = spark.createDataFrame(
        [(123, "active", "tier 1", True), (567, "churned", "tier 2", None)],
        "customer_id int, status string, segment string, is_updated boolean",
    )
    long = aggregates.unpivot(df, keep=["Customer_Id"], drop=["STATUS"], name="prop", value="val")
    assert {tuple(r) for r in long.collect()} == {
        (123, "segment", "tier 1"), (123, "is_updated", "true"), (567, "segment", "tier 2"), (567, "is_updated", None)
    }


def test_union_relations(spark):
    one = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e")], "id int, name string, favorite_number string")
    two = spark.createDataFrame([(1, "green", 7)], "id int, favorite_color string, favorite_number int")
    stacked = sets.union_relations({"one": one, "two": two}, column_override={"favorite_number": "string"})
    assert {tuple(r) for r in stacked.select("source_relation", "id", "name", "favorite_color", "favorite_number").collect()} == {
        ("one", 1, "drew", None, "pi"), ("one", 2, "bob", None, "e"), ("two", 1, None, "green", "7")
    }
    less = sets.union_relations({"one": one, "two": two}, {"favorite_number": "string"}, exclude=["NAME"], source_column=None, where="id = 1")
    assert sorted(less.columns) == ["favorite_color", "favorite_number", "id"] and less.count() == 2
    with pytest.raises(ValueError):
        sets.union_relations({"one": one}, include=["id"], exclude=["name"])


def test_tables_by_pattern(spark):
    for i in (1, 2, 3):
        spark.range(i).createOrReplaceTempView(f"daily_2018010{i}")
    found = sets.frames_like(spark, "daily_*", exclude="*03")
    assert sorted(found) == ["daily_20180101", "daily_20180102"]
    assert sets.union_relations(found).groupBy("source_relation").count().count() == 2


def test_deduplicate_and_clean(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    kept = ordered.first_per_group(df, ["user_id"], ["-version"])
    assert {tuple(r) for r in kept.collect()} == {(1, "play", 2), (2, "pause", 1)}
    blank = spark.createDataFrame([("a", "", 1), ("", "b", 2)], "f string, g string, n int")
    assert [tuple(r) for r in rows.blank_to_null(blank).collect()] == [("a", None, 1), (None, "b", 2)]
    assert rows.star(blank, drop=["F"], prefix="p_", suffix="_s").columns == ["p_g_s", "p_n_s"]
    assert rows.value_list(df, "event", 10) == ["play", "pause"]
    assert rows.value_list(df.filter("user_id > 5"), "event", 10, default=["x"]) == ["x"]
    with pytest.raises(ValueError):
        rows.value_list(df, "event", 1)


def test_spines(spark):
    spine = sets.date_spine(spark, F.lit("2018-01-01"), F.lit("2018-01-10"))
    assert [r[0].day for r in spine.orderBy("date_day").collect()] == list(range(1, 10))
    assert sets.date_spine(spark, F.lit("2018-01-05"), F.lit("2018-01-05")).count() == 0
    months = sets.date_spine(spark, F.lit("2018-01-15"), F.lit("2018-04-01"), "month")
    assert [r[0].month for r in months.orderBy("date_month").collect()] == [1, 2, 3]
    last = sets.base_dates(spark, last=3, as_of=F.lit(dt.date(2020, 1, 10)))
    assert [r[0].day for r in last.orderBy("date_day").collect()] == [7, 8, 9, 10]
    assert [r[0] for r in sets.series(spark, 4).collect()] == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        sets.series(spark, 0)


def test_fiscal_calendar(spark):
    days = sets.date_spine(spark, F.lit("2015-01-01"), F.lit("2024-12-31"))
    periods = calendar.fiscal_periods(calendar.date_dimension(days), year_end_month=1).cache()
    sizes = {r[0]: r[1] for r in periods.groupBy("fiscal_year_number").agg(F.max("fiscal_week_of_year")).collect()}
    assert sizes[2017] == 53 and sizes[2018] == 52  # the retail year 2017 has 53 weeks
    first = periods.groupBy("fiscal_year_number").agg(F.min("date_day")).collect()
    assert {r[0]: r[1] for r in first}[2018] == dt.date(2018, 2, 4)
    whole = periods.filter("fiscal_year_number = 2018").groupBy("fiscal_period_number").agg(F.count_distinct("fiscal_week_of_year"))
    assert [r[1] for r in whole.orderBy("fiscal_period_number").collect()] == [4, 5, 4] * 4
    last = periods.filter("fiscal_week_of_year = 53").first()
    assert (last.fiscal_period_number, last.fiscal_quarter_number, last.fiscal_week_of_period) == (12, 4, 5)


def test_sums_keep_small_and_large_amounts(spark):
    from larkspur.functions.numbers import exact_avg, exact_sum

    small = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert small.agg(exact_sum("x"), exact_avg("x")).first() == (4.0, 0.004)
    large = spark.createDataFrame([(2e16,), (1.5,)], "x double")
    assert large.agg(exact_sum("x")).first()[0] == 2e16 + 2
