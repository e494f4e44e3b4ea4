"""Order tables, history, routing, joins and layout on small inputs."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larkspur.operators import joins, layout, ordered, routing
from larkspur.plans import facilities, forecast, history, lineage, marts, orders, staging
from larkspur.session import TASK_BYTES, cut, tune
from larkspur.sources import readers, tables, writers


def order_frame(spark, rows):
    return spark.createDataFrame(rows, orders.ORDER_SCHEMA)


def cleaned(spark):
    return orders.clean(
        order_frame(
            spark,
            [
                (1, "C1", "lisbon", "Toys", 1, 60000.0, "2024-01-15", "completed"),
                (1, "C1", "lisbon", "Toys", 1, 60000.0, "2024-01-15", "completed"),
                (2, "C2", "Porto", "Toys", 3, 5000.0, "2024-06-15", None),
                (3, "C9", None, "Books", None, 10.0, "bad", "completed"),
                (None, "C1", "x", "Toys", 1, 1.0, "2024-01-15", "completed"),
            ],
        )
    )


def test_clean(spark):
    rows = {r.order_id: r for r in cleaned(spark).collect()}
    assert set(rows) == {1, 2, 3}
    assert (rows[1].city, rows[2].status, rows[3].quantity) == ("LISBON", "unknown", 0)
    assert rows[1].order_date == dt.date(2024, 1, 15) and rows[3].order_date is None


def test_enrich_and_reports(spark):
    rich = orders.enrich(cleaned(spark), "2024-07-01")
    rows = {r.order_id: r for r in rich.collect()}
    assert (rows[1].total_value, rows[1].is_high_value, rows[1].value_tier) == (60000.0, "YES", "Gold")
    assert (rows[2].value_tier, rows[2].order_month, rows[2].order_year, rows[2].days_since_order) == ("Silver", 6, 2024, 16)
    assert (rows[3].total_value, rows[3].is_high_value, rows[3].value_tier) == (0.0, "NO", "Bronze")
    assert sum(r.order_count for r in orders.by_tier(rich).collect()) == 2
    people = spark.createDataFrame([("C1", "A", "Premium")], "customer_id string, customer_name string, membership_tier string")
    best = orders.by_customer(orders.with_customers(rich, people)).collect()
    assert [tuple(r) for r in best] == [("C1", "A", "Premium", 1, 60000.0), ("C9", "Unknown", None, 1, 0.0)]


def test_total_keeps_small_prices(spark):
    one = orders.clean(order_frame(spark, [(1, "C", "x", "y", 6, 8266.095, "2024-01-01", "completed")]))
    assert orders.enrich(one, "2024-01-02").first().total_value == 49596.57


def test_anomalies(spark):
    rows = [
        ("1", "C1", "P1", "2", "-5", "2024-01-01 00:00:00"), ("2", " ", "P1", "2", "5.00", "2024-01-01 00:00:00"),
        ("3", "C1", "P2", "150", "0.00", "2024-01-01 00:00:00"), ("4", None, "P1", "x", "y", "2030-01-01 00:00:00"),
        ("5", "C1", "P1", "1", "1", "never"), ("5", "C1", "P1", "1", "1", "never"),
    ]
    names = "order_id string, customer_id string, product_id string, quantity string, order_amount string, order_timestamp string"
    found = orders.anomalies(spark.createDataFrame(rows, names), "2024-06-01 00:00:00")
    assert sorted((r.order_id, r.anomaly_type) for r in found.collect()) == [
        ("1", "NEGATIVE_AMOUNT"), ("2", "MISSING_CUSTOMER_ID"), ("3", "ZERO_AMOUNT_HIGH_QTY"), ("4", "FUTURE_TIMESTAMP"),
        ("4", "MISSING_CUSTOMER_ID"), ("5", "DUPLICATE_ORDER_ID"),
    ]
    texts = {r.anomaly_type: r.description for r in found.collect()}
    assert texts["NEGATIVE_AMOUNT"] == "Order ID 1 has a negative order amount of -5.00 INR with quantity 2. Customer ID C1."
    report = orders.stamp_run(found, "r1", "2024-06-01").unionByName(orders.stamp_run(found.limit(2), "r2", "2024-06-02"))
    kpis = orders.report_kpis(report).first()
    assert (kpis.findings, kpis.runs, kpis.types, kpis.latest) == (8, 2, 5, dt.datetime(2024, 6, 2))


def test_summary(spark):
    rows = [("a", "c", 3, 450.0, "completed"), ("b", "c", 1, 75.0, "cancelled"), ("d", None, 1, 1.0, "completed")]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, items int, unit_price double, status string")
    priced = orders.priced(df, processed_at=dt.datetime(2024, 1, 1))
    assert {r.order_id: (r.total_value, r.is_high_value, r.status, r.error) for r in priced.collect()} == {
        "a": (1350.0, True, "COMPLETED", None), "b": (75.0, False, "CANCELLED", None), "d": (1.0, False, "COMPLETED", "missing customer_id")
    }
    assert tuple(orders.summary(priced).first()) == (2, 1, 1, 1350.0, 1)
    assert tuple(orders.summary(priced.limit(0)).first()) == (0, 0, 0, 0.0, 0)


# --- history --------------------------------------------------------------------


def people(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, email string, name string, age int")


T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def versions(df):
    stamp = lambda v: v and v.month
    return sorted((r.customer_id, r.email, r.name, stamp(r.valid_from), stamp(r.valid_to)) for r in df.collect())


def test_snapshot(spark):
    first = history.first_snapshot(people(spark, [(1, "a", "x", 20), (2, "b", "y", 30), (3, None, "z", 70)]), "customer_id", T1)
    source = people(spark, [(1, "a2", "x", 20), (3, None, "renamed", 70), (4, "d", "w", 40)])
    second = history.snapshot(first, source, "customer_id", ["email"], T2)
    after = [
        (1, "a", "x", 1, 2), (1, "a2", "x", 2, None), (2, "b", "y", 1, 2), (3, None, "z", 1, None), (4, "d", "w", 2, None)
    ]
    assert versions(second) == sorted(after, key=lambda r: (r[0], r[1] or "", r[3]))
    again = history.snapshot(second, source, "customer_id", ["email"], T3)
    assert versions(again) == versions(second)
    kept = history.snapshot(first, source, "customer_id", ["email"], T2, hard_deletes=False)
    assert (2, "b", "y", 1, None) in versions(kept)
    back = history.snapshot(second, people(spark, [(2, "b", "y", 30)]), "customer_id", ["email"], T3)
    assert [v for v in versions(back) if v[0] == 2] == [(2, "b", "y", 1, 2), (2, "b", "y", 3, None)]


def test_dimension_and_increment(spark):
    first = history.first_snapshot(people(spark, [(1, "a", "x", 20), (2, "b", "y", 60)]), "customer_id", T1)
    stored = history.dimension(first)
    second = history.snapshot(first, people(spark, [(1, "a2", "x", 20), (2, "b", "y", 60)]), "customer_id", ["email"], T2)
    step = history.dimension_increment(second, stored)
    assert sorted((r.customer_id, r._version_num, r._is_current) for r in step.collect()) == [(1, 1, False), (1, 2, True)]
    merged = history.merge_increment(stored, step)
    whole = history.dimension(second)
    assert merged.select(whole.columns).exceptAll(whole).count() == 0 and merged.count() == whole.count()
    assert [r.customer_id for r in history.multi_version(merged).collect()] == [1, 1]
    assert {r.age_bucket for r in whole.collect()} == {"18-25", "56+"}
    now = history.current(second)
    assert sorted(map(tuple, now.select("customer_id", "email", "age_bucket").collect())) == sorted(map(tuple, whole.filter("_is_current").select("customer_id", "email", "age_bucket").collect()))


def test_stored_history_is_made_from_itself(spark, tmp_path, monkeypatch):
    stored = tables.Stored(spark, str(tmp_path / "history"))
    source, moved = people(spark, [(1, "a", "x", 20)]), people(spark, [(1, "b", "x", 20)])
    assert history.look(stored, source, "customer_id", ["email"], T1).count() == 1
    # lost between writing the new version and naming it: the old one stands, and the next look finds it
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(tables.Files, "write_new", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        history.look(stored, moved, "customer_id", ["email"], T2)
    assert [v.valid_to for v in stored.read().collect()] == [None]
    early = stored.read()
    assert history.look(stored, moved, "customer_id", ["email"], T2).count() == 2
    assert history.look(stored, moved, "customer_id", ["email"], T3).count() == 2
    assert early.count() == 1  # frames over an older version still work


def test_as_of_version_is_half_open(spark):
    vs = spark.createDataFrame(
        [(1, "old", 0, 10), (1, "new", 10, None)], "k int, city string, valid_from int, valid_to int"
    )
    facts = spark.createDataFrame([(1, 9), (1, 10), (2, 5)], "k int, at int")
    found = joins.as_of_version(facts, vs, "k", "at")
    assert sorted(((r.at, r.city) for r in found.collect())) == [(5, None), (9, "old"), (10, "new")]


# --- joins ------------------------------------------------------------------------


def test_not_in_follows_sql(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    cases = {"some": [(1,)], "with_null": [(1,), (None,)], "empty": []}
    for rows in cases.values():
        right = spark.createDataFrame(rows, "y int")
        left.createOrReplaceTempView("l"), right.createOrReplaceTempView("r")
        expected = spark.sql("SELECT x FROM l WHERE x NOT IN (SELECT y FROM r)")
        found = joins.not_in(left, "x", right, "y")
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_range_join(spark):
    points = spark.createDataFrame([(dt.date(2020, m, d),) for m in (1, 2, 3) for d in (1, 15, 28)], "day date")
    ranges = spark.createDataFrame(
        [("a", dt.date(2020, 1, 15), dt.date(2020, 3, 1)), ("b", dt.date(2020, 2, 1), dt.date(2020, 2, 1)), ("c", dt.date(2020, 3, 1), dt.date(2020, 1, 1))],
        "name string, lo date, hi date",
    )
    expected = points.join(ranges, F.col("day").between(F.col("lo"), F.col("hi")))
    for cells in (None, 1, 2, 40):
        found = joins.range_join(points, ranges, "day", "lo", "hi", cells)
        assert found.columns == ["day", "name", "lo", "hi"]
        assert sorted(map(tuple, found.select("day", "name").collect())) == sorted(map(tuple, expected.select("day", "name").collect()))
    assert joins.range_join(points.limit(0), ranges, "day", "lo", "hi").count() == 0


def test_range_join_with_open_ends(spark):
    points = spark.createDataFrame([(dt.date(2020, 1, d),) for d in range(1, 29)] + [(None,)], "day date")
    ranges = spark.createDataFrame([("open", dt.date(2020, 1, 10), dt.date(9999, 12, 31)), ("one", dt.date(2020, 1, 5), dt.date(2020, 1, 5)), ("none", None, dt.date(2020, 1, 5))], "name string, lo date, hi date")
    for cells in (None, 5):
        found = joins.range_join(points, ranges, "day", "lo", "hi", cells).groupBy("name").count()
        assert {r["name"]: r["count"] for r in found.collect()} == {"open": 19, "one": 1}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "decimal(20,3)", "bigint"])
def test_range_join_of_other_types(spark, kind):
    base = spark.range(400)
    value = lambda c: (F.timestamp_seconds(c * 7) if kind == "timestamp" else F.timestamp_seconds(c * 7).cast(kind) if "time" in kind else c.cast(kind))
    points = base.select(value(F.col("id") % 97).alias("x"), "id")
    ranges = base.limit(60).select(F.col("id").alias("r"), value(F.col("id")).alias("lo"), value(F.col("id") + F.col("id") % 5 - 1).alias("hi"))
    want = points.join(ranges, F.col("x").between(F.col("lo"), F.col("hi")))
    found = joins.range_join(points, ranges, "x", "lo", "hi", 12)
    assert found.exceptAll(want).count() == 0 and found.count() == want.count() > 0


def test_range_join_deals_out_a_busy_month(spark):
    """A third of the points in one month, half of those on one day: no task has more than twice the median."""
    day = F.when(F.col("id") % 6 == 0, F.lit(45)).when(F.col("id") % 6 == 1, 31 + F.col("id") % 28).otherwise(F.col("id") * 31 % 3650)
    points = spark.range(120_000).select(F.date_add(F.lit(dt.date(2020, 1, 1)), day.cast("int")).alias("day"))
    ranges = spark.range(500).select(F.col("id").alias("r"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") * 7).cast("int")).alias("lo")).withColumn("hi", F.date_add("lo", 6))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.range_join(points, ranges, "day", "lo", "hi")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == points.filter(F.col("day") < dt.date(2029, 8, 1)).join(ranges, F.col("day").between(F.col("lo"), F.col("hi"))).count()
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


# --- routing, layout, sources -------------------------------------------------------


def test_routes(spark):
    names = ", ".join(f"{f} string" for f in facilities.FIELDS)
    row = ["id", "n", "c", "TX", "z", "c", "Acute", "o", "Yes", "5", facilities.ABOVE, "Not Available", facilities.ABOVE]
    def with_(**changes):
        return tuple(changes.get(f, v) for f, v in zip(facilities.FIELDS, row))
    data = [with_(), with_(facility_id="", state="T1"), with_(mortality_comparison="?", overall_rating="x"), with_(hospital_type=None)]
    routed = facilities.routes(spark.createDataFrame(data, names), "salt_", "2024-01-01")
    alert, = routed["alerts"].collect()
    assert (alert.quality_tier, alert.risk_score, alert.has_emergency) == ("A", 16.67, True)
    calm, = routed["curated"].collect()
    assert (calm.quality_tier, calm.risk_score) == ("UNKNOWN", 33.33)
    assert sorted(r.validation_errors for r in routed["dead_letter"].collect()) == [
        "missing_facility_id, invalid_state:T1", "missing_hospital_type"
    ]


def test_facility_files_of_two_shapes(spark, tmp_path):
    head = "Facility ID,Facility Name,Address,City,State,Zip Code,County,Phone Number,Hospital Type,Ownership,Emergency Services,Overall Rating,Readmission Comparison,Patient Experience Comparison,Mortality Comparison"
    wide = f"{head}\n 1 ,Saint A,1 Road,Town, TX,1,C,555,Acute,Gov,Yes,4,x,y,z\nshort,line\n2,B,,,,,,,,,,,,,\n"
    (tmp_path / "wide.csv").write_text(wide)
    rows = facilities.read(spark, str(tmp_path / "wide.csv")).orderBy("facility_id").collect()
    assert [(r.facility_id, r.city, r.state, r.hospital_type) for r in rows] == [("1", "Town", "TX", "Acute"), ("2", "", "", "")]
    (tmp_path / "narrow.csv").write_text(",".join(facilities.FIELDS) + "\n1,Saint A,Town,TX,1,C,Acute,Gov,Yes,4,x,y,z\n")
    assert facilities.read(spark, str(tmp_path / "narrow.csv")).count() == 1
    with pytest.raises(ValueError):
        readers.delimited(spark, str(tmp_path / "narrow.csv"), ["nope"])


def test_group_apply_in_chunks(spark):
    import pandas as pd

    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k"))
    tally = lambda rows: pd.DataFrame({"k": rows["k"].iloc[:1], "n": [len(rows)], "s": [rows["id"].sum()]})
    merge = lambda parts: pd.DataFrame({"k": parts["k"].iloc[:1], "n": [parts["n"].sum()], "s": [parts["s"].sum()]})
    schema = "k string, n long, s long"
    whole = df.groupBy("k").applyInPandas(tally, schema)
    parts = routing.group_apply(df.repartition(7), ["k"], tally, schema, merge)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


def test_map_rows(spark):
    df = spark.createDataFrame([(1, 2), (None, 3)], "a int, b int")
    good, bad = routing.map_rows(df, {"c": F.col("a") + F.col("b")}, required=["a"])
    assert [tuple(r) for r in good.collect()] == [(1, 2, 3)]
    assert [r.validation_errors for r in bad.collect()] == ["missing_a"]
    everything, none = routing.map_rows(df, {"c": F.lit(1)})
    assert (everything.count(), none.count()) == (2, 0)


def test_skew_report(spark):
    df = spark.createDataFrame([("a",)] * 7 + [("b",)] * 3, "k string")
    assert {r.k: (r.n_rows, r.share_pct, r.is_skewed) for r in layout.skew_report(df, "k").collect()} == {
        "a": (7, 70.0, True), "b": (3, 30.0, False)
    }


def test_clustered_write_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("part"))
    writers.write_clustered(df, path, "part", "id")
    plan = spark.read.parquet(path).filter("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    writers.replace_partitions(df.filter("part = 1").limit(3), path, "part")
    assert spark.read.parquet(path).count() == 78
    with pytest.raises(RuntimeError):
        writers.read_back(spark, path, 1)


def test_each_file_has_its_own_header(spark, tmp_path):
    """Other columns, another order, the header's text as a record, quoted separators, empty and headless files."""
    files = {
        "a.csv": 'Key,Name,Brand\n1,"Anna, the first",x\nKey,Name,Brand\n2,short\n3,Cara,z,more\n4,"open,y\n',
        "b.csv": "Size,Brand,KEY,name\n9,w,5,Dora\n9,w,6\n,,,\n",
        "c.csv": "brand,Other Field,key,2nd,name\nv,o,7,2,Emil\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    rows = readers.delimited(spark, str(tmp_path), ["key", "name", "brand"])
    assert rows.columns == ["key", "name", "brand"]
    assert sorted(map(tuple, rows.collect())) == sorted([
        ("1", "Anna, the first", "x"), ("Key", "Name", "Brand"), ("3", "Cara", "z"), ("5", "Dora", "w"), ("", "", ""), ("7", "Emil", "v"),
    ])
    (tmp_path / "d.csv").write_text("key,brand\n1,x\n")
    with pytest.raises(ValueError, match="name.*d.csv"):
        readers.delimited(spark, str(tmp_path), ["key", "name", "brand"])


def test_headers_of_many_splits(spark, tmp_path):
    """A file in several splits has one header; its lines stay whole."""
    for part, names in (("x", "a,b"), ("y", "b,a")):
        (tmp_path / f"{part}.csv").write_text(names + "\n" + "".join(f"{i},{part}{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.delimited(spark, str(tmp_path), ["a", "b"]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, rows)) == sorted([(str(i), f"x{i}") for i in range(5000)] + [(f"y{i}", str(i)) for i in range(5000)])


def test_expired_folders_go_and_others_are_not_touched(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(30).select("id", F.when(F.col("id") < 28, F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))).alias("d"))
    writers.write_partitioned(days, path, "d")
    before = {p: (p.stat().st_mtime_ns, p.stat().st_ino) for p in (tmp_path / "t").rglob("*.parquet")}
    gone = writers.expire_partitions(spark, path, "d", F.lit("2024-01-30").cast("date"), 10)
    assert gone == [f"2024-01-{d:02}" for d in range(1, 20)]
    after = {p: (p.stat().st_mtime_ns, p.stat().st_ino) for p in (tmp_path / "t").rglob("*.parquet")}
    assert after == {p: s for p, s in before.items() if p in after} and len(after) == len(before) - 19
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [*range(19, 30)]  # those without a date stay
    assert writers.expire_partitions(spark, path, "d", F.lit("2024-01-30").cast("date"), 10) == []


def test_aggregate_kept_up_by_signed_rows(spark):
    draw = random.Random(11)
    schema, keys = "k int, x decimal(38,10), v double", ["k"]
    whole = [F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.min("v").alias("low"), F.max("v").alias("high")]
    made = lambda n: [(draw.choice([None, 1, 2, 3, 4]), Decimal(draw.randint(-50, 50)), draw.choice([None, float(draw.randint(0, 9))])) for _ in range(n)]
    rows = made(30)
    stored = cut(spark.createDataFrame(rows, schema).groupBy(*keys).agg(*whole))
    for step in range(5):
        came, went = made(6), draw.sample(rows, 9 if step < 3 else len(rows) - 2)
        for row in went:
            rows.remove(row)
        rows += came
        changes = spark.createDataFrame([(*r, 1) for r in came] + [(*r, -1) for r in went], schema + ", _sign int")
        source = spark.createDataFrame(rows, schema)
        stored = cut(writers.apply_changes(stored, changes, source, keys, {"s": "x"}, {"low": "v"}, {"high": "v"}))
        want = source.groupBy(*keys).agg(*whole)
        assert sorted(map(tuple, stored.select("k", "n", "s", "low", "high").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_only_touched_groups_are_read_again(spark, monkeypatch):
    """A source that knows only the groups whose extremes went is enough."""
    stored = spark.createDataFrame([(1, 2, 1.0, 9.0), (2, 2, 1.0, 9.0)], "k int, n long, low double, high double")
    changes = spark.createDataFrame([(1, 1.0, -1), (2, 5.0, -1), (2, 0.5, 1), (3, 4.0, 1)], "k int, v double, _sign int")
    source = spark.createDataFrame([(1, 9.0)], "k int, v double")
    found = writers.apply_changes(stored, changes, source, ["k"], {}, {"low": "v"}, {"high": "v"})
    assert sorted(map(tuple, found.select("k", "n", "low", "high").collect())) == [(1, 1, 9.0, 9.0), (2, 2, 0.5, 9.0), (3, 1, 4.0, 4.0)]


def test_stored_aggregate_and_merge(spark, tmp_path):
    src = spark.createDataFrame([(1, 10), (1, 5), (2, 7)], "d int, x int")
    totals = [F.sum("x").alias("s")]
    stored = writers.refresh_aggregate(None, src, ["d"], totals, "d")
    later = src.unionByName(spark.createDataFrame([(2, 1)], "d int, x int"))
    fresh = writers.refresh_aggregate(stored, later, ["d"], totals, "d", changed=[2])
    assert sorted(map(tuple, fresh.collect())) == [(1, 15), (2, 8)]
    kept = tables.Stored(spark, str(tmp_path / "m"))
    kept.replace(stored)
    writers.save_merged(kept, spark.createDataFrame([(2, 9), (3, 1)], "d int, s long"), ["d"])
    assert sorted(map(tuple, kept.read().collect())) == [(1, 15), (2, 9), (3, 1)]


def test_lineage_counts(spark, tmp_path):
    hop = lineage.Hop("t", "a", "b", "filter")
    hop.leaving(hop.entering(spark.range(10)).filter("id < 4")).write.parquet(str(tmp_path / "out"))
    row = hop.record(spark, "run", dt.datetime(2024, 1, 1)).first()
    assert (row.rows_in, row.rows_out, row.source_table) == (10, 4, "a")


# --- staging, marts, forecast ---------------------------------------------------------


def test_staged_products(spark):
    schema = (
        "product_id long, product_name string, category string, price double, cost_price double, stock_quantity long, supplier string, "
        "rating double, review_count long, is_available boolean, _ingested_at string, _source string, _batch_id string, _ingested_date string"
    )
    audit = ("2024-01-01", "s", "b", "2024-01-01")
    rows = [
        (1, " Lamp ", "home_decor", 10.0, 4.0, n, "s", 4.5, 3, True, *audit) for n in (0,)
    ] + [(2, "x", "a", 0.0, 1.0, 20, "s", 1.0, 1, True, *audit), (3, "x", "a", 3.0, 1.0, 200, "s", 1.0, 1, True, *audit), (4, "x", "a", 3.0, 1.0, 201, "s", 1.0, 1, True, *audit)]
    found = {r.product_id: r for r in staging.products(spark.createDataFrame(rows, schema)).collect()}
    assert (found[1].product_name, found[1].category_display, found[1].margin, found[1].margin_pct) == ("Lamp", "Home Decor", 6.0, 60.0)
    assert [found[i].stock_status for i in (1, 2, 3, 4)] == ["out_of_stock", "low_stock", "in_stock", "overstocked"]
    assert found[2].margin_pct is None


def test_sales_of_a_day_with_only_cancellations(spark):
    rows = [(dt.date(2024, 1, 1), 1, 1, 1, 10.0, 1, "cancelled", "upi", "toys")]
    sold = spark.createDataFrame(
        rows, "order_date date, order_id long, customer_id long, product_id long, total_amount double, quantity long, order_status string, payment_method string, product_category string"
    )
    catalogue = spark.createDataFrame([(2, "x")], "product_id long, category string")
    day = marts.sales_daily(sold, catalogue).first()
    assert (day.total_revenue, day.avg_order_value, day.cancellation_rate, day.top_category) == (0.0, 0.0, 100.0, None)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(2.0, 3.0), (4.0, 4.0), (0.0, 1.0), (None, 5.0)], "actual double, predicted double")
    m = forecast.regression_metrics(df).first()
    assert round(m.rmse, 6) == round((2 / 3) ** 0.5, 6) and round(m.mae, 6) == round(2 / 3, 6)
    assert round(m.r_squared, 6) == round(1 - (2 / 3) / (8 / 3), 6) and round(m.mape, 6) == 25.0


def test_stumps_against_plain_python(spark):
    draw = random.Random(4)
    rows = [(draw.choice([None, draw.random() * 10]), float(draw.randint(0, 5)), 1.0, draw.randint(0, 40)) for _ in range(300)]
    df = spark.createDataFrame([*rows, (1.0, 1.0, 1.0, None)], "a double, b double, c double, y int")
    model = forecast.train_stumps(df, ["a", "b", "c"], "y", rounds=5, bins=7)
    ends = [(min(v), max(v)) for v in ([r[i] for r in rows if r[i] is not None] for i in range(3))]

    def bin_of(x, i):
        low, high = ends[i]
        return 0 if x is None or high <= low else int(min(max((x - low) * 7 // (high - low), 0), 6))

    target = [r[3] * 1000 for r in rows]
    said = [sum(target) // len(rows)] * len(rows)
    binned = [[bin_of(r[i], i) for i in range(3)] for r in rows]
    splits = []
    for _ in range(5):
        best = None
        for f in range(3):
            for k in range(7):
                left = [t - p for t, p, b in zip(target, said, binned) if b[f] <= k]
                right = [t - p for t, p, b in zip(target, said, binned) if b[f] > k]
                if left and right and any(b[f] == k for b in binned):
                    gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right)
                    if best is None or gain > best[0]:
                        best = (gain, f, k, sum(left) * 3 // (len(left) * 10), sum(right) * 3 // (len(right) * 10))
        splits.append(best[1:])
        said = [p + (best[3] if b[best[1]] <= best[2] else best[4]) for p, b in zip(said, binned)]
    assert list(model.splits) == splits
    got = model.transform(df.limit(300)).select("prediction").collect()
    assert [round(r.prediction * 1000) for r in got] == said
    errors = lambda p: sum((t - x) ** 2 for t, x in zip(target, p))
    assert errors(said) < errors([sum(target) // len(rows)] * len(rows))
    assert forecast.train_stumps(df.filter("y > 99"), ["a"], "y").transform(df).select("prediction").first().prediction == 0


def test_marts_do_not_expand(spark):
    """Distinct things are counted as rows, not by a copy of every order or click per count."""
    orders = spark.createDataFrame([], "order_id long, product_id long, customer_id long, order_date date, order_status string, quantity long, total_amount double, unit_price double")
    clicks = spark.createDataFrame([], "event_date date, session_id string, user_id long, event_type string, device_type string")
    products = spark.createDataFrame([], "product_id long, product_sk string, product_name string, category string, category_display string, price double, cost_price double, margin double, "
        "margin_pct double, stock_quantity long, stock_status string, is_available boolean, supplier string, rating double, review_count long")  # fmt: skip
    seen = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(marts, "cut", lambda df: seen.append(df) or df)
        seen.append(marts.product_performance(products, orders))
    seen.append(marts.funnel(clicks, orders))
    assert len(seen) == 3
    for df in seen:
        assert "Expand" not in df._jdf.queryExecution().toString()


def test_split_is_repeatable(spark):
    df = spark.range(1000)
    sizes = [part.count() for part in forecast.split(df, ["id"])]
    assert sum(sizes) == 1000 and sizes == [part.count() for part in forecast.split(df.repartition(7), ["id"])]
    with pytest.raises(ValueError):
        forecast.require_trainable(
            df.select(F.col("id").alias("product_id"), F.current_date().alias("week_start"), F.lit("c").alias("category"), F.lit(None).cast("long").alias(forecast.TARGET))
        )


# --- marts in several tasks ------------------------------------------------------


def sold_rows(spark):
    rng = random.Random(8)
    rows = [
        (i, rng.randrange(25), rng.choice([None, *range(30)]), f"c{rng.randrange(3)}", 5.0 + i % 7, 1 + i % 4, 10.0 * rng.randrange(1, 9),
         rng.choice(["shipped", "cancelled"]), rng.choice(["upi", "cod", None]), dt.date(2024, 1, 1 + rng.randrange(20)))
        for i in range(150)
    ]
    return spark.createDataFrame(rows, "order_id long, product_id long, customer_id long, product_category string, unit_price double, quantity long, total_amount double, "
        "order_status string, payment_method string, order_date date")  # fmt: skip


def in_one_task_and_in_several(make):
    """The rows of ``make`` as a rule, and with tasks that hold few bytes; whether windows ran in segments then."""
    seen, plain = [], sorted(map(repr, make().collect()))
    segments = ordered.segments
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ordered, "BYTES_PER_TASK", 300, raising=False)
        patch.setattr(ordered, "segments", lambda *a, **k: seen.append(segments(*a, **k)) or seen[-1])
        spread = sorted(map(repr, make().collect()))
    return plain, spread, any(df is not None for df in seen)


def test_windows_hold_fewer_wide_rows(spark):
    narrow, wide = spark.range(1), spark.range(1).select(*[F.lit("x").alias(f"c{i}") for i in range(60)])
    assert ordered.rows_per_task(narrow, None) == ordered.ROWS_PER_TASK
    assert ordered.rows_per_task(wide, None) < ordered.ROWS_PER_TASK / 10 and ordered.rows_per_task(wide, 7) == 7


def test_product_ranks_in_several_tasks(spark):
    rows = [(i, f"s{i}", f"p{i}", None if i % 9 == 4 else f"c{i % 3}", "C", 5.0, 2.5, 2.5, 50.0, i, "low", True, "b", 0.1 * i, i) for i in range(40)]
    products = spark.createDataFrame(rows, "product_id long, product_sk string, product_name string, category string, category_display string, price double, cost_price double, margin double, "
        "margin_pct double, stock_quantity long, stock_status string, is_available boolean, supplier string, rating double, review_count long")  # fmt: skip
    plain, spread, several = in_one_task_and_in_several(lambda: marts.product_performance(products, sold_rows(spark)))
    assert len(plain) == 40 and plain == spread and several


def test_customer_quintiles_in_several_tasks(spark):
    customers = spark.range(40).select(F.col("id").alias("customer_id"), F.concat(F.lit("n"), "id").alias("full_name"))
    plain, spread, several = in_one_task_and_in_several(lambda: marts.customer_ltv(customers, sold_rows(spark), "2024-03-01"))
    assert len(plain) == 40 and plain == spread and several


@pytest.mark.parametrize("asked, left", [("64MB", str(TASK_BYTES)), ("67108864b", str(TASK_BYTES)), ("1g", str(TASK_BYTES)), ("8m", "8m"), ("1000", "1000")])
def test_tasks_of_a_shuffle_are_bounded(spark, asked, left):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    try:
        spark.conf.set(name, asked)
        assert tune(spark).conf.get(name) == left
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
