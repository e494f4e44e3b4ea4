"""Streams against hand-made files: late rows, dead letters, repeats, restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larkspur.sources import tables, writers
from larkspur.streaming import events, sinks

SCHEMA = "hospital_id string, severity string, severity_score int, is_critical boolean, at timestamp"


def admission(hospital, severity, minute, second=0):
    at = dt.datetime(2024, 1, 1, 10, minute, second)
    return (hospital, severity, events.SEVERITY_SCORES[severity], severity == "CRITICAL", at)


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder):
    source = events.read_files(spark, f"{folder}/in", SCHEMA)
    stats = events.window_stats(source, "hospital_id", "at", late="2 minutes", surge_above=2)
    sinks.finish(sinks.updates_to(stats, f"{folder}/out", ["hospital_id", "window_start"], f"{folder}/state"))
    return {
        (r.hospital_id, r.window_start.minute): r
        for r in sinks.latest(spark, f"{folder}/out", ["hospital_id", "window_start"]).collect()
    }


def test_late_rows_correct_their_window(spark, tmp_path):
    folder = str(tmp_path)
    put(spark, f"{folder}/in", [admission("A", "LOW", 1), admission("A", "CRITICAL", 2), admission("B", "HIGH", 4)])
    first = run(spark, folder)
    assert (first["A", 0].total_admissions, first["A", 0].avg_severity_score, first["A", 0].is_surge) == (2, 2.5, False)
    put(spark, f"{folder}/in", [admission("A", "HIGH", 3), admission("A", "LOW", 6)])
    second = run(spark, folder)
    assert (second["A", 0].total_admissions, second["A", 0].critical_count, second["A", 0].high_count) == (3, 1, 1)
    assert second["A", 0].surge_reason == "3 admissions in window"
    assert second["A", 5].total_admissions == 1 and second["B", 0].total_admissions == 1
    put(spark, f"{folder}/in", [admission("A", "LOW", 30)])
    run(spark, folder)
    put(spark, f"{folder}/in", [admission("A", "LOW", 1)])  # far behind the watermark: dropped
    assert run(spark, folder)["A", 0].total_admissions == 3


def test_sliding_windows_overlap(spark):
    rows = spark.createDataFrame([admission("A", "LOW", 3, 30)], SCHEMA)
    stats = events.window_stats(rows, "hospital_id", "at", "3 minutes", "1 minute")
    assert sorted(r.window_start.minute for r in stats.collect()) == [1, 2, 3]


def test_report_texts(spark):
    rows = spark.createDataFrame([admission("A", "LOW", 3, 30)], SCHEMA)
    report = events.as_report(events.window_stats(rows, "hospital_id", "at"), "2024-01-01 11:00:00").first()
    assert (report.window_start, report.computed_at) == ("2024-01-01 10:00:00 UTC", "2024-01-01 11:00:00 UTC")


def test_sample_comes_from_the_first_event(spark):
    rows = spark.createDataFrame([admission("A", "LOW", 2), admission("A", "HIGH", 1)], SCHEMA)
    stats = events.window_stats(rows, "hospital_id", "at", sample=["severity"])
    assert stats.first().severity == "HIGH"


def test_parse_reasons(spark):
    texts = [
        '{"hospital_id": "H", "severity": "LOW"}', '{"hospital_id": "", "severity": "LOW"}', '{"hospital_id": "H"}', "nope", None,
    ]
    messages = spark.createDataFrame([(t,) for t in texts], "raw string")
    parsed = events.parse(messages, "hospital_id string, severity string")
    assert [r.error for r in parsed.collect()] == [None, "missing_hospital_id", "missing_severity", "parse_error", "parse_error"]
    assert events.valid(parsed).count() == 1
    assert events.dead_letters(parsed).columns == ["raw", "error"]


def test_enrich(spark):
    df = spark.createDataFrame([("p", "CRITICAL"), (None, "odd"), ("q", None)], "patient_id string, severity string")
    rows = events.enrich(df, "salt_", "v1").collect()
    assert [(r.severity_score, r.is_critical) for r in rows] == [(4, True), (1, False), (1, False)]
    assert all(len(r.patient_id_masked) == 10 for r in rows)


def test_prices(spark):
    df = spark.createDataFrame(
        [("a", 1.005, 2.0, 0.12345), ("b", 0.0, 1.0, 1.0), ("c", 5.0, None, 1.0), ("d", None, 1.0, 1.0)],
        "coin string, usd double, usd_24h_vol double, usd_24h_change double",
    ).withColumn("ingested_at", F.current_timestamp())
    kept = events.valid_prices(df, "s", "v").collect()
    assert [(r.coin, r.price_usd, r.change_24h_pct) for r in kept] == [("a", 1.01, 0.1235)]


KEYED = "id long, at timestamp, v int"


def put_versions(spark, folder, rows):
    made = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m) if m is not None else None, v) for i, m, v in rows]
    spark.createDataFrame(made, KEYED).coalesce(1).write.mode("append").parquet(folder)


def test_repeated_ids(spark, tmp_path):
    folder = str(tmp_path)
    for v, minute in ((1, 1), (2, 2), (3, 1)):
        put_versions(spark, f"{folder}/in", [(7, minute, v), (8 + v, minute, v)])
    once = events.dedupe(events.read_files(spark, f"{folder}/in", KEYED), "id", "at", "1 hour")
    sinks.finish(sinks.append_to(once, f"{folder}/once", f"{folder}/s2"))
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/once").collect()) == [7, 9, 10, 11]


@pytest.mark.parametrize("parts", [1, 3])
def test_newest_version_by_state(spark, tmp_path, parts):
    """Each batch gives out what is newer; state goes once the watermark has left it behind; old batches are not read."""
    folder = str(tmp_path)
    order, states = ["-at", "-v"], []

    def run(rows):
        put_versions(spark, f"{folder}/in", rows)
        stream = events.newest_per_key(events.read_files(spark, f"{folder}/in", KEYED), "id", "at", "v", "10 minutes", "1 hour", parts)
        query = sinks.updates_to(stream, f"{folder}/new", ["id"], f"{folder}/state", newest=order)
        sinks.finish(query)
        states.append(query.lastProgress.stateOperators[0].numRowsTotal)
        return {r.id: (r.at.hour * 60 + r.at.minute, r.v) for r in sinks.latest(spark, f"{folder}/new", ["id"], order).collect()}

    assert run([(1, 5, 1), (1, 9, 2), (1, 9, 1), (2, 3, 7), (None, 1, 1), (3, None, 1)]) == {1: (9, 2), 2: (3, 7), None: (1, 1)}
    assert run([(1, 8, 9), (2, 4, 1)]) == {1: (9, 2), 2: (4, 1), None: (1, 1)}  # an older version changes nothing
    found = run([(4, 200, 1)])  # all others are more than an hour behind
    assert found == {1: (9, 2), 2: (4, 1), None: (1, 1), 4: (200, 1)}
    assert states[1] >= 3 and states[2] == 1
    assert run([(1, 210, 5), (2, 5, 1)])[1] == (210, 5)  # forgotten, and taken up again; what the watermark has passed is left out
    assert run([]) == {1: (210, 5), 2: (4, 1), None: (1, 1), 4: (200, 1)}


def test_reading_does_not_grow_with_batches(spark, tmp_path):
    folder = str(tmp_path / "t")
    stored = tables.Stored(spark, folder, ["k"])
    sizes = []
    for i in range(24):
        assert stored.upsert(spark.createDataFrame([(k, i) for k in range(i % 5, 40, 5)], "k int, v int"), "s", i)
        sizes.append((len(stored.manifest()["runs"]), sum(r["rows"] for r in stored.manifest()["runs"])))
        want = {k: max(j for j in range(i + 1) if j % 5 == k % 5) for k in range(40) if any(j % 5 == k % 5 for j in range(i + 1))}
        assert {r.k: r.v for r in stored.read().collect()} == want
    assert max(n for n, _ in sizes) <= 4 and max(n for _, n in sizes) <= 80
    names = stored.files.names("log")
    assert len(names) == tables.KEPT and len(stored.files.names("data")) <= 4 * tables.KEPT


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    stored = tables.Stored(spark, str(tmp_path / "t"), ["k"])
    one = spark.createDataFrame([(1, 1)], "k int, v int")
    two = spark.createDataFrame([(1, 2)], "k int, v int")
    assert stored.upsert(one, "s", 0) and stored.upsert(two, "s", 1)
    before = stored.manifest()
    assert not stored.upsert(one, "s", 0) and not stored.upsert(one, "s", 1)
    assert stored.manifest() == before and [r.v for r in stored.read().collect()] == [2]
    assert stored.upsert(one, "other", 0) and [r.v for r in stored.read().collect()] == [1]


def test_a_writer_lost_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    stored = tables.Stored(spark, folder, ["k"])
    stored.replace(spark.createDataFrame([(1, 1), (2, 1)], "k int, v int"))

    def lost(*_):
        raise KeyboardInterrupt

    for change in (lambda s: s.replace(s.read().filter("k = 1")), lambda s: s.upsert(spark.createDataFrame([(2, 5)], "k int, v int"))):
        with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
            patch.setattr(tables.Files, "write_new", lost)
            change(stored)
        assert sorted(map(tuple, tables.Stored(spark, folder, ["k"]).read().collect())) == [(1, 1), (2, 1)]
    # a manifest that was cut short doesn't count either, and its number is not used again
    version = stored.manifest()["version"]
    stored.files.write_new(f"log/{version + 1:020d}.json", '{"version": ')
    assert stored.read().count() == 2
    stored.change(lambda rows: rows.filter("k = 2"))
    assert stored.manifest()["version"] == version + 2 and [r.k for r in stored.read().collect()] == [2]


def test_two_writers_are_told_apart(spark, tmp_path):
    folder = str(tmp_path / "t")
    a, b = tables.Stored(spark, folder), tables.Stored(spark, folder)
    a.replace(spark.range(3).toDF("k"))
    before = a.manifest()
    b.replace(spark.range(5).toDF("k"))
    with pytest.raises(RuntimeError):
        a._commit(before, before["runs"], spark.range(1).toDF("k").schema, {})
    assert a.read().count() == 5
    with pytest.raises(FileNotFoundError):
        tables.Stored(spark, str(tmp_path / "none")).read()


def test_routes_are_written_once(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(10).write.parquet(f"{folder}/in")
    routes = {f"{folder}/even": lambda df: df.filter("id % 2 = 0"), f"{folder}/odd": lambda df: df.filter("id % 2 = 1")}
    for _ in range(2):  # a restart finds nothing new
        stream = events.read_files(spark, f"{folder}/in", "id long")
        sinks.finish(sinks.route_to(stream, routes, f"{folder}/state"))
    assert sinks.stored_rows(spark, f"{folder}/even").count() == 5
    assert sinks.stored_rows(spark, f"{folder}/odd").count() == 5


def test_insert_needs_a_table(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(5).write.parquet(f"{folder}/in")
    stream = events.read_files(spark, f"{folder}/in", "id long")
    with pytest.raises(ValueError):
        sinks.insert_to(stream, "not_there", f"{folder}/state")
    writers.ensure_table(spark, "there", "id BIGINT", path=f"{folder}/rows")
    for _ in range(2):
        sinks.finish(sinks.insert_to(stream, "there", f"{folder}/state"))
    spark.catalog.refreshTable("there")
    assert spark.table("there").count() == 5
    spark.sql("DROP TABLE there")
