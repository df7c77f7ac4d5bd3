import datetime as dt
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_scan import START
from tidewright.session import scratch_path
from tidewright.sinks.maintain import VersionedTable, complete_folders
from tidewright.streaming import flows

SCHEMA = "id int, k string, ts timestamp_ntz, v double"
at = lambda m: START + timedelta(minutes=m)


def land(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_updates_and_late_rows_reach_the_table(spark):
    folder = scratch_path(spark, "in")
    land(spark, folder, [(1, "a", at(1), 2.0), (2, "a", at(30), 4.0)])
    path = scratch_path(spark, "upsert")

    def run():
        stream = flows.event_time(spark.readStream.schema(SCHEMA).parquet(folder), "ts")
        flows.upsert_latest(flows.bucket_means(stream, ["k"], "ts", ["v"], "1 hour"), path, f"{path}/state").awaitTermination()
        return {(r.k, r.bucket): (r.v, r.n) for r in flows.latest_state(spark, path, ["k", "bucket"]).collect()}

    assert run() == {("a", at(0)): (3.0, 2)}
    land(spark, folder, [(3, "a", at(50), 6.0), (4, "a", at(70), 1.0)])
    assert run() == {("a", at(0)): (4.0, 3), ("a", at(60)): (1.0, 1)}


def test_duplicates_across_batches_are_dropped(spark):
    folder = scratch_path(spark, "in")
    land(spark, folder, [(1, "a", at(1), 2.0), (1, "a", at(1), 2.0)])
    path = scratch_path(spark, "dedupe")

    def run():
        stream = flows.event_time(spark.readStream.schema(SCHEMA).parquet(folder), "ts")
        flows.run_to_files(flows.first_per_key(stream, ["k", "ts"]), f"{path}/out", f"{path}/state").awaitTermination()
        return spark.read.schema("id int").parquet(f"{path}/out").count()

    assert run() == 1
    land(spark, folder, [(1, "a", at(1), 2.0), (2, "a", at(2), 2.0)])
    assert run() == 2


def test_freeze_across_batches(spark):
    folder, path = scratch_path(spark, "in"), scratch_path(spark, "freeze")
    schema = "target timestamp_ntz, run_at timestamp_ntz, value double"
    table = VersionedTable(spark, f"{path}/table")
    table.publish(flows.empty_forecasts(spark, "target"))

    def run(rows):
        land(spark, folder, rows, schema)
        stream = spark.readStream.schema(schema).parquet(folder)
        flows.freeze_forecasts(stream, table, "target", "value", "run_at", f"{path}/state").awaitTermination()
        r = table.read().first()
        return r.dynamic, r.frozen, r.updated_at

    assert run([(at(300), at(100), 1.0)]) == (1.0, None, at(100))
    assert run([(at(300), at(160), 2.0), (at(300), at(170), 3.0)]) == (3.0, 2.0, at(170))
    assert run([(at(300), at(180), 4.0)]) == (4.0, 2.0, at(180))
    assert run([(at(300), at(180), 4.0)]) == (4.0, 2.0, at(180))


def test_stream_stream_hour_join(spark):
    fine, hourly = scratch_path(spark, "fine"), scratch_path(spark, "hourly")
    land(spark, fine, [(1, "a", at(5), 1.0), (2, "a", at(65), 2.0), (3, "b", at(5), 3.0)])
    land(spark, hourly, [("a", at(0), 10.0), ("a", at(60), 20.0)], "k string, hts timestamp_ntz, h double")
    left = flows.event_time(spark.readStream.schema(SCHEMA).parquet(fine), "ts", "1 hour")
    right = flows.event_time(spark.readStream.schema("k string, hts timestamp_ntz, h double").parquet(hourly), "hts", "1 hour")
    out = flows.collected(spark, flows.join_hourly_stream(left, right, "ts", "hts", ["k"], how="inner").select("id", "h"), "join")
    assert sorted(map(tuple, out.collect())) == [(1, 10.0), (2, 20.0)]


def test_aged_hours_need_three_hours(spark):
    folder = scratch_path(spark, "in")
    land(spark, folder, [(1, "a", at(10), 2.0), (2, "a", at(100), 2.0), (3, "a", at(300), 2.0)])
    stream = flows.event_time(spark.readStream.schema(SCHEMA).parquet(folder), "ts", "3 hours")
    out = flows.collected(spark, flows.old_enough(stream, ["k"], "ts", ["v"]), "aged")
    assert [r.bucket for r in out.orderBy("bucket").collect()] == [at(0), at(60)]


def landing(spark, path, frames):
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def readings_of(spark, rows):
    return spark.createDataFrame([(i, dt.datetime.fromisoformat(t), v) for i, t, v in rows], "event_id long, ts timestamp_ntz, value double")


def test_late_and_repeated_rows_rebuild_only_their_days(spark, tmp_path):
    first = [(1, "2024-01-01 00:10", 1.0), (2, "2024-01-02 05:00", 2.0), (3, "2024-01-04 09:00", 4.0)]
    second = [(1, "2024-01-01 00:10", 1.0), (4, "2024-01-01 00:50", 3.0), (5, "2024-01-04 09:30", 6.0)]
    stream = landing(spark, str(tmp_path / "in"), [readings_of(spark, first), readings_of(spark, second)])
    out, days_built = str(tmp_path / "out"), []

    def build(rows):
        days_built.append(sorted(r.d for r in rows.selectExpr("CAST(CAST(ts AS date) AS string) AS d").distinct().collect()))
        return rows.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("bucket")).agg(F.sum("value").alias("value"), F.count("*").alias("n"))

    flows.rebuild_days(stream, out, f"{out}/state", ["event_id"], "ts", "bucket", build).awaitTermination()
    got = {(str(r.bucket), r.value, r.n) for r in spark.read.parquet(f"{out}/days").collect()}
    assert got == {("2024-01-01 00:00:00", 4.0, 2), ("2024-01-02 05:00:00", 2.0, 1), ("2024-01-04 09:00:00", 10.0, 2)}
    assert days_built == [["2024-01-01", "2024-01-02", "2024-01-04"], ["2024-01-01", "2024-01-04"]]
    assert [(r.batch, r.rows, r.late) for r in spark.read.parquet(f"{out}/log").orderBy("batch").collect()] == [(0, 3, 0), (1, 3, 2)]


def test_gap_between_two_batches_is_filled(spark, tmp_path):
    hours = [("2024-01-01 00:00", 3.0), ("2024-01-01 03:00", 4.0), ("2024-01-01 05:00", 1.0), ("2024-01-02 00:00", 1.0)]
    frames = [readings_of(spark, [(i, t, v)]).drop("event_id") for i, (t, v) in enumerate(hours)]
    out = str(tmp_path / "out")
    flows.fill_aged_gaps(landing(spark, str(tmp_path / "in"), frames), out, f"{out}/state", [], "ts", ["value"]).awaitTermination()
    rows = spark.read.parquet(f"{out}/rows").orderBy("ts").collect()
    assert [(r.ts.hour, round(r.value, 6), r.synthetic) for r in rows] == [
        (0, 3.0, False), (1, round(12.5 ** 0.5, 6), True), (2, round(12.5 ** 0.5, 6), True), (3, 4.0, False), (5, 1.0, False), (0, 1.0, False)]


def test_frozen_value_in_any_order_of_batches(spark, tmp_path):
    target = dt.datetime(2024, 1, 1, 12)
    runs = [(target, target - dt.timedelta(minutes=m), float(m)) for m in (149, 120, 95, 30, 400)]
    ddl, finals = "target timestamp_ntz, run_at timestamp_ntz, value double", set()
    for n, order in enumerate([(0, 1, 2, 3, 4), (4, 3, 2, 1, 0), (2, 0, 4, 1, 3)]):
        frames = [spark.createDataFrame([runs[i]], ddl) for i in order]
        path = str(tmp_path / str(n))
        table = VersionedTable(spark, f"{path}/table")
        table.publish(flows.empty_forecasts(spark, "target"))
        stream = landing(spark, f"{path}/in", frames)
        flows.freeze_forecasts(stream, table, "target", "value", "run_at", f"{path}/state").awaitTermination()
        finals.add(tuple(table.read().first()))
    assert finals == {(target, 30.0, 149.0, target - dt.timedelta(minutes=30), target - dt.timedelta(minutes=149))}


def test_folded_log_stays_short_and_survives_replay(spark):
    """Nine batches, folded every second one: log bounded, state whole, a repeated fold changes nothing, a torn one is ignored."""
    folder, path = scratch_path(spark, "in"), scratch_path(spark, "fold")
    for i in range(9):
        land(spark, folder, [(i, "ab"[i % 2], at(i), float(i)), (i + 100, f"k{i}", at(i), 1.0)])
    stream = flows.event_time(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder), "ts")
    sums = stream.groupBy("k").agg(F.sum("v").alias("v"))
    flows.upsert_latest(sums, path, f"{path}/state", keys=["k"], fold_every=2).awaitTermination()
    state = lambda: {r.k: r.v for r in flows.latest_state(spark, path, ["k"]).collect()}
    want = {"a": 20.0, "b": 16.0} | {f"k{i}": 1.0 for i in range(9)}
    assert state() == want
    folds, log = complete_folders(spark, f"{path}/folds", "upto="), complete_folders(spark, f"{path}/log", "batch=")
    assert len(folds) <= 2 and len(log) <= 4 and log[-1] >= 8
    flows.fold_log(spark, path, ["k"], folds[-1])
    spark.createDataFrame([("a", -1.0, 99)], "k string, v double, batch long").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/folds/upto=99")
    assert state() == want


def test_log_of_nothing(spark):
    with pytest.raises(FileNotFoundError):
        flows.latest_state(spark, scratch_path(spark, "none"), ["k"])
