from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewright.operators.rollup import collapse_runs, rollup
from tidewright.operators.shaping import stringify
from tidewright.session import scratch_path
from tidewright.sinks import maintain

NOW = datetime(2024, 1, 1, 10)
TABLE = "ts timestamp_ntz, dynamic double, frozen double, updated_at timestamp_ntz"
at = lambda m: NOW + timedelta(minutes=m)


def now(spark=None, minutes=0):
    return F.lit(at(minutes)).cast("timestamp_ntz")


def content(df):
    return {(r.ts - NOW).total_seconds() / 60: (r.dynamic, r.frozen, r.updated_at) for r in df.collect()}


def test_freeze_window_boundaries(spark):
    table = spark.createDataFrame([(at(120), 1.0, 0.5, at(-60)), (at(600), 9.0, None, at(-60))], TABLE)
    run = spark.createDataFrame([(at(m), float(m)) for m in (89, 90, 120, 150, 151)], "ts timestamp_ntz, v double")
    out = content(maintain.merge_freeze(table, run, "ts", "v", now()))
    assert out[89] == (89.0, None, NOW) and out[151] == (151.0, None, NOW)
    assert out[90] == (90.0, 90.0, NOW) and out[150] == (150.0, 150.0, NOW)
    assert out[120] == (120.0, 0.5, NOW)
    assert out[600] == (9.0, None, at(-60))


def test_freeze_twice_and_later_run_never_changes_the_frozen_value(spark):
    table = spark.createDataFrame([], TABLE)
    first = spark.createDataFrame([(at(120), 1.0)], "ts timestamp_ntz, v double")
    once = maintain.merge_freeze(table, first, "ts", "v", now())
    twice = maintain.merge_freeze(once, first, "ts", "v", now())
    assert content(once) == content(twice)
    later = spark.createDataFrame([(at(120), 2.0)], "ts timestamp_ntz, v double")
    assert content(maintain.merge_freeze(twice, later, "ts", "v", now(minutes=10)))[120] == (2.0, 1.0, at(10))


def test_update_from_takes_nulls_and_keeps_the_rest(spark):
    table = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, v double")
    source = spark.createDataFrame([(1, None), (3, 30.0), (4, 40.0)], "k int, w double")
    out = maintain.update_from(table, source, ["k"], {"v": "w"}, F.col("k") < 3)
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, None), (2, 2.0), (3, 3.0)]


def test_upsert_changes_one_column_and_inserts_whole_rows(spark):
    table = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b")], "k int, rain double, note string")
    rows = spark.createDataFrame([(2, 9.0, "zz"), (3, 7.0, "c")], "k int, rain double, note string")
    out = maintain.upsert_columns(table, rows, ["k"], ["rain"])
    assert sorted(map(tuple, out.collect())) == [(1, 1.0, "a"), (2, 9.0, "b"), (3, 7.0, "c")]


def test_merge_keep_first(spark):
    table = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, None)], "k int, d double, f double")
    rows = spark.createDataFrame([(1, 5.0, 5.0), (2, 6.0, 6.0), (3, 7.0, None)], "k int, d double, f double")
    out = maintain.merge_keep_first(table, rows, ["k"], ["d"], ["f"])
    assert sorted(map(tuple, out.collect())) == [(1, 5.0, 1.0), (2, 6.0, 6.0), (3, 7.0, None)]


def test_rolling_refresh_equals_full_rebuild(spark):
    raw = spark.range(400).select(
        (F.lit(NOW).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") * 13).cast("int"))).alias("ts"), (F.col("id") % 11).cast("double").alias("v")
    )
    early = raw.filter(F.col("ts") < F.lit(at(60 * 70)).cast("timestamp_ntz"))
    stored = rollup(early, [], "ts", ["v"])
    full = rollup(raw, [], "ts", ["v"])
    cutoff = maintain.cutoff_before_newest(early, "ts", 24)
    out = maintain.rolling_refresh(stored, full, "ts_hour", cutoff)
    assert out.exceptAll(full).count() == 0 and out.count() == full.count()


def test_refresh_drops_rows_without_time(spark):
    stored = spark.createDataFrame([(None, 1.0), (at(0), 2.0)], "ts timestamp_ntz, v double")
    out = maintain.rolling_refresh(stored, stored, "ts", now())
    assert [r.v for r in out.collect()] == [2.0]


def test_versioned_table_survives_a_dead_writer(spark):
    table = maintain.VersionedTable(spark, scratch_path(spark, "versions"))
    assert not table.exists()
    table.publish(spark.range(3))
    spark.range(99).write.parquet(f"{table.path}/v=1")
    import os

    os.remove(f"{table.path}/v=1/_SUCCESS")
    assert table.read().count() == 3
    assert table.publish(table.read().filter("id > 0")).count() == 2


def test_day_writer_replaces_only_its_days(spark):
    path = scratch_path(spark, "days")
    df = spark.createDataFrame([(at(0), 1), (at(60 * 24), 2)], "ts timestamp_ntz, v int")
    maintain.write_days(df, path, "ts")
    maintain.write_days(spark.createDataFrame([(at(60 * 24), 5)], "ts timestamp_ntz, v int"), path, "ts", files_per_day=2)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 5]


def test_tables_truncate_clone_view(spark):
    df = spark.createDataFrame([(at(0), 1)], "ts timestamp_ntz, v int")
    spark.sql("DROP TABLE IF EXISTS t_src"), spark.sql("DROP TABLE IF EXISTS t_copy")
    try:
        maintain.save_table(df, "t_src", "ts")
        maintain.clone_table(spark, "t_src", "t_copy")
        maintain.define_view(spark.table("t_copy"), "v_copy")
        maintain.truncate_table(spark, "t_src")
        assert spark.table("t_src").count() == 0 and spark.table("v_copy").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS t_src"), spark.sql("DROP TABLE IF EXISTS t_copy")


def test_append_overwrite_grow_and_migrate(spark):
    path = scratch_path(spark, "rows")
    maintain.overwrite_rows(spark.range(2), path)
    maintain.append_rows(spark.range(3), path)
    assert spark.read.parquet(path).count() == 5
    grown = maintain.grow_schema(spark.range(1).select("id"), spark.createDataFrame([(7, "x")], "id long, s string"))
    assert sorted(map(tuple, grown.collect())) == [(0, None), (7, "x")]
    wider = maintain.change_type(maintain.add_column(grown, "n", "double"), "s", "double")
    assert wider.dtypes == [("id", "bigint"), ("s", "double"), ("n", "double")]
    staged = maintain.stage_run(grown, "staged_run", {"target": ("id", "double")})
    assert staged.columns == ["target"] and spark.table("staged_run").count() == 2


def test_stringify_and_collapse(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert tuple(stringify(df).first()) == ("1", "")
    runs = spark.createDataFrame(
        [("t", 1, 5.0, None), ("t", 2, 6.0, 6.0), ("t", 3, 7.0, 7.0), ("u", 1, 4.0, None)], "t string, o int, v double, f double")
    out = {r.t: (r.dynamic, r["first"]) for r in collapse_runs(runs, "t", "o", "v", "f").collect()}
    assert out == {"t": (7.0, 6.0), "u": (4.0, 4.0)}


def test_merge_days_touches_only_the_days_of_the_run(spark):
    path = scratch_path(spark, "forecast_days")
    table = spark.createDataFrame([(at(120), 1.0, None, at(-60)), (at(60 * 48), 9.0, None, at(-60))], TABLE)
    maintain.write_days(table, path, "ts")
    import glob

    untouched = glob.glob(f"{path}/dt=2024-01-03/*.parquet")
    run = spark.createDataFrame([(at(120), 2.0), (at(60 * 24), 3.0)], "ts timestamp_ntz, v double")
    maintain.merge_days(spark, path, run, "ts", lambda t, r: maintain.merge_freeze(t, r, "ts", "v", now()))
    out = content(spark.read.parquet(path).select("ts", "dynamic", "frozen", "updated_at"))
    assert out == {120: (2.0, 2.0, NOW), 60 * 24: (3.0, None, NOW), 60 * 48: (9.0, None, at(-60))}
    assert untouched and glob.glob(f"{path}/dt=2024-01-03/*.parquet") == untouched
