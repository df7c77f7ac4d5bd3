from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.test_scan import START, series
from tidewright.operators import grid
from tidewright.operators.scan import CutBuckets, FixedBuckets, grid_buckets

HOLES = [None, None, 1.0, None, 4.0, None, None, None, None, None, 16.0, 2.0, None, None, None]


@pytest.mark.parametrize("limit", [1, 2, 6, None])
@pytest.mark.parametrize("width", [2, 5, 100])
def test_interpolation_equals_pandas(spark, limit, width):
    df = series(spark, HOLES)
    got = grid.interpolate_linear(df, ["k"], "ts", ["v"], 3600, limit, 6, FixedBuckets(3600 * width))
    want = pd.Series(HOLES, dtype="float64").interpolate("linear", limit=limit, limit_direction="both").round(6)
    assert [r.v for r in got.orderBy("ts").collect()] == [None if pd.isna(x) else pytest.approx(x) for x in want]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-9, 9).map(float)), min_size=2, max_size=30))
def test_interpolation_keeps_known_points(spark, values):
    df = series(spark, values)
    got = grid.interpolate_linear(df, ["k"], "ts", ["v"], 3600, 2, None, FixedBuckets(3600 * 4))
    for before, after in zip(values, [r.v for r in got.orderBy("ts").collect()]):
        assert before is None or before == after


def test_grid_keeps_exact_hits_and_first_duplicate(spark):
    at = lambda m, s=0: START + timedelta(minutes=m, seconds=s)
    rows = [(at(1), 1, 9.0), (at(5), 2, 5.0), (at(5), 1, 4.0), (at(10, 7), 1, 8.0), (at(21), 1, 2.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, o int, v double")
    out = grid.regular_grid(df, [], "ts", 300, tie_break=["o"]).orderBy("ts").collect()
    assert [(r.ts.minute, r.v) for r in out] == [(0, None), (5, 4.0), (10, None), (15, None), (20, None)]


def test_grid_is_generated_in_chunks(spark):
    bounds = spark.createDataFrame([("a", START, START + timedelta(days=30))], "k string, lo timestamp_ntz, hi timestamp_ntz")
    out = grid.grid_instants(bounds, ["k"], "ts", 300)
    assert out.count() == 30 * 288 + 1 and out.distinct().count() == 30 * 288 + 1


def test_interpolate_onto_counts_rows_not_time(spark):
    at = lambda m: START + timedelta(minutes=m)
    instants = spark.createDataFrame([(at(m),) for m in (0, 5, 30, 35)], "ts timestamp_ntz")
    tide = spark.createDataFrame([(at(0), 0.0), (at(35), 3.0), (at(12), 99.0)], "ts timestamp_ntz, h double")
    out = grid.interpolate_onto(instants, tide, [], "ts", ["h"], grid_buckets(300, 2)).orderBy("ts").collect()
    assert [r.h for r in out] == [0.0, 1.0, 2.0, 3.0]


def test_local_cubic_reproduces_a_cubic(spark):
    curve = lambda x: 2 + x - 0.5 * x**2 + 0.1 * x**3
    values = [curve(i) if i not in (4, 5, 9) else None for i in range(14)]
    out = grid.interpolate_local(series(spark, values), ["k"], "ts", ["v"], 3600, 3, 6).orderBy("ts").collect()
    assert [r.v for r in out] == pytest.approx([round(curve(i), 6) for i in range(14)])


def test_local_quadratic_edges(spark):
    out = grid.interpolate_local(series(spark, [None, 1.0, None, 3.0, None]), ["k"], "ts", ["v"], 3600, 2).orderBy("ts").collect()
    assert [r.v for r in out] == [1.0, 1.0, 2.0, 3.0, 3.0]


def test_rms_rows_only_for_exact_three_hour_gaps(spark):
    at = lambda h: START + timedelta(hours=h)
    rows = [("x", at(0), 3.0, "a"), ("x", at(3), 4.0, "b"), ("x", at(5), 1.0, "c"), ("x", at(9), 1.0, "d"),
            ("x", at(12), None, "e"), ("y", at(0), 1.0, "f")]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double, label string")
    for buckets in (CutBuckets(), FixedBuckets(7200)):
        out = grid.rms_gap_rows(df, ["k"], "ts", ["v"], buckets).orderBy("ts").collect()
        assert [(r.ts, r.label, r.synthetic) for r in out] == [
            (at(1), "b", True), (at(2), "b", True), (at(10), "e", True), (at(11), "e", True)]
        assert out[0].v == pytest.approx(np.sqrt(12.5)) and out[2].v is None


def test_fill_gaps_default(spark):
    out = grid.fill_gaps(series(spark, [None, 2.0, None]), ["k"], "ts", ["v"], FixedBuckets(3600), backward_too=False, default=0.0)
    assert [r.v for r in out.orderBy("ts").collect()] == [0.0, 2.0, 2.0]


def test_replicate_to_hours_latest_wins(spark):
    at = lambda h: START + timedelta(hours=h)
    df = spark.createDataFrame([(at(0), 1.0), (at(2), 2.0)], "ts timestamp_ntz, v double")
    out = grid.replicate_to_hours(df, [], "ts").orderBy("ts").collect()
    assert [(r.ts.hour, r.v) for r in out] == [(0, 1.0), (1, 1.0), (2, 2.0), (3, 2.0), (4, 2.0)]


def test_extend_and_append(spark):
    df = series(spark, [1.0, 2.0]).drop("k")
    now = F.lit(START + timedelta(hours=5)).cast("timestamp_ntz")
    out = grid.extend_last_row(df, [], "ts", now).orderBy("ts").collect()
    assert [(r.ts.hour, r.v) for r in out] == [(0, 1.0), (1, 2.0), (5, 2.0)]
    again = grid.extend_last_row(df, [], "ts", F.lit(START).cast("timestamp_ntz"))
    assert again.count() == 2
