"""Bucketed scans must equal one global window over the series."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tidewright.operators import features
from tidewright.operators.scan import (
    CutBuckets, FixedBuckets, balanced_buckets, grid_buckets, halo_window, nearest_known, row_position,
)

START = datetime(2024, 1, 1)


def series(spark, values, key="a", step=3600):
    rows = [(key, START + timedelta(seconds=i * step), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")


def sparse(n, every):
    return [float(i * i % 17) if i % every == 0 else None for i in range(n)]


@pytest.mark.parametrize("steps", [3, 7, 1000])
def test_halo_equals_global_window(spark, steps):
    df = series(spark, [float((i * 37) % 101) for i in range(60)]).unionByName(series(spark, [1.0, 2.0, 3.0], "b"))

    def build(w):
        return (
            features.lag_columns(w, ["v"], [0, 1, 5]) + features.lead_columns(w, ["v"], [1, 4])
            + features.moving_mean_columns(w, ["v"], [3, 12])
        )

    got = halo_window(df, ["k"], "ts", 3600, 12, 4, build, steps_per_bucket=steps)
    want = df.select("*", *build(Window.partitionBy("k").orderBy("ts")))
    assert got.count() == df.count()
    assert got.exceptAll(want.select(got.columns)).count() == 0


def test_moving_mean_equals_pandas(spark):
    values = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0]
    df = series(spark, values)
    got = halo_window(df, ["k"], "ts", 3600, 3, 0, lambda w: features.moving_mean_columns(w, ["v"], [3]), steps_per_bucket=4)
    want = pd.Series(values).rolling(3).mean().shift(1)
    shown = [r.v_ma3 for r in got.orderBy("ts").collect()]
    assert shown == [None if pd.isna(x) else pytest.approx(x) for x in want]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-5, 5).map(lambda x: round(x, 2))), min_size=1, max_size=40), st.integers(1, 9))
def test_nearest_known_equals_fill(spark, values, width):
    df = series(spark, values)
    out = nearest_known(df, ["k"], "ts", ["v"], FixedBuckets(3600 * width)).orderBy("ts").collect()
    s = pd.Series(values, dtype="float64")
    clean = lambda x: [None if pd.isna(v) else v for v in x]
    assert [r.v__pv for r in out] == clean(s.ffill())
    assert [r.v__nv for r in out] == clean(s.bfill())


def test_carry_crosses_many_empty_buckets(spark):
    df = series(spark, [7.0] + [None] * 50 + [9.0])
    out = nearest_known(df, ["k"], "ts", ["v"], FixedBuckets(7200)).collect()
    assert {r.v__pv for r in out} == {7.0, 9.0} and {r.v__nv for r in out} == {7.0, 9.0}


def test_row_position_equals_row_number(spark):
    rows = [("a" if i % 3 else "b", START + timedelta(minutes=(i * 97) % 500), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int")
    cuts = balanced_buckets(df, "ts", rows_per_bucket=40)
    assert len(cuts.cuts) >= 5
    got = row_position(df, ["k"], ["ts", "id"], cuts, name="i", total="n")
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = df.withColumn("i", F.row_number().over(w).cast("long")).withColumn("n", F.count("*").over(Window.partitionBy("k")))
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count()


def test_balanced_cuts_split_a_burst(spark):
    """A third of the rows within one minute still spreads over several buckets."""
    burst = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(START) + F.make_dt_interval(secs=(F.col("id") * 0.05).cast("decimal(18,6)")))
        .otherwise(F.lit(START) + F.make_dt_interval(mins=(F.col("id") * 7).cast("int"))).cast("timestamp_ntz").alias("ts")
    )
    buckets = balanced_buckets(burst, "ts", rows_per_bucket=300)
    largest = buckets.assign(burst, "ts").groupBy("__bucket").count().agg(F.max("count")).first()[0]
    assert largest <= 450


def test_small_input_is_cut_like_large(spark):
    assert balanced_buckets(series(spark, [1.0, 2.0, 3.0]), "ts").cuts


def test_bucket_rows_are_bounded_on_a_grid(spark):
    df = series(spark, [1.0] * 100)
    sizes = grid_buckets(3600, 10).assign(df, "ts").groupBy("__bucket").count().agg(F.max("count")).first()[0]
    assert sizes <= 10


def test_feature_matrix_rejects_holes(spark):
    df = series(spark, [float(i) for i in range(20)]).filter("v <> 7")
    spec = features.FeatureSpec(base=("v",), targets=("v",), lags=(1,), short_means=(2,), horizons=(1,))
    with pytest.raises(Exception, match="regular grid"):
        features.feature_matrix(df, ["k"], "ts", 3600, spec).collect()


def test_feature_count_of_the_full_matrix():
    rain = tuple(f"rain_{i}" for i in range(9))
    weather = ("hi_temp", "out_hum", "wind_speed", "vento_num", "bar")
    other = tuple(f"x{i}" for i in range(9))
    spec = features.FeatureSpec(base=weather + rain + other, lead_base=weather + rain, long_base=rain, targets=("x0", "x1", "x2"))
    assert len(spec.feature_names()) == 258 and len(set(spec.feature_names())) == 258
    assert (spec.before, spec.after) == (48, 5)
