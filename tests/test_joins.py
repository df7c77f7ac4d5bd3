from datetime import datetime, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.test_scan import START
from tidewright.operators import joins, rollup, shaping
from tidewright.operators.scan import CutBuckets, balanced_buckets

at = lambda m: START + timedelta(minutes=m)


def brute(left, right, tolerance=None):
    out = []
    for key, t in left:
        best = None
        for rk, rt, v in sorted(right, key=lambda r: (r[1], r[2])):
            if rk == key and (tolerance is None or abs(rt - t) <= tolerance) and (best is None or abs(rt - t) < best[0]):
                best = (abs(rt - t), rt, v)
        out.append((key, at(t), best and at(best[1]), best and best[2]))
    return sorted(out, key=repr)


minutes = st.integers(0, 60)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), minutes), min_size=1, max_size=25),
       st.lists(st.tuples(st.sampled_from("ab"), minutes, st.integers(0, 3).map(float)), min_size=1, max_size=25),
       st.sampled_from([None, 4]))
def test_nearest_time_join_equals_brute_force(spark, left, right, tolerance):
    l = spark.createDataFrame([(k, at(t)) for k, t in left], "k string, ts timestamp_ntz")
    r = spark.createDataFrame([(k, at(t), v) for k, t, v in right], "k string, ts timestamp_ntz, v double")
    buckets = balanced_buckets(l.select("ts").unionByName(r.select("ts")), "ts", rows_per_bucket=6)
    out = joins.nearest_time_join(l, r, "ts", ["v"], buckets, ["k"], None if tolerance is None else tolerance * 60)
    got = sorted(((x.k, x.ts, x.matched_ts, x.v) for x in out.collect()), key=repr)
    assert got == brute(left, right, tolerance)


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_one_sided_join_equals_merge_asof(spark, direction):
    left = [(t,) for t in (0, 5, 9, 30, 59)]
    right = [(t, float(t)) for t in (2, 5, 8, 40)]
    l = spark.createDataFrame([(at(t),) for (t,) in left], "ts timestamp_ntz")
    r = spark.createDataFrame([(at(t), v) for t, v in right], "ts timestamp_ntz, v double")
    out = joins.nearest_time_join(l, r, "ts", ["v"], CutBuckets((1704067200e6 + 7 * 60e6,)), direction=direction)
    want = pd.merge_asof(pd.DataFrame(left, columns=["t"]), pd.DataFrame(right, columns=["t", "v"]), on="t", direction=direction)
    assert [x.v for x in out.orderBy("ts").collect()] == [None if pd.isna(v) else v for v in want.v]


def test_full_coverage_skips_null_keys(spark):
    a = spark.createDataFrame([(at(0), 1), (None, 2)], "ts timestamp_ntz, a int")
    b = spark.createDataFrame([(at(5), 3)], "ts timestamp_ntz, b int")
    out = joins.full_coverage_join([a, b], ["ts"]).orderBy("ts").collect()
    assert [(r.a, r.b) for r in out] == [(1, None), (None, 3)]


def test_spine_join_does_not_fan_out_after_latest_per_hour(spark):
    spine = spark.createDataFrame([(at(0),), (at(60),)], "ts_hour timestamp_ntz")
    dim = spark.createDataFrame([(at(3), 1), (at(40), 2)], "ts timestamp_ntz, v int")
    out = joins.spine_join(spine, [rollup.latest_per_hour(dim, [], "ts")], "ts_hour").orderBy("ts_hour").collect()
    assert [r.v for r in out] == [2, None]


def test_scalar_bound_is_a_subquery(spark):
    df = spark.createDataFrame([(at(i),) for i in range(10)], "ts timestamp_ntz")
    bound = df.filter(F.minute("ts") < 5).agg(F.max("ts"))
    assert joins.up_to_scalar(df, "ts", bound).count() == 5
    assert "Cartesian" not in joins.up_to_scalar(df, "ts", bound)._jdf.queryExecution().toString()


def test_combine_first_and_anti(spark):
    l = spark.createDataFrame([(1, 1.0), (2, None)], "k int, v double")
    r = spark.createDataFrame([(1, None), (2, 5.0), (3, 6.0)], "k int, v double")
    assert sorted((x.k, x.v) for x in joins.combine_first(l, r, ["k"], ["v"]).collect()) == [(1, 1.0), (2, 5.0)]
    assert [x.k for x in joins.new_keys_only(r, l, ["k"]).collect()] == [3]


def test_top_n_limits_each_group_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    out = rollup.top_n_per_key(df, ["k"], ["o"], 2)
    assert sorted(r.o for r in out.collect()) == [994, 995, 996, 997, 998, 999]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_rollup_skips_null_labels(spark):
    df = spark.createDataFrame([(at(1), 1.0, None), (at(2), 3.0, "x"), (at(3), None, "y")], "ts timestamp_ntz, v double, s string")
    row = rollup.rollup(df, [], "ts", ["v"], ["s"], last_instant="last").first()
    assert (row.v, row.s, row["last"]) == (2.0, "x", at(3))


def test_zero_sum_cancels_and_complete_cases(spark):
    df = spark.createDataFrame([(1.0, -1.0), (0.0, 0.0), (1.0, 2.0), (None, 3.0)], "a double, b double")
    assert shaping.drop_dead_rows(df, ["a", "b"]).count() == 2
    assert shaping.complete_cases(df).count() == 3


def test_numeric_columns_by_share(spark):
    rows = [("1", "a", 1), ("2.5", "3", 2), ("x", "b", 3), ("4", None, 4), ("5", None, 5)]
    df = spark.createDataFrame(rows, "mostly string, rarely string, id int")
    assert shaping.numeric_columns(df, exclude=["id"]) == ["mostly"]


def test_conform_and_required_columns(spark):
    df = spark.createDataFrame([("7", "x")], "a string, b string")
    from pyspark.sql import types as T

    out = shaping.conform(df, T.StructType([T.StructField("c", T.DateType()), T.StructField("a", T.LongType())]))
    assert out.columns == ["c", "a"] and out.first().a == 7
    with pytest.raises(ValueError):
        shaping.require_columns(df, ["a", "zz"])


def test_folds_take_one_shuffle_and_keep_null_keys_apart(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y"), (2, None)], "k int, a string")
    b = spark.createDataFrame([(1, 1.0), (3, 3.0), (None, 9.0)], "k int, b double")
    c = spark.createDataFrame([(3, True), (None, False)], "k int, c boolean")
    folded = joins.outer_fold([a, b, c], "k")
    want = [(1, "x", 1.0, None), (2, None, None, None), (3, None, 3.0, True), (None, "y", None, None), (None, None, 9.0, None), (None, None, None, False)]
    assert sorted(map(tuple, folded.collect()), key=repr) == sorted(want, key=repr)
    covered = joins.full_coverage_join([a, b, c], ["k"])
    assert sorted(map(tuple, covered.collect())) == sorted((w for w in want if w[0]), key=lambda w: w[0])
    for df in (folded, covered):
        assert df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError):
        joins.outer_fold([a, a], "k")
