from datetime import date

from pyspark.sql import functions as F

from tidewright.operators.rollup import merged_profile, profile, profile_days

SCHEMA = "day date, a double, b string, c int, d boolean"
ROWS = [
    (date(2024, 1, 1), 0.0, "x", 0, True), (date(2024, 1, 1), -0.0, "0", 1, None), (date(2024, 1, 2), None, None, 2, False),
    (date(2024, 1, 2), 1.5, "x", None, True), (None, float("nan"), "", 0, True),
]
NAMES = ["a", "b", "c", "d"]


def as_dict(df):
    return {r.column_name: (r.row_count, r.null_count, r.zero_count, r.distinct_count, r.example, r.zero_pct) for r in df.collect()}


def test_both_forms_count_the_same(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    want = {
        "a": (5, 1, 2, 3, "0.0", 40.0), "b": (5, 1, 1, 3, "", 20.0),
        "c": (5, 1, 2, 3, "0", 40.0), "d": (5, 1, 0, 2, "false", 0.0),
    }
    assert as_dict(profile(df, NAMES)) == want
    assert as_dict(merged_profile(profile_days(df, NAMES, "day"))) == want


def test_days_can_be_added(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    first, rest = df.filter("day = date'2024-01-01'"), df.filter("day is null or day <> date'2024-01-01'")
    parts = profile_days(first, NAMES, "day").unionByName(profile_days(rest, NAMES, "day"))
    assert as_dict(merged_profile(parts)) == as_dict(profile(df, NAMES))


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert as_dict(profile(df, ["a"])) == {"a": (0, 0, 0, 0, None, None)}
    assert profile_days(df, NAMES, "day").count() == 0


def test_many_columns_share_one_aggregation(spark):
    """150 columns: per day one aggregation without expanded rows; the exact form has two, whatever the number of columns."""
    wide = spark.range(2000).select(
        (F.col("id") % 3).alias("day"), *[(F.col("id") % (i + 2)).alias(f"c{i}") for i in range(150)])
    names = [f"c{i}" for i in range(150)]
    days = profile_days(wide, names, "day")
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 1
    assert profile(wide, names)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    exact, near = as_dict(profile(wide, names)), as_dict(merged_profile(days))
    assert len(exact) == 150 and exact["c9"][:4] == (2000, 0, 182, 11)
    assert all(near[c][:3] == exact[c][:3] and abs(near[c][3] - exact[c][3]) <= 0.05 * exact[c][3] for c in names)
