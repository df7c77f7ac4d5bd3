from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewright.functions import cleaning, direction, timekeys


def values(spark, column, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


def test_compass_rounds_half_up_and_wraps(spark):
    got = values(spark, direction.compass_label(F.col("d")), [(0.0,), (11.25,), (56.25,), (90.0,), (348.75,), (360.0,), (-11.25,), (None,)], "d double")
    assert got == ["N", "NNE", "ENE", "E", "N", "N", "N", None]


def test_sector_rounds_half_even(spark):
    got = values(spark, direction.sector_number(F.col("d")), [(11.25,), (33.75,), (56.25,), (360.0,), (270.0,), (None,)], "d double")
    assert got == [0.0, 2.0, 2.0, 0.0, 12.0, None]


def test_flow_sign_keeps_ese_as_flood_and_null_as_null(spark):
    got = values(spark, direction.flow_sign(F.col("l")), [("E",), ("ESE",), ("se",), ("N",), (None,)], "l string")
    assert got == [-1, 1, -1, 1, None]


def test_sign_by_degrees_is_open_interval(spark):
    got = values(spark, direction.signed_by_degrees(F.lit(2.0), F.col("d")), [(90.0,), (90.1,), (269.9,), (270.0,), (None,)], "d double")
    assert got == [2.0, -2.0, -2.0, 2.0, 2.0]


def test_parse_unpadded_hours(spark):
    got = values(spark, timekeys.parse_date_hour(F.col("d"), F.col("h")), [("31/12/2024", "300"), ("01/02/2024", "0"), ("01/02/2024", "2300"), ("x", "0")], "d string, h string")
    assert got == [datetime(2024, 12, 31, 3), datetime(2024, 2, 1), datetime(2024, 2, 1, 23), None]


def test_zone_conversion_crosses_the_day(spark):
    got = values(spark, timekeys.utc_to_local(F.col("t").cast("timestamp_ntz"), "America/Sao_Paulo"), [("2024-06-02 02:00:00",)], "t string")
    assert got == [datetime(2024, 6, 1, 23)]


@pytest.mark.parametrize("late, minutes", [("01:30:59", 90), ("02:30:00", 150), ("00:59:59", 59)])
def test_minutes_truncate(spark, late, minutes):
    a, b = (F.lit(f"2024-01-01 {t}").cast("timestamp_ntz") for t in (late, "00:00:00"))
    assert values(spark, timekeys.minutes_between(a, b), [(1,)], "x int") == [minutes]


def test_keys(spark):
    t = F.lit("2024-01-01 10:05:07.25").cast("timestamp_ntz")
    got = spark.range(1).select(timekeys.hour_key(t), timekeys.five_minute_key(t), timekeys.floor_step(t, 900)).first()
    assert list(got) == [datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 5), datetime(2024, 1, 1, 10)]


def test_numbers_from_text(spark):
    rows = [("1,5",), ("x",), ("",), (None,), ("-2",)]
    assert values(spark, cleaning.comma_number(F.col("t")), rows, "t string") == [1.5, None, None, None, -2.0]
    assert values(spark, cleaning.zero_filled(F.col("t")), rows, "t string") == [0.0, 0.0, 0.0, 0.0, -2.0]


def test_finite_or_zero(spark):
    rows = [(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (3.5,)]
    assert values(spark, cleaning.finite_or_zero(F.col("v")), rows, "v double") == [0.0, 0.0, 0.0, 0.0, 3.5]


def test_percent_accuracy_guards_nulls_zero_and_sign(spark):
    rows = [(2.0, 1.5), (2.0, 9.0), (None, 1.0), (1.0, None), (0.0, 1.0), (-2.0, -1.5)]
    got = values(spark, cleaning.percent_accuracy(F.col("r"), F.col("p")), rows, "r double, p double")
    assert got == [75.0, 0.0, None, None, None, 75.0]


def test_rms(spark):
    got = values(spark, cleaning.root_mean_square(F.col("a"), F.col("b")), [(3.0, 4.0), (None, 1.0)], "a double, b double")
    assert got[0] == pytest.approx(12.5 ** 0.5) and got[1] is None
