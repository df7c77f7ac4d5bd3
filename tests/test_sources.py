import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewright.schemas import LIVE_COLUMNS, RAIN_CITIES, SENSOR_5MIN, STATION_HEADERS
from tidewright.session import scratch_path
from tidewright.sources import station_csv, tables, weather_json


def write_station(folder, name, lines):
    Path(folder).mkdir(parents=True, exist_ok=True)
    header = ";".join(STATION_HEADERS)
    (Path(folder) / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


def test_station_file(spark):
    folder = scratch_path(spark, "csv")
    fields = lambda day, hour, temp, rain: ";".join([day, hour, temp] + [""] * 15 + [rain])
    write_station(folder, "A802_20240101_20240630.csv", [
        fields("31/12/2023", "300", "21,5", "0,4"), fields("01/01/2024", "0", "", "0"), fields("01/01/2024", "100", "20", ""),
        "01/01/2024;200;broken", fields("01/01/2024", "2300", "nan", "1,2"), "lone", fields("32/01/2024", "100", "", "5"),
        fields("", "", "", ""), fields("01/01/2024", "300", "", "1") + ";more",
    ])
    rows = station_csv.station_rows(station_csv.read_station_text(spark, folder)).orderBy("dt_utc")
    got = [(r.estacao, r.dt_utc, r.hora_utc, r.temperatura_inst, r.chuva) for r in rows.collect()]
    assert got == [
        ("A802", datetime(2023, 12, 31, 3), "0300", 21.5, 0.4),
        ("A802", datetime(2024, 1, 1, 0), "0000", None, 0.0),
        ("A802", datetime(2024, 1, 1, 23), "2300", None, 1.2),
    ]
    assert station_csv.rainy_rows(rows.unionByName(rows)).count() == 2
    assert station_csv.read_station_text(spark, folder).select("Data").count() == 6
    assert station_csv.read_station_text(spark, folder).count() == 6
    rejected = station_csv.rejected_lines(spark, folder)
    assert rejected.count() == 5 and {(r.estacao, r.file_name) for r in rejected.collect()} == {("A802", "A802_20240101_20240630.csv")}
    assert sorted((r.reason, r.line) for r in rejected.collect()) == sorted([
        ("fields", "01/01/2024;200;broken"), ("fields", "lone"), ("fields", fields("01/01/2024", "300", "", "1") + ";more"),
        ("time", fields("32/01/2024", "100", "", "5")), ("time", fields("", "", "", ""))])


def test_current_weather_with_missing_parts(spark):
    full = {"name": "Rio Grande", "id": 7, "coord": {"lon": -52.1, "lat": -32.0}, "weather": [{"id": 800, "main": "Clear"}],
            "main": {"temp": 20.25, "humidity": 80}, "wind": {"speed": 3.5, "deg": 90}, "rain": {"1h": 0.3}, "dt": 1704067200}
    bare = {"name": "X", "weather": [], "main": {}}
    df = spark.createDataFrame([(json.dumps(full),), (json.dumps(bare),)], "payload string")
    a, b = sorted(weather_json.current_weather(df).collect(), key=lambda r: r.city)
    assert (a.city_id, float(a.main_temp), a.weather_main, float(a.rain_1h), a.dt) == (7, 20.25, "Clear", 0.3, datetime(2024, 1, 1))
    assert (b.main_temp, b.weather_main, b.rain_1h) == (None, None, None)


def test_forecast_list_and_air(spark):
    payload = {"cod": "200", "city": {"coord": {"lat": -32.0, "lon": -52.0}, "timezone": -10800},
               "list": [{"dt_txt": "2024-01-01 00:00:00", "main": {"temp": 1.0}, "rain": {"3h": 2.0}, "weather": [{"main": "Rain"}]},
                        {"dt_txt": "2024-01-01 03:00:00", "main": {"temp": 2.0}, "weather": []}]}
    df = spark.createDataFrame([("RG", json.dumps(payload))], "city_name string, payload string")
    a, b = sorted(weather_json.forecast_list(df).collect(), key=lambda r: r.dt_txt)
    assert (a.city_name, a.temp, a.rain_3h, a.lat, a.weather_main) == ("RG", 1.0, 2.0, -32.0, "Rain")
    assert (b.temp, b.rain_3h, b.weather_main, b.timestamp_utc) == (2.0, None, None, datetime(2024, 1, 1, 3))
    air = {"list": [{"dt": 1704067200, "main": {"aqi": 2}, "components": {"co": 201.5, "pm2_5": 3.1}}]}
    row = weather_json.air_quality(spark.createDataFrame([(json.dumps(air),)], "payload string")).first()
    assert (int(row.aqi), float(row.co), float(row.pm2_5), row.no2) == (2, 201.5, 3.1, None)


def test_rain_arrays_and_onecall(spark):
    rain = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "precipitation": [0.1]}}
    out = weather_json.hourly_rain(spark.createDataFrame([("C", json.dumps(rain))], "city string, payload string"))
    assert [(r.time.hour, r.precipitation) for r in out.orderBy("time").collect()] == [(0, 0.1), (1, None)]
    daily = {"daily": {"time": ["2024-01-01"], "precipitation_sum": [4.5]}}
    d = weather_json.daily_rain(spark.createDataFrame([(json.dumps(daily),)], "payload string")).first()
    assert (d.time, d.precipitation_sum) == (date(2024, 1, 1), 4.5)
    one = {"hourly": [{"dt": 1704067200, "wind_speed": 2.0, "feels_like": 19.0}]}
    h = weather_json.onecall_hours(spark.createDataFrame([(json.dumps(one),)], "payload string"), "America/Sao_Paulo").first()
    assert (h.datahora, h.wind_speed, h.hi_temp, h.bar) == (datetime(2023, 12, 31, 21), 2.0, 19.0, None)


def test_block_plans(spark):
    years = [tuple(r) for r in tables.year_blocks(spark, date(2020, 3, 1), date(2022, 1, 1)).orderBy("block_start").collect()]
    assert years == [(date(2020, 3, 1), date(2020, 12, 31)), (date(2021, 1, 1), date(2021, 12, 31))]
    bounds = spark.createDataFrame([(date(2024, 1, 1), date(2024, 12, 31))], "a date, b date")
    blocks = [(r.block_start, r.block_end) for r in tables.day_blocks(bounds, "a", "b").orderBy("block_start").collect()]
    assert blocks == [(date(2024, 1, 1), date(2024, 6, 30)), (date(2024, 7, 1), date(2024, 12, 29)), (date(2024, 12, 30), date(2024, 12, 31))]


def test_scans(spark):
    path = scratch_path(spark, "scan")
    spark.range(100).selectExpr("id", "cast(id as string) AS temp", "id * 2 AS spare").write.parquet(path)
    assert tables.scan(spark, path, ["id"]).columns == ["id"]
    assert tables.scan_mapped(spark, path, {"temp": ("t", "double")}).dtypes == [("t", "double")]
    assert [r.id for r in tables.latest_rows(tables.scan(spark, path), ["id"], 3).collect()] == [97, 98, 99]


def test_city_table_and_clocks(spark):
    cities = spark.createDataFrame([(n, *c) for n, c in RAIN_CITIES.items()], "city_name string, lat double, lon double")
    df = spark.createDataFrame([("RIO_GRANDE",), ("?",)], "city_name string")
    got = {r.city_name: r.lat for r in weather_json.attach_city(df, cities).collect()}
    assert got == {"RIO_GRANDE": -32.035, "?": None}
    local = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert weather_json.with_both_clocks(local, "t", "America/Sao_Paulo").first().timestamp_utc == datetime(2024, 1, 1, 3)
    assert len(SENSOR_5MIN.fields) > 45 and len(LIVE_COLUMNS) == 15


def test_day_scan_prunes_folders_and_row_groups(spark):
    from tidewright.sinks.maintain import write_days

    path = scratch_path(spark, "prune")
    hours = spark.range(72).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"), "id")
    write_days(hours, path, "ts")
    out = tables.scan_days(spark, path, "ts", F.lit("2024-01-02 06:00:00").cast("timestamp_ntz"), F.lit("2024-01-02 09:00:00").cast("timestamp_ntz"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 3 and "PartitionFilters: [isnotnull(dt" in plan and "GreaterThanOrEqual(ts" in plan
