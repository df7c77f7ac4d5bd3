"""Weather, air-quality and rain payloads: one JSON text per landed row.

Each function takes a frame with the payload in ``payload`` and passes the other
columns (city, collection time) through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewright import schemas
from tidewright.functions.timekeys import epoch_to_local, epoch_to_utc, local_to_utc


def _parsed(df: DataFrame, schema: T.StructType, payload: str) -> tuple[DataFrame, list[str]]:
    keep = [c for c in df.columns if c != payload]
    return df.select(*keep, F.from_json(payload, schema).alias("j")), keep


def _opened(df: DataFrame, schema: T.StructType, payload: str) -> tuple[DataFrame, list[str]]:
    """Top-level payload fields as columns, for readers that explode one of them.

    Going through a generator keeps it at one parse per payload; nested column
    pruning around ``explode`` would otherwise parse once per field used.
    """
    keep = [c for c in df.columns if c != payload]
    return df.select(*keep, F.inline(F.array(F.from_json(payload, schema)))), keep


def _paths(prefix: str, names: str, tag: str) -> list[Column]:
    return [F.col(f"{prefix}.`{n}`").alias(f"{tag}{n}") for n in names.split()]


def _first(array: str) -> Column:
    return F.get(F.col(array), 0)


def current_weather(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Flat row per current-weather object."""
    parsed, keep = _parsed(df, schemas.WEATHER_NOW_JSON, payload)
    w = _first("j.weather")
    return parsed.select(
        *keep,
        F.col("j.name").alias("city"), F.col("j.id").alias("city_id"),
        *_paths("j.coord", "lon lat", "coord_"),
        w["id"].alias("weather_id"), w["main"].alias("weather_main"),
        w["description"].alias("weather_description"), w["icon"].alias("weather_icon"),
        F.col("j.base").alias("base"),
        *_paths("j.main", "temp feels_like temp_min temp_max pressure humidity sea_level grnd_level", "main_"),
        F.col("j.visibility").alias("visibility"),
        *_paths("j.wind", "speed deg gust", "wind_"),
        F.col("j.clouds.all").alias("clouds_all"),
        *_paths("j.rain", "1h 3h", "rain_"),
        *_paths("j.snow", "1h 3h", "snow_"),
        epoch_to_utc(F.col("j.dt")).alias("dt"),
        *_paths("j.sys", "type id country", "sys_"),
        epoch_to_utc(F.col("j.sys.sunrise")).alias("sys_sunrise"),
        epoch_to_utc(F.col("j.sys.sunset")).alias("sys_sunset"),
        F.col("j.timezone").alias("timezone_offset"), F.col("j.cod").alias("cod"),
    )


def forecast_list(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per entry of the forecast list, parent fields repeated."""
    parsed, keep = _opened(df, schemas.WEATHER_FORECAST_JSON, payload)
    rows = parsed.select(*keep, "cod", "city", F.explode("list").alias("e"))
    w = _first("e.weather")
    return rows.select(
        *keep,
        F.try_to_timestamp("e.dt_txt").alias("timestamp_utc"),
        F.col("city.coord.lat").alias("lat"), F.col("city.coord.lon").alias("lon"),
        *_paths("e.main", "temp feels_like temp_min temp_max pressure sea_level grnd_level humidity", ""),
        w["id"].alias("weather_id"), w["main"].alias("weather_main"),
        w["description"].alias("weather_description"), w["icon"].alias("weather_icon"),
        F.col("e.clouds.all").alias("clouds_all"),
        *_paths("e.wind", "speed deg gust", "wind_"),
        F.col("e.visibility").alias("visibility"), F.col("e.pop").alias("pop"),
        F.col("e.rain.`3h`").alias("rain_3h"), F.col("e.snow.`3h`").alias("snow_3h"),
        F.col("e.sys.pod").alias("sys_pod"),
        F.col("city.timezone").alias("timezone"), F.col("cod"), F.col("e.dt_txt").alias("dt_txt"),
    )


def air_quality(df: DataFrame, payload: str = "payload") -> DataFrame:
    """First list entry of an air-quality payload."""
    parsed, keep = _parsed(df, schemas.AIR_QUALITY_JSON, payload)
    e = _first("j.list")
    return parsed.select(
        *keep,
        epoch_to_utc(e["dt"]).alias("timestamp_utc"),
        e["main"]["aqi"].alias("aqi"),
        *[e["components"][gas].alias(gas) for gas in schemas.AIR_GASES],
    )


def parallel_arrays(df: DataFrame, time: str, values: Sequence[str]) -> DataFrame:
    """Object of parallel arrays to rows; shorter arrays are padded with null."""
    keep = [c for c in df.columns if c not in (time, *values)]
    return df.select(*keep, F.inline(F.arrays_zip(time, *values)))


def hourly_rain(df: DataFrame, payload: str = "payload") -> DataFrame:
    parsed, keep = _opened(df, schemas.RAIN_ARRAYS_JSON, payload)
    flat = parsed.select(*keep, F.col("hourly.time").alias("time"), F.col("hourly.precipitation").alias("precipitation"))
    rows = parallel_arrays(flat, "time", ["precipitation"])
    return rows.withColumn("time", F.try_to_timestamp("time").cast("timestamp_ntz"))


def daily_rain(df: DataFrame, payload: str = "payload") -> DataFrame:
    parsed, keep = _opened(df, schemas.RAIN_DAILY_JSON, payload)
    flat = parsed.select(
        *keep, F.col("daily.time").alias("time"), F.col("daily.precipitation_sum").alias("precipitation_sum")
    )
    rows = parallel_arrays(flat, "time", ["precipitation_sum"])
    return rows.withColumn("time", F.col("time").try_cast("date"))


def onecall_hours(df: DataFrame, zone: str, payload: str = "payload") -> DataFrame:
    """Hourly outlook with epoch times turned into local wall time."""
    parsed, keep = _opened(df, schemas.ONECALL_JSON, payload)
    rows = parsed.select(*keep, F.inline("hourly"))
    return rows.select(
        *keep,
        epoch_to_local(F.col("dt"), zone).alias("datahora"),
        F.col("wind_speed"), F.col("wind_deg").alias("vento_num"), F.col("pressure").alias("bar"),
        F.col("humidity").alias("out_hum"), F.col("feels_like").alias("hi_temp"),
    )


def attach_city(df: DataFrame, cities: DataFrame, on: str = "city_name") -> DataFrame:
    """Coordinates from a city table instead of a geocoding call."""
    return df.join(cities, on, "left")


def with_both_clocks(df: DataFrame, local: str, zone: str, utc: str = "timestamp_utc") -> DataFrame:
    """Add the UTC instant of a local wall-clock column (one declared source zone)."""
    return df.withColumn(utc, local_to_utc(F.col(local), zone))
