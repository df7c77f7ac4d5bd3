"""Hourly and 5-minute master tables out of the landed sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions.timekeys import five_minute_key, hour_key, utc_to_local
from tidewright.operators.grid import replicate, rms_gap_rows
from tidewright.operators.joins import full_coverage_join, outer_fold, spine_join, up_to_scalar
from tidewright.operators.rollup import dedupe, hour_end, latest_per_hour, latest_two_aged, rollup, rollup_by_type
from tidewright.operators.scan import CutBuckets
from tidewright.operators.shaping import current_hour, drop_prefixed, gate_hourly, suffix_columns, union_unlike
from tidewright.schemas import AIR_GASES, SENSOR_LABELS, SENSOR_VALUES, STATION_VALUES

LOCAL_ZONE = "America/Sao_Paulo"
HOUR = "ts_hour"


def sensor_hours(sensor: DataFrame) -> DataFrame:
    """Mean readings and first labels per hour."""
    values = [c for c in SENSOR_VALUES if c in sensor.columns]
    labels = [c for c in SENSOR_LABELS if c in sensor.columns]
    rolled = rollup(drop_prefixed(sensor, "valid_"), [], "timestamp", values, labels, last_instant="timestamp")
    return rolled.withColumn("timestamp_end", hour_end(HOUR))


def station_hours(station: DataFrame, code: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """Newest station row per local hour, one row per hour."""
    mine = station.filter(F.col("estacao") == code).withColumn("inmet_datetime", utc_to_local(F.col("dt_utc"), zone))
    newest = latest_per_hour(mine, [], "inmet_datetime", ("timestamp_execucao",))
    values = [F.col(c).alias(f"{c}_inmet") for c in STATION_VALUES]
    return newest.select(HOUR, "inmet_datetime", *values, F.col("dt_utc").alias("dt_utc_inmet"))


def weather_hours(weather: DataFrame, city: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """Newest current-weather row per local hour, ``ow_`` prefixed."""
    mine = weather.filter(F.col("city") == city).withColumn(
        "openweather_timestamp", utc_to_local(F.col("timestamp_utc"), zone)
    )
    newest = latest_per_hour(mine, [], "openweather_timestamp", ("dt",))
    plain = [c for c in newest.columns if c not in (HOUR, "openweather_timestamp", "city", "timestamp_utc", "timestamp")]
    return newest.select(HOUR, "openweather_timestamp", *[F.col(c).alias(f"ow_{c.removeprefix('main_')}") for c in plain])


def run_hours(rows: DataFrame, city: str, prefix: str, stamp: str, limit: DataFrame, values: Sequence[str]) -> DataFrame:
    """Newest collector run per local hour, bounded by the last sensor hour."""
    mine = up_to_scalar(rows.filter(F.col("city_name") == city), "timestamp_execucao", limit)
    newest = latest_per_hour(mine, [], "timestamp_execucao", ("timestamp_utc",))
    return newest.select(
        HOUR, F.col("timestamp_execucao").alias(stamp), *[F.col(c).alias(f"{prefix}{c}") for c in values]
    )


def source_hours(
    sensor: DataFrame, station: DataFrame, weather: DataFrame, forecast: DataFrame, air: DataFrame,
    station_code: str = "A802", city: str = "Rio Grande",
) -> dict[str, DataFrame]:
    """Every source reduced to one row per local hour."""
    end_of_last_hour = hour_key(F.max("timestamp")) + F.expr("INTERVAL '59:59.999999' MINUTE TO SECOND")
    limit = sensor.agg(end_of_last_hour.alias("limit"))
    drop = {"timestamp_execucao", "city_name"}
    forecast_values = [c for c in forecast.columns if c not in drop]
    return {
        "sensor": sensor_hours(sensor),
        "station": station_hours(station, station_code),
        "weather": weather_hours(weather, city),
        "forecast": run_hours(forecast, city, "fc_", "forecast_timestamp_execucao", limit, forecast_values),
        "air": run_hours(air, city, "air_", "airpollution_timestamp_execucao", limit, ["aqi", *AIR_GASES]),
    }


def master_hour(hours: Mapping[str, DataFrame], full_coverage: bool = False) -> DataFrame:
    """Sensor hours (or every hour of any source) with all sources attached."""
    frames = [hours[n] for n in ("sensor", "station", "weather", "forecast", "air")]
    if full_coverage:
        joined = full_coverage_join(frames, [HOUR])
    else:
        joined = spine_join(frames[0], frames[1:], HOUR)
    return joined.withColumnRenamed(HOUR, "timestamp_br")


def master_5min(sensor: DataFrame, hours: Mapping[str, DataFrame]) -> DataFrame:
    """5-minute rows; the hourly sources show only on the full hour."""
    fine = drop_prefixed(sensor, "valid_")
    fine = fine.withColumn("timestamp_br", five_minute_key(F.col("timestamp"))).withColumn(HOUR, hour_key(F.col("timestamp")))
    sides = [hours[n] for n in ("station", "weather", "forecast", "air")]
    joined = spine_join(fine, sides, HOUR)
    gated = [c for side in sides for c in side.columns if c != HOUR]
    return gate_hourly(joined, "timestamp_br", gated).drop(HOUR)


def master_5min_mixed(
    sensor: DataFrame, weather: DataFrame, hours: Mapping[str, DataFrame], city: str = "Rio Grande",
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Current weather matched on the 5-minute bucket, the other sources on the hour.

    Weather is reduced to its newest row per bucket, so rows cannot multiply.
    """
    fine = drop_prefixed(sensor, "valid_")
    fine = fine.withColumn("timestamp_br", five_minute_key(F.col("timestamp"))).withColumn(HOUR, hour_key(F.col("timestamp")))
    local = weather.filter(F.col("city") == city).withColumn(
        "openweather_timestamp", utc_to_local(F.col("timestamp_utc"), zone)
    ).withColumn("timestamp_br", five_minute_key(F.col("openweather_timestamp")))
    values = [c for c in ("main_temp", "main_humidity", "wind_speed", "clouds_all", "weather_main", "weather_description") if c in local.columns]
    order = F.struct("openweather_timestamp", *values)
    bucketed = local.groupBy("timestamp_br").agg(
        F.max("openweather_timestamp").alias("openweather_timestamp"),
        *[F.max_by(c, order).alias(f"ow_{c.removeprefix('main_')}") for c in values],
    )
    joined = fine.join(bucketed, "timestamp_br", "left")
    return spine_join(joined, [hours[n] for n in ("station", "forecast", "air")], HOUR).drop(HOUR)


def stacked_5min(
    sensor: DataFrame, weather: DataFrame, forecast: DataFrame, air: DataFrame, station: DataFrame,
    now: Column, station_code: str = "A802",
) -> DataFrame:
    """All sources under each other: 5-minute feeds as they are, forecast and air of the running
    hour, station hours repeated every 5 minutes. Absent columns are null."""
    mine = station.filter(F.col("estacao") == station_code)
    fine_station = replicate(mine.withColumn("timestamp_utc", F.col("dt_utc")), "timestamp_utc", 300, 12)
    return union_unlike(
        drop_prefixed(sensor, "valid_"), weather,
        current_hour(forecast, "timestamp_utc", now), current_hour(air, "timestamp_utc", now), fine_station,
    )


def three_hour_gap_rows(
    master: DataFrame, keys: Sequence[str], ts: str, numeric: Sequence[str], now: Column, age_hours: int = 3
) -> DataFrame:
    """Synthetic rows between the two newest rows per key, once both are old enough; of repeated rows the greatest stands."""
    rest = [c for c in master.columns if c not in (*keys, ts)]
    single = dedupe(master, [*keys, ts], rest or [ts])
    return rms_gap_rows(latest_two_aged(single, keys, ts, now, age_hours), keys, ts, numeric, CutBuckets())


def merge_sources_by_type(frames: Mapping[str, DataFrame], ts: str = "timestamp_utc") -> DataFrame:
    """Any tables with a common time column: hour means by type, source tag as suffix, outer join."""
    tagged = [
        suffix_columns(rollup_by_type(drop_prefixed(df, "valid_"), [], ts, bucket=HOUR), tag, keep=[HOUR])
        for tag, df in frames.items()
    ]
    return outer_fold(tagged, HOUR)
