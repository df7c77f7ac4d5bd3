"""The composed jobs of ``plans/`` over sources shaped out of ``events``.

click is the sensor, error the station, purchase the current weather, signup the forecast runs and
view the air quality; UTC stamps lie three hours ahead of the local wall time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import R, instant, query, readings, shown
from tidewright.operators.rollup import dedupe
from tidewright.plans import master, treated
from tidewright.schemas import AIR_GASES, STATION_VALUES

_CITY, _CODE = "Rio Grande", "A802"
_NOW, _SINCE, _CUTOFF = "2024-01-16 12:30:00", "2024-01-10 06:00:00", "2024-01-16 00:00:00"


def _sources(spark, sf):
    """(sensor, station, weather, forecast, air) in the shapes the jobs read."""
    rows = readings(spark, sf)
    utc = (F.col("ts").cast("timestamp") + F.expr("INTERVAL 3 HOURS"))
    of = lambda source, *columns: rows.filter(F.col("source") == source).select(*columns)
    given = {"chuva": F.col("value"), "vento_dir_deg": F.col("degrees")}
    sensor = of("click", "event_id", F.col("ts").alias("timestamp"), F.col("value").alias("umidade"), F.col("degrees").alias("direcao_3m"),
                (F.col("user_id") % 7).cast("double").alias("intensidade_3m"), F.concat(F.lit("s"), "user_id").alias("status"),
                F.lit(1).alias("valid_umidade"))
    station = of("error", F.when(F.col("user_id") % 10 == 0, "B000").otherwise(_CODE).alias("estacao"), utc.alias("dt_utc"),
                 *[given.get(v, F.lit(None).cast("double")).alias(v) for v in STATION_VALUES], utc.alias("timestamp_execucao"))
    weather = of("purchase", F.when(F.col("user_id") % 10 == 0, "Pelotas").otherwise(_CITY).alias("city"), utc.alias("timestamp_utc"),
                 F.col("value").alias("main_temp"), utc.alias("dt"))
    run = [F.lit(_CITY).alias("city_name"), F.col("ts").alias("timestamp_execucao"), utc.alias("timestamp_utc")]
    forecast = of("signup", *run, F.col("value").alias("temp"))
    air = of("view", *run, (F.col("user_id") % 5).cast("double").alias("aqi"), *[F.col("value").alias(g) for g in AIR_GASES])
    return sensor, station, weather, forecast, air


_HOURS = R + """, lim AS (SELECT date_trunc('hour', max(ts)) + INTERVAL 1 HOUR AS hi FROM r WHERE source = 'click'),
sensor AS (SELECT date_trunc('hour', ts) AS t, round(avg(value), 8) AS umidade, round(avg(user_id % 7), 8) AS intensidade_3m,
  round(avg(degrees), 8) AS direcao_3m, 's' || arg_min(user_id, ts) AS status FROM r WHERE source = 'click' GROUP BY 1),
station AS (SELECT date_trunc('hour', ts) AS t, arg_max(value, ts) AS chuva_inmet, arg_max(degrees, ts) AS vento_dir_deg_inmet
  FROM r WHERE source = 'error' AND user_id % 10 <> 0 GROUP BY 1),
weather AS (SELECT date_trunc('hour', ts) AS t, arg_max(value, ts) AS ow_temp FROM r WHERE source = 'purchase' AND user_id % 10 <> 0 GROUP BY 1),
forecast AS (SELECT date_trunc('hour', ts) AS t, arg_max(value, ts) AS fc_temp FROM r, lim WHERE source = 'signup' AND ts < hi GROUP BY 1),
air AS (SELECT date_trunc('hour', ts) AS t, CAST(arg_max(user_id % 5, ts) AS DOUBLE) AS air_aqi, arg_max(value, ts) AS air_co
  FROM r, lim WHERE source = 'view' AND ts < hi GROUP BY 1)"""
_SHOWN = "t AS timestamp_br, umidade, intensidade_3m, direcao_3m, status, chuva_inmet, vento_dir_deg_inmet, ow_temp, fc_temp, air_aqi, air_co"
_HOUR_COLUMNS = ["timestamp_br", *_SHOWN.split(", ")[1:]]


def _master_hour(spark, sf, full):
    out = master.master_hour(master.source_hours(*_sources(spark, sf), _CODE, _CITY), full)
    return shown(out.select(*_HOUR_COLUMNS), ["umidade", "intensidade_3m", "direcao_3m"])


@query("job_master_hour", f"""WITH {_HOURS} SELECT {_SHOWN} FROM sensor LEFT JOIN station USING (t) LEFT JOIN weather USING (t)
LEFT JOIN forecast USING (t) LEFT JOIN air USING (t)""")
def job_master_hour(spark, sf):
    return _master_hour(spark, sf, False)


@query("job_master_hour_full", f"""WITH {_HOURS} SELECT {_SHOWN} FROM sensor FULL JOIN station USING (t) FULL JOIN weather USING (t)
FULL JOIN forecast USING (t) FULL JOIN air USING (t)""")
def job_master_hour_full(spark, sf):
    return _master_hour(spark, sf, True)


def _master_5min(spark, sf):
    sources = _sources(spark, sf)
    return master.master_5min(sources[0], master.source_hours(*sources, _CODE, _CITY))


_GATED = ("chuva_inmet", "ow_temp", "fc_temp", "air_aqi")


@query("job_master_5min", f"""WITH {_HOURS}, fine AS (
  SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS timestamp_br, date_trunc('hour', ts) AS t, value AS umidade FROM r WHERE source = 'click')
SELECT event_id, timestamp_br, fine.umidade, {", ".join(f"CASE WHEN minute(timestamp_br) = 0 THEN {c} END AS {c}" for c in _GATED)}
FROM fine LEFT JOIN station USING (t) LEFT JOIN weather USING (t) LEFT JOIN forecast USING (t) LEFT JOIN air USING (t)""")
def job_master_5min(spark, sf):
    return _master_5min(spark, sf).select("event_id", "timestamp_br", "umidade", *_GATED)


@query("job_master_5min_mixed", f"""WITH {_HOURS}, fine AS (
  SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS timestamp_br, date_trunc('hour', ts) AS t, value AS umidade FROM r WHERE source = 'click'),
near AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS timestamp_br, max(ts) AS openweather_timestamp, arg_max(value, ts) AS ow_temp
  FROM r WHERE source = 'purchase' AND user_id % 10 <> 0 GROUP BY 1)
SELECT event_id, timestamp_br, fine.umidade, openweather_timestamp, near.ow_temp, chuva_inmet, fc_temp, air_aqi
FROM fine LEFT JOIN near USING (timestamp_br) LEFT JOIN station USING (t) LEFT JOIN forecast USING (t) LEFT JOIN air USING (t)""")
def job_master_5min_mixed(spark, sf):
    """Weather on the 5-minute bucket, the other sources on the hour."""
    sources = _sources(spark, sf)
    out = master.master_5min_mixed(sources[0], sources[2], master.source_hours(*sources, _CODE, _CITY), _CITY)
    return out.select("event_id", "timestamp_br", "umidade", "openweather_timestamp", "ow_temp", "chuva_inmet", "fc_temp", "air_aqi")


@query("job_stacked_5min", f"""WITH {R}, u AS (SELECT *, ts + INTERVAL 3 HOUR AS t FROM r),
running AS (SELECT * FROM u WHERE t >= date_trunc('hour', TIMESTAMP '{_NOW}') AND t < date_trunc('hour', TIMESTAMP '{_NOW}') + INTERVAL 1 HOUR)
SELECT event_id, CAST(NULL AS TIMESTAMP) AS timestamp_utc, value AS umidade, CAST(NULL AS DOUBLE) AS main_temp, CAST(NULL AS DOUBLE) AS temp,
       CAST(NULL AS DOUBLE) AS aqi, CAST(NULL AS DOUBLE) AS chuva FROM u WHERE source = 'click'
UNION ALL SELECT NULL, t, NULL, value, NULL, NULL, NULL FROM u WHERE source = 'purchase'
UNION ALL SELECT NULL, t, NULL, NULL, value, NULL, NULL FROM running WHERE source = 'signup'
UNION ALL SELECT NULL, t, NULL, NULL, NULL, user_id % 5, NULL FROM running WHERE source = 'view'
UNION ALL SELECT NULL, t + INTERVAL 5 MINUTE * k, NULL, NULL, NULL, NULL, value FROM u, range(12) AS s(k) WHERE source = 'error' AND user_id % 10 <> 0""")
def job_stacked_5min(spark, sf):
    sensor, station, weather, forecast, air = _sources(spark, sf)
    out = master.stacked_5min(sensor, weather, forecast, air, station, instant(_NOW), _CODE)
    return out.select("event_id", F.col("timestamp_utc").cast("timestamp_ntz").alias("timestamp_utc"), "umidade", "main_temp", "temp", "aqi", "chuva")


def _filled(table, seconds, limit, columns):
    """SQL of ``columns`` of ``table`` (t, columns) on its grid, filled linearly within ``limit`` steps."""
    parts, done = [], []
    for c in columns:
        at = f"CASE WHEN {c} IS NOT NULL THEN x END"
        parts.append(f"last_value({c} IGNORE NULLS) OVER p AS {c}_pv, first_value({c} IGNORE NULLS) OVER n AS {c}_nv, "
                     f"last_value({at} IGNORE NULLS) OVER p AS {c}_px, first_value({at} IGNORE NULLS) OVER n AS {c}_nx")
        done.append(f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN NOT coalesce(x - {c}_px <= {limit}, false) AND NOT coalesce({c}_nx - x <= {limit}, false) THEN NULL
          WHEN {c}_pv IS NULL THEN {c}_nv WHEN {c}_nv IS NULL THEN {c}_pv
          ELSE round({c}_pv + ({c}_nv - {c}_pv) * (x - {c}_px) / ({c}_nx - {c}_px), 8) END AS {c}""")
    return f"""{table}_b AS (SELECT make_timestamp(CAST(floor(epoch(min(t)) / {seconds}) * {seconds} AS BIGINT) * 1000000) AS lo, max(t) AS hi FROM {table}),
{table}_g AS (SELECT unnest(generate_series(lo, hi, INTERVAL {seconds} SECOND)) AS t FROM {table}_b),
{table}_k AS (SELECT *, {", ".join(parts)} FROM (SELECT t, {", ".join(columns)}, epoch(t) / {seconds} AS x FROM {table}_g LEFT JOIN {table} USING (t))
  WINDOW p AS (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{table}_f AS (SELECT t, {", ".join(done)} FROM {table}_k)"""


_TREATED = ["umidade", "chuva_inmet"]
_FINE = f"""{_HOURS}, fine AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS t, arg_min(value, ts) AS umidade FROM r WHERE source = 'click' GROUP BY 1),
m AS (SELECT fine.t, fine.umidade, CASE WHEN minute(fine.t) = 0 THEN chuva_inmet END AS chuva_inmet
  FROM fine LEFT JOIN station ON station.t = date_trunc('hour', fine.t)), {_filled("m", 300, 72, _TREATED)}"""
_ROUNDED = ", ".join(f"round({c}, 8) AS {c}" for c in _TREATED)
_FINE_SQL = f"WITH {_FINE} SELECT t AS timestamp_br, {_ROUNDED} FROM m_f"


def _fine_rows(spark, sf):
    return dedupe(_master_5min(spark, sf), ["timestamp_br"], ["timestamp", "event_id"], keep="first")


def _treated_5min(spark, sf):
    return treated.treated_5min(_fine_rows(spark, sf), _TREATED, digits=8).select("timestamp_br", *_TREATED)


@query("job_treated_5min", _FINE_SQL)
def job_treated_5min(spark, sf):
    return _treated_5min(spark, sf)


@query("job_refresh_treated", _FINE_SQL)
def job_refresh_treated(spark, sf):
    """The table treated up to an instant, brought up to date with what came later; its twin treats everything at once."""
    rows = _fine_rows(spark, sf).select("timestamp_br", *_TREATED)
    cutoff = instant(_CUTOFF)
    before = treated.treated_5min(rows.filter(F.col("timestamp_br") < cutoff), _TREATED, digits=8)
    return treated.refresh_treated(before, rows, cutoff, _TREATED, digits=8).select("timestamp_br", *_TREATED)


_HOURLY = f"""{_FINE}, s AS (SELECT t, {", ".join(_TREATED)} FROM m_f WHERE minute(t) = 0),
q AS (SELECT date_trunc('hour', t) AS t, CAST(NULL AS DOUBLE) AS umidade, CAST(NULL AS DOUBLE) AS chuva_inmet FROM m_f
  WHERE t IN (SELECT min(t) FROM m_f) AND minute(t) <> 0),
w AS (SELECT * FROM s UNION ALL SELECT * FROM q), {_filled("w", 3600, 6, _TREATED)}"""


def _treated_hour(spark, sf):
    return treated.treated_hour(_treated_5min(spark, sf), _TREATED, digits=8).select("timestamp_br", *_TREATED)


@query("job_treated_hour", f"WITH {_HOURLY} SELECT t AS timestamp_br, {_ROUNDED} FROM w_f")
def job_treated_hour(spark, sf):
    return _treated_hour(spark, sf)


@query("job_tide_hour", f"""WITH {_HOURLY}, tide AS (
  SELECT date_trunc('hour', ts) AS t, arg_min(value, ts) AS altura_prevista, arg_min(degrees, ts) AS altura_prev_getmare FROM r WHERE source = 'view' GROUP BY 1)
SELECT w_f.t AS timestamp_br, {_ROUNDED}, altura_prevista, altura_prev_getmare, tide.t AS timestamp_prev
FROM w_f LEFT JOIN tide ON tide.t = w_f.t AND w_f.t >= TIMESTAMP '{_SINCE}'""")
def job_tide_hour(spark, sf):
    """Tide columns on the treated hours from an instant on."""
    first = lambda c: F.min_by(c, F.struct("ts", "event_id"))
    tide = readings(spark, sf).filter(F.col("source") == "view").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp_br")).agg(
        first("value").alias("altura_prevista"), first("degrees").alias("altura_prev_getmare"))
    out = treated.attach_tide_hour(_treated_hour(spark, sf), tide, since=instant(_SINCE))
    return out.select("timestamp_br", *_TREATED, "altura_prevista", "altura_prev_getmare", "timestamp_prev")
