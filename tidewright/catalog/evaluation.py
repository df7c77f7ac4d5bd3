"""Splits, folds, error metrics and the audit view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import G, HOUR, R, grid, query, readings
from tidewright.functions.timekeys import clock_label
from tidewright.operators import evaluate as ops
from tidewright.operators.features import lag_columns
from tidewright.operators.scan import balanced_buckets, grid_buckets, halo_window
from tidewright.operators.shaping import both_present

_BY = ["source"]


@query("split_80_10_10", f"""WITH {R}, n AS (
  SELECT event_id, source, ts, row_number() OVER (PARTITION BY source ORDER BY ts, event_id) AS i,
         count(*) OVER (PARTITION BY source) AS n FROM r)
SELECT event_id, source, CASE WHEN i <= floor(n * 0.8) THEN 'train'
  WHEN i <= floor(n * 0.8) + floor(n * 0.1) THEN 'validation' ELSE 'test' END AS split FROM n""")
def split_80_10_10(spark, sf):
    rows = readings(spark, sf).select("event_id", "source", "ts")
    return ops.chronological_split(rows, _BY, ["ts", "event_id"], balanced_buckets(rows, "ts")).drop("ts")


@query("split_single_series", f"""WITH {G}, n AS (
  SELECT source, ts_hour, row_number() OVER (PARTITION BY source ORDER BY ts_hour) AS i,
         count(*) OVER (PARTITION BY source) AS n FROM g)
SELECT source, ts_hour, CASE WHEN i <= floor(n * 0.92) THEN 'train' ELSE 'test' END AS split FROM n""")
def split_single_series(spark, sf):
    cells = grid(spark, sf).drop("value")
    return ops.chronological_split(
        cells, _BY, ["ts_hour"], grid_buckets(HOUR, 168), (("train", 0.92), ("test", 0.08))
    )


@query("timeseries_folds", f"""WITH {G}, n AS (
  SELECT source, ts_hour, row_number() OVER (PARTITION BY source ORDER BY ts_hour) AS i,
         count(*) OVER (PARTITION BY source) AS n FROM g),
f AS (SELECT source, ts_hour, i, CAST(k AS INTEGER) AS fold, n // 6 AS block, n - (6 - k) * (n // 6) AS start
      FROM n, range(1, 6) AS s(k))
SELECT source, ts_hour, fold, CASE WHEN i <= start THEN 'train' ELSE 'test' END AS role
FROM f WHERE i <= start + block""")
def timeseries_folds(spark, sf):
    cells = grid(spark, sf).drop("value")
    return ops.expanding_folds(cells, _BY, ["ts_hour"], grid_buckets(HOUR, 168))


@query("rolling_blocks", f"""WITH {G}, n AS (
  SELECT source, ts_hour, row_number() OVER (PARTITION BY source ORDER BY ts_hour) - 1 AS i,
         count(*) OVER (PARTITION BY source) AS n FROM g)
SELECT source, ts_hour, CAST(i // 2 AS BIGINT) AS block, '+' || (i % 2 + 1) || 'h' AS step
FROM n WHERE (i // 2) * 2 < n - 2""")
def rolling_blocks(spark, sf):
    return ops.rolling_blocks(grid(spark, sf).drop("value"), _BY, ["ts_hour"], grid_buckets(HOUR, 168))


def _metrics_sql(source: str, keys: str) -> str:
    return f"""SELECT {keys}, count(*) AS n, round(avg(abs(real - pred)), 3) AS mae,
  round(sqrt(avg((real - pred) * (real - pred))), 3) AS rmse,
  round(1 - sum((real - pred) * (real - pred)) / nullif(var_pop(real) * count(*), 0), 3) AS r2,
  round(avg(CASE WHEN abs(real - pred) < 0.5 THEN 1.0 ELSE 0.0 END) * 100, 3) AS within_pct
FROM {source} WHERE real IS NOT NULL AND pred IS NOT NULL GROUP BY {keys}"""


@query("naive_baseline_metrics", f"""WITH {G}, f AS (
  SELECT source, value AS real, lag(value, 2) OVER (PARTITION BY source ORDER BY ts_hour) AS pred FROM g)
{_metrics_sql('f', 'source')}""")
def naive_baseline_metrics(spark, sf):
    pairs = ops.naive_forecast(grid(spark, sf), _BY, "ts_hour", HOUR, "value", 2)
    return ops.error_metrics(pairs, _BY)


_HORIZONS = f"""WITH {G}, l AS (
  SELECT source, ts_hour, value AS real, lag(value, 1) OVER w AS p1, lag(value, 2) OVER w AS p2, lag(value, 3) OVER w AS p3
  FROM g WINDOW w AS (PARTITION BY source ORDER BY ts_hour)),
f AS (SELECT source, real, CAST(1 AS INTEGER) AS horizon, p1 AS pred FROM l UNION ALL
      SELECT source, real, 2, p2 FROM l UNION ALL SELECT source, real, 3, p3 FROM l)"""


def _by_horizon(spark, sf):
    wide = halo_window(grid(spark, sf), _BY, "ts_hour", HOUR, 3, 0, lambda w: lag_columns(w, ["value"], [1, 2, 3]))
    rows = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"value_lag{h}").alias("pred")) for h in (1, 2, 3)])
    return wide.select("source", F.col("value").alias("real"), F.inline(rows))


@query("metrics_by_horizon", f"{_HORIZONS} {_metrics_sql('f', 'source, horizon')} ORDER BY source, horizon")
def metrics_by_horizon(spark, sf):
    return ops.error_metrics(_by_horizon(spark, sf), ["source", "horizon"]).orderBy("source", "horizon")


@query("threshold_accuracy", f"""{_HORIZONS} SELECT horizon,
  round(avg(CASE WHEN abs(real - pred) < 0.3 THEN 1.0 WHEN abs(real - pred) >= 0.3 THEN 0.0 END) * 100, 3) AS within_0_3,
  round(avg(CASE WHEN abs(real - pred) < 0.5 THEN 1.0 WHEN abs(real - pred) >= 0.5 THEN 0.0 END) * 100, 3) AS within_0_5
FROM f GROUP BY horizon""")
def threshold_accuracy(spark, sf):
    return ops.threshold_accuracy(_by_horizon(spark, sf), ["horizon"], "real", "pred")


@query("last_points", f"""WITH {R} SELECT event_id, source, ts FROM r
QUALIFY row_number() OVER (PARTITION BY source ORDER BY ts DESC, event_id DESC) <= 300""")
def last_points(spark, sf):
    return ops.last_points(readings(spark, sf).select("event_id", "source", "ts"), _BY, ["ts", "event_id"], 300)


_AUDIT = f"""WITH {R}, p AS (
  SELECT date_trunc('hour', ts) AS datahora_alvo, max(value) AS dyn,
         min(value) FILTER (WHERE event_id % 2 = 0) AS frz FROM r WHERE source = 'click' GROUP BY 1),
t AS (SELECT date_trunc('hour', ts) AS datahora_alvo, max(value) AS real FROM r WHERE source = 'view' GROUP BY 1),
v AS (SELECT datahora_alvo, round(dyn, 3) AS previsto_dinamico, round(frz, 3) AS previsto_2h_congelado,
  round(real, 3) AS medicao_real_boia, round(abs(real - dyn), 3) AS erro_dinamico_nos, round(abs(real - frz), 3) AS erro_2h_nos,
  round(CASE WHEN real IS NOT NULL AND dyn IS NOT NULL AND real <> 0 THEN greatest(0, (1 - abs(real - dyn) / abs(real)) * 100) END, 1) AS acerto_perc_dinamico,
  round(CASE WHEN real IS NOT NULL AND frz IS NOT NULL AND real <> 0 THEN greatest(0, (1 - abs(real - frz) / abs(real)) * 100) END, 1) AS acerto_perc_2h
  FROM p LEFT JOIN t USING (datahora_alvo))"""


def _audit(spark, sf):
    rows = readings(spark, sf).withColumn("datahora_alvo", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    forecasts = rows.filter(F.col("source") == "click").groupBy("datahora_alvo").agg(
        F.max("value").alias("dyn"), F.min(F.when(F.col("event_id") % 2 == 0, F.col("value"))).alias("frz")
    )
    truth = rows.filter(F.col("source") == "view").groupBy("datahora_alvo").agg(F.max("value").alias("real"))
    return ops.audit(forecasts, truth, "datahora_alvo", "dyn", "frz", "real")


@query("audit_view", f"{_AUDIT} SELECT * FROM v ORDER BY datahora_alvo DESC")
def audit_view(spark, sf):
    return _audit(spark, sf).orderBy(F.desc("datahora_alvo"))


@query("audit_hourly_report", f"""{_AUDIT} SELECT strftime(datahora_alvo, '%H:%M') AS hora, datahora_alvo,
  previsto_2h_congelado AS previsao, medicao_real_boia AS medido, erro_2h_nos AS erro, acerto_perc_2h AS assertividade
FROM v WHERE previsto_2h_congelado IS NOT NULL AND medicao_real_boia IS NOT NULL AND CAST(datahora_alvo AS DATE) = DATE '2024-01-12'
ORDER BY datahora_alvo""")
def audit_hourly_report(spark, sf):
    day = _audit(spark, sf).filter(F.to_date("datahora_alvo") == F.lit("2024-01-12").cast("date"))
    return both_present(day, "previsto_2h_congelado", "medicao_real_boia").select(
        clock_label(F.col("datahora_alvo")).alias("hora"), "datahora_alvo",
        F.col("previsto_2h_congelado").alias("previsao"), F.col("medicao_real_boia").alias("medido"),
        F.col("erro_2h_nos").alias("erro"), F.col("acerto_perc_2h").alias("assertividade"),
    ).orderBy("datahora_alvo")


@query("audit_daily", f"""{_AUDIT} SELECT CAST(datahora_alvo AS DATE) AS dia,
  round(avg(acerto_perc_2h), 8) AS assertividade_media_dia, count(*) AS horas
FROM v WHERE previsto_2h_congelado IS NOT NULL AND medicao_real_boia IS NOT NULL GROUP BY 1""")
def audit_daily(spark, sf):
    return ops.audit_daily(_audit(spark, sf), "datahora_alvo", digits=8)
