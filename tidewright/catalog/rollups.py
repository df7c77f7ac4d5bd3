"""Rollups, latest-row picks, dedupe and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import R, SG, instant, query, readings, sample_grid, shown, table
from tidewright.functions.timekeys import five_minute_key
from tidewright.operators import rollup as ops
from tidewright.operators.shaping import numeric_share
from tidewright.sources.tables import latest_rows


@query("hour_rollup", f"""WITH {R}
SELECT source, date_trunc('hour', ts) AS ts_hour, round(avg(value), 8) AS value,
       round(avg(degrees), 8) AS degrees, max(ts) AS last_ts
FROM r GROUP BY ALL""")
def hour_rollup(spark, sf):
    out = ops.rollup(readings(spark, sf), ["source"], "ts", ["value", "degrees"], last_instant="last_ts")
    return shown(out, ["value", "degrees"])


@query("hour_rollup_first_label", f"""WITH {R}
SELECT date_trunc('hour', ts) AS ts_hour, round(avg(value), 8) AS value,
       arg_min(source, ts) AS source, arg_min(user_id, ts) AS user_id,
       date_trunc('hour', ts) + INTERVAL 59 MINUTE AS ts_end
FROM r GROUP BY date_trunc('hour', ts)""")
def hour_rollup_first_label(spark, sf):
    out = ops.rollup(readings(spark, sf), [], "ts", ["value"], ["source", "user_id"], tie_break=["event_id"])
    return shown(out.withColumn("ts_end", ops.hour_end("ts_hour")), ["value"])


@query("hour_rollup_by_type", f"""WITH {R}
SELECT user_id, date_trunc('hour', ts) AS ts_hour, round(avg(value), 8) AS value,
       round(avg(degrees), 8) AS degrees, arg_min(source, ts) AS source
FROM r GROUP BY user_id, date_trunc('hour', ts)""")
def hour_rollup_by_type(spark, sf):
    out = ops.rollup_by_type(readings(spark, sf), ["user_id"], "ts", ["event_id"])
    return shown(out, ["value", "degrees"])


@query("hour_and_instant", f"""WITH {R}
SELECT date_trunc('hour', ts) AS ts_hour, ts, min(value) AS value, min(source) AS source
FROM r GROUP BY date_trunc('hour', ts), ts""")
def hour_and_instant(spark, sf):
    return ops.rollup_hour_and_instant(readings(spark, sf), "ts", ["value", "source"])


@query("newest_instant_labels", f"""WITH {R}
SELECT user_id, date_trunc('day', ts) AS day, max(ts) AS newest, arg_max(source, ts) AS source,
       arg_max(value, ts) AS value
FROM r GROUP BY user_id, date_trunc('day', ts)""")
def newest_instant_labels(spark, sf):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    return readings(spark, sf).groupBy("user_id", day).agg(
        F.max("ts").alias("newest"), F.max_by("source", "ts").alias("source"), F.max_by("value", "ts").alias("value")
    )


@query("time_span", f"WITH {R} SELECT min(ts) AS ts_min, max(ts) AS ts_max FROM r")
def time_span(spark, sf):
    return ops.time_span(readings(spark, sf), "ts")


@query("bucket_5min", f"""WITH {R}
SELECT source, time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, round(avg(value), 8) AS value
FROM r GROUP BY ALL""")
def bucket_5min(spark, sf):
    out = ops.rollup(readings(spark, sf), ["source"], "ts", ["value"], step_seconds=300, bucket="bucket")
    return shown(out, ["value"])


@query("bucket_5min_rows", f"""WITH {R}
SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS bucket FROM r""")
def bucket_5min_rows(spark, sf):
    return readings(spark, sf).select("event_id", five_minute_key(F.col("ts")).alias("bucket"))


@query("partial_hour_mean", f"""WITH {R}
SELECT source, round(avg(value), 8) AS value FROM r
WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' AND ts <= TIMESTAMP '2024-01-15 12:40:00' GROUP BY source""")
def partial_hour_mean(spark, sf):
    out = ops.partial_hour_mean(readings(spark, sf), ["source"], "ts", ["value"], instant("2024-01-15 12:40:00"))
    return shown(out, ["value"])


@query("latest_per_hour", f"""WITH {R}
SELECT event_id, ts, source, user_id, value, round(degrees, 8) AS degrees, date_trunc('hour', ts) AS ts_hour FROM r
QUALIFY row_number() OVER (PARTITION BY source, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_hour(spark, sf):
    return shown(ops.latest_per_hour(readings(spark, sf), ["source"], "ts", ["event_id"]), ["degrees"])


@query("top2_per_key", f"""WITH {R}
SELECT user_id, ts, source, value FROM r WHERE ts <= TIMESTAMP '2024-01-30 21:00:00'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 2""")
def top2_per_key(spark, sf):
    rows = readings(spark, sf).select("event_id", "user_id", "ts", "source", "value")
    return ops.latest_two_aged(rows, ["user_id"], "ts", instant("2024-01-31 00:00:00"), tie_break=["event_id"]).drop("event_id")


@query("dedupe_key", f"""WITH {R}
SELECT event_id, user_id, source, ts FROM r
QUALIFY row_number() OVER (PARTITION BY user_id, source ORDER BY ts, event_id) = 1""")
def dedupe_key(spark, sf):
    rows = readings(spark, sf).select("event_id", "user_id", "source", "ts")
    return ops.dedupe(rows, ["user_id", "source"], ["ts", "event_id"], keep="first")


@query("dedupe_rows", f"WITH {R} SELECT DISTINCT source, date_trunc('hour', ts) AS ts_hour FROM r")
def dedupe_rows(spark, sf):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts_hour")
    return readings(spark, sf).select("source", hour).dropDuplicates()


@query("latest_n_resorted", f"""WITH {R}
SELECT event_id, ts, source, value FROM (SELECT * FROM r ORDER BY ts DESC LIMIT 48) ORDER BY ts""")
def latest_n_resorted(spark, sf):
    return latest_rows(readings(spark, sf).select("event_id", "ts", "source", "value"), ["ts"], 48)


@query("metric_means", """
SELECT l_returnflag, metric, round(avg(v), 8) AS mean FROM (
  SELECT l_returnflag, unnest(['l_quantity', 'l_discount', 'l_tax']) AS metric,
         unnest([l_quantity, l_discount, l_tax]) AS v FROM lineitem)
GROUP BY ALL""")
def metric_means(spark, sf):
    items = table(spark, sf, "lineitem")
    return shown(ops.stack_means(items, ["l_returnflag"], ["l_quantity", "l_discount", "l_tax"]), ["mean"])


@query("collapse_forecasts", f"""WITH {R}, runs AS (
  SELECT date_trunc('hour', ts) AS target, ts AS origin, value,
         CASE WHEN source = 'view' THEN value END AS frozen FROM r)
SELECT target, round(arg_max(value, origin), 4) AS dynamic,
       round(coalesce(arg_min(frozen, origin) FILTER (WHERE frozen IS NOT NULL), arg_max(value, origin)), 4) AS first
FROM runs GROUP BY target""")
def collapse_forecasts(spark, sf):
    runs = readings(spark, sf).select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("target"),
        F.col("ts").alias("origin"),
        "value",
        F.when(F.col("source") == "view", F.col("value")).alias("frozen"),
    )
    return ops.collapse_runs(runs, "target", "origin", "value", "frozen")


@query("profile_columns", f"""WITH {SG}, c AS (
  SELECT 'source' AS column_name, source AS v FROM g UNION ALL
  SELECT 'value', CAST(value AS VARCHAR) FROM g UNION ALL
  SELECT 'ts_day', CAST(CAST(ts_hour AS DATE) AS VARCHAR) FROM g)
SELECT column_name, count(*) AS row_count, count(*) - count(v) AS null_count,
       coalesce(count(*) FILTER (WHERE TRY_CAST(v AS DOUBLE) = 0), 0) AS zero_count,
       count(DISTINCT v) AS distinct_count,
       coalesce(count(*) FILTER (WHERE TRY_CAST(v AS DOUBLE) = 0), 0) * 100.0 / count(*) AS zero_pct
FROM c GROUP BY column_name ORDER BY zero_pct DESC, column_name""")
def profile_columns(spark, sf):
    rows = sample_grid(spark, sf).select(
        "source", "value", F.to_date("ts_hour").cast("string").alias("ts_day")
    )
    return ops.profile(rows, ["source", "value", "ts_day"]).drop("example").orderBy(F.desc("zero_pct"), "column_name")


_PROFILED = ("event_id", "source", "user_id", "value", "degrees", "ts")
_CELLS = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS v FROM r" for c in _PROFILED)


@query("profile_days", f"""WITH {R}, c AS ({_CELLS})
SELECT column_name, count(*) AS row_count, count(*) - count(v) AS null_count,
       count(*) FILTER (WHERE TRY_CAST(v AS DOUBLE) = 0) AS zero_count, count(DISTINCT v) AS distinct_count, TRUE AS sketch_close
FROM c GROUP BY column_name""")
def profile_days(spark, sf):
    """Days merged by their sketches next to the exact distinct counts; ``sketch_close`` is within 5 %."""
    rows = readings(spark, sf).withColumn("day", F.to_date("ts"))
    merged = ops.merged_profile(ops.profile_days(rows, _PROFILED, "day")).withColumnRenamed("distinct_count", "sketched")
    exact = ops.profile(rows, _PROFILED).select("column_name", "distinct_count")
    close = F.abs(F.col("sketched") - F.col("distinct_count")) <= 0.05 * F.col("distinct_count")
    return merged.join(exact, "column_name").select(
        "column_name", "row_count", "null_count", "zero_count", "distinct_count", close.alias("sketch_close"))


@query("numeric_detect", """
SELECT column_name, count(v) AS filled, round(avg(CASE WHEN v IS NOT NULL
       THEN CASE WHEN TRY_CAST(v AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END END), 8) AS numeric_share
FROM (SELECT 'o_orderpriority' AS column_name, o_orderpriority AS v FROM orders UNION ALL
      SELECT 'leading', CASE WHEN o_orderstatus <> 'P' THEN substr(o_orderpriority, 1, 1) END FROM orders UNION ALL
      SELECT 'mixed', CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS VARCHAR) ELSE o_orderstatus END FROM orders)
GROUP BY column_name""")
def numeric_detect(spark, sf):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    text = table(spark, sf, "orders").select(
        "o_orderpriority",
        F.when(status != "P", F.substring(priority, 1, 1)).alias("leading"),
        F.when(status == "O", F.col("o_custkey").cast("string")).otherwise(status).alias("mixed"),
    )
    return shown(numeric_share(text, ["o_orderpriority", "leading", "mixed"]), ["numeric_share"])
