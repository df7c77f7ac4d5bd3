"""Spine joins, scalar bounds, nearest-time joins and overlays."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import G, H, R, S, SOURCES, grid, hours, instant, query, readings, samples, shown, table
from tidewright.functions.timekeys import five_minute_key, hour_key
from tidewright.operators import joins as ops
from tidewright.operators.rollup import latest_per_hour, rollup
from tidewright.operators import scan as seq
from tidewright.operators.forecast import inject_weather
from tidewright.operators.scan import balanced_buckets
from tidewright.operators.shaping import current_hour, gate_hourly, half_open, last_hours, union_unlike


def _source_hours(rows, source, columns=("value",)):
    """Newest reading of a source per hour, columns tagged with the source."""
    newest = latest_per_hour(rows.filter(F.col("source") == source), [], "ts", ["event_id"])
    return newest.select("ts_hour", *[F.col(c).alias(f"{source}_{c}") for c in columns])


def _bounded(rows):
    limit = rows.filter(F.col("source") == "click").agg(F.max("ts").alias("limit"))
    return ops.up_to_scalar(rows, "ts", limit)


_LATEST = "".join(f""", {s}_h AS (
  SELECT date_trunc('hour', ts) AS ts_hour, arg_max(value, ts) AS {s}_value FROM r
  WHERE source = '{s}' AND ts <= (SELECT max(ts) FROM r WHERE source = 'click') GROUP BY 1)""" for s in SOURCES[1:])


@query("master_hour", f"""WITH {R}{_LATEST}, spine AS (
  SELECT date_trunc('hour', ts) AS ts_hour, round(avg(value), 8) AS value, arg_min(user_id, ts) AS user_id
  FROM r WHERE source = 'click' GROUP BY 1)
SELECT * FROM spine LEFT JOIN error_h USING (ts_hour) LEFT JOIN purchase_h USING (ts_hour)
LEFT JOIN signup_h USING (ts_hour) LEFT JOIN view_h USING (ts_hour) ORDER BY ts_hour""")
def master_hour(spark, sf):
    rows = readings(spark, sf)
    spine = rollup(rows.filter(F.col("source") == "click"), [], "ts", ["value"], ["user_id"])
    bounded = _bounded(rows)
    sides = [_source_hours(bounded, s) for s in SOURCES[1:]]
    return shown(ops.spine_join(spine, sides, "ts_hour"), ["value"]).orderBy("ts_hour")


@query("master_5min_gated", f"""WITH {R}{_LATEST}, fine AS (
  SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS ts_5min, date_trunc('hour', ts) AS ts_hour, value
  FROM r WHERE source = 'click')
SELECT event_id, ts_5min, value,
       CASE WHEN minute(ts_5min) = 0 THEN error_value END AS error_value,
       CASE WHEN minute(ts_5min) = 0 THEN purchase_value END AS purchase_value,
       CASE WHEN minute(ts_5min) = 0 THEN signup_value END AS signup_value,
       CASE WHEN minute(ts_5min) = 0 THEN view_value END AS view_value
FROM fine LEFT JOIN error_h USING (ts_hour) LEFT JOIN purchase_h USING (ts_hour)
LEFT JOIN signup_h USING (ts_hour) LEFT JOIN view_h USING (ts_hour)""")
def master_5min_gated(spark, sf):
    rows = readings(spark, sf)
    fine = rows.filter(F.col("source") == "click").select(
        "event_id", five_minute_key(F.col("ts")).alias("ts_5min"), hour_key(F.col("ts")).alias("ts_hour"), "value"
    )
    bounded = _bounded(rows)
    joined = ops.spine_join(fine, [_source_hours(bounded, s) for s in SOURCES[1:]], "ts_hour")
    return gate_hourly(joined, "ts_5min", [f"{s}_value" for s in SOURCES[1:]]).drop("ts_hour")


@query("master_5min_mixed_keys", f"""WITH {R}{_LATEST}, fine AS (
  SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS ts_5min, date_trunc('hour', ts) AS ts_hour, value
  FROM r WHERE source = 'click'),
now AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS ts_5min, arg_max(value, ts) AS now_value
        FROM r WHERE source = 'purchase' GROUP BY 1)
SELECT event_id, ts_5min, value, now_value, error_value, signup_value, view_value
FROM fine LEFT JOIN now USING (ts_5min) LEFT JOIN error_h USING (ts_hour) LEFT JOIN signup_h USING (ts_hour) LEFT JOIN view_h USING (ts_hour)""")
def master_5min_mixed_keys(spark, sf):
    rows = readings(spark, sf)
    fine = rows.filter(F.col("source") == "click").select(
        "event_id", five_minute_key(F.col("ts")).alias("ts_5min"), hour_key(F.col("ts")).alias("ts_hour"), "value"
    )
    now = rows.filter(F.col("source") == "purchase").groupBy(five_minute_key(F.col("ts")).alias("ts_5min")).agg(
        F.max_by("value", "ts").alias("now_value")
    )
    bounded = _bounded(rows)
    joined = ops.spine_join(fine.join(now, "ts_5min", "left"), [_source_hours(bounded, s) for s in ("error", "signup", "view")], "ts_hour")
    return joined.drop("ts_hour")


_SERIES = "".join(f""", {s}_s AS (
  SELECT ts_hour, round(value, 8) AS {s} FROM h WHERE source = '{s}')""" for s in SOURCES)


def _series(spark, sf):
    rolled = hours(spark, sf)
    return [
        rolled.filter(F.col("source") == s).select("ts_hour", F.round("value", 8).alias(s)) for s in SOURCES
    ]


@query("full_coverage_spine", f"""WITH {H}{_SERIES}, spine AS (SELECT DISTINCT ts_hour FROM h)
SELECT * FROM spine {' '.join(f'LEFT JOIN {s}_s USING (ts_hour)' for s in SOURCES)}""")
def full_coverage_spine(spark, sf):
    return ops.full_coverage_join(_series(spark, sf), ["ts_hour"])


@query("outer_fold", f"""WITH {H}{_SERIES}
SELECT * FROM click_s {' '.join(f'FULL JOIN {s}_s USING (ts_hour)' for s in SOURCES[1:])}""")
def outer_fold(spark, sf):
    return ops.outer_fold(_series(spark, sf), "ts_hour")


@query("key_union", f"""WITH {R}
{' UNION '.join(f"SELECT date_trunc('hour', ts) AS ts_hour FROM r WHERE source = '{s}'" for s in SOURCES)}""")
def key_union(spark, sf):
    rows = readings(spark, sf).withColumn("ts_hour", hour_key(F.col("ts")))
    return ops.key_union([rows.filter(F.col("source") == s) for s in SOURCES], ["ts_hour"])


@query("union_unlike", f"""WITH {R}
SELECT event_id, ts, value, NULL::BIGINT AS user_id FROM r WHERE source = 'click'
UNION ALL SELECT event_id, ts, NULL, user_id FROM r WHERE source = 'view'""")
def union_of_unlike(spark, sf):
    rows = readings(spark, sf)
    return union_unlike(
        rows.filter(F.col("source") == "click").select("event_id", "ts", "value"),
        rows.filter(F.col("source") == "view").select("event_id", "ts", "user_id"),
    )


_PIVOT = ", ".join(f"round(avg(value) FILTER (WHERE source = '{s}'), 8) AS rain_{s}" for s in SOURCES)


@query("pivot_series", f"WITH {R} SELECT date_trunc('hour', ts) AS ts_hour, {_PIVOT} FROM r GROUP BY 1")
def pivot_series(spark, sf):
    rows = readings(spark, sf).withColumn("ts_hour", hour_key(F.col("ts")))
    return shown(ops.pivot_series(rows, ["ts_hour"], "source", "value", SOURCES, "rain_"), [f"rain_{s}" for s in SOURCES])


@query("join_on_hour", f"""WITH {R}, wide AS (SELECT date_trunc('hour', ts) AS ts_hour, {_PIVOT} FROM r GROUP BY 1)
SELECT event_id, ts, value, rain_click, rain_error, rain_purchase, rain_signup, rain_view
FROM r LEFT JOIN wide ON wide.ts_hour = date_trunc('hour', r.ts)""")
def join_on_hour(spark, sf):
    return ops.join_on_hour(readings(spark, sf).select("event_id", "ts", "value"), pivot_series(spark, sf), "ts")


@query("daily_pivot_join", """WITH d AS (
  SELECT CAST(l_shipdate AS DATE) AS day,
         round(avg(l_quantity) FILTER (WHERE l_returnflag = 'A'), 8) AS rain_A,
         round(avg(l_quantity) FILTER (WHERE l_returnflag = 'N'), 8) AS rain_N,
         round(avg(l_quantity) FILTER (WHERE l_returnflag = 'R'), 8) AS rain_R
  FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderdate, rain_A, rain_N, rain_R
FROM orders LEFT JOIN d ON d.day = CAST(o_orderdate AS DATE)""")
def daily_pivot_join(spark, sf):
    items = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"), "l_returnflag", "l_quantity")
    flags = ("A", "N", "R")
    daily = shown(ops.pivot_series(items, ["day"], "l_returnflag", "l_quantity", flags, "rain_"), [f"rain_{f}" for f in flags])
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))
    return ops.join_on_day(orders, daily, "o_orderdate")


@query("bounded_by_scalar", f"""WITH {R}
SELECT event_id, ts, source FROM r
WHERE source <> 'click' AND ts <= (SELECT date_trunc('hour', max(ts)) FROM r WHERE source = 'click')""")
def bounded_by_scalar(spark, sf):
    rows = readings(spark, sf).select("event_id", "ts", "source")
    limit = rows.filter(F.col("source") == "click").agg(hour_key(F.max("ts")).alias("limit"))
    return ops.up_to_scalar(rows.filter(F.col("source") != "click"), "ts", limit)


@query("scalar_columns", f"""WITH {R}, s AS (SELECT min(ts) AS ts_min, max(ts) AS ts_max FROM r)
SELECT event_id, ts, ts_min, ts_max FROM r, s""")
def scalar_columns(spark, sf):
    rows = readings(spark, sf).select("event_id", "ts")
    return ops.with_scalars(rows, rows.agg(F.min("ts").alias("ts_min"), F.max("ts").alias("ts_max")))


@query("half_open_window", f"""WITH {R} SELECT event_id, ts, value FROM r
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'""")
def half_open_window(spark, sf):
    return half_open(readings(spark, sf).select("event_id", "ts", "value"), "ts", instant("2024-01-10"), instant("2024-01-12"))


@query("between_cutoffs", f"""WITH {R} SELECT event_id, ts, source FROM r
WHERE source = 'view' AND ts BETWEEN (SELECT date_trunc('hour', max(ts)) - INTERVAL 24 HOUR FROM r WHERE source = 'click')
  AND TIMESTAMP '2024-01-31'""")
def between_cutoffs(spark, sf):
    rows = readings(spark, sf).select("event_id", "ts", "source")
    newest = rows.filter(F.col("source") == "click").agg((hour_key(F.max("ts")) - F.expr("INTERVAL 24 HOURS")).alias("cutoff"))
    return ops.between_scalar_and(rows.filter(F.col("source") == "view"), "ts", newest, instant("2024-01-31"))


@query("current_hour", f"""WITH {R} SELECT event_id, ts, value FROM r
WHERE ts >= TIMESTAMP '2024-01-20 08:00:00' AND ts < TIMESTAMP '2024-01-20 09:00:00'""")
def rows_of_current_hour(spark, sf):
    return current_hour(readings(spark, sf).select("event_id", "ts", "value"), "ts", instant("2024-01-20 08:35:00"))


@query("last_hours", f"""WITH {R} SELECT event_id, ts, value FROM r WHERE ts >= TIMESTAMP '2024-01-29 12:00:00'""")
def rows_of_last_hours(spark, sf):
    return last_hours(readings(spark, sf).select("event_id", "ts", "value"), "ts", instant("2024-01-30 12:00:00"), 24)


@query("anti_existing", f"""WITH {R}
SELECT event_id, source, date_trunc('hour', ts) AS ts_hour FROM r a WHERE source = 'click' AND NOT EXISTS (
  SELECT 1 FROM r b WHERE b.source = 'view' AND date_trunc('hour', b.ts) = date_trunc('hour', a.ts))""")
def anti_existing(spark, sf):
    rows = readings(spark, sf).select("event_id", "source", hour_key(F.col("ts")).alias("ts_hour"))
    return ops.new_keys_only(rows.filter(F.col("source") == "click"), rows.filter(F.col("source") == "view"), ["ts_hour"])


@query("combine_first", f"""WITH {H}{_SERIES}
SELECT ts_hour, coalesce(v.view, c.click) AS value FROM click_s c LEFT JOIN view_s v USING (ts_hour)""")
def combine_first(spark, sf):
    series = dict(zip(SOURCES, _series(spark, sf)))
    return ops.combine_first(
        series["click"].withColumnRenamed("click", "value"), series["view"].withColumnRenamed("view", "value"),
        ["ts_hour"], ["value"],
    )


@query("asof_nearest", f"""WITH {R}, l AS (SELECT event_id, user_id, ts FROM r WHERE source = 'error'),
v AS (SELECT user_id, ts, arg_min(value, event_id) AS value FROM r WHERE source = 'view' GROUP BY ALL),
b AS (SELECT l.*, v.ts AS bt, v.value AS bv FROM l ASOF LEFT JOIN v ON l.user_id = v.user_id AND l.ts >= v.ts),
a AS (SELECT b.*, v.ts AS aft, v.value AS av FROM b ASOF LEFT JOIN v ON b.user_id = v.user_id AND b.ts <= v.ts)
SELECT event_id, user_id, ts,
  CASE WHEN bt IS NOT NULL AND (aft IS NULL OR ts - bt <= aft - ts) THEN bt ELSE aft END AS matched_ts,
  CASE WHEN bt IS NOT NULL AND (aft IS NULL OR ts - bt <= aft - ts) THEN bv ELSE av END AS value
FROM a""")
def asof_nearest(spark, sf):
    rows = readings(spark, sf)
    left = rows.filter(F.col("source") == "error").select("event_id", "user_id", "ts")
    right = rows.filter(F.col("source") == "view").select("user_id", "ts", "value")
    return ops.nearest_time_join(left, right, "ts", ["value"], balanced_buckets(rows, "ts"), ["user_id"])


@query("asof_tolerance", f"""WITH {R}, l AS (SELECT event_id, ts FROM r WHERE source = 'error'),
v AS (SELECT ts, value FROM r WHERE source = 'view'),
b AS (SELECT l.*, v.ts AS bt, v.value AS bv FROM l ASOF LEFT JOIN v ON l.ts >= v.ts),
a AS (SELECT b.*, v.ts AS aft, v.value AS av FROM b ASOF LEFT JOIN v ON b.ts <= v.ts),
m AS (SELECT event_id, ts,
  CASE WHEN bt IS NOT NULL AND (aft IS NULL OR ts - bt <= aft - ts) THEN bt ELSE aft END AS mt,
  CASE WHEN bt IS NOT NULL AND (aft IS NULL OR ts - bt <= aft - ts) THEN bv ELSE av END AS mv
  FROM a)
SELECT event_id, ts,
  CASE WHEN abs(epoch_us(mt) - epoch_us(ts)) <= 600000000 THEN mt END AS matched_ts,
  CASE WHEN abs(epoch_us(mt) - epoch_us(ts)) <= 600000000 THEN mv END AS value FROM m""")
def asof_tolerance(spark, sf):
    rows = readings(spark, sf)
    left = rows.filter(F.col("source") == "error").select("event_id", "ts")
    right = rows.filter(F.col("source") == "view").select("ts", "value")
    return ops.nearest_time_join(
        left, right, "ts", ["value"], balanced_buckets(rows, "ts"), tolerance_seconds=600
    )


@query("previous_and_next", f"""WITH {R}
SELECT event_id, user_id, ts, lag(value) OVER w AS prev_value, lag(ts) OVER w AS prev_ts,
       lead(value) OVER w AS next_value FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
def previous_and_next(spark, sf):
    rows = readings(spark, sf).select("event_id", "user_id", "ts", "value")
    out = seq.previous_and_next(rows, ["user_id"], "ts", ["value"], balanced_buckets(rows, "ts"))
    return out.select(
        "event_id", "user_id", "ts", F.col("prev.value").alias("prev_value"),
        F.col("prev.ts").alias("prev_ts"), F.col("next.value").alias("next_value"),
    )


@query("range_slice_origins", f"""WITH {G}
SELECT o.source, o.ts_hour AS origin, CAST(date_diff('hour', o.ts_hour, x.ts_hour) AS INTEGER) AS ahead,
       x.ts_hour, round(x.value, 8) AS value
FROM g o JOIN g x ON x.source = o.source AND x.ts_hour BETWEEN o.ts_hour AND o.ts_hour + INTERVAL 9 HOUR
WHERE hour(o.ts_hour) = 0""")
def range_slice_origins(spark, sf):
    cells = grid(spark, sf)
    origins = cells.filter(F.hour("ts_hour") == 0).select("source", F.col("ts_hour").alias("origin"))
    out = ops.horizon_slice(origins, cells, "origin", "ts_hour", 3600, 9, ["source"])
    return shown(out.select("source", "origin", "ahead", "ts_hour", "value"), ["value"])


@query("inject_weather", f"""WITH {S}, l AS (
  SELECT ts_hour AS origin, ts_hour + INTERVAL 3 HOUR AS ts, value AS bar_lag1 FROM h WHERE source = 'click'),
v AS (SELECT ts, value FROM r WHERE source = 'view'),
b AS (SELECT l.*, v.ts AS bt, v.value AS bv FROM l ASOF LEFT JOIN v ON l.ts >= v.ts),
a AS (SELECT b.*, v.ts AS aft, v.value AS av FROM b ASOF LEFT JOIN v ON b.ts <= v.ts),
m AS (SELECT origin, ts, bar_lag1,
  CASE WHEN bt IS NOT NULL AND (aft IS NULL OR ts - bt <= aft - ts) THEN bt ELSE aft END AS mt,
  CASE WHEN bt IS NOT NULL AND (aft IS NULL OR ts - bt <= aft - ts) THEN bv ELSE av END AS mv FROM a)
SELECT origin, CASE WHEN abs(epoch_us(mt) - epoch_us(ts)) <= 3600000000 THEN mv ELSE bar_lag1 END AS bar_lag1 FROM m""")
def injected_weather(spark, sf):
    features = samples(spark, sf).filter(F.col("source") == "click").select(
        F.col("ts_hour").alias("origin"), F.col("value").alias("bar_lag1")
    )
    rows = readings(spark, sf)
    weather = rows.filter(F.col("source") == "view").select("ts", F.col("value").alias("pressure"))
    return inject_weather(features, weather, "origin", 3, {"pressure": "bar"}, balanced_buckets(rows, "ts"))
