"""Streaming jobs drained with ``availableNow``; the SQL twins describe the final state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import H, R, hours, query, shown, table
from tidewright.functions.timekeys import five_minute_key
from tidewright.session import scratch_path
from tidewright.sinks.maintain import VersionedTable
from tidewright.sources.tables import stream_readings
from tidewright.streaming import flows


def _raw(spark, sf):
    schema = table(spark, sf, "events").schema
    raw = stream_readings(spark, sf, schema, "events.parquet")
    return raw.select("event_id", "ts", F.col("event_type").alias("source"), "user_id", "value")


def _stream(spark, sf, delay="24 hours"):
    return flows.event_time(_raw(spark, sf), "ts", delay)


def _landed(spark, rows, parts, part):
    """``rows`` as ``parts`` files that a stream reads one by one, in the order of ``part``."""
    folder = scratch_path(spark, "landing")
    for i in range(parts):
        rows.filter(part == i).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", F.col("event_type").alias("source"), "user_id", "value")


# Append mode emits a window once the final watermark has passed its end.
def _closed(end: str, delay: str) -> str:
    return f"{end} <= (SELECT date_trunc('millisecond', max(ts)) FROM r) - INTERVAL {delay}"


@query("stream_bucket", f"""WITH {R}, b AS (
  SELECT source, time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, avg(value) AS value, count(*) AS n FROM r GROUP BY ALL)
SELECT source, bucket, round(value, 8) AS value, n FROM b WHERE {_closed('bucket + INTERVAL 5 MINUTE', '24 HOUR')}""")
def stream_bucket(spark, sf):
    out = flows.bucket_means(_stream(spark, sf), ["source"], "ts", ["value"])
    return shown(flows.collected(spark, out, "bucket"), ["value"])


@query("stream_aged_hours", f"""WITH {R}, b AS (
  SELECT source, date_trunc('hour', ts) AS bucket, avg(value) AS value, count(*) AS n FROM r GROUP BY ALL)
SELECT source, bucket, round(value, 8) AS value, n FROM b WHERE {_closed('bucket + INTERVAL 1 HOUR', '3 HOUR')}""")
def stream_aged_hours(spark, sf):
    out = flows.old_enough(_stream(spark, sf, "3 hours"), ["source"], "ts", ["value"])
    return shown(flows.collected(spark, out, "aged"), ["value"])


@query("stream_hour_rollup", f"""WITH {R}
SELECT source, date_trunc('hour', ts) AS bucket, round(avg(value), 8) AS value, count(*) AS n FROM r GROUP BY ALL""")
def stream_hour_rollup(spark, sf):
    path = scratch_path(spark, "hours")
    out = flows.bucket_means(_stream(spark, sf), ["source"], "ts", ["value"], "1 hour")
    flows.upsert_latest(out, path, f"{path}/state", keys=["source", "bucket"]).awaitTermination()
    return shown(flows.latest_state(spark, path, ["source", "bucket"]), ["value"])


@query("stream_folded_log", f"""WITH {R}
SELECT source, date_trunc('hour', ts) AS bucket, round(avg(value), 8) AS value, count(*) AS n FROM r GROUP BY ALL""")
def stream_folded_log(spark, sf):
    """The hour rollup over seven batches whose log is folded every second batch."""
    path = scratch_path(spark, "folded")
    stream = flows.event_time(_landed(spark, _events(spark, sf), 7, F.pmod("event_id", F.lit(7))), "ts", "60 days")
    out = flows.bucket_means(stream, ["source"], "ts", ["value"], "1 hour")
    flows.upsert_latest(out, path, f"{path}/state", keys=["source", "bucket"], fold_every=2).awaitTermination()
    return shown(flows.latest_state(spark, path, ["source", "bucket"]), ["value"])


@query("stream_dedupe", f"WITH {R} SELECT DISTINCT source, time_bucket(INTERVAL 5 MINUTE, ts) AS ts_5min FROM r")
def stream_dedupe(spark, sf):
    slots = _raw(spark, sf).select("source", five_minute_key(F.col("ts")).alias("ts_5min"))
    out = flows.first_per_key(flows.event_time(slots, "ts_5min"), ["source", "ts_5min"])
    out = out.select("source", F.col("ts_5min").cast("timestamp_ntz").alias("ts_5min"))
    return flows.collected(spark, out, "dedupe")


@query("stream_enrich", f"""WITH {H}, v AS (SELECT ts_hour, value AS view_value FROM h WHERE source = 'view')
SELECT event_id, r.value, round(view_value, 8) AS view_value
FROM r LEFT JOIN v ON v.ts_hour = date_trunc('hour', r.ts) WHERE r.source = 'click'""")
def stream_enrich(spark, sf):
    hourly = hours(spark, sf).filter(F.col("source") == "view").select("ts_hour", F.col("value").alias("view_value"))
    clicks = _stream(spark, sf).filter(F.col("source") == "click")
    out = flows.enrich_hourly(clicks, hourly, "ts").select("event_id", "value", "view_value")
    return shown(flows.collected(spark, out, "enrich"), ["view_value"])


_FROZEN = f"""WITH {R}, runs AS (
  SELECT date_trunc('hour', ts) + (event_id % 4) * INTERVAL 1 HOUR AS target, ts AS run_at, value FROM r),
e AS (SELECT *, CASE WHEN trunc((epoch_us(target) - epoch_us(run_at)) / 60000000.0) BETWEEN 90 AND 150 THEN run_at END AS ok FROM runs)
SELECT target, arg_max(value, run_at) AS dynamic, arg_min(value, ok) FILTER (WHERE ok IS NOT NULL) AS frozen,
       max(run_at) AS updated_at, min(ok) AS frozen_at FROM e GROUP BY target"""


def _freeze(spark, rows):
    path = scratch_path(spark, "freeze")
    target = VersionedTable(spark, f"{path}/table")
    target.publish(flows.empty_forecasts(spark, "target"))
    ahead = F.make_dt_interval(hours=(F.col("event_id") % 4).cast("int"))
    runs = rows.select(
        (F.date_trunc("hour", "ts") + ahead).cast("timestamp_ntz").alias("target"),
        F.col("ts").cast("timestamp_ntz").alias("run_at"), "value",
    )
    flows.freeze_forecasts(runs, target, "target", "value", "run_at", f"{path}/state").awaitTermination()
    return target.read()


@query("stream_freeze", _FROZEN)
def stream_freeze(spark, sf):
    return _freeze(spark, _stream(spark, sf))


@query("stream_freeze_batches", _FROZEN)
def stream_freeze_batches(spark, sf):
    """The same runs in five batches, later ones first in each target: one final state."""
    return _freeze(spark, _landed(spark, _events(spark, sf), 5, 4 - F.floor(F.minute("ts") / 12)))


@query("stream_late_rows", f"""WITH {R}
SELECT source, date_trunc('hour', ts) AS bucket, round(avg(value), 8) AS value, count(*) AS n FROM r GROUP BY ALL""")
def stream_late_rows(spark, sf):
    """Rows in five files out of order, a tenth of them twice; the table equals the batch build."""
    events, path = _events(spark, sf), scratch_path(spark, "late")
    slot = (4 - F.pmod("event_id", F.lit(5)))
    again = events.filter("event_id % 10 = 0")
    rows = events.withColumn("file", slot).unionByName(again.withColumn("file", F.pmod(slot + 2, F.lit(5))))
    stream = _landed(spark, rows, 5, F.col("file")).drop("file")

    def build(day):
        bucket = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("bucket")
        return day.groupBy("source", bucket).agg(F.avg("value").alias("value"), F.count("*").alias("n"))

    flows.rebuild_days(stream, path, f"{path}/state", ["event_id"], "ts", "bucket", build).awaitTermination()
    return shown(spark.read.parquet(f"{path}/days").drop("dt"), ["value"])


@query("stream_gap_fill", f"""WITH {H}, c AS (SELECT source, ts_hour, value FROM h WHERE {_closed('ts_hour + INTERVAL 1 HOUR', '3 HOUR')}),
p AS (SELECT source, ts_hour, value, lag(ts_hour) OVER w AS pt, lag(value) OVER w AS pv FROM c WINDOW w AS (PARTITION BY source ORDER BY ts_hour))
SELECT source, ts_hour AS bucket, round(value, 8) AS value, FALSE AS synthetic FROM c
UNION ALL SELECT source, pt + i * INTERVAL 1 HOUR, round(sqrt((pv * pv + value * value) / 2), 8), TRUE
FROM p, (VALUES (1), (2)) AS s(i) WHERE ts_hour - pt = INTERVAL 3 HOUR""")
def stream_gap_fill(spark, sf):
    """Hours of five files in order of time; gaps across two batches are filled like those inside one."""
    path = scratch_path(spark, "gaps")
    stream = flows.event_time(_landed(spark, _events(spark, sf), 5, F.floor((F.dayofmonth("ts") - 1) / 7)), "ts", "3 hours")
    hours_ = flows.old_enough(stream, ["source"], "ts", ["value"]).drop("n")
    flows.fill_aged_gaps(hours_, path, f"{path}/state", ["source"], "bucket", ["value"]).awaitTermination()
    return shown(spark.read.parquet(f"{path}/rows").select("source", "bucket", "value", "synthetic"), ["value"])


@query("stream_sliding_mean", f"""WITH {R}, w AS (
  SELECT source, value, date_trunc('hour', ts) - i * INTERVAL 1 HOUR AS window_start FROM r, range(6) AS s(i)),
b AS (SELECT source, window_start, window_start + INTERVAL 6 HOUR AS window_end, avg(value) AS value FROM w GROUP BY ALL)
SELECT source, window_start, window_end, round(value, 8) AS value FROM b WHERE {_closed('window_end', '24 HOUR')}""")
def stream_sliding_mean(spark, sf):
    out = flows.sliding_means(_stream(spark, sf), ["source"], "ts", ["value"])
    return shown(flows.collected(spark, out, "sliding"), ["value"])
