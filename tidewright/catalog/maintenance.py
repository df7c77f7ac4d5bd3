"""Upserts, rolling refresh, schema growth and table round trips."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tidewright.catalog.base import H, R, hours, instant, query, readings, shown, table
from tidewright.functions.timekeys import hour_key
from tidewright.operators.shaping import conform, drop_all_null, drop_matching, drop_prefixed, ensure_columns, mapped_scan, overlay, stringify, suffix_columns
from tidewright.session import scratch_path
from tidewright.sinks import maintain as ops
from tidewright.sources.tables import scan_days

_NOW = "2024-01-15 10:00:00"


def _forecasts(spark, sf):
    """A stored forecast table (click hours, every third frozen) and a later run (view hours)."""
    rolled = hours(spark, sf)
    stored = rolled.filter(F.col("source") == "click").select(
        "ts_hour", F.col("value").alias("dynamic"),
        F.when(F.hour("ts_hour") % 3 == 0, F.col("value")).alias("frozen"),
        instant("2024-01-01 00:00:00").alias("updated_at"),
    )
    run = rolled.filter(F.col("source") == "view").select("ts_hour", "value")
    return stored, run


_STORED = f"""WITH {H}, s AS (
  SELECT ts_hour, value AS dynamic, CASE WHEN hour(ts_hour) % 3 = 0 THEN value END AS frozen,
         TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM h WHERE source = 'click'),
n AS (SELECT ts_hour, value FROM h WHERE source = 'view')"""
_LEAD = f"trunc((epoch(ts_hour) - epoch(TIMESTAMP '{_NOW}')) / 60)"


@query("merge_freeze", f"""{_STORED}
SELECT ts_hour, round(coalesce(value, dynamic), 8) AS dynamic,
  round(coalesce(frozen, CASE WHEN {_LEAD} BETWEEN 90 AND 150 THEN value END), 8) AS frozen,
  CASE WHEN value IS NOT NULL THEN TIMESTAMP '{_NOW}' ELSE updated_at END AS updated_at
FROM s FULL JOIN n USING (ts_hour)""")
def merge_freeze(spark, sf):
    stored, run = _forecasts(spark, sf)
    return shown(ops.merge_freeze(stored, run, "ts_hour", "value", instant(_NOW)), ["dynamic", "frozen"])


@query("merge_coalesce", f"""{_STORED}
SELECT ts_hour, round(coalesce(value, dynamic), 8) AS dynamic, round(coalesce(frozen, value / 2), 8) AS frozen,
       CASE WHEN value IS NOT NULL THEN TIMESTAMP '{_NOW}' ELSE updated_at END AS updated_at
FROM s FULL JOIN n USING (ts_hour)""")
def merge_coalesce(spark, sf):
    stored, run = _forecasts(spark, sf)
    new = run.select(
        "ts_hour", F.col("value").alias("dynamic"), (F.col("value") / 2).alias("frozen"), instant(_NOW).alias("updated_at")
    )
    out = ops.merge_keep_first(stored, new, ["ts_hour"], ["dynamic", "updated_at"], ["frozen"])
    return shown(out, ["dynamic", "frozen"])


@query("update_from", f"""{_STORED}
SELECT ts_hour, round(dynamic, 8) AS dynamic,
  round(CASE WHEN n.value IS NOT NULL AND ts_hour >= TIMESTAMP '2024-01-20' THEN n.value ELSE frozen END, 8) AS frozen, updated_at
FROM s LEFT JOIN n USING (ts_hour)""")
def update_from(spark, sf):
    stored, run = _forecasts(spark, sf)
    out = ops.update_from(stored, run, ["ts_hour"], {"frozen": "value"}, F.col("ts_hour") >= instant("2024-01-20"))
    return shown(out, ["dynamic", "frozen"])


@query("upsert_one_column", f"""{_STORED}
SELECT ts_hour, round(coalesce(value, dynamic), 8) AS dynamic, round(frozen, 8) AS frozen, updated_at
FROM s FULL JOIN n USING (ts_hour)""")
def upsert_one_column(spark, sf):
    stored, run = _forecasts(spark, sf)
    out = ops.upsert_columns(stored, run.withColumnRenamed("value", "dynamic"), ["ts_hour"], ["dynamic"])
    return shown(out, ["dynamic", "frozen"])


@query("rolling_refresh", f"""WITH {H}, c AS (SELECT max(ts_hour) - INTERVAL 24 HOUR AS cutoff FROM h WHERE source = 'click')
SELECT ts_hour, 'old' AS origin, round(value, 8) AS value FROM h, c WHERE source = 'click' AND ts_hour < cutoff
UNION ALL SELECT ts_hour, 'new', round(value, 8) FROM h, c WHERE source = 'view' AND ts_hour >= cutoff""")
def rolling_refresh(spark, sf):
    rolled = hours(spark, sf)
    stored = rolled.filter(F.col("source") == "click").select("ts_hour", F.lit("old").alias("origin"), "value")
    rebuilt = rolled.filter(F.col("source") == "view").select("ts_hour", F.lit("new").alias("origin"), "value")
    return shown(ops.rolling_refresh(stored, rebuilt, "ts_hour", ops.cutoff_before_newest(stored, "ts_hour", 24)), ["value"])


@query("union_evolve", f"""WITH {R}
SELECT event_id, value, NULL::DOUBLE AS degrees FROM r WHERE ts < TIMESTAMP '2024-01-10'
UNION ALL SELECT event_id, value, round(degrees, 8) FROM r WHERE ts >= TIMESTAMP '2024-01-10'""")
def union_evolve(spark, sf):
    rows, cut = readings(spark, sf), instant("2024-01-10")
    stored = rows.filter(F.col("ts") < cut).select("event_id", "value")
    return shown(ops.grow_schema(stored, rows.filter(F.col("ts") >= cut).select("event_id", "value", "degrees")), ["degrees"])


@query("append_and_dedupe", f"""WITH {R}, a AS (
  SELECT source, date_trunc('hour', ts) AS ts_hour, ts, value FROM r WHERE ts < TIMESTAMP '2024-01-20'
  UNION ALL SELECT source, date_trunc('hour', ts), ts, value FROM r WHERE ts >= TIMESTAMP '2024-01-18')
SELECT DISTINCT source, ts_hour, ts, value FROM a QUALIFY row_number() OVER (PARTITION BY source, ts_hour ORDER BY ts DESC) = 1""")
def append_and_dedupe(spark, sf):
    rows = readings(spark, sf).select("source", hour_key(F.col("ts")).alias("ts_hour"), "ts", "value")
    return ops.append_and_dedupe(
        rows.filter(F.col("ts") < instant("2024-01-20")), rows.filter(F.col("ts") >= instant("2024-01-18")),
        ["source", "ts_hour"], ["ts", "value"],
    )


@query("mapped_scan", """SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(38, 9)) AS price,
  CAST(o_orderdate AS DATE) AS day, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority FROM orders""")
def mapped(spark, sf):
    orders = table(spark, sf, "orders").withColumn("p1", F.substring("o_orderpriority", 1, 1))
    return mapped_scan(orders, {
        "o_orderkey": ("id", "bigint"), "o_totalprice": ("price", "decimal(38,9)"),
        "o_orderdate": ("day", "date"), "p1": ("priority", "double"),
    })


@query("conform_schema", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_acctbal, NULL::VARCHAR AS estacao,
  TRY_CAST(c_mktsegment AS DOUBLE) AS c_mktsegment FROM customer""")
def conform_schema(spark, sf):
    target = T.StructType([
        T.StructField("c_custkey", T.StringType()), T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("estacao", T.StringType()), T.StructField("c_mktsegment", T.DoubleType()),
    ])
    return conform(table(spark, sf, "customer"), target)


@query("stringify", """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
  coalesce(CASE WHEN s_nationkey > 10 THEN CAST(s_nationkey AS VARCHAR) END, '') AS s_nationkey FROM supplier""")
def stringified(spark, sf):
    rows = table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", F.when(F.col("s_nationkey") > 10, F.col("s_nationkey")).alias("s_nationkey")
    )
    return stringify(rows)


@query("shape_columns", """SELECT c_custkey, c_name AS c_name_ow, c_acctbal AS c_acctbal_ow, 0.0 AS rain FROM customer""")
def shape_columns(spark, sf):
    rows = table(spark, sf, "customer").withColumns({
        "valid_name": F.lit(True), "wind_dir_deg": F.lit(1.0), "empty": F.lit(None).cast("double"),
    })
    trimmed = drop_matching(drop_prefixed(rows, "valid_"), ["c_nationkey", "c_mktsegment"], ["wind_dir"])
    return ensure_columns(suffix_columns(drop_all_null(trimmed), "ow", ["c_custkey"]), ["rain"])


@query("overlay_freshest", f"""WITH {R}, last AS (SELECT user_id, arg_max(value, ts) AS value, arg_max(degrees, ts) AS degrees
  FROM r WHERE ts < TIMESTAMP '2024-01-20' GROUP BY user_id),
now AS (SELECT user_id, avg(value) AS value FROM r WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-20 12:00:00' GROUP BY user_id)
SELECT user_id, round(coalesce(now.value, last.value), 8) AS value, round(degrees, 8) AS degrees
FROM last LEFT JOIN now USING (user_id)""")
def overlay_freshest(spark, sf):
    rows, cut = readings(spark, sf), instant("2024-01-20")
    last = rows.filter(F.col("ts") < cut).groupBy("user_id").agg(
        F.max_by("value", "ts").alias("value"), F.max_by("degrees", "ts").alias("degrees")
    )
    now = rows.filter((F.col("ts") >= cut) & (F.col("ts") < instant("2024-01-20 12:00:00"))).groupBy("user_id").agg(F.avg("value").alias("value"))
    return shown(overlay(last, now, ["user_id"], ["value"]), ["value", "degrees"])


@query("partitioned_days", f"""WITH {R} SELECT event_id, ts, source, value FROM r
WHERE ts >= TIMESTAMP '2024-01-12 06:00:00' AND ts < TIMESTAMP '2024-01-13 18:00:00'""")
def partitioned_days(spark, sf):
    path = scratch_path(spark, "days")
    ops.write_days(readings(spark, sf).select("event_id", "ts", "source", "value"), path, "ts")
    return scan_days(spark, path, "ts", instant("2024-01-12 06:00:00"), instant("2024-01-13 18:00:00"))


@query("versioned_merge", f"""{_STORED}
SELECT ts_hour, round(coalesce(value, dynamic), 8) AS dynamic,
  round(coalesce(frozen, CASE WHEN {_LEAD} BETWEEN 90 AND 150 THEN value END), 8) AS frozen,
  CASE WHEN value IS NOT NULL THEN TIMESTAMP '{_NOW}' ELSE updated_at END AS updated_at
FROM s FULL JOIN n USING (ts_hour)""")
def versioned_merge(spark, sf):
    """The same run applied twice through published snapshots changes nothing more."""
    stored, run = _forecasts(spark, sf)
    target = ops.VersionedTable(spark, scratch_path(spark, "forecasts"))
    target.publish(stored)
    for _ in range(2):
        target.publish(ops.merge_freeze(target.read(), run, "ts_hour", "value", instant(_NOW)))
    return shown(target.read(), ["dynamic", "frozen"])


@query("rewritten_rows", f"WITH {R} SELECT event_id, source, value FROM r")
def rewritten_rows(spark, sf):
    """Written whole, overwritten by the even rows, the odd ones appended: every row once."""
    path = scratch_path(spark, "rewritten")
    rows = readings(spark, sf).select("event_id", "source", "value")
    ops.overwrite_rows(rows, path)
    ops.overwrite_rows(rows.filter(F.col("event_id") % 2 == 0), path)
    ops.append_rows(rows.filter(F.col("event_id") % 2 != 0), path)
    return spark.read.parquet(path)


@query("staged_columns", f"""WITH {R}
SELECT event_id AS id, source, CAST(value AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS note, date_trunc('hour', ts) AS ts_hour FROM r""")
def staged_columns(spark, sf):
    """A column added, one retyped to text, staged with a fixed schema and read through a view."""
    rows = readings(spark, sf).select("event_id", "source", "value", "ts")
    grown = ops.change_type(ops.add_column(ops.add_column(rows, "note", "string"), "value", "double"), "value", "string")
    ops.stage_run(grown, "staged_run", {
        "id": ("event_id", "bigint"), "source": ("source", "string"), "value": ("value", "double"), "note": ("note", "string"),
        "ts": ("ts", "timestamp_ntz")})
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts_hour")
    ops.define_view(spark.table("staged_run").select("id", "source", "value", "note", hour), "staged_hours")
    return spark.table("staged_hours")
