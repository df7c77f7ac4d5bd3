"""Regular grids, interpolation, replication and gap rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import G, HOUR, R, SG, grid, hours, instant, query, readings, sample_grid, samples, shown
from tidewright.functions.timekeys import five_minute_key, hour_key
from tidewright.operators import grid as ops
from tidewright.operators.scan import grid_buckets

_BY = ["source"]


@query("grid_regular", f"WITH {G} SELECT source, ts_hour, round(value, 8) AS value FROM g")
def grid_regular(spark, sf):
    return shown(grid(spark, sf), ["value"])


_FIVE = """five AS (SELECT source, time_bucket(INTERVAL 5 MINUTE, ts) AS ts_5min, arg_min(value, ts) AS value
  FROM r GROUP BY ALL)"""


def _five(spark, sf):
    return readings(spark, sf).groupBy("source", five_minute_key(F.col("ts")).alias("ts_5min")).agg(
        F.min_by("value", "ts").alias("value")
    )


@query("grid_sample_vs_mean", f"""WITH {R}, {_FIVE},
h AS (SELECT source, date_trunc('hour', ts_5min) AS ts_hour, avg(value) AS mean_value,
             max(value) FILTER (WHERE minute(ts_5min) = 0) AS sample_value FROM five GROUP BY ALL),
b AS (SELECT source, min(ts_hour) AS lo, max(ts_hour) AS hi FROM h GROUP BY source),
s AS (SELECT source, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts_hour FROM b)
SELECT s.source, s.ts_hour, h.sample_value, round(h.mean_value, 8) AS mean_value
FROM s LEFT JOIN h USING (source, ts_hour)""")
def grid_sample_vs_mean(spark, sf):
    five = _five(spark, sf)
    sample = ops.regular_grid(five.withColumnRenamed("ts_5min", "ts_hour"), _BY, "ts_hour", HOUR, rolled_up=True)
    mean = five.groupBy("source", hour_key(F.col("ts_5min")).alias("ts_hour")).agg(F.round(F.avg("value"), 8).alias("mean_value"))
    return sample.withColumnRenamed("value", "sample_value").join(mean, ["source", "ts_hour"], "left")


_KNOWN = """k AS (
  SELECT source, ts_hour, value, epoch(ts_hour) / 3600.0 AS x,
    last_value(value IGNORE NULLS) OVER p AS pv, first_value(value IGNORE NULLS) OVER n AS nv,
    last_value(CASE WHEN value IS NOT NULL THEN epoch(ts_hour) / 3600.0 END IGNORE NULLS) OVER p AS px,
    first_value(CASE WHEN value IS NOT NULL THEN epoch(ts_hour) / 3600.0 END IGNORE NULLS) OVER n AS nx
  FROM g WINDOW p AS (PARTITION BY source ORDER BY ts_hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                n AS (PARTITION BY source ORDER BY ts_hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
_LINEAR = "CASE WHEN value IS NOT NULL THEN value WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (x - px) / (nx - px) END"


@query("interp_linear_limit", f"""WITH {G}, {_KNOWN}
SELECT source, ts_hour, CASE WHEN x - px <= 2 OR nx - x <= 2 THEN round({_LINEAR}, 8) END AS value FROM k""")
def interp_linear_limit(spark, sf):
    return ops.interpolate_linear(grid(spark, sf), _BY, "ts_hour", ["value"], HOUR, limit=2, digits=8)


@query("treated_refresh", f"""WITH {SG}, {_KNOWN}
SELECT source, ts_hour, CASE WHEN x - px <= 2 OR nx - x <= 2 THEN round({_LINEAR}, 8) END AS value FROM k""")
def treated_refresh(spark, sf):
    """A table filled up to a day, brought up to date with what came later; its twin fills everything at once."""
    rows = samples(spark, sf)
    cutoff = instant("2024-01-16 00:00:00")
    old = rows.filter(F.col("ts_hour") < cutoff)
    table = ops.interpolate_linear(ops.regular_grid(old, _BY, "ts_hour", HOUR), _BY, "ts_hour", ["value"], HOUR, limit=2, digits=8)
    return ops.refresh_interpolated(table, rows, _BY, "ts_hour", ["value"], HOUR, 2, cutoff, digits=8)


@query("interp_linear_unlimited", f"WITH {G}, {_KNOWN} SELECT source, ts_hour, round({_LINEAR}, 8) AS value FROM k")
def interp_linear_unlimited(spark, sf):
    return ops.interpolate_linear(grid(spark, sf), _BY, "ts_hour", ["value"], HOUR, digits=8)


@query("interp_onto_instants", f"""WITH {R}, {_FIVE},
i AS (SELECT DISTINCT source, ts_5min FROM five),
tide AS (SELECT source, time_bucket(INTERVAL 5 MINUTE, ts) AS ts_5min, avg(degrees) AS tide
         FROM r WHERE minute(ts) < 5 GROUP BY ALL),
j AS (SELECT i.source, i.ts_5min, tide.tide AS v, row_number() OVER (PARTITION BY i.source ORDER BY i.ts_5min) AS x
      FROM i LEFT JOIN tide USING (source, ts_5min)),
k AS (SELECT *, last_value(v IGNORE NULLS) OVER p AS pv, first_value(v IGNORE NULLS) OVER n AS nv,
        last_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER p AS px,
        first_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER n AS nx
  FROM j WINDOW p AS (PARTITION BY source ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                n AS (PARTITION BY source ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT source, ts_5min, round(CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
  ELSE pv + (nv - pv) * (x - px) / (nx - px) END, 5) AS tide FROM k""")
def interp_onto_instants(spark, sf):
    instants = _five(spark, sf).select("source", "ts_5min")
    tide = (
        readings(spark, sf).filter(F.minute("ts") < 5)
        .groupBy("source", five_minute_key(F.col("ts")).alias("ts_5min")).agg(F.avg("degrees").alias("tide"))
    )
    return ops.interpolate_onto(instants, tide, _BY, "ts_5min", ["tide"], grid_buckets(300), digits=5)


def _chain_sql(curve: str, enough: str) -> str:
    return f"""WITH {SG}, kn AS (
  SELECT source, ts_hour, sqrt(value) AS v, epoch(ts_hour) / 3600.0 AS x FROM g WHERE value IS NOT NULL),
ln AS (SELECT *, lag(v) OVER w AS lv, lag(x) OVER w AS lx, lead(v) OVER w AS fv, lead(x) OVER w AS fx
       FROM kn WINDOW w AS (PARTITION BY source ORDER BY ts_hour)),
j AS (SELECT g.source, g.ts_hour, sqrt(g.value) AS value, epoch(g.ts_hour) / 3600.0 AS t, ln.v, ln.x, lv, lx, fv, fx
      FROM g LEFT JOIN ln USING (source, ts_hour)),
k AS (SELECT source, ts_hour, value, t,
  last_value(v IGNORE NULLS) OVER p AS b, last_value(x IGNORE NULLS) OVER p AS xb,
  last_value(CASE WHEN v IS NOT NULL THEN struct_pack(v := lv, x := lx) END IGNORE NULLS) OVER p AS ps,
  first_value(v IGNORE NULLS) OVER n AS c, first_value(x IGNORE NULLS) OVER n AS xc,
  first_value(CASE WHEN v IS NOT NULL THEN struct_pack(v := fv, x := fx) END IGNORE NULLS) OVER n AS ns
  FROM j WINDOW p AS (PARTITION BY source ORDER BY ts_hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                n AS (PARTITION BY source ORDER BY ts_hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
q AS (SELECT *, ps.v AS a, ps.x AS xa, ns.v AS d, ns.x AS xd FROM k)
SELECT source, ts_hour, round(CASE WHEN value IS NOT NULL THEN value WHEN b IS NULL THEN c WHEN c IS NULL THEN b
  WHEN {enough} THEN {curve} ELSE b * (t - xc) / (xb - xc) + c * (t - xb) / (xc - xb) END, 6) AS value FROM q"""


_CUBIC = (
    "a*(t-xb)*(t-xc)*(t-xd)/((xa-xb)*(xa-xc)*(xa-xd)) + b*(t-xa)*(t-xc)*(t-xd)/((xb-xa)*(xb-xc)*(xb-xd))"
    " + c*(t-xa)*(t-xb)*(t-xd)/((xc-xa)*(xc-xb)*(xc-xd)) + d*(t-xa)*(t-xb)*(t-xc)/((xd-xa)*(xd-xb)*(xd-xc))"
)
_QUADRATIC = (
    "a*(t-xb)*(t-xc)/((xa-xb)*(xa-xc)) + b*(t-xa)*(t-xc)/((xb-xa)*(xb-xc)) + c*(t-xa)*(t-xb)/((xc-xa)*(xc-xb))"
)


def _rooted(spark, sf):
    """Square roots, so that no exact rounding ties blur the comparison."""
    return sample_grid(spark, sf).withColumn("value", F.sqrt("value"))


@query("interp_local_cubic", _chain_sql(_CUBIC, "a IS NOT NULL AND d IS NOT NULL"))
def interp_local_cubic(spark, sf):
    return ops.interpolate_local(_rooted(spark, sf), _BY, "ts_hour", ["value"], HOUR, order=3, digits=6)


@query("interp_local_quadratic", _chain_sql(_QUADRATIC, "a IS NOT NULL"))
def interp_local_quadratic(spark, sf):
    return ops.interpolate_local(_rooted(spark, sf), _BY, "ts_hour", ["value"], HOUR, order=2, digits=6)


@query("ffill_bfill", f"WITH {G}, {_KNOWN} SELECT source, ts_hour, round(coalesce(pv, nv), 8) AS value FROM k")
def ffill_bfill(spark, sf):
    return shown(ops.fill_gaps(grid(spark, sf), _BY, "ts_hour", ["value"], grid_buckets(HOUR)), ["value"])


@query("ffill_then_zero", f"""WITH {R}, h AS (
  SELECT date_trunc('hour', ts) AS ts_hour, avg(value) FILTER (WHERE source = 'view') AS value FROM r GROUP BY 1)
SELECT ts_hour, round(coalesce(last_value(value IGNORE NULLS) OVER (ORDER BY ts_hour), 0), 8) AS value FROM h""")
def ffill_then_zero(spark, sf):
    rows = readings(spark, sf).groupBy(hour_key(F.col("ts")).alias("ts_hour")).agg(
        F.avg(F.when(F.col("source") == "view", F.col("value"))).alias("value")
    )
    out = ops.fill_gaps(rows, [], "ts_hour", ["value"], grid_buckets(HOUR), backward_too=False, default=0.0)
    return shown(out, ["value"])


@query("replicate_12x5min", f"""WITH {G}
SELECT source, ts_hour + i * INTERVAL 5 MINUTE AS ts_5min, round(value, 8) AS value
FROM h, range(12) AS s(i)""")
def replicate_12x5min(spark, sf):
    out = ops.replicate(hours(spark, sf).withColumnRenamed("ts_hour", "ts_5min"), "ts_5min", 300, 12)
    return shown(out, ["value"])


@query("replicate_3h", f"""WITH {R}, t AS (
  SELECT source, date_trunc('hour', ts) AS src, arg_max(value, ts) AS value
  FROM r WHERE hour(ts) % 3 = 0 GROUP BY ALL),
e AS (SELECT source, src + i * INTERVAL 1 HOUR AS ts_hour, src, value FROM t, range(3) AS s(i))
SELECT source, ts_hour, arg_max(value, src) AS value FROM e GROUP BY ALL""")
def replicate_3h(spark, sf):
    three = readings(spark, sf).filter(F.hour("ts") % 3 == 0).groupBy("source", hour_key(F.col("ts")).alias("ts_hour")).agg(
        F.max_by("value", "ts").alias("value")
    )
    return ops.replicate_to_hours(three, _BY, "ts_hour", 3)


@query("rms_gap_fill", f"""WITH {G}, p AS (
  SELECT source, ts_hour, value, degrees, lag(ts_hour) OVER w AS pt, lag(value) OVER w AS pv, lag(degrees) OVER w AS pd
  FROM h WINDOW w AS (PARTITION BY source ORDER BY ts_hour))
SELECT source, pt + i * INTERVAL 1 HOUR AS ts_hour, round(sqrt((pv * pv + value * value) / 2), 8) AS value,
       round(degrees, 8) AS degrees, TRUE AS synthetic
FROM p, (VALUES (1), (2)) AS s(i) WHERE ts_hour - pt = INTERVAL 3 HOUR""")
def rms_gap_fill(spark, sf):
    out = ops.rms_gap_rows(hours(spark, sf, ("value", "degrees")), _BY, "ts_hour", ["value"], grid_buckets(HOUR))
    return shown(out, ["value", "degrees"])


@query("extend_last_row", f"""WITH {G}, n AS (
  SELECT source, max(ts_hour) AS last, arg_max(value, ts_hour) AS value FROM h GROUP BY source)
SELECT source, ts_hour, round(value, 8) AS value FROM h
UNION ALL SELECT source, TIMESTAMP '2024-01-31 02:00:00', round(value, 8) FROM n WHERE last < TIMESTAMP '2024-01-31 02:00:00'""")
def extend_last_row(spark, sf):
    return shown(ops.extend_last_row(hours(spark, sf), _BY, "ts_hour", instant("2024-01-31 02:00:00")), ["value"])


@query("append_future", f"""WITH {G}
SELECT ts_hour, round(value, 8) AS value, NULL::DOUBLE AS degrees FROM h
WHERE source = 'click' AND ts_hour <= TIMESTAMP '2024-01-20 00:00:00'
UNION ALL SELECT ts_hour, NULL, round(degrees, 8) FROM h
WHERE source = 'view' AND ts_hour > TIMESTAMP '2024-01-20 00:00:00' AND ts_hour <= TIMESTAMP '2024-01-20 14:00:00'""")
def append_future(spark, sf):
    rows = hours(spark, sf, ("value", "degrees"))
    start = instant("2024-01-20 00:00:00")
    past = rows.filter((F.col("source") == "click") & (F.col("ts_hour") <= start)).select("ts_hour", "value")
    outlook = rows.filter(F.col("source") == "view").select("ts_hour", "degrees")
    return shown(ops.append_future(past, outlook, "ts_hour", start), ["value", "degrees"])


@query("sorted_distinct_instants", f"WITH {R} SELECT DISTINCT time_bucket(INTERVAL 5 MINUTE, ts) AS ts_5min FROM r ORDER BY 1")
def sorted_distinct_instants(spark, sf):
    return readings(spark, sf).select(five_minute_key(F.col("ts")).alias("ts_5min")).distinct().orderBy("ts_5min")
