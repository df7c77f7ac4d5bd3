"""Directions, lags, leads, moving means, targets, filters and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import HOUR, R, S, SG, SOURCES, query, readings, sample_grid, samples, shown, table
from tidewright.functions.cleaning import finite_or_zero
from tidewright.functions.direction import compass_label, flow_sign, sector_number, signed_by_degrees, signed_by_label
from tidewright.operators import features as ops
from tidewright.operators.grid import regular_grid
from tidewright.operators.joins import pivot_columns, pivot_series
from tidewright.operators.scan import halo_window
from tidewright.operators.shaping import complete_cases, drop_dead_rows, drop_zero, narrow_to_float

_BY = ["source"]

_POINTS = "['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW']"
_LABEL = f"{_POINTS}[(CAST(floor((degrees % 360) / 22.5 + 0.5) AS INTEGER) % 16) + 1]"
_EBB = "('E','SE','SSE','S','SSW','SW','WSW')"


@query("direction_compass", f"WITH {R} SELECT event_id, round(degrees, 8) AS degrees, {_LABEL} AS label FROM r")
def direction_compass(spark, sf):
    out = readings(spark, sf).select("event_id", "degrees", compass_label(F.col("degrees")).alias("label"))
    return shown(out, ["degrees"])


@query("direction_sector", f"WITH {R} SELECT event_id, round_even(degrees / 22.5, 0) % 16 AS sector FROM r")
def direction_sector(spark, sf):
    return readings(spark, sf).select("event_id", sector_number(F.col("degrees")).alias("sector"))


@query("ebb_flood", f"""WITH {R}
SELECT event_id, CASE WHEN {_LABEL} IN {_EBB} THEN -1 ELSE 1 END AS flow FROM r""")
def ebb_flood(spark, sf):
    return readings(spark, sf).select("event_id", flow_sign(compass_label(F.col("degrees"))).alias("flow"))


@query("signed_intensity", f"""WITH {R}
SELECT event_id, value * CASE WHEN {_LABEL} IN {_EBB} THEN -1 ELSE 1 END AS by_label,
       CASE WHEN degrees > 90 AND degrees < 270 THEN -value ELSE value END AS by_degrees FROM r""")
def signed_intensity(spark, sf):
    label = compass_label(F.col("degrees"))
    return readings(spark, sf).select(
        "event_id",
        signed_by_label(F.col("value"), label).alias("by_label"),
        signed_by_degrees(F.col("value"), F.col("degrees")).alias("by_degrees"),
    )


_W = "WINDOW w AS (PARTITION BY source ORDER BY ts_hour)"


def _windowed(spark, sf, before, after, build):
    cells = sample_grid(spark, sf)
    out = halo_window(cells, _BY, "ts_hour", HOUR, before, after, build)
    added = [c for c in out.columns if c not in cells.columns]
    return shown(out.drop("value"), added)


@query("lags", f"WITH {SG} SELECT source, ts_hour, "
       + ", ".join(f"round(lag(value, {n}) OVER w, 8) AS value_lag{n}" for n in range(1, 6)) + f" FROM g {_W}")
def lags(spark, sf):
    return _windowed(spark, sf, 5, 0, lambda w: ops.lag_columns(w, ["value"], range(1, 6)))


@query("leads", f"WITH {SG} SELECT source, ts_hour, "
       + ", ".join(f"round(lead(value, {n}) OVER w, 8) AS value_lead{n}" for n in range(1, 6)) + f" FROM g {_W}")
def leads(spark, sf):
    return _windowed(spark, sf, 0, 5, lambda w: ops.lead_columns(w, ["value"], range(1, 6)))


def _mean_sql(w: int, column: str = "value") -> str:
    frame = f"(PARTITION BY source ORDER BY ts_hour ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    return (f"round(CASE WHEN count({column}) OVER {frame} = {w} THEN avg({column}) OVER {frame} END, 8)"
            f" AS {column}_ma{w}")


@query("moving_mean_short", f"WITH {SG} SELECT source, ts_hour, {_mean_sql(3)}, {_mean_sql(6)} FROM g")
def moving_mean_short(spark, sf):
    return _windowed(spark, sf, 6, 0, lambda w: ops.moving_mean_columns(w, ["value"], [3, 6]))


@query("moving_mean_long", f"WITH {SG} SELECT source, ts_hour, {_mean_sql(12)}, {_mean_sql(24)}, {_mean_sql(48)} FROM g")
def moving_mean_long(spark, sf):
    return _windowed(spark, sf, 48, 0, lambda w: ops.moving_mean_columns(w, ["value"], [12, 24, 48]))


@query("targets_h1_h2", f"""WITH {SG} SELECT source, ts_hour, round(lead(value, 1) OVER w, 8) AS value_h1,
       round(lead(value, 2) OVER w, 8) AS value_h2 FROM g {_W}""")
def targets_h1_h2(spark, sf):
    return _windowed(spark, sf, 0, 2, lambda w: ops.target_columns(w, ["value"], [1, 2]))


@query("targets_h1_to_h6", f"WITH {SG} SELECT source, ts_hour, "
       + ", ".join(f"round(lead(value, {n}) OVER w, 8) AS value_h{n}" for n in range(1, 7)) + f" FROM g {_W}")
def targets_h1_to_h6(spark, sf):
    return _windowed(spark, sf, 0, 6, lambda w: ops.target_columns(w, ["value"], range(1, 7)))


SPEC = ops.FeatureSpec(
    base=("value", "degrees"), targets=("value",), lead_base=("degrees",), long_base=("degrees",),
)


def _matrix_sql() -> str:
    wins = "WINDOW w AS (PARTITION BY source ORDER BY ts_hour)"
    parts = [f"lag({c}, {n}) OVER w AS {c}_lag{n}" for n in SPEC.lags for c in SPEC.base]
    for width in (*SPEC.short_means, *SPEC.long_means):
        for c in SPEC.base if width in SPEC.short_means else SPEC.long_base:
            frame = f"(PARTITION BY source ORDER BY ts_hour ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING)"
            parts.append(f"CASE WHEN count({c}) OVER {frame} = {width} THEN avg({c}) OVER {frame} END AS {c}_ma{width}")
    parts += [f"lead({c}, {n}) OVER w AS {c}_lead{n}" for n in SPEC.leads for c in SPEC.lead_base]
    parts += [f"lead({c}, {h}) OVER w AS {c}_h{h}" for c in SPEC.targets for h in SPEC.horizons]
    names = SPEC.feature_names() + SPEC.target_names()
    keep = " AND ".join(f"{n} IS NOT NULL" for n in names)
    shown_names = ", ".join(f"round({n}, 8) AS {n}" for n in names)
    return (f"WITH {SG}, z AS (SELECT source, ts_hour, coalesce(value, 0) AS value, coalesce(degrees, 0) AS degrees FROM g),"
            f" f AS (SELECT source, ts_hour, {', '.join(parts)} FROM z {wins})"
            f" SELECT source, ts_hour, {shown_names} FROM f WHERE {keep}")


def filled_grid(spark, sf):
    cells = sample_grid(spark, sf, ("value", "degrees"))
    return narrow_to_float(cells, ["source", "ts_hour"], "double")


@query("feature_matrix", _matrix_sql())
def feature_matrix(spark, sf):
    out = ops.feature_matrix(filled_grid(spark, sf), _BY, "ts_hour", HOUR, SPEC)
    return shown(out.drop("value", "degrees"), SPEC.feature_names() + SPEC.target_names())


def wide_grid(spark, sf):
    """One row per hour with a column per source: a single series, as in the training table."""
    rows = samples(spark, sf, ("value", "degrees"))
    wide = rows.groupBy("ts_hour").agg(
        *pivot_columns("source", "value", SOURCES, "rain_"), *pivot_columns("source", "degrees", SOURCES, "dir_")
    )
    cells = regular_grid(wide, [], "ts_hour", HOUR, rolled_up=True)
    return narrow_to_float(cells, ["ts_hour"], "double")


WIDE_SPEC = ops.FeatureSpec(
    base=tuple(f"rain_{s}" for s in SOURCES) + tuple(f"dir_{s}" for s in SOURCES),
    targets=("rain_click", "rain_error", "rain_view"),
    lead_base=tuple(f"dir_{s}" for s in SOURCES),
    long_base=("rain_purchase", "rain_signup"),
)


def single_series_columns(spec) -> list[str]:
    """SQL of all features and targets of ``spec`` over one series ordered by ``ts_hour`` (window ``w``)."""
    parts = [f"lag({c}, {n}) OVER w AS {c}_lag{n}" for n in spec.lags for c in spec.base]
    for width in (*spec.short_means, *spec.long_means):
        for c in spec.base if width in spec.short_means else spec.long_base:
            frame = f"(ORDER BY ts_hour ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING)"
            parts.append(f"CASE WHEN count({c}) OVER {frame} = {width} THEN avg({c}) OVER {frame} END AS {c}_ma{width}")
    parts += [f"lead({c}, {n}) OVER w AS {c}_lead{n}" for n in spec.leads for c in spec.lead_base]
    parts += [f"lead({c}, {h}) OVER w AS {c}_h{h}" for c in spec.targets for h in spec.horizons]
    return parts


def _wide_sql() -> str:
    spec = WIDE_SPEC
    picks = ", ".join(
        [f"coalesce(avg(value) FILTER (WHERE source = '{s}'), 0) AS rain_{s}" for s in SOURCES]
        + [f"coalesce(avg(degrees) FILTER (WHERE source = '{s}'), 0) AS dir_{s}" for s in SOURCES]
    )
    parts = single_series_columns(spec)
    names = spec.feature_names() + spec.target_names()
    return (f"WITH {S}, b AS (SELECT min(ts_hour) AS lo, max(ts_hour) AS hi FROM h),"
            f" s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts_hour FROM b),"
            f" p AS (SELECT s.ts_hour, {picks} FROM s LEFT JOIN h ON h.ts_hour = s.ts_hour GROUP BY s.ts_hour),"
            f" f AS (SELECT ts_hour, rain_click + rain_error + rain_view AS live, {', '.join(parts)} FROM p WINDOW w AS (ORDER BY ts_hour))"
            f" SELECT ts_hour, {', '.join(f'round({n}, 8) AS {n}' for n in names)} FROM f"
            f" WHERE live <> 0 AND {' AND '.join(f'{n} IS NOT NULL' for n in names)}")


@query("feature_matrix_single_series", _wide_sql())
def feature_matrix_single_series(spark, sf):
    out = ops.feature_matrix(wide_grid(spark, sf), [], "ts_hour", HOUR, WIDE_SPEC)
    live = drop_dead_rows(out, WIDE_SPEC.targets)
    names = WIDE_SPEC.feature_names() + WIDE_SPEC.target_names()
    return shown(live.select("ts_hour", *names), names)


_SEQ = "(PARTITION BY source ORDER BY ts_hour ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)"


@query("sequence_windows", f"""WITH {SG}, z AS (
  SELECT source, ts_hour, coalesce(value, 0) AS value, coalesce(degrees, 0) AS degrees FROM g),
w AS (SELECT source, ts_hour, list([value, degrees]) OVER {_SEQ} AS s FROM z)
SELECT source, ts_hour, CAST(len(s) AS BIGINT) AS steps, round(s[1][1], 2) AS oldest, round(s[6][2], 2) AS newest_degrees,
       round(list_sum(list_transform(s, lambda x: x[1])), 2) AS total
FROM w WHERE len(s) = 6""")
def sequence_windows(spark, sf):
    out = ops.sequence_windows(filled_grid(spark, sf), _BY, "ts_hour", HOUR, ["value", "degrees"])
    total = F.aggregate("sequence", F.lit(0.0), lambda a, x: a + x[0].cast("double"))
    return out.select(
        "source", "ts_hour", F.size("sequence").cast("long").alias("steps"),
        F.round(F.col("sequence")[0][0].cast("double"), 2).alias("oldest"),
        F.round(F.col("sequence")[5][1].cast("double"), 2).alias("newest_degrees"),
        F.round(total, 2).alias("total"),
    )


@query("zero_sum_filter", f"""WITH {S}, p AS (
  SELECT ts_hour, coalesce(max(value) FILTER (WHERE source = 'click'), 0) AS a,
         -coalesce(max(value) FILTER (WHERE source = 'click'), 0) AS b,
         coalesce(max(value) FILTER (WHERE source = 'view'), 0) AS c FROM h GROUP BY ts_hour)
SELECT ts_hour, round(a, 8) AS a, round(b, 8) AS b, round(c, 8) AS c FROM p WHERE a + b + c <> 0""")
def zero_sum_filter(spark, sf):
    wide = pivot_series(samples(spark, sf), ["ts_hour"], "source", "value", ("click", "view"))
    click, view = F.coalesce("click", F.lit(0.0)), F.coalesce("view", F.lit(0.0))
    rows = wide.select("ts_hour", click.alias("a"), (-click).alias("b"), view.alias("c"))
    return shown(drop_dead_rows(rows, ["a", "b", "c"]), ["a", "b", "c"])


@query("drop_zero_future", f"""WITH {SG}, f AS (
  SELECT source, ts_hour, lead(coalesce(value, 0)) OVER w AS value_h1 FROM g {_W})
SELECT source, ts_hour, round(value_h1, 8) AS value_h1 FROM f WHERE value_h1 <> 0""")
def drop_zero_future(spark, sf):
    cells = filled_grid(spark, sf).drop("degrees")
    out = halo_window(cells, _BY, "ts_hour", HOUR, 0, 1, lambda w: ops.target_columns(w, ["value"], [1]))
    return shown(drop_zero(out, "value_h1").drop("value"), ["value_h1"])


@query("complete_cases", f"WITH {S}, p AS (SELECT ts_hour, "
       + ", ".join(f"round(max(value) FILTER (WHERE source = '{s}'), 8) AS {s}" for s in SOURCES)
       + f" FROM h GROUP BY ts_hour) SELECT * FROM p WHERE {' AND '.join(f'{s} IS NOT NULL' for s in SOURCES)}")
def complete_rows(spark, sf):
    wide = pivot_series(samples(spark, sf), ["ts_hour"], "source", "value", SOURCES)
    return shown(complete_cases(wide), SOURCES)


@query("nan_to_zero", f"""WITH {R} SELECT event_id,
  CASE WHEN source IN ('click', 'error', 'view') THEN 0.0 ELSE value END AS value FROM r""")
def nan_to_zero(spark, sf):
    broken = (
        F.when(F.col("source") == "click", F.lit(float("nan")))
        .when(F.col("source") == "error", F.lit(float("inf")))
        .when(F.col("source") == "view", F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    return readings(spark, sf).select("event_id", finite_or_zero(broken).alias("value"))


_FIT = "fit AS (SELECT source, min(value) AS lo, max(value) AS hi FROM r WHERE ts < TIMESTAMP '2024-01-25' GROUP BY source)"


@query("minmax_fit_apply", f"""WITH {R}, {_FIT}
SELECT event_id, r.source, round((value - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END, 8) AS value
FROM r JOIN fit ON fit.source = r.source""")
def minmax_fit_apply(spark, sf):
    rows = readings(spark, sf).select("event_id", "source", "ts", "value")
    fit = ops.fit_min_max(rows.filter(F.col("ts") < F.lit("2024-01-25").cast("timestamp_ntz")), ["value"], _BY)
    return shown(ops.scale_min_max(rows, fit, ["value"], _BY).drop("ts"), ["value"])


@query("minmax_inverse", f"""WITH {R} SELECT event_id, round(value, 8) AS value, round(degrees, 8) AS degrees,
  round((value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER () + 1e-8), 8) AS scaled FROM r""")
def minmax_inverse(spark, sf):
    rows = readings(spark, sf).select("event_id", "value", "degrees")
    fit = ops.fit_min_max(rows, ["value", "degrees"])
    scaled = ops.scale_min_max(rows, fit, ["value", "degrees"], epsilon=1e-8).withColumn("scaled", F.col("value"))
    return shown(ops.unscale_min_max(scaled, fit, ["value", "degrees"], epsilon=1e-8), ["value", "degrees", "scaled"])


@query("variance_screen", """
SELECT column_name, round(variance, 8) AS variance, variance > 1e-4 AS kept FROM (
  SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'flat']) AS column_name,
         unnest([var_pop(l_quantity), var_pop(l_discount), var_pop(l_tax), 0.0]) AS variance FROM lineitem)""")
def variance_screen(spark, sf):
    items = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", F.lit(1.0).alias("flat"))
    out = ops.column_variances(items, items.columns)
    return out.select("column_name", F.round("variance", 8).alias("variance"), (F.col("variance") > 1e-4).alias("kept"))
