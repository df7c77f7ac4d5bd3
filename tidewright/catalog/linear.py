"""The forecasting family with a learner that SQL can state: least squares on the hourly series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import HOUR, S, query
from tidewright.catalog.features import wide_grid
from tidewright.operators.evaluate import chronological_split, error_metrics
from tidewright.operators.features import FeatureSpec, feature_matrix
from tidewright.operators.forecast import degradation, recursive_forecast, with_truth
from tidewright.operators.least_squares import fit_least_squares
from tidewright.operators.rollup import collapse_runs
from tidewright.operators.scan import grid_buckets

TS, STEPS = "ts_hour", 6
SPEC = FeatureSpec(base=("rain_click", "rain_view", "dir_click"), targets=("rain_click", "rain_view"), lead_base=("dir_click",),
                   lags=(1, 2), short_means=(6,), leads=(1,))
_FEATURES, _TARGETS = SPEC.feature_names(), SPEC.target_names()
_P, _Q = len(_FEATURES), len(_TARGETS)


def _fitted(spark, sf):
    matrix = feature_matrix(wide_grid(spark, sf), [], TS, HOUR, SPEC)
    tagged = chronological_split(matrix, [], [TS], grid_buckets(HOUR, 168))
    models = fit_least_squares(tagged.filter(F.col("split") == "train"), _FEATURES, _TARGETS)
    return models, tagged.filter(F.col("split") == "test")


def _forecasts(spark, sf, advance=1):
    models, _ = _fitted(spark, sf)
    return recursive_forecast(wide_grid(spark, sf), [], TS, HOUR, SPEC, models, steps=STEPS, advance=advance)


def _columns() -> str:
    parts = [f"lag({c}, {n}) OVER w AS {c}_lag{n}" for n in SPEC.lags for c in SPEC.base]
    for width in SPEC.short_means:
        frame = f"(ORDER BY ts_hour ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING)"
        parts += [f"CASE WHEN count(*) OVER {frame} = {width} THEN avg({c}) OVER {frame} END AS {c}_ma{width}" for c in SPEC.base]
    parts += [f"lead({c}, {n}) OVER w AS {c}_lead{n}" for n in SPEC.leads for c in SPEC.lead_base]
    return ", ".join(parts + [f"lead({c}, {h}) OVER w AS {c}_h{h}" for c in SPEC.targets for h in SPEC.horizons])


_PICKS = ", ".join(f"coalesce(any_value({v}) FILTER (WHERE source = '{s}'), 0) AS {c}" for c, v, s in (
    ("rain_click", "value", "click"), ("rain_view", "value", "view"), ("dir_click", "degrees", "click")))
_COMPLETE = " AND ".join(f"{n} IS NOT NULL" for n in _FEATURES + _TARGETS)
#: Grid p, matrix m with its split, covariances c, Gauss-Jordan elimination e, weights v (the last one is the constant).
_FIT = f"""{S}, b AS (SELECT min(ts_hour) AS lo, max(ts_hour) AS hi FROM h),
hours AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts_hour FROM b),
p AS (SELECT hours.ts_hour, {_PICKS} FROM hours LEFT JOIN h ON h.ts_hour = hours.ts_hour GROUP BY hours.ts_hour),
f AS (SELECT *, {_columns()} FROM p WINDOW w AS (ORDER BY ts_hour)),
m AS (SELECT *, row_number() OVER (ORDER BY ts_hour) AS i, count(*) OVER () AS n FROM f WHERE {_COMPLETE}),
z AS (SELECT [{', '.join(_FEATURES + _TARGETS)}] AS z FROM m WHERE i <= floor(n * 0.8)),
c AS (SELECT a, b, covar_pop(z[a], z[b]) AS v FROM z, range(1, {_P + _Q + 1}) AS x(a), range(1, {_P + _Q + 1}) AS y(b) GROUP BY a, b),
e(k, g) AS (
  SELECT 0, list(r ORDER BY a) FROM (SELECT a, list(v ORDER BY b) AS r FROM c WHERE a <= {_P} GROUP BY a)
  UNION ALL
  SELECT k + 1, list_transform(g, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda x: x / r[k + 1])
      ELSE list_transform(range(1, {_P + _Q + 1}), lambda j: r[j] - r[k + 1] * g[k + 1][j] / g[k + 1][k + 1]) END)
  FROM e WHERE k < {_P}),
mean AS (SELECT list(v ORDER BY a) AS u FROM (SELECT a, avg(z[a]) AS v FROM z, range(1, {_P + _Q + 1}) AS x(a) GROUP BY a)),
v AS (SELECT """ + ", ".join(
    f"list_transform(range(1, {_P + 1}), lambda i: g[i][{_P + t}]) AS w{t}" for t in range(1, _Q + 1)) + f""", u FROM e, mean WHERE k = {_P}),
k AS (SELECT """ + ", ".join(
    f"w{t}, u[{_P + t}] - list_dot_product(w{t}, u[1:{_P}]) AS c{t}" for t in range(1, _Q + 1)) + " FROM v)"
_PREDICTED = {name: f"list_dot_product(w{t}, x) + c{t}" for t, name in enumerate(_TARGETS, start=1)}


def _recursion(advance: int) -> str:
    """Every hour with six before and six after it as origin; ``advance`` horizons a round."""
    depth, first = SPEC.short_means[0], SPEC.leads[0]
    values = {"rain_click": "hc", "rain_view": "hv"}
    now = {"rain_click": "cc", "rain_view": "cv"}
    x = [f"{values[c]}[-{n}]" if c in values else f"{c}_lag{n}" for n in SPEC.lags for c in SPEC.base]
    x += [f"list_sum({values[c]}) / {depth}" if c in values else f"{c}_ma{depth}" for c in SPEC.base] + [f"dir_click_lead{first}"]
    preds = {c: [_PREDICTED[f"{c}_h{h}"] for h in range(1, advance + 1)] for c in SPEC.targets}
    moved = {c: f"list_concat({values[c]}[{advance + 1}:], [{', '.join([now[c], *preds[c][:-1]])}])" for c in SPEC.targets}
    a, b = SPEC.targets
    return f"""WITH RECURSIVE {_FIT},
o AS (SELECT *, row_number() OVER (ORDER BY ts_hour) AS i, count(*) OVER () AS n, list(rain_click) OVER q AS hc, list(rain_view) OVER q AS hv
      FROM f WINDOW q AS (ORDER BY ts_hour ROWS BETWEEN {depth} PRECEDING AND 1 PRECEDING)),
s(origin, done, hc, hv, cc, cv, pc, pv) AS (
  SELECT ts_hour, 0, hc, hv, rain_click, rain_view, CAST([] AS DOUBLE[]), CAST([] AS DOUBLE[]) FROM o WHERE i > {depth} AND i + {STEPS - 1 + first} <= n
  UNION ALL
  SELECT origin, done + {advance}, {moved[a]}, {moved[b]}, {preds[a][-1]}, {preds[b][-1]}, list_concat(pc, [{', '.join(preds[a])}]), list_concat(pv, [{', '.join(preds[b])}])
  FROM (SELECT s.*, [{', '.join(x)}] AS x, k.* FROM s JOIN (SELECT ts_hour, {', '.join(n for n in _FEATURES if n.startswith('dir'))} FROM f) f
        ON f.ts_hour = s.origin + s.done * INTERVAL 1 HOUR, k WHERE s.done < {STEPS})),
made AS (SELECT origin, h AS horizon, origin + h * INTERVAL 1 HOUR AS target_ts, t AS target, CASE t WHEN '{a}' THEN pc[h] ELSE pv[h] END AS pred
      FROM s, range(1, {STEPS + 1}) AS x(h), (VALUES ('{a}'), ('{b}')) AS y(t) WHERE done = {STEPS})"""


_METRICS = """round(avg(abs(pred - real)), 3) AS mae, round(sqrt(avg((pred - real) ** 2)), 3) AS rmse,
  round(1 - sum((real - pred) ** 2) / (var_pop(real) * count(*)), 3) AS r2, round(100 * avg(CASE WHEN abs(real - pred) < 0.5 THEN 1.0 ELSE 0.0 END), 3) AS within_pct"""


@query("least_squares_score", f"""WITH RECURSIVE {_FIT},
x AS (SELECT m.*, [{', '.join(_FEATURES)}] AS x, k.* FROM m, k WHERE m.i > floor(m.n * 0.8) + floor(m.n * 0.1)),
l AS (SELECT ts_hour, unnest({_TARGETS}) AS target, unnest([{', '.join(_TARGETS)}]) AS real, unnest([{', '.join(_PREDICTED.values())}]) AS pred FROM x)
SELECT target, count(*) AS n, {_METRICS} FROM l GROUP BY target""")
def least_squares_score(spark, sf):
    models, test = _fitted(spark, sf)
    rows = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("real"), F.col(f"pred_{t}").alias("pred")) for t in _TARGETS])
    return error_metrics(models.predict(test).select(TS, F.inline(rows)), ["target"])


@query("linear_recursion", _recursion(1) + " SELECT origin, horizon, target_ts, target, round(pred, 5) AS pred FROM made")
def linear_recursion(spark, sf):
    return _forecasts(spark, sf).withColumn("pred", F.round("pred", 5))


@query("linear_two_step", _recursion(2) + " SELECT origin, horizon, target_ts, target, round(pred, 5) AS pred FROM made")
def linear_two_step(spark, sf):
    return _forecasts(spark, sf, advance=2).withColumn("pred", F.round("pred", 5))


@query("linear_degradation", _recursion(1) + f""", j AS (
  SELECT made.target, made.horizon, made.pred, CASE made.target WHEN 'rain_click' THEN p.rain_click ELSE p.rain_view END AS real FROM made JOIN p ON p.ts_hour = made.target_ts)
SELECT target, horizon, count(*) AS n, {_METRICS} FROM j GROUP BY ALL""")
def linear_degradation(spark, sf):
    cells = wide_grid(spark, sf)
    rows = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("real")) for t in SPEC.targets])
    truth = cells.select(F.col(TS).alias("target_ts"), F.inline(rows))
    return degradation(with_truth(_forecasts(spark, sf), truth, []))


@query("linear_simulation", _recursion(2) + """
SELECT target_ts, round(arg_max(pred, origin), 4) AS dynamic,
       round(coalesce(arg_min(CASE WHEN horizon = 2 THEN pred END, origin) FILTER (WHERE horizon = 2), arg_max(pred, origin)), 4) AS first
FROM made WHERE target = 'rain_click' GROUP BY target_ts""")
def linear_simulation(spark, sf):
    """Every hour as origin, then one dynamic and one first value per target instant."""
    long = _forecasts(spark, sf, advance=2).filter(F.col("target") == "rain_click")
    runs = long.withColumn("frozen", F.when(F.col("horizon") == 2, F.col("pred")))
    return collapse_runs(runs, "target_ts", "origin", "pred", "frozen")
