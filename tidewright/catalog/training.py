"""The training table and its matrix through ``plans/forecasting``, on a history shaped out of ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import S, SOURCES, query, samples
from tidewright.catalog.features import single_series_columns, wide_grid
from tidewright.operators.features import FeatureSpec
from tidewright.plans import forecasting as plan
from tidewright.schemas import RAIN_CITIES

#: Column of the history and the column of ``wide_grid`` that stands in for it; the last two are left out by the job.
_HISTORY = {
    "intensidade_6m_kt": "rain_click", "intensidade_superficie_kt": "rain_error", "intensidade_3m_kt": "rain_view",
    "direcao_6m_deg": "dir_click", "direcao_superficie_deg": "dir_error", "direcao_3m_deg": "dir_view",
    "hi_temp": "rain_purchase", "out_hum": "dir_signup", "wind_speed": "rain_signup", "vento_num": "dir_purchase",
    "temp_out": "rain_click", "wind_dir_x": "dir_click",
}
_CITY_OF = dict(zip(SOURCES, RAIN_CITIES))


def _table(spark, sf):
    history = wide_grid(spark, sf).select(F.col("ts_hour").alias(plan.TS), *[F.col(c).alias(n) for n, c in _HISTORY.items()])
    city = F.create_map(*[F.lit(x) for pair in _CITY_OF.items() for x in pair])[F.col("source")]
    rain = samples(spark, sf).select(city.alias("city"), F.col("ts_hour").alias("time"), F.col("value").alias("precipitation"))
    return plan.model_table(history, plan.rain_by_city(rain))


def _table_sql() -> tuple[str, FeatureSpec]:
    """CTEs up to ``t`` (ts_hour, base columns as FLOAT) and the specification of its matrix."""
    flow = {n: d for n, d in plan.FLOW_PAIRS.items()}
    done = {}
    for name, column in _HISTORY.items():
        if name in flow:
            d = _HISTORY[flow[name]]
            done[name] = f"CASE WHEN {d} > 90 AND {d} < 270 THEN -{column} ELSE {column} END"
        elif name in plan.DIRECTIONS:
            done[name] = f"round_even({column} / 22.5, 0) % 16"
        elif name not in ("temp_out", "wind_dir_x"):
            done[name] = column
    source_of = {c: s for s, c in _CITY_OF.items()}
    done |= {f"rain_{c}": f"rain_{source_of[c]}" if c in source_of else "0" for c in RAIN_CITIES}
    wide = ", ".join(
        f"coalesce(avg({v}) FILTER (WHERE source = '{s}'), 0) AS {p}_{s}" for p, v in (("rain", "value"), ("dir", "degrees")) for s in SOURCES)
    rain = tuple(f"rain_{c}" for c in RAIN_CITIES)
    spec = FeatureSpec(base=tuple(done), targets=plan.TARGETS, lead_base=tuple(c for c in plan.WEATHER if c in done) + rain, long_base=rain)
    return f"""WITH {S}, b AS (SELECT min(ts_hour) AS lo, max(ts_hour) AS hi FROM h),
s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts_hour FROM b),
p AS (SELECT s.ts_hour, {wide} FROM s LEFT JOIN h ON h.ts_hour = s.ts_hour GROUP BY s.ts_hour),
t AS (SELECT ts_hour, {", ".join(f"CAST({e} AS FLOAT) AS {n}" for n, e in done.items())} FROM p)""", spec


_CTES, _SPEC = _table_sql()
_NAMES = _SPEC.feature_names() + _SPEC.target_names()


@query("job_model_table", f"""{_CTES}
SELECT ts_hour AS datahora, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SPEC.base)} FROM t""")
def job_model_table(spark, sf):
    """Rain of the cities attached, flows signed, directions as sectors, gaps as zeros."""
    return _table(spark, sf).select(plan.TS, *[F.col(c).cast("double").alias(c) for c in _SPEC.base])


@query("job_training_matrix", f"""{_CTES},
f AS (SELECT ts_hour, {" + ".join(f"CAST({c} AS DOUBLE)" for c in plan.TARGETS)} AS live, {", ".join(single_series_columns(_SPEC))}
  FROM t WINDOW w AS (ORDER BY ts_hour))
SELECT ts_hour AS datahora, {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in _NAMES)} FROM f
WHERE live <> 0 AND {" AND ".join(f"{n} IS NOT NULL" for n in _NAMES)}""")
def job_training_matrix(spark, sf):
    """All lags, means, leads and targets of the history, in one halo pass."""
    return plan.training_matrix(_table(spark, sf)).select(plan.TS, *[F.col(n).cast("double").alias(n) for n in _NAMES])
