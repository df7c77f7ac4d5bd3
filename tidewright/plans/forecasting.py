"""Feature build, training, live forecast and audit."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions.direction import sector_number, signed_by_degrees
from tidewright.operators.evaluate import audit, chronological_split
from tidewright.operators.features import FeatureSpec, feature_matrix
from tidewright.operators.forecast import TargetModels, fit_targets, recursive_forecast
from tidewright.operators.grid import append_future, extend_last_row, fill_gaps
from tidewright.operators.joins import join_on_hour, pivot_series
from tidewright.operators.rollup import collapse_runs
from tidewright.operators.scan import grid_buckets
from tidewright.operators.shaping import drop_dead_rows, drop_matching, narrow_to_float
from tidewright.schemas import RAIN_CITIES
from tidewright.sinks.maintain import merge_freeze, merge_keep_first

TS, STEP = "datahora", 3600
TARGETS = ("intensidade_6m_kt", "intensidade_superficie_kt", "intensidade_3m_kt")
FLOW_PAIRS = {t: t.replace("intensidade", "direcao").replace("_kt", "_deg") for t in TARGETS}
DIRECTIONS = (*FLOW_PAIRS.values(), "vento_num")
RAIN = tuple(f"rain_{city}" for city in RAIN_CITIES)
WEATHER = ("hi_temp", "out_hum", "wind_speed", "vento_num", "bar")


def rain_by_city(long_rain: DataFrame, city: str = "city") -> DataFrame:
    """(city, time, precipitation) rows to one hourly row with a column per city."""
    hours = long_rain.withColumn("ts_hour", F.date_trunc("hour", "time").cast("timestamp_ntz"))
    return pivot_series(hours, ["ts_hour"], city, "precipitation", list(RAIN_CITIES), "rain_")


def model_inputs(joined: DataFrame) -> DataFrame:
    """Flow sign from degrees, then sectors: what training and live runs both feed the models."""
    signed = joined.withColumns({
        i: signed_by_degrees(F.col(i), F.col(d)) for i, d in FLOW_PAIRS.items() if {i, d} <= set(joined.columns)
    })
    return signed.withColumns({d: sector_number(F.col(d)) for d in DIRECTIONS if d in signed.columns})


def model_table(history: DataFrame, rain: DataFrame) -> DataFrame:
    """Rain attached, dead columns dropped, sign from degrees, then sectors, zeros for gaps."""
    joined = drop_matching(join_on_hour(history, rain, TS), ["temp_out"], ["wind_dir"])
    return narrow_to_float(model_inputs(joined), [TS])


def model_spec(table: DataFrame) -> FeatureSpec:
    base = tuple(c for c in table.columns if c != TS)
    rain = tuple(c for c in base if c.startswith("rain_"))
    return FeatureSpec(
        base=base, targets=tuple(t for t in TARGETS if t in base),
        lead_base=tuple(c for c in WEATHER if c in base) + rain, long_base=rain,
    )


def training_matrix(table: DataFrame) -> DataFrame:
    """Complete feature rows; hours in which every sensor was silent are left out.

    They are removed after the shifts, so each lag stays a true hour.
    """
    spec = model_spec(table)
    features = feature_matrix(table, [], TS, STEP, spec)
    live = drop_dead_rows(features, spec.targets)
    return live.select(TS, *spec.feature_names(), *spec.target_names())


def train(matrix: DataFrame, spec: FeatureSpec, estimator: Estimator, scaled: bool = True) -> tuple[TargetModels, DataFrame]:
    """Models fitted on the first 80 % and the tagged matrix."""
    tagged = chronological_split(matrix, [], [TS], grid_buckets(STEP))
    fitted = fit_targets(
        tagged.filter(F.col("split") == "train"), spec.feature_names(), spec.target_names(), estimator, scaled
    )
    return fitted, tagged


def live_grid(history: DataFrame, outlook: DataFrame, rain: DataFrame, now: Column, hours_ahead: int = 14) -> DataFrame:
    """Past rows carried to the current hour plus the weather outlook, gaps forward filled, rest 0."""
    hour = F.date_trunc("hour", now).cast("timestamp_ntz")
    past = extend_last_row(history, [], TS, hour, STEP)
    joined = append_future(past, outlook, TS, hour, hours_ahead)
    joined = join_on_hour(joined, rain, TS)
    sectors = model_inputs(joined)
    numbers = [c for c in sectors.columns if c != TS]
    typed = sectors.select(TS, *[F.col(c).try_cast("double").alias(c) for c in numbers])
    return fill_gaps(typed, [], TS, numbers, grid_buckets(STEP), backward_too=False, default=0.0)


def run_forecast(
    grid: DataFrame, models: TargetModels, spec: FeatureSpec, now: Column, steps: int = 6, advance: int = 1
) -> DataFrame:
    """(target instant, surface forecast) rows of one run; fails if the origin lacks history or outlook."""
    hour = F.date_trunc("hour", now).cast("timestamp_ntz")
    origin = grid.filter(F.col(TS) == hour).select(F.col(TS).alias("origin"))
    long = recursive_forecast(grid, [], TS, STEP, spec, models, steps, advance, origin)
    surface = long.filter(F.col("target") == "intensidade_superficie_kt")
    if surface.isEmpty():
        raise ValueError("the origin has no complete history or outlook")
    return surface.select(
        F.col("target_ts").alias("datahora_alvo"), F.round("pred", 4).alias("previsao_correnteza_superficie")
    )


def publish_forecast(table: DataFrame, run: DataFrame, now: Column) -> DataFrame:
    """New content of the forecast table after one run."""
    return merge_freeze(
        table, run, "datahora_alvo", "previsao_correnteza_superficie", now,
        dynamic="correnteza_superficie_prevista_dinamica",
        frozen="correnteza_superficie_prevista_primeiro_calculo",
        stamp="atualizado_em",
    )


def simulate(
    grid: DataFrame, models: TargetModels, spec: FeatureSpec, start: Column, end: Column,
    steps: int = 6, advance: int = 2, freeze_at: int = 2,
) -> DataFrame:
    """Every hour in ``[start, end]`` as origin, collapsed to one row per target instant.

    The newest origin gives the dynamic value, the forecast made ``freeze_at``
    hours ahead the frozen one.
    """
    origins = grid.filter((F.col(TS) >= start) & (F.col(TS) <= end)).select(F.col(TS).alias("origin"))
    long = recursive_forecast(grid, [], TS, STEP, spec, models, steps, advance, origins)
    surface = long.filter(F.col("target") == "intensidade_superficie_kt").withColumn(
        "frozen", F.when(F.col("horizon") == freeze_at, F.col("pred"))
    )
    runs = collapse_runs(surface, "target_ts", "origin", "pred", "frozen")
    return runs.select(
        F.col("target_ts").alias("datahora_alvo"),
        F.col("dynamic").alias("correnteza_superficie_prevista_dinamica"),
        F.col("first").alias("correnteza_superficie_prevista_primeiro_calculo"),
    )


def publish_simulation(table: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """New content of the forecast table: dynamic values replaced, frozen ones only filled."""
    return merge_keep_first(
        table, runs.withColumn("atualizado_em", now), ["datahora_alvo"],
        ["correnteza_superficie_prevista_dinamica", "atualizado_em"],
        ["correnteza_superficie_prevista_primeiro_calculo"],
    )


def audit_view(table: DataFrame, treated_hours: DataFrame) -> DataFrame:
    truth = treated_hours.withColumnRenamed("timestamp_br", "datahora_alvo")
    return audit(
        table, truth, "datahora_alvo", "correnteza_superficie_prevista_dinamica",
        "correnteza_superficie_prevista_primeiro_calculo", "intensidade_superficie",
    )
