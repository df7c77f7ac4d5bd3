"""Tree models per target, time-ordered search, recursive forecasting.

Recursion loops over the few forecast steps, never over origins: every origin
is one row that carries its recent target values and the outside (weather)
features of the coming steps, so a step is a projection plus model scoring.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewright.functions.timekeys import micros
from tidewright.operators.evaluate import error_metrics
from tidewright.operators.features import (
    FeatureSpec, lag_columns, lead_columns, moving_mean_columns, varying_columns,
)
from tidewright.operators.joins import nearest_time_join
from tidewright.operators.scan import CutBuckets, FixedBuckets, halo_window

FEATURES = "__features"


def boosted_trees(**params) -> GBTRegressor:
    """Gradient-boosted trees; ``maxIter``, ``stepSize``, ``maxDepth`` ... as keywords."""
    return GBTRegressor(**({"maxIter": 100, "stepSize": 0.05, "maxDepth": 5, "seed": 42} | params))


def random_forest(**params) -> RandomForestRegressor:
    defaults = {"numTrees": 300, "maxDepth": 12, "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt", "seed": 42}
    return RandomForestRegressor(**(defaults | params))


@dataclass(frozen=True)
class Scaling:
    """Fitted ranges as plain numbers; a constant column maps to 0."""

    ranges: Mapping[str, tuple[float, float]]

    def apply(self, name: str, value: Column) -> Column:
        low, high = self.ranges[name]
        return (value - low) / ((high - low) or 1.0)

    def undo(self, name: str, value: Column) -> Column:
        low, high = self.ranges[name]
        return value * ((high - low) or 1.0) + low


def fit_scaling(train: DataFrame, columns: Sequence[str]) -> Scaling:
    """One aggregation over the training slice; two numbers per column reach the driver."""
    aggs = [f(F.col(c).cast("double")).alias(f"{c}__{n}") for c in columns for f, n in ((F.min, "lo"), (F.max, "hi"))]
    row = train.agg(*aggs).first()
    return Scaling({c: (row[f"{c}__lo"], row[f"{c}__hi"]) for c in columns})


@dataclass(frozen=True)
class TargetModels:
    """One fitted model per target column over a fixed, named feature order."""

    features: tuple[str, ...]
    models: Mapping[str, Model]
    scaling: Scaling | None = None

    def vector(self, values: Mapping[str, Column] | None = None) -> Column:
        """Feature vector; ``values`` overrides where a feature comes from."""
        def one(name: str) -> Column:
            value = (values[name] if values is not None else F.col(name)).cast("double")
            return self.scaling.apply(name, value) if self.scaling else value

        return array_to_vector(F.array(*[one(n) for n in self.features]))

    def score(self, df: DataFrame, targets: Sequence[str] | None = None, prefix: str = "pred_") -> DataFrame:
        """Add ``pred_<target>`` from an existing feature vector column."""
        for target in targets or self.models:
            out = f"{prefix}{target}"
            df = self.models[target].copy({self.models[target].predictionCol: out}).transform(df)
            if self.scaling:
                df = df.withColumn(out, self.scaling.undo(target, F.col(out)))
        return df

    def predict(self, df: DataFrame, targets: Sequence[str] | None = None) -> DataFrame:
        """Batch scoring of a feature matrix by column name."""
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError(f"feature columns missing: {missing[:10]}")
        return self.score(df.withColumn(FEATURES, self.vector()), targets).drop(FEATURES)

    def save(self, spark: SparkSession, path: str) -> None:
        """Models side by side, feature order and scaling as a one-row table."""
        names = list(self.models)
        for i, name in enumerate(names):
            PipelineModel([self.models[name]]).write().overwrite().save(f"{path}/model={i}")
        meta = {"features": list(self.features), "targets": names,
                "ranges": dict(self.scaling.ranges) if self.scaling else None}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TargetModels":
        meta = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()["meta"])
        models = {
            name: PipelineModel.load(f"{path}/model={i}").stages[0] for i, name in enumerate(meta["targets"])
        }
        ranges = meta["ranges"]
        scaling = Scaling({k: tuple(v) for k, v in ranges.items()}) if ranges else None
        return TargetModels(tuple(meta["features"]), models, scaling)


def fit_targets(
    train: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    estimator: Estimator,
    scaled: bool = False,
    parallel: int = 2,
) -> TargetModels:
    """Fit one model per target; fits run side by side, each one distributed."""
    scaling = fit_scaling(train, [*features, *targets]) if scaled else None
    shell = TargetModels(tuple(features), {}, scaling)

    def label(name: str) -> Column:
        value = F.col(name).cast("double")
        return (scaling.apply(name, value) if scaling else value).alias(name)

    data = train.select(shell.vector().alias(FEATURES), *[label(t) for t in targets]).persist()
    try:
        def one(target: str) -> tuple[str, Model]:
            configured = estimator.copy({estimator.featuresCol: FEATURES, estimator.labelCol: target})
            return target, configured.fit(data.filter(F.col(target).isNotNull()))

        with ThreadPool(min(parallel, len(targets))) as pool:
            models = dict(pool.map(one, targets))
    finally:
        data.unpersist()
    return replace(shell, models={t: models[t] for t in targets})


def select_by_variance(train: DataFrame, features: Sequence[str], threshold: float = 1e-4) -> list[str]:
    """Features whose population variance exceeds ``threshold``, in one pass."""
    return varying_columns(train, features, threshold)


def draw_parameters(space: Mapping[str, Sequence], draws: int, seed: int = 42) -> list[dict]:
    """Seeded random draws without repeats (all combinations if there are fewer)."""
    rng = random.Random(seed)
    total = 1
    for choices in space.values():
        total *= len(choices)
    seen: list[dict] = []
    while len(seen) < min(draws, total):
        pick = {name: rng.choice(list(choices)) for name, choices in space.items()}
        if pick not in seen:
            seen.append(pick)
    return seen


def binned(df: DataFrame, fitted_on: DataFrame, features: Sequence[str], bins: int = 32) -> tuple[DataFrame, list[str]]:
    """``df`` with a quantile code per feature and the names of the codes; all edges come from one pass over ``fitted_on``."""
    shares = [i / bins for i in range(1, bins)]
    edges = fitted_on.agg(*[F.percentile_approx(F.col(c).cast("double"), shares).alias(c) for c in features]).first()
    codes = [f"__bin_{i}" for i in range(len(features))]
    splits = [[-math.inf, *sorted(set(edges[c] or [0.0])), math.inf] for c in features]
    typed = df.withColumns({c: F.col(c).cast("double") for c in features})
    coder = Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=codes, handleInvalid="keep")
    return coder.transform(typed), codes


def random_search(
    blocks: DataFrame,
    features: Sequence[str],
    target: str,
    candidates: Sequence[dict],
    folds: int,
    parallel: int = 2,
    threshold: float = 0.5,
    bins: int | None = 32,
) -> DataFrame:
    """MSE and threshold accuracy per (draw, fold) on expanding folds.

    ``blocks`` carries ``block`` (:func:`~tidewright.operators.evaluate.fold_blocks`): every row is kept once, whatever
    the number of folds. Features are binned once for all draws, by the quantiles of block 0, which every fold trains
    on; ``bins=None`` leaves them as they are. Only the driver-side plan loops over draws and folds; each fit and each
    metric is a distributed job.
    """
    names = list(features)
    if bins:
        blocks, names = binned(blocks, blocks.filter(F.col("block") == 0), features, bins)
    shell = TargetModels(tuple(names), {})
    data = blocks.select("block", shell.vector().alias(FEATURES), F.col(target).cast("double").alias(target)).persist()

    def one(task: tuple[int, int]) -> DataFrame:
        draw, fold = task
        forest = random_forest(featuresCol=FEATURES, labelCol=target, **candidates[draw])
        model = forest.fit(data.filter(F.col("block") < fold))
        scored = model.transform(data.filter(F.col("block") == fold))
        measured = error_metrics(scored, [], target, "prediction", threshold, digits=None)
        return measured.select(
            F.lit(draw).alias("draw"), F.lit(fold).alias("fold"), F.lit(json.dumps(candidates[draw])).alias("params"),
            "n", F.pow("rmse", F.lit(2.0)).alias("mse"), "within_pct",
        )

    tasks = [(d, f) for d in range(len(candidates)) for f in range(1, folds + 1)]
    try:
        with ThreadPool(min(parallel, len(tasks))) as pool:
            # One small row per (draw, fold) is kept; the rows can then be released.
            rows = [r for part in pool.map(lambda t: one(t).collect(), tasks) for r in part]
    finally:
        data.unpersist()
    return blocks.sparkSession.createDataFrame(
        rows, "draw int, fold int, params string, n bigint, mse double, within_pct double"
    )


def best_draw(search: DataFrame) -> DataFrame:
    """Draws ranked by mean MSE over the folds."""
    return search.groupBy("draw", "params").agg(
        F.avg("mse").alias("mse"), F.avg("within_pct").alias("within_pct")
    ).orderBy("mse", "draw")


def history_depth(spec: FeatureSpec) -> int:
    """Past target values that a step of the recursion needs."""
    long = spec.long_means if set(spec.targets) & set(spec.long_base) else ()
    return max([*spec.lags, *spec.short_means, *long])


def forecast_state(
    grid: DataFrame, keys: Sequence[str], ts: str, step_seconds: int, spec: FeatureSpec, steps: int
) -> tuple[DataFrame, list[str]]:
    """One row per origin: recent targets, current targets, outside features of the next steps.

    Built in one halo pass. Returns the frame and the order of the outside features.
    """
    targets = list(spec.targets)
    outside = [c for c in spec.base if c not in targets]
    outside_long = [c for c in spec.long_base if c not in targets]
    names = (
        [f"{c}_lag{n}" for n in spec.lags for c in outside]
        + [f"{c}_ma{w}" for w in spec.short_means for c in outside]
        + [f"{c}_ma{w}" for w in spec.long_means for c in outside_long]
        + [f"{c}_lead{n}" for n in spec.leads for c in spec.lead_base]
    )
    depth = history_depth(spec)
    if set(spec.lead_base) & set(targets):
        raise ValueError("a target cannot be a lead feature: a forecast does not know its future")

    def panel(w: Window) -> list[Column]:
        return (
            lag_columns(w, outside, spec.lags)
            + moving_mean_columns(w, outside, spec.short_means)
            + moving_mean_columns(w, outside_long, spec.long_means)
            + lead_columns(w, spec.lead_base, spec.leads)
        )

    ahead = (max(spec.leads) if spec.lead_base else 0) + steps - 1

    def gather(w: Window) -> list[Column]:
        row = F.array(*[F.col(n).cast("double") for n in names])
        coming = F.collect_list(row).over(w.rowsBetween(0, steps - 1)).alias("__outside")
        recent = [
            F.collect_list(F.coalesce(F.col(t).cast("double"), F.lit(float("nan")))).over(w.rowsBetween(-depth, -1)).alias(f"__hist_{t}")
            for t in targets
        ]
        around = w.rowsBetween(-max(spec.before, depth), ahead)
        spread = (micros(F.max(ts).over(around)) - micros(F.min(ts).over(around))) / F.lit(step_seconds * 1_000_000)
        even = (spread == F.count("*").over(around) - 1).alias("__even")
        return [coming, *recent, even]

    wide = halo_window(grid, keys, ts, step_seconds, max(spec.before, depth), ahead, panel, gather)
    whole = (F.size("__outside") == steps) & (F.size(f"__hist_{targets[0]}") == depth)
    known = whole
    for t in targets:
        known = known & F.col(t).isNotNull() & ~F.exists(f"__hist_{t}", F.isnan)
    known = known & F.forall("__outside", lambda r: F.forall(r, lambda x: x.isNotNull()))
    # Shifts count rows: an origin whose rows are not one step apart would read moved lags.
    state = wide.filter(known & F.col("__even")).select(
        *keys, F.col(ts).alias("origin"), "__outside",
        *[F.col(f"__hist_{t}") for t in targets],
        *[F.col(t).cast("double").alias(f"__cur_{t}") for t in targets],
    )
    return state, names


def recursive_forecast(
    grid: DataFrame,
    keys: Sequence[str],
    ts: str,
    step_seconds: int,
    spec: FeatureSpec,
    models: TargetModels,
    steps: int = 6,
    advance: int = 1,
    origins: DataFrame | None = None,
) -> DataFrame:
    """Forecast ``steps`` ahead from every origin, feeding predictions back in.

    ``advance`` is how many horizons each round keeps (1: only the next step; 2:
    two at a time). Row ``i`` predicts ``i + h``, so a prediction is written to
    its own instant and moves into the lags from there. Rows with incomplete
    history or outside features are no origins.

    Returns (keys, origin, horizon, target_ts, target, pred).
    """
    if steps % advance:
        raise ValueError("steps must be a multiple of advance")
    targets = list(spec.targets)
    state, outside_names = forecast_state(grid, keys, ts, step_seconds, spec, steps)
    if origins is not None:
        state = state.join(origins.select(*keys, "origin").distinct(), [*keys, "origin"], "left_semi")
    place = {n: i for i, n in enumerate(outside_names)}
    depth = history_depth(spec)
    kept = [f"{t}__p{h}" for t in targets for h in range(1, steps + 1)]

    for done in range(0, steps, advance):
        values: dict[str, Column] = {}
        for t in targets:
            history = F.col(f"__hist_{t}")
            for n in spec.lags:
                values[f"{t}_lag{n}"] = F.element_at(history, -n) if n else F.col(f"__cur_{t}")
            widths = [*spec.short_means, *(spec.long_means if t in spec.long_base else ())]
            for w in widths:
                total = F.aggregate(F.slice(history, -w, w), F.lit(0.0), lambda a, x: a + x)
                values[f"{t}_ma{w}"] = total / w
        for name, i in place.items():
            values[name] = F.get(F.get(F.col("__outside"), done), i)
        state = state.withColumn(FEATURES, models.vector(values))
        state = models.score(state, [f"{t}_h{h}" for t in targets for h in range(1, advance + 1)])
        moved = {}
        for t in targets:
            preds = [F.col(f"pred_{t}_h{h}") for h in range(1, advance + 1)]
            grown = F.concat(F.col(f"__hist_{t}"), F.array(F.col(f"__cur_{t}"), *preds[:-1]))
            moved[f"__hist_{t}"] = F.slice(grown, -depth, depth)
            moved[f"__cur_{t}"] = preds[-1]
            for h, p in enumerate(preds, start=1):
                moved[f"{t}__p{done + h}"] = p
        passed = [c for c in state.columns if not c.startswith("pred_") and c not in moved and c != FEATURES]
        state = state.select(*passed, *[e.alias(n) for n, e in moved.items()])

    rows = F.array(*[
        F.struct(
            F.lit(h).alias("horizon"),
            (F.col("origin") + F.make_dt_interval(secs=F.lit(h * step_seconds).cast("decimal(18,6)"))).alias("target_ts"),
            F.lit(t).alias("target"),
            F.col(f"{t}__p{h}").alias("pred"),
        )
        for t in targets for h in range(1, steps + 1)
    ])
    return state.select(*keys, "origin", *kept).select(*keys, "origin", F.inline(rows))


def inject_weather(
    features: DataFrame,
    weather: DataFrame,
    origin: str,
    offset_hours: int,
    mapping: Mapping[str, str],
    buckets: FixedBuckets | CutBuckets,
    keys: Sequence[str] = (),
    tolerance_seconds: int | None = 3600,
) -> DataFrame:
    """Overwrite ``<model>_lag1`` by the weather nearest to origin + offset.

    ``mapping`` is weather column -> model column; values outside the tolerance
    or missing leave the feature as it is. ``weather`` has its instant in ``ts``.
    """
    asked = features.withColumn("ts", F.col(origin) + F.make_dt_interval(hours=F.lit(offset_hours)))
    fresh = {w: f"__w_{w}" for w in mapping}
    renamed = weather.select(*keys, "ts", *[F.col(w).alias(n) for w, n in fresh.items()])
    near = nearest_time_join(
        asked, renamed, "ts", list(fresh.values()), buckets, keys, tolerance_seconds, matched="__at"
    )
    patched = {f"{m}_lag1": F.coalesce(F.col(fresh[w]), F.col(f"{m}_lag1")) for w, m in mapping.items() if f"{m}_lag1" in features.columns}
    return near.select([patched[c].alias(c) if c in patched else F.col(c) for c in features.columns])


def with_truth(forecasts: DataFrame, long_truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join predictions to the measurement at their own target instant.

    ``long_truth``: (keys, target_ts, target, real), one row each.
    """
    return forecasts.join(long_truth, [*keys, "target_ts", "target"], "left")


def degradation(forecasts_with_truth: DataFrame, keys: Sequence[str] = ("target", "horizon")) -> DataFrame:
    """Error metrics by forecast distance."""
    return error_metrics(forecasts_with_truth, list(keys), "real", "pred")
