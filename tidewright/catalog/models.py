"""Tree models, search and recursive forecasts on the hourly series (rows only, no SQL twin)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import HOUR, query
from tidewright.catalog.features import WIDE_SPEC, wide_grid
from tidewright.operators.evaluate import chronological_split, error_metrics, fold_blocks
from tidewright.operators.features import FeatureSpec, feature_matrix
from tidewright.operators.forecast import (
    best_draw, boosted_trees, degradation, draw_parameters, fit_targets, random_forest, random_search,
    recursive_forecast, select_by_variance, with_truth,
)
from tidewright.operators.rollup import collapse_runs
from tidewright.operators.scan import grid_buckets
from tidewright.session import checkpoint_root

TS = "ts_hour"
SMALL = FeatureSpec(
    base=WIDE_SPEC.base, targets=("rain_click",), lead_base=WIDE_SPEC.lead_base[:2], long_base=(),
    lags=(1, 2, 3), short_means=(3,), leads=(1, 2),
)


def _matrix(spark, sf):
    """Small feature matrix, cut from its lineage because every fit scans it several times."""
    checkpoint_root(spark)
    return feature_matrix(wide_grid(spark, sf), [], TS, HOUR, SMALL).checkpoint()


def _split(spark, sf):
    tagged = chronological_split(_matrix(spark, sf), [], [TS], grid_buckets(HOUR, 168))
    return tagged.filter(F.col("split") == "train"), tagged.filter(F.col("split") == "test")


def _fitted(spark, sf, scaled=False):
    train, test = _split(spark, sf)
    trees = boosted_trees(maxIter=4, maxDepth=3, stepSize=0.3)
    return fit_targets(train, SMALL.feature_names(), SMALL.target_names(), trees, scaled), test


def _scores(scored):
    rows = F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(t).alias("real"), F.col(f"pred_{t}").alias("pred"))
        for t in SMALL.target_names()
    ])
    return error_metrics(scored.select(TS, F.inline(rows)), ["target"])


@query("gbt_score")
def gbt_score(spark, sf):
    models, test = _fitted(spark, sf, scaled=True)
    return _scores(models.predict(test))


@query("rf_score")
def rf_score(spark, sf):
    train, test = _split(spark, sf)
    kept = select_by_variance(train, SMALL.feature_names())
    forest = random_forest(numTrees=10, maxDepth=5)
    return _scores(fit_targets(train, kept, SMALL.target_names(), forest).predict(test))


@query("cv_search")
def cv_search(spark, sf):
    blocks = fold_blocks(_matrix(spark, sf), [], [TS], grid_buckets(HOUR, 168), folds=5)
    draws = draw_parameters({"maxDepth": [3, 5], "minInstancesPerNode": [1, 2], "numTrees": [5]}, 2)
    return best_draw(random_search(blocks, SMALL.feature_names(), "rain_click_h1", draws, folds=5))


@query("recursive_forecast")
def recursive(spark, sf):
    models, _ = _fitted(spark, sf)
    return recursive_forecast(wide_grid(spark, sf), [], TS, HOUR, SMALL, models, steps=6)


@query("recursive_two_step")
def recursive_two_step(spark, sf):
    models, _ = _fitted(spark, sf)
    return recursive_forecast(wide_grid(spark, sf), [], TS, HOUR, SMALL, models, steps=6, advance=2)


@query("degradation_by_horizon")
def degradation_by_horizon(spark, sf):
    cells = wide_grid(spark, sf)
    truth = cells.select(F.col(TS).alias("target_ts"), F.lit("rain_click").alias("target"), F.col("rain_click").alias("real"))
    return degradation(with_truth(recursive(spark, sf), truth, []))


@query("simulate_origins")
def simulate_origins(spark, sf):
    """Every hour as origin, then one dynamic and one first value per target instant."""
    long = recursive_two_step(spark, sf)
    runs = long.withColumn("frozen", F.when(F.col("horizon") == 2, F.col("pred")))
    return collapse_runs(runs, "target_ts", "origin", "pred", "frozen")
