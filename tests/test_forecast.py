from datetime import timedelta

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tests.test_scan import START
from tidewright.operators import evaluate, forecast
from tidewright.operators.features import FeatureSpec, feature_matrix, fit_min_max, scale_min_max, sequence_windows, unscale_min_max
from tidewright.operators.scan import CutBuckets, FixedBuckets, grid_buckets
from tidewright.session import scratch_path

SPEC = FeatureSpec(base=("y", "w"), targets=("y",), lead_base=("w",), lags=(1, 2), short_means=(3,), leads=(1,), horizons=(1, 2))


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(1)
    w = rng.normal(size=80)
    y = np.zeros(80)
    for i in range(2, 80):
        y[i] = 0.6 * y[i - 1] - 0.2 * y[i - 2] + 0.5 * w[i - 1] + 0.05 * rng.normal()
    rows = [(START + timedelta(hours=i), float(y[i]), float(w[i])) for i in range(80)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, y double, w double")


@pytest.fixture(scope="module")
def models(cells):
    matrix = feature_matrix(cells, [], "ts", 3600, SPEC)
    return forecast.fit_targets(matrix, SPEC.feature_names(), SPEC.target_names(), LinearRegression(regParam=0.0))


def by_hand(models, cells, advance, steps=6):
    rows = sorted(cells.collect(), key=lambda r: r.ts)
    y0, w = [r.y for r in rows], [r.w for r in rows]
    coefs = {t: (np.array(m.coefficients), m.intercept) for t, m in models.models.items()}
    out = {}
    for t in range(3, len(rows) - steps):
        y = y0[: t + 1]
        for done in range(0, steps, advance):
            i = t + done
            values = {
                "y_lag1": y[i - 1], "y_lag2": y[i - 2], "w_lag1": w[i - 1], "w_lag2": w[i - 2],
                "y_ma3": np.mean(y[i - 3:i]), "w_ma3": np.mean(w[i - 3:i]), "w_lead1": w[i + 1],
            }
            x = np.array([values[n] for n in SPEC.feature_names()])
            for h in range(1, advance + 1):
                c, b = coefs[f"y_h{h}"]
                y.append(float(c @ x + b))
        out.update({(rows[t].ts, h): y[t + h] for h in range(1, steps + 1)})
    return out


@pytest.mark.parametrize("advance", [1, 2])
def test_recursion_equals_a_loop_over_origins(models, cells, advance):
    got = forecast.recursive_forecast(cells, [], "ts", 3600, SPEC, models, steps=6, advance=advance).collect()
    want = by_hand(models, cells, advance)
    assert len(got) == len(want)
    for r in got:
        assert r.pred == pytest.approx(want[(r.origin, r.horizon)], abs=1e-9)
        assert r.target_ts == r.origin + timedelta(hours=r.horizon)


def test_recursion_for_chosen_origins_only(spark, models, cells):
    origin = cells.filter(F.hour("ts") == 12).select(F.col("ts").alias("origin"))
    got = forecast.recursive_forecast(cells, [], "ts", 3600, SPEC, models, origins=origin)
    assert {r.origin.hour for r in got.collect()} == {12}


def test_truth_is_joined_at_the_target_instant(models, cells):
    long = forecast.recursive_forecast(cells, [], "ts", 3600, SPEC, models)
    truth = cells.select(F.col("ts").alias("target_ts"), F.lit("y").alias("target"), F.col("y").alias("real"))
    table = forecast.degradation(forecast.with_truth(long, truth, [])).orderBy("horizon").collect()
    assert [r.horizon for r in table] == list(range(1, 7))
    assert table[0].mae < table[-1].mae


def test_scaled_models_save_and_load(spark, cells):
    matrix = feature_matrix(cells, [], "ts", 3600, SPEC)
    fitted = forecast.fit_targets(matrix, SPEC.feature_names(), ["y_h1"], forecast.boosted_trees(maxIter=2, maxDepth=2), scaled=True)
    path = scratch_path(spark, "model")
    fitted.save(spark, path)
    loaded = forecast.TargetModels.load(spark, path)
    a = [r.pred_y_h1 for r in fitted.predict(matrix).orderBy("ts").collect()]
    assert [r.pred_y_h1 for r in loaded.predict(matrix).orderBy("ts").collect()] == a
    with pytest.raises(ValueError):
        loaded.predict(matrix.drop("y_lag1"))


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "c double, v double")
    fit = fit_min_max(df, ["c", "v"])
    scaled = scale_min_max(df, fit, ["c", "v"])
    assert sorted(map(tuple, scaled.collect())) == [(0.0, 0.0), (0.0, 1.0)]
    assert sorted(map(tuple, unscale_min_max(scaled, fit, ["c", "v"]).collect())) == sorted(map(tuple, df.collect()))


def test_variance_selection_and_draws(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "flat double, v double")
    assert forecast.select_by_variance(df, ["flat", "v"]) == ["v"]
    space = {"a": [1, 2, 3], "b": [4, 5]}
    draws = forecast.draw_parameters(space, 4)
    assert draws == forecast.draw_parameters(space, 4) and len({tuple(d.items()) for d in draws}) == 4
    assert len(forecast.draw_parameters(space, 60)) == 6


def test_metrics_are_not_squared_correlation(spark):
    rows = [(1.0, 2.0), (2.0, 3.0), (3.0, 4.0), (None, 1.0), (4.0, 5.0)]
    df = spark.createDataFrame(rows, "real double, pred double")
    r = evaluate.error_metrics(df, []).first()
    assert (r.n, r.mae, r.rmse, r.r2, r.within_pct) == (4, 1.0, 1.0, 0.2, 0.0)


@pytest.mark.parametrize("n, folds", [(23, 5), (60, 5), (7, 2)])
def test_expanding_folds_equal_the_usual_split(spark, n, folds):
    df = spark.createDataFrame([(START + timedelta(hours=i), i) for i in range(n)], "ts timestamp_ntz, i int")
    got = evaluate.expanding_folds(df, [], ["ts"], FixedBuckets(3600 * 4), folds).collect()
    size = n // (folds + 1)
    for fold in range(1, folds + 1):
        start = n - (folds + 1 - fold) * size
        train = sorted(r.i for r in got if r.fold == fold and r.role == "train")
        test = sorted(r.i for r in got if r.fold == fold and r.role == "test")
        assert train == list(range(start)) and test == list(range(start, start + size))


def test_split_and_blocks(spark):
    df = spark.createDataFrame([(START + timedelta(hours=i), i) for i in range(11)], "ts timestamp_ntz, i int")
    split = {r.i: r.split for r in evaluate.chronological_split(df, [], ["ts"], grid_buckets(3600, 3)).collect()}
    assert [split[i] for i in range(11)] == ["train"] * 8 + ["validation"] + ["test"] * 2
    blocks = evaluate.rolling_blocks(df, [], ["ts"], grid_buckets(3600, 3)).orderBy("i").collect()
    assert [(r.i, r.block, r.step) for r in blocks][:3] == [(0, 0, "+1h"), (1, 0, "+2h"), (2, 1, "+1h")]
    assert max(r.i for r in blocks) == 9


def test_sequences_hold_the_previous_rows(cells):
    out = sequence_windows(cells, [], "ts", 3600, ["y", "w"], 6).orderBy("ts").collect()
    rows = sorted(cells.collect(), key=lambda r: r.ts)
    assert len(out) == 74
    assert out[0].sequence[0] == pytest.approx([rows[0].y, rows[0].w]) and out[0].sequence[5] == pytest.approx([rows[5].y, rows[5].w])


def test_inject_weather_respects_tolerance(spark):
    features = spark.createDataFrame([(START, 1.0), (START + timedelta(hours=30), 2.0)], "origin timestamp_ntz, bar_lag1 double")
    weather = spark.createDataFrame([(START + timedelta(hours=3, minutes=50), 1013.0)], "ts timestamp_ntz, pressure double")
    out = forecast.inject_weather(features, weather, "origin", 3, {"pressure": "bar"}, CutBuckets())
    assert [r.bar_lag1 for r in out.orderBy("origin").collect()] == [1013.0, 2.0]


def test_search_ranks_draws(spark, cells):
    matrix = feature_matrix(cells, [], "ts", 3600, SPEC)
    blocks = evaluate.fold_blocks(matrix, [], ["ts"], grid_buckets(3600, 24), folds=2)
    found = forecast.random_search(blocks, SPEC.feature_names(), "y_h1", [{"numTrees": 2, "maxDepth": 1}, {"numTrees": 8, "maxDepth": 4}], 2)
    ranked = forecast.best_draw(found).collect()
    assert found.count() == 4 and ranked[0].mse <= ranked[1].mse


@pytest.mark.parametrize("n,folds", [(23, 5), (12, 2), (4, 5), (0, 3)])
def test_blocks_are_the_expanding_folds(spark, n, folds):
    df = spark.createDataFrame([(i, START + timedelta(hours=i)) for i in range(n)], "i int, ts timestamp_ntz")
    buckets = FixedBuckets(3600 * 4)
    blocks = evaluate.fold_blocks(df, [], ["ts"], buckets, folds).collect()
    copies = evaluate.expanding_folds(df, [], ["ts"], buckets, folds).collect()
    assert sorted(r.i for r in blocks) == list(range(n))
    for f in range(1, folds + 1):
        assert {r.i for r in blocks if r.block == f} == {r.i for r in copies if (r.fold, r.role) == (f, "test")}
        train = {r.i for r in copies if (r.fold, r.role) == (f, "train")}
        assert {r.i for r in blocks if r.block < f} == train or n <= folds


def test_search_equals_fits_on_copies(spark, cells):
    """One tree without drawing is the same tree on blocks and on copied folds, and on codes of many bins."""
    matrix, names = feature_matrix(cells, [], "ts", 3600, SPEC), SPEC.feature_names()
    buckets, plain = grid_buckets(3600, 24), {"numTrees": 1, "maxDepth": 3, "bootstrap": False, "featureSubsetStrategy": "all"}
    found = forecast.random_search(evaluate.fold_blocks(matrix, [], ["ts"], buckets, 2), names, "y_h1", [plain], 2, bins=None)
    copies = evaluate.expanding_folds(matrix, [], ["ts"], buckets, 2)
    vector = forecast.TargetModels(tuple(names), {}).vector().alias(forecast.FEATURES)
    for fold in (1, 2):
        part = copies.filter(F.col("fold") == fold).select("role", vector, F.col("y_h1").cast("double").alias("y_h1"))
        tree = forecast.random_forest(featuresCol=forecast.FEATURES, labelCol="y_h1", **plain).fit(part.filter("role = 'train'"))
        want = tree.transform(part.filter("role = 'test'")).agg(F.avg((F.col("prediction") - F.col("y_h1")) ** 2)).first()[0]
        assert found.filter(F.col("fold") == fold).first().mse == pytest.approx(want)


def test_bins_come_from_one_part_and_keep_the_order(spark):
    rows = spark.createDataFrame([(float(i), 7.0, None if i % 3 else 1.0, i) for i in range(100)], "a double, b double, c double, i int")
    coded, names = forecast.binned(rows, rows.filter("i < 50"), ["a", "b", "c"], 8)
    got = coded.orderBy("a").collect()
    codes = [r[names[0]] for r in got]
    assert codes == sorted(codes) and len(set(codes)) == 8 and codes[50] == codes[99]
    assert len({r[names[1]] for r in got}) == 1 and coded.count() == 100
