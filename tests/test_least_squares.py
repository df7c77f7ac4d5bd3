"""Least squares by one correlation pass, against a dense solution."""

import numpy as np
import pytest

from tidewright.operators.least_squares import LinearModels, fit_least_squares


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    x = rng.normal(3, 2, (400, 4))
    y = np.column_stack([x @ [1, -2, 0.5, 3] + 7 + rng.normal(0, 0.1, 400), x[:, 0] ** 2])
    return np.column_stack([x, np.full(400, 5.0), x[:, 0] + x[:, 1], y])


def frame(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, c double, d double, same double, both double, y double, z double")


def test_equals_the_dense_solution(spark, rows):
    models = fit_least_squares(frame(spark, rows), list("abcd"), ["y", "z"])
    design = np.column_stack([rows[:, :4], np.ones(len(rows))])
    for t, target in enumerate(("y", "z")):
        assert np.allclose(models.weights[target], np.linalg.lstsq(design, rows[:, 6 + t], rcond=None)[0], atol=1e-8)


def test_constant_and_dependent_features_do_no_harm(spark, rows):
    df = frame(spark, rows)
    plain = fit_least_squares(df, list("abcd"), ["y"]).predict(df)
    odd = fit_least_squares(df, ["a", "b", "c", "d", "same", "both"], ["y"])
    assert odd.weights["y"][4] == 0
    a, b = ([r.pred_y for r in f.orderBy("a", "b").collect()] for f in (plain, odd.predict(df)))
    assert np.allclose(a, b, atol=1e-8)


def test_nulls_and_constant_targets(spark, rows):
    df = frame(spark, rows).selectExpr("IF(a > 3, NULL, a) AS a", "b", "same")
    models = fit_least_squares(df, ["a", "b"], ["same"])
    assert models.weights["same"] == (0, 0, 5)
    with pytest.raises(ValueError):
        fit_least_squares(df.where("false"), ["a", "b"], ["same"])


def test_save_and_load(spark, rows, tmp_path):
    df = frame(spark, rows)
    models = fit_least_squares(df, list("abcd"), ["y"])
    models.save(spark, str(tmp_path / "m"))
    assert LinearModels.load(spark, str(tmp_path / "m")) == models
    with pytest.raises(ValueError):
        models.predict(df.drop("b"))
