"""Splines and local fills of several columns against direct solutions."""

import datetime as dt
import random

import numpy as np
import pytest

from tidewright.operators.grid import interpolate_local
from tidewright.operators.scan import grid_buckets
from tidewright.operators.spline import NATURAL, NOT_A_KNOT, interpolate_spline

HOUR = 3600
COLUMNS = ["a", "b", "c", "d", "e"]


def series(n=700, seed=1):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for key in ("x", "y", None):
        for i in range(n):
            made = []
            for j, c in enumerate(COLUMNS):
                known = rng.random() < (0.5, 0.1, 0.9, 0.3, 0.02)[j] and not (c == "a" and 200 < i < 320)
                if key == "y" and c == "e":
                    known = i in (3, 40)
                made.append(rng.gauss(0, 5) if known else None)
            rows.append((key, start + dt.timedelta(hours=i), *made))
    return rows


def moments(x, y, ends):
    """Second derivatives by a dense system."""
    n = len(x)
    h, s = np.diff(x), np.diff(y) / np.diff(x)
    full, right = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):
        full[i, i - 1:i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        right[i] = 6 * (s[i] - s[i - 1])
    if ends == NATURAL:
        full[0, 0] = full[-1, -1] = 1
    else:
        full[0, :3] = h[1], -(h[0] + h[1]), h[0]
        full[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
    return np.linalg.solve(full, right)


def fill(values, ends):
    x = np.array([i for i, v in enumerate(values) if v is not None], float)
    y = np.array([v for v in values if v is not None])
    out = list(values)
    if len(x) == 0:
        return out
    m = moments(x, y, ends) if len(x) >= (3 if ends == NATURAL else 4) else None
    for t in range(len(values)):
        if values[t] is not None:
            continue
        k = int(np.searchsorted(x, t)) - 1
        if k < 0 or (m is None) or k == len(x) - 1:
            out[t] = y[max(k, 0)]
            continue
        w = x[k + 1] - x[k]
        u, v = (x[k + 1] - t) / w, (t - x[k]) / w
        out[t] = u * y[k] + v * y[k + 1] + ((u ** 3 - u) * m[k] + (v ** 3 - v) * m[k + 1]) * w * w / 6
    return out


@pytest.fixture(scope="module")
def grid(spark):
    return spark.createDataFrame(series(), "k string, ts timestamp_ntz, a double, b double, c double, d double, e double")


def by_key(rows, columns):
    held = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        held.setdefault(r[0], []).append(r[2:])
    return {k: dict(zip(columns, map(list, zip(*v)))) for k, v in held.items()}


@pytest.mark.parametrize("ends", [NATURAL, NOT_A_KNOT])
@pytest.mark.parametrize("rows_per_bucket", [24, 4096])
def test_spline_equals_the_dense_solution(grid, ends, rows_per_bucket):
    got = interpolate_spline(grid, ["k"], "ts", COLUMNS, HOUR, ends, digits=None, buckets=grid_buckets(HOUR, 24),
                             rows_per_bucket=rows_per_bucket)
    assert got.columns == grid.columns
    got, given = by_key([tuple(r) for r in got.collect()], COLUMNS), by_key(series(), COLUMNS)
    for key, columns in given.items():
        for c, values in columns.items():
            want = fill(values, ends)
            assert np.allclose(np.array(got[key][c], float), np.array(want, float), rtol=1e-9, atol=1e-9), (key, c)


def test_spline_without_extension_leaves_the_outside(grid):
    got = by_key([tuple(r) for r in interpolate_spline(grid, ["k"], "ts", ["b"], HOUR, extend=False).select("k", "ts", "b").collect()], ["b"])
    for key, columns in by_key(series(), COLUMNS).items():
        places = [i for i, v in enumerate(columns["b"]) if v is not None]
        assert [i for i, v in enumerate(got[key]["b"]) if v is None] == [i for i in range(700) if not places[0] <= i <= places[-1]]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("fill_with", [interpolate_spline, interpolate_local])
def test_columns_share_their_shuffles(grid, fill_with):
    one, five = (exchanges(fill_with(grid, ["k"], "ts", columns, HOUR)) for columns in (["a"], COLUMNS))
    assert 0 < five == one
