"""Cubic splines through whole series, split over tasks.

The second derivatives of an interpolating spline solve one tridiagonal system per series, in which every known point depends
on all others. The dependence halves (at least) from one point to the next, which makes the system fit for cyclic reduction:
each step replaces the neighbours at distance p by those at 2 p and squares the weight of what is left out. After
``DOUBLINGS`` steps that weight is below 2**-128, far under the precision of a double, so a point needs no more
than the ``REACH`` points on either side. A step is a lag and a lead, so the solver is a window over row-numbered buckets with a halo:
no task holds a series, and no system of bucket borders remains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions.timekeys import seconds
from tidewright.operators.grid import known_points, with_points
from tidewright.operators.scan import (
    GRID_STEPS_PER_BUCKET, CutBuckets, FixedBuckets, grid_buckets, halo_rows, nearest_known, row_position,
)

DOUBLINGS = 7
#: Reduction steps, the first difference, the neighbour of a segment and the ends that a not-a-knot spline looks up.
REACH = 2 ** DOUBLINGS + 3
NATURAL, NOT_A_KNOT = "natural", "not_a_knot"


def spline_segments(points: DataFrame, keys: Sequence[str], x: str, y: str, position: str, total: str, ends: str = NATURAL,
                    rows_per_bucket: int = GRID_STEPS_PER_BUCKET) -> DataFrame:
    """``points`` with ``__m`` (second derivative) and ``__next``, the following point as a struct (x, y, m).

    ``position`` numbers the points of a series from 1 to ``total``; ``x`` grows with it. Natural ends have no curvature; not-a-knot
    ends continue the neighbouring segment's cubic, as the usual unbounded spline fits do.
    """
    if ends not in (NATURAL, NOT_A_KNOT):
        raise ValueError("ends must be natural or not_a_knot")
    at, last = F.col(position), F.col(total)
    inner = (at > 1) & (at < last)

    def widths(w):
        return [(F.col(x) - F.lag(x).over(w)).alias("__h0"), (F.lead(x).over(w) - F.col(x)).alias("__h1"),
                ((F.col(y) - F.lag(y).over(w)) / (F.col(x) - F.lag(x).over(w))).alias("__s0"),
                ((F.lead(y).over(w) - F.col(y)) / (F.lead(x).over(w) - F.col(x))).alias("__s1")]

    def equations(w):
        """m + a * m(before) + c * m(after) = d."""
        h0, h1 = F.col("__h0"), F.col("__h1")
        a, b, c = h0, 2 * (h0 + h1), h1
        if ends == NOT_A_KNOT:
            # The outer point is a combination of the next two, put into the equation of its neighbour.
            second, before_last = at == 2, at == last - 1
            b = b + F.when(second, h0 + h0 * h0 / h1).otherwise(0) + F.when(before_last, h1 + h1 * h1 / h0).otherwise(0)
            a = F.when(second, 0).when(before_last, h0 - h1 * h1 / h0).otherwise(h0)
            c = F.when(before_last, 0).when(second, h1 - h0 * h0 / h1).otherwise(h1)
        zero = F.lit(0.0)
        return [F.when(inner, a / b).otherwise(zero).alias("__a0"), F.when(inner, c / b).otherwise(zero).alias("__c0"),
                F.when(inner, 6 * (F.col("__s1") - F.col("__s0")) / b).otherwise(zero).alias("__d0")]

    def reduction(k: int):
        def stage(w):
            def side(move, name):
                return F.coalesce(move(f"__{name}{k}", 2 ** k).over(w), F.lit(0.0))

            a, c, d = F.col(f"__a{k}"), F.col(f"__c{k}"), F.col(f"__d{k}")
            left, right = ({n: side(move, n) for n in "acd"} for move in (F.lag, F.lead))
            scale = 1 - a * left["c"] - c * right["a"]
            return [(-a * left["a"] / scale).alias(f"__a{k + 1}"), (-c * right["c"] / scale).alias(f"__c{k + 1}"),
                    ((d - a * left["d"] - c * right["d"]) / scale).alias(f"__d{k + 1}")]
        return stage

    solved = F.col(f"__d{DOUBLINGS}")

    def moments(w):
        if ends == NATURAL:
            return [solved.alias("__m")]
        m = f"__d{DOUBLINGS}"

        def outer(move, own, next_width):
            ratio = F.col(own) / next_width
            return (1 + ratio) * move(m, 1).over(w) - ratio * move(m, 2).over(w)
        return [F.when(at == 1, outer(F.lead, "__h1", F.lead("__h1").over(w)))
                .when(at == last, outer(F.lag, "__h0", F.lag("__h0").over(w))).otherwise(solved).alias("__m")]

    def segment(w):
        return [F.when(at < last, F.struct(*[F.lead(c).over(w).alias(n) for n, c in (("x", x), ("y", y), ("m", "__m"))])).alias("__next")]

    out = halo_rows(points, keys, position, REACH, REACH, widths, equations, *map(reduction, range(DOUBLINGS)), moments, segment,
                    rows_per_bucket=rows_per_bucket)
    return out.select(*points.columns, "__m", "__next")


def interpolate_spline(
    grid: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    step_seconds: int,
    ends: str = NATURAL,
    extend: bool = True,
    digits: int | None = 4,
    buckets: FixedBuckets | CutBuckets | None = None,
    rows_per_bucket: int = GRID_STEPS_PER_BUCKET,
) -> DataFrame:
    """Fill the columns of a regular grid by one cubic spline a series and column.

    Outside the known points the nearest value is extended, or nothing is filled (``extend=False``). Where a spline has too few
    points (three, not-a-knot four) the value before is carried, then the one after. Known values stay.
    All columns share the same shuffles.
    """
    if buckets is None:
        buckets = grid_buckets(step_seconds)
    by = [*keys, "__c"]
    known = row_position(known_points(grid, keys, ts, columns), by, [ts], buckets, name="__pos", total="__n")
    known = known.withColumn("__x", seconds(F.col(ts)).cast("double") / step_seconds)
    found = spline_segments(known, by, "__x", "__v", "__pos", "__n", ends, rows_per_bucket)
    enough = F.col("__n") >= (3 if ends == NATURAL else 4)
    found = found.withColumn("__seg", F.struct(F.col("__x").alias("x"), F.col("__v").alias("y"), F.col("__m").alias("m"), "__next", enough.alias("curved")))
    names = [f"__p{i}" for i in range(len(columns))]
    near = nearest_known(with_points(grid, found, keys, ts, columns, "__seg"), keys, ts, names, buckets, instants=False)
    t = seconds(F.col(ts)).cast("double") / step_seconds

    def filled(i: int, c: str) -> Column:
        here, following = F.col(f"__p{i}__pv"), F.col(f"__p{i}__nv")
        to = here["__next"]
        width = to["x"] - here["x"]
        u, v = (to["x"] - t) / width, (t - here["x"]) / width
        curve = u * here["y"] + v * to["y"] + ((u * u * u - u) * here["m"] + (v * v * v - v) * to["m"]) * width * width / 6
        few = ~F.coalesce(here["curved"], following["curved"])
        value = (
            F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
            .when(few, F.coalesce(here["y"], following["y"]))
            .when(here.isNotNull() & to.isNotNull(), curve)
        )
        if extend:
            value = value.otherwise(F.coalesce(here["y"], following["y"]))
        return (value if digits is None else F.round(value, digits)).alias(c)

    made = {c: filled(i, c) for i, c in enumerate(columns)}
    return near.select(*[made.get(c, F.col(c)) for c in grid.columns])
