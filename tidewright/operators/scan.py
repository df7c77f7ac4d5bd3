"""Ordered scans of long series without one task per series.

A window partitioned by series alone would put a hot series into one task, so
ordered work is split by (series, time bucket):

* bounded frames (lags, leads, moving means) copy the few rows near a bucket
  edge into the neighbouring bucket (:func:`halo_window`);
* unbounded look-back and look-ahead combine a window inside each bucket with a
  carry from a one-row-per-bucket summary (:func:`nearest_known`);
* row numbers add the sizes of the preceding buckets (:func:`row_position`).

On a regular grid a fixed bucket width bounds the rows of a bucket by
construction. Irregular rows use quantile cuts, so a burst is split too.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.functions.timekeys import micros, seconds

BUCKET = "__bucket"

GRID_STEPS_PER_BUCKET = 4096
ROWS_PER_BUCKET = 2_000_000
LEAST_BUCKETS, MOST_BUCKETS = 8, 1 << 16


@dataclass(frozen=True)
class FixedBuckets:
    """Buckets of equal duration; for grids, where duration bounds the rows."""

    width_seconds: int

    def assign(self, df: DataFrame, ts: str, name: str = BUCKET) -> DataFrame:
        return df.withColumn(name, F.floor(seconds(F.col(ts)) / self.width_seconds))


@dataclass(frozen=True)
class CutBuckets:
    """Buckets between data-dependent cut instants (microseconds, ascending)."""

    cuts: tuple[float, ...] = field(default=())

    def assign(self, df: DataFrame, ts: str, name: str = BUCKET) -> DataFrame:
        if not self.cuts:
            return df.withColumn(name, F.lit(0).cast("long"))
        raw, slot = f"{name}_micros", f"{name}_slot"
        # Rows without an instant sort first, so they belong to the first bucket.
        keyed = df.withColumn(raw, F.coalesce(micros(F.col(ts)).cast("double"), F.lit(-math.inf)))
        splits = [-math.inf, *self.cuts, math.inf]
        out = Bucketizer(splits=splits, inputCol=raw, outputCol=slot).transform(keyed)
        return out.withColumn(name, F.col(slot).cast("long")).drop(raw, slot)


def attach(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys match each other, as they do in a window partition."""
    named = right.withColumnsRenamed({k: f"__r_{k}" for k in by})
    condition = [left[k].eqNullSafe(named[f"__r_{k}"]) for k in by]
    return left.join(named, condition, how).drop(*[f"__r_{k}" for k in by])


def grid_buckets(step_seconds: int, steps: int = GRID_STEPS_PER_BUCKET) -> FixedBuckets:
    return FixedBuckets(step_seconds * steps)


def balanced_buckets(df: DataFrame, ts: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> CutBuckets:
    """Cut instants that spread the rows of ``df`` evenly.

    Costs one count (file metadata for plain Parquet) and one pass over ``ts``.
    Every size is split, so small and large inputs run the same plan. At most
    ``MOST_BUCKETS`` cut values (0.5 MB) reach the driver; they only choose the
    split points, no row is dropped.
    """
    wanted = min(MOST_BUCKETS, max(LEAST_BUCKETS, math.ceil(df.count() / rows_per_bucket)))
    quantiles = [i / wanted for i in range(1, wanted)]
    points = df.select(micros(F.col(ts)).cast("double").alias("m")).approxQuantile(
        "m", quantiles, 1 / (4 * wanted)
    )
    return CutBuckets(tuple(sorted(set(points))))


def halo_window(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    step_seconds: int,
    before: int,
    after: int,
    *stages: Callable[[Window], Sequence[Column]],
    steps_per_bucket: int = GRID_STEPS_PER_BUCKET,
) -> DataFrame:
    """Add window columns whose frames reach ``before`` / ``after`` grid steps.

    ``df`` must be a regular grid. A stage receives the window spec and returns
    the columns to add; later stages may use the columns of earlier ones, and the
    reach then covers their combined frames. All stages share one shuffle and
    one sort per bucket.
    """
    steps = max(steps_per_bucket, before + after)
    width = steps * step_seconds
    at = seconds(F.col(ts))
    lowest = F.floor((at - after * step_seconds) / width)
    highest = F.floor((at + before * step_seconds) / width)
    spread = df.withColumn(BUCKET, F.explode(F.sequence(lowest, highest)))
    window = Window.partitionBy(*keys, BUCKET).orderBy(ts)
    owned = F.col(BUCKET) == F.floor(at / width)
    for columns in stages:
        spread = spread.select("*", *columns(window))
    return spread.filter(owned).drop(BUCKET)


def halo_rows(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    before: int,
    after: int,
    *stages: Callable[[Window], Sequence[Column]],
    rows_per_bucket: int = GRID_STEPS_PER_BUCKET,
) -> DataFrame:
    """:func:`halo_window` over consecutive row numbers instead of grid steps; frames reach ``before`` / ``after`` rows."""
    size = max(rows_per_bucket, before + after)
    at = F.col(position)
    spread = df.withColumn(BUCKET, F.explode(F.sequence(F.floor((at - after) / size), F.floor((at + before) / size))))
    window = Window.partitionBy(*keys, BUCKET).orderBy(position)
    for columns in stages:
        spread = spread.select("*", *columns(window))
    return spread.filter(F.col(BUCKET) == F.floor(at / size)).drop(BUCKET)


def nearest_known(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    buckets: FixedBuckets | CutBuckets,
    backward: bool = True,
    forward: bool = True,
    instants: bool = True,
    axis: str | None = None,
    touch: Sequence[str] = (),
) -> DataFrame:
    """For every row and column, the nearest non-null value at or before / after it.

    Adds ``{c}__pv`` / ``{c}__nv`` (value) and, with ``instants``, ``{c}__pt`` /
    ``{c}__nt`` (its place on ``axis``: the instant, or another column that grows
    with it). ``(keys, ts)`` must be unique. ``touch`` names further columns the
    bucket summary should read, so that it prunes no more than the main branch
    and Spark can reuse the shuffle below both.
    """
    placed = buckets.assign(df, ts)
    by = [*keys, BUCKET]
    known = {c: F.when(F.col(c).isNotNull(), F.col(axis or ts)) for c in columns}
    sides = [s for s, on in (("p", backward), ("n", forward)) if on]

    # Looking ahead is a running value over the bucket in descending order; a
    # following-rows frame over ascending order would be re-read for every row.
    running = (Window.unboundedPreceding, Window.currentRow)
    frames = {
        "p": Window.partitionBy(*by).orderBy(F.asc(ts)).rowsBetween(*running),
        "n": Window.partitionBy(*by).orderBy(F.desc(ts)).rowsBetween(*running),
    }

    def in_bucket(side: str) -> list[Column]:
        out = []
        for c in columns:
            out.append(F.last(F.col(c), ignorenulls=True).over(frames[side]).alias(f"{c}__{side}v"))
            if instants:
                out.append(F.last(known[c], ignorenulls=True).over(frames[side]).alias(f"{c}__{side}t"))
        return out

    local = placed.select("*", *[e for side in sides for e in in_bucket(side)])
    if isinstance(buckets, CutBuckets) and not buckets.cuts:
        return local.drop(BUCKET)

    extreme = {"p": (F.max_by, F.max), "n": (F.min_by, F.min)}
    summary_aggs = []
    for side in sides:
        value_at, instant_at = extreme[side]
        for c in columns:
            summary_aggs.append(value_at(F.col(c), known[c]).alias(f"{c}__{side}v"))
            summary_aggs.append(instant_at(known[c]).alias(f"{c}__{side}t"))
    if touch:
        summary_aggs.append(sum((F.count(c) for c in touch), F.count("*")).alias("__rows"))
    summary = placed.groupBy(*by).agg(*summary_aggs)
    if touch:
        summary = summary.filter("__rows >= 0")

    # One row per (series, bucket): the span of the series bounds this window.
    order = {"p": F.col(BUCKET).asc(), "n": F.col(BUCKET).desc()}
    kinds = ["v", "t"] if instants else ["v"]
    carried = []
    for side in sides:
        earlier = Window.partitionBy(*keys).orderBy(order[side]).rowsBetween(Window.unboundedPreceding, -1)
        for c in columns:
            for kind in kinds:
                carried.append(
                    F.last(f"{c}__{side}{kind}", ignorenulls=True).over(earlier).alias(f"{c}__{side}{kind}c")
                )
    carry = summary.select(*by, *carried)

    added = [f"{c}__{side}{kind}" for side in sides for c in columns for kind in kinds]
    joined = attach(local, carry, by)
    return joined.select(
        *df.columns,
        *[F.coalesce(F.col(name), F.col(f"{name}c")).alias(name) for name in added],
    )


def row_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: FixedBuckets | CutBuckets,
    name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """1-based row number per series (and the series size as ``total``).

    ``order[0]`` is the instant the buckets are cut on; further columns break
    ties. Row numbers inside a bucket are shifted by the size of the buckets
    before it, so no task ever sorts a whole series.
    """
    ts = order[0]
    placed = buckets.assign(df, ts)
    by = [*keys, BUCKET]
    local = placed.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
    sizes = placed.groupBy(*by).agg(F.count("*").alias("__size"))
    series = Window.partitionBy(*keys)
    offsets = sizes.select(
        *by,
        F.coalesce(
            F.sum("__size").over(series.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__before"),
        F.sum("__size").over(series).alias("__total"),
    )
    out = attach(local, offsets, by, "inner").withColumn(name, F.col(name) + F.col("__before"))
    if total is not None:
        out = out.withColumn(total, F.col("__total"))
    return out.drop(BUCKET, "__before", "__total", "__size")


def previous_and_next(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str],
                      buckets: FixedBuckets | CutBuckets) -> DataFrame:
    """Each row with its neighbours of the same key as ``prev`` / ``next`` structs (ts, columns).

    A shift inside each bucket, plus the last row of the bucket before and the
    first of the one after. ``(keys, ts)`` must be unique.
    """
    placed = buckets.assign(df, ts).withColumn("__p", F.struct(ts, *columns))
    by = [*keys, BUCKET]
    inside = Window.partitionBy(*by).orderBy(ts)
    edges = placed.groupBy(*by).agg(F.min_by("__p", ts).alias("__first"), F.max_by("__p", ts).alias("__last"))
    series = Window.partitionBy(*keys).orderBy(BUCKET)
    edges = edges.select(
        *by, F.lag("__last").over(series).alias("__before"), F.lead("__first").over(series).alias("__after")
    )
    local = placed.select("*", F.lag("__p").over(inside).alias("__lag"), F.lead("__p").over(inside).alias("__lead"))
    return attach(local, edges, by, "inner").select(
        *df.columns,
        F.coalesce("__lag", "__before").alias("prev"),
        F.coalesce("__lead", "__after").alias("next"),
    )
