"""Spine joins, nearest-time joins, overlays and scalar bounds.

No side is force-broadcast: Spark broadcasts below its size threshold from
statistics or at run time and shuffles on the key otherwise. Sides are reduced
to one row per key before they are joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions.timekeys import micros
from tidewright.operators.scan import CutBuckets, FixedBuckets, attach, nearest_known


def spine_join(spine: DataFrame, sides: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """Chain of left joins; every side holds at most one row per key."""
    return reduce(lambda left, side: left.join(side, on, "left"), sides, spine)


def key_union(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Distinct union of the keys of all frames, null keys left out."""
    keys = reduce(DataFrame.unionByName, [f.select(*on) for f in frames])
    return keys.dropna(subset=list(on)).distinct()


def full_coverage_join(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Every key that occurs anywhere, with the columns of all frames; null keys left out."""
    return _fold([f.dropna(subset=list(on)) for f in frames], list(on))


def outer_fold(frames: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """Full outer join of n frames on the same key; a row with a null key meets no other."""
    keys = [on] if isinstance(on, str) else list(on)
    alone = F.when(reduce(Column.__or__, [F.col(k).isNull() for k in keys]), F.monotonically_increasing_id())
    # The number is unique within its frame only, so the frame's place goes with it.
    marked = [f.withColumn("__alone", F.when(alone.isNotNull(), F.struct(F.lit(i).alias("frame"), alone.alias("row")))) for i, f in enumerate(frames)]
    return _fold(marked, [*keys, "__alone"]).drop("__alone")


def _fold(frames: Sequence[DataFrame], on: list[str]) -> DataFrame:
    """Frames with at most one row per key side by side, by one union and one shuffle whatever their number."""
    values = [c for f in frames for c in f.columns if c not in on]
    if len(set(values)) < len(values):
        raise ValueError(f"columns occur in several frames: {sorted({c for c in values if values.count(c) > 1})}")
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
    return rows.groupBy(*on).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def pivot_columns(series: str, value: str, names: Sequence[str], prefix: str = "") -> list[Column]:
    """One mean per name; ``names`` is declared, so no job is needed to discover it."""
    return [F.avg(F.when(F.col(series) == n, F.col(value))).alias(f"{prefix}{n}") for n in names]


def pivot_series(
    df: DataFrame, index: Sequence[str], series: str, value: str, names: Sequence[str], prefix: str = ""
) -> DataFrame:
    """Long series to one column per name, in one aggregation."""
    return df.groupBy(*index).agg(*pivot_columns(series, value, names, prefix))


def join_on_hour(df: DataFrame, hourly: DataFrame, ts: str, hour: str = "ts_hour") -> DataFrame:
    keyed = df.withColumn(hour, F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz"))
    return keyed.join(hourly, hour, "left").drop(hour)


def join_on_day(df: DataFrame, daily: DataFrame, ts: str, day: str = "day") -> DataFrame:
    return df.withColumn(day, F.to_date(ts)).join(daily, day, "left").drop(day)


def nearest_time_join(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    columns: Sequence[str],
    buckets: FixedBuckets | CutBuckets,
    keys: Sequence[str] = (),
    tolerance_seconds: int | None = None,
    direction: str = "nearest",
    tie_break: Sequence[str] = (),
    matched: str = "matched_ts",
    left_unique: bool = False,
) -> DataFrame:
    """Attach the right row closest in time; equal gaps go to the earlier one.

    Both sides are reduced to distinct (series, instant) rows, merged into one
    ordered sequence and scanned bucket by bucket; no pairs are formed. Left rows
    sharing an instant get the answer back by an equi-join, which AQE can split
    when one instant dominates (``left_unique`` skips it).
    """
    if direction not in ("nearest", "backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    by = [*keys, ts]
    kind = right.select(F.struct(*columns).alias("r")).schema["r"].dataType
    order = F.struct(*(tie_break or columns))
    rank_kind = right.select(order.alias("o")).schema["o"].dataType
    asked = left.select(*by, F.lit(True).alias("__asked"), F.lit(None).cast(kind).alias("__r"), F.lit(None).cast(rank_kind).alias("__o"))
    answers = right.select(*by, F.lit(False).alias("__asked"), F.struct(*columns).alias("__r"), order.alias("__o"))
    points = asked.unionByName(answers).filter(F.col(ts).isNotNull()).groupBy(*by).agg(
        F.max("__asked").alias("__asked"), F.min_by("__r", "__o").alias("__r")
    )
    near = nearest_known(
        points, keys, ts, ["__r"], buckets,
        backward=direction != "forward", forward=direction != "backward", touch=["__asked"],
    ).filter("__asked")

    missing_t = F.lit(None).cast("timestamp_ntz")
    missing_r = F.lit(None).cast(kind)
    prev_t, prev_r = (F.col("__r__pt"), F.col("__r__pv")) if direction != "forward" else (missing_t, missing_r)
    next_t, next_r = (F.col("__r__nt"), F.col("__r__nv")) if direction != "backward" else (missing_t, missing_r)
    back, ahead = micros(F.col(ts)) - micros(prev_t), micros(next_t) - micros(F.col(ts))
    use_prev = prev_t.isNotNull() & (next_t.isNull() | (back <= ahead))
    gap = F.when(use_prev, back).otherwise(ahead)
    hit = gap.isNotNull()
    if tolerance_seconds is not None:
        hit = hit & (gap <= tolerance_seconds * 1_000_000)
    found = near.select(
        *by,
        F.when(hit, F.when(use_prev, prev_t).otherwise(next_t)).alias(matched),
        F.when(hit, F.when(use_prev, prev_r).otherwise(next_r)).alias("__r"),
    ).select(*by, matched, "__r.*")
    if left_unique and set(left.columns) == set(by):
        return found
    return attach(left, found, by)


def combine_first(left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join; the right value wins where present."""
    renamed = right.select(*on, *[F.col(c).alias(f"__new_{c}") for c in columns])
    joined = left.join(renamed, list(on), "left")

    def value(c: str) -> Column:
        if c not in columns:
            return F.col(c)
        old = F.col(c) if c in left.columns else F.lit(None)
        return F.coalesce(F.col(f"__new_{c}"), old).alias(c)

    return joined.select(*[value(c) for c in dict.fromkeys([*left.columns, *columns])])


def new_keys_only(df: DataFrame, existing: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(existing.select(*on), list(on), "left_anti")


def up_to_scalar(df: DataFrame, ts: str, bound: DataFrame) -> DataFrame:
    """Rows up to a data-dependent instant; ``bound`` is a one-row, one-column frame.

    A scalar subquery, evaluated once and usable by the Parquet scan.
    """
    return df.filter(F.col(ts) <= bound.scalar())


def between_scalar_and(df: DataFrame, ts: str, lower: DataFrame, now: Column) -> DataFrame:
    return df.filter((F.col(ts) >= lower.scalar()) & (F.col(ts) <= now))


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row."""
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


def horizon_slice(
    origins: DataFrame,
    readings: DataFrame,
    origin_ts: str,
    ts: str,
    step_seconds: int,
    steps: int,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Readings at origin, origin+1 step, ... origin+``steps`` steps for every origin.

    On a grid a time range is a list of instants, so the range join is an
    equi-join on (series, instant) with a fixed fan-out.
    """
    at = origins.select(
        *keys, origin_ts, F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("ahead")
    ).withColumn(ts, F.col(origin_ts) + F.make_dt_interval(secs=(F.col("ahead") * step_seconds).cast("decimal(18,6)")))
    return at.join(readings, [*keys, ts])

