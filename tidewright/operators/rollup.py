"""Hour and step rollups, latest-row picks and dedupe.

Picks are aggregations wherever the result is one row per key, so a hot key is
reduced before the shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewright.functions.timekeys import floor_step, hour_key


def rollup(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    means: Sequence[str],
    labels: Sequence[str] = (),
    step_seconds: int = 3600,
    tie_break: Sequence[str] = (),
    bucket: str = "ts_hour",
    last_instant: str | None = None,
) -> DataFrame:
    """Mean of ``means``, earliest non-null of ``labels`` per (series, step).

    Labels at the same instant are settled by ``tie_break``, then by value.
    """
    def earliest(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(ts, *tie_break, c))).alias(c)

    aggs = [F.avg(c).alias(c) for c in means] + [earliest(c) for c in labels]
    if last_instant is not None:
        aggs.append(F.max(ts).alias(last_instant))
    key = hour_key(F.col(ts)) if step_seconds == 3600 else floor_step(F.col(ts), step_seconds)
    return df.groupBy(*keys, key.alias(bucket)).agg(*aggs)


def rollup_by_type(
    df: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[str] = (), bucket: str = "ts_hour"
) -> DataFrame:
    """Hour rollup whose aggregate follows the column type: mean for numbers, first for the rest."""
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    skip = {*keys, ts, *tie_break}
    means = [c for c in numbers if c not in skip]
    labels = [c for c in df.columns if c not in skip and c not in means]
    return rollup(df, keys, ts, means, labels, tie_break=tie_break, bucket=bucket)


def hour_end(bucket: str) -> Column:
    """Closing minute of an hour row (hh:59)."""
    return F.col(bucket) + F.make_dt_interval(mins=F.lit(59))


def rollup_hour_and_instant(df: DataFrame, ts: str, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per (hour, exact instant); values of repeated instants are the smallest non-null."""
    return df.groupBy(*keys, hour_key(F.col(ts)).alias("ts_hour"), ts).agg(*[F.min(c).alias(c) for c in values])


def latest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], newest: bool = True) -> DataFrame:
    """One whole row per key: the last (or first) in ``order``, which must be total."""
    row = F.struct(*df.columns)
    rank = F.struct(*order)
    pick = F.max_by if newest else F.min_by
    return df.groupBy(*keys).agg(pick(row, rank).alias("__row")).select("__row.*")


def latest_per_hour(df: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest row of each (series, hour), tagged with ``ts_hour``."""
    tagged = df.withColumn("ts_hour", hour_key(F.col(ts)))
    return latest_per_group(tagged, [*keys, "ts_hour"], [ts, *tie_break])


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """Keep one row per key, first or last in a total ``order``."""
    return latest_per_group(df, keys, order, newest=keep == "last")


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, rank: str | None = None
) -> DataFrame:
    """Newest ``n`` rows per key.

    ``row_number() <= n`` lets Spark keep only ``n`` rows per key and task before
    the shuffle (window group limit), so hot keys stay cheap.
    """
    name = rank or "__rank"
    window = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    out = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest_two_aged(df: DataFrame, keys: Sequence[str], ts: str, now: Column, age_hours: int = 3,
                    tie_break: Sequence[str] = ()) -> DataFrame:
    """Two newest rows per key that are at least ``age_hours`` old; of rows on one instant the last in ``tie_break`` order counts as newer."""
    old_enough = df.filter(F.col(ts) <= now - F.make_dt_interval(hours=F.lit(age_hours)))
    return top_n_per_key(old_enough, keys, [ts, *tie_break], 2)


def partial_hour_mean(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], now: Column) -> DataFrame:
    """Mean of the running hour up to ``now``."""
    start = F.date_trunc("hour", now).cast("timestamp_ntz")
    running = df.filter((F.col(ts) >= start) & (F.col(ts) <= now))
    return running.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def time_span(df: DataFrame, ts: str) -> DataFrame:
    """One row: first and last instant."""
    return df.agg(F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max"))


def stack_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Means of several columns as rows (metric, mean)."""
    long = df.unpivot(list(keys), list(columns), "metric", "value")
    return long.groupBy(*keys, "metric").agg(F.avg("value").alias("mean"))


def collapse_runs(df: DataFrame, target: str, origin: str, value: str, frozen: str, digits: int = 4) -> DataFrame:
    """One row per target instant out of many forecast runs.

    ``dynamic`` is the value of the newest run, ``first`` the earliest non-null
    frozen value, falling back on the dynamic one.
    """
    newest = F.max_by(value, F.struct(origin, value))
    earliest = F.min_by(frozen, F.when(F.col(frozen).isNotNull(), F.struct(origin, frozen)))
    return df.groupBy(target).agg(
        F.round(newest, digits).alias("dynamic"),
        F.round(F.coalesce(earliest, newest), digits).alias("first"),
    )


def _as_text(df: DataFrame, name: str) -> Column:
    """A value as text, one text per value (-0.0 is 0.0)."""
    kind = df.schema[name].dataType
    value = F.col(name) + F.lit(0.0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(name)
    return value.cast("string")


def _with_share(counts: DataFrame) -> DataFrame:
    return counts.withColumn("zero_pct", F.col("zero_count") * 100.0 / F.nullif("row_count", F.lit(0)))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, nulls, values that read as zero, share of zeros, distinct values, an example.

    Exact at any number of columns: cells become (column, value) rows, which fold per value before the shuffle;
    a second aggregation counts the values of a column. An empty table gives zeros.
    """
    cells = df.select(*[_as_text(df, c).alias(c) for c in columns]).unpivot([], list(columns), "column_name", "value")
    values = cells.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    none = df.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name"), F.lit(None).cast("string").alias("value"),
        F.lit(0).cast("long").alias("n"))
    value = F.col("value")
    return _with_share(values.unionByName(none).groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.when(value.isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.sum(F.when(value.try_cast("double") == 0, F.col("n")).otherwise(0)).alias("zero_count"),
        F.count("value").alias("distinct_count"),
        F.min("value").alias("example"),
    ))


def profile_days(df: DataFrame, columns: Sequence[str], day: str, log_buckets: int = 12) -> DataFrame:
    """Mergeable profile per day and column, in one partial aggregation without a row per cell.

    The table is kept and only new days are added to it; :func:`merged_profile` sums any set of days. Distinct
    values are sketched: with ``2**log_buckets`` buckets the relative error is about 1.04 / sqrt of that.
    """
    parts = [
        F.struct(
            F.lit(c).alias("column_name"), F.count("*").alias("row_count"), F.count_if(text.isNull()).alias("null_count"),
            F.count_if(text.try_cast("double") == 0).alias("zero_count"),
            # Sketches skip empty texts, so every text gets a mark.
            F.hll_sketch_agg(F.concat(F.lit("="), text), log_buckets).alias("sketch"), F.min(text).alias("example"),
        ).alias(f"__{i}")
        for i, (c, text) in enumerate((c, _as_text(df, c)) for c in columns)
    ]
    wide = df.groupBy(F.col(day).alias("day")).agg(*parts)
    return wide.select("day", F.inline(F.array(*[f"__{i}" for i in range(len(columns))])))


def merged_profile(days: DataFrame) -> DataFrame:
    """The rows of :func:`profile` out of those of :func:`profile_days`, with a sketched distinct count."""
    return _with_share(days.groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in ("row_count", "null_count", "zero_count")],
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count"),
        F.min("example").alias("example"),
    ))
