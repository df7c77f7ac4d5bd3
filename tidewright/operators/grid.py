"""Regular grids, replication onto finer grids and gap fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions.cleaning import root_mean_square
from tidewright.functions.timekeys import floor_step, micros, ntz_from_seconds, seconds
from tidewright.operators.scan import (
    CutBuckets, FixedBuckets, attach, grid_buckets, nearest_known, previous_and_next, row_position,
)

# Grid instants generated per source row; keeps arrays small for long series.
GRID_CHUNK_STEPS = 4096


def grid_instants(bounds: DataFrame, keys: Sequence[str], ts: str, step_seconds: int) -> DataFrame:
    """Every instant from ``lo`` to ``hi`` per series.

    Generated in chunks that are spread over the shuffle partitions first, so a
    long series is not produced by one task.
    """
    chunk = step_seconds * GRID_CHUNK_STEPS
    parallel = int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = bounds.select(*keys, seconds(F.col("lo")).alias("__lo"), seconds(F.col("hi")).alias("__hi"))
    chunks = span.select(
        *keys, "__hi", F.explode(F.sequence("__lo", "__hi", F.lit(chunk))).alias("__from")
    ).repartition(parallel, *keys, "__from")
    upto = F.least(F.col("__hi"), F.col("__from") + chunk - step_seconds)
    steps = chunks.select(*keys, F.explode(F.sequence(F.col("__from"), upto, F.lit(step_seconds))).alias("__at"))
    return steps.select(*keys, ntz_from_seconds(F.col("__at")).alias(ts))


def regular_grid(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    step_seconds: int,
    tie_break: Sequence[str] = (),
    rolled_up: bool = False,
) -> DataFrame:
    """Reindex onto floor(min) ... floor(max); only exact hits keep their values.

    Of several rows on one instant the first in ``tie_break`` order wins, by
    default the most complete one.
    ``rolled_up`` input (one row per series and step, on the step) skips the
    dedupe and is aggregated from the raw rows only once.
    """
    for c in (*keys, ts):
        df = df.filter(F.col(c).isNotNull())
    values = [c for c in df.columns if c not in (*keys, ts)]
    lo, hi = floor_step(F.min(ts), step_seconds), floor_step(F.max(ts), step_seconds)
    if rolled_up:
        # Asking for the values too keeps this branch on the shuffle of the data
        # branch, so the rollup below is computed once; the filter is always true.
        touched = sum((F.count(v) for v in values), F.count("*"))
        bounds = df.groupBy(*keys).agg(lo.alias("lo"), hi.alias("hi"), touched.alias("__n")).filter("__n >= 0")
        return grid_instants(bounds, keys, ts, step_seconds).join(df, [*keys, ts], "left").select(*keys, ts, *values)
    bounds = df.groupBy(*keys).agg(lo.alias("lo"), hi.alias("hi"))
    slots = grid_instants(bounds, keys, ts, step_seconds)
    if not values:
        return slots
    return slots.join(exact_hits(df, keys, ts, step_seconds, tie_break), [*keys, ts], "left").select(*keys, ts, *values)


def exact_hits(df: DataFrame, keys: Sequence[str], ts: str, step_seconds: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per series and grid instant: the first in ``tie_break`` order, else the one with the fewest nulls."""
    values = [c for c in df.columns if c not in (*keys, ts)]
    hits = df.filter(F.pmod(micros(F.col(ts)), F.lit(step_seconds * 1_000_000)) == 0)
    holes = sum((F.col(c).isNull().cast("int") for c in values), F.lit(0))
    rank = F.struct(*tie_break) if tie_break else F.struct(holes.alias("holes"), *values)
    return hits.groupBy(*keys, ts).agg(F.min_by(F.struct(*values), rank).alias("__row")).select(*keys, ts, "__row.*")


def interpolate_linear(
    grid: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    step_seconds: int | None = None,
    limit: int | None = None,
    digits: int | None = 4,
    buckets: FixedBuckets | CutBuckets | None = None,
    by_position: str | None = None,
) -> DataFrame:
    """Linear fill; at most ``limit`` steps from a known point on either side.

    Before the first and after the last known point the nearest value is
    extended. ``by_position`` names a row-number column to measure distance in
    rows instead of time (needed when the instants are not equally spaced).
    """
    if buckets is None:
        buckets = grid_buckets(step_seconds)
    axis = by_position or ts
    near = nearest_known(grid, keys, ts, columns, buckets, axis=axis)

    def steps(later: Column, earlier: Column) -> Column:
        if by_position:
            return (later - earlier).cast("double")
        return (micros(later) - micros(earlier)) / F.lit((step_seconds or 1) * 1e6)

    filled = []
    for c in columns:
        prev, nxt = F.col(f"{c}__pv").cast("double"), F.col(f"{c}__nv").cast("double")
        back, ahead = steps(F.col(axis), F.col(f"{c}__pt")), steps(F.col(f"{c}__nt"), F.col(axis))
        value = (
            F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
            .when(prev.isNull(), nxt)
            .when(nxt.isNull(), prev)
            .otherwise(prev + (nxt - prev) * back / (back + ahead))
        )
        if limit is not None:
            value = F.when((back <= limit) | (ahead <= limit), value)
        if digits is not None:
            value = F.round(value, digits)
        filled.append(value.alias(c))
    rest = [c for c in grid.columns if c not in columns]
    return near.select(*rest, *filled).select(*grid.columns)


def refresh_interpolated(
    table: DataFrame, df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], step_seconds: int,
    limit: int, cutoff: Column, digits: int | None = 4, tie_break: Sequence[str] = (),
) -> DataFrame:
    """``table`` after new rows arrived in ``df`` from ``cutoff`` on; equal to the full grid and limited fill of ``df``.

    New points change fills back to the last known point before the cutoff, however old it is.
    Per series the rebuild starts at the oldest such point of a column that has new points, and each
    column's last known point before that start is one more anchor, so only that span is filled again.
    """
    for c in (*keys, ts):
        df = df.filter(F.col(c).isNotNull())
    step = F.make_dt_interval(secs=F.lit(step_seconds).cast("decimal(18,6)"))
    at = F.col(ts)
    bound = floor_step(cutoff, step_seconds)
    hits = exact_hits(df, keys, ts, step_seconds, tie_break)
    ends = df.groupBy(*keys).agg(floor_step(F.min(ts), step_seconds).alias("__lo"), floor_step(F.max(ts), step_seconds).alias("__hi"))
    old = {c: F.when(F.col(c).isNotNull() & (at < bound), at) for c in columns}
    facts = hits.groupBy(*keys).agg(
        *[F.max(old[c]).alias(f"__p_{c}") for c in columns],
        *[F.max(F.col(c).isNotNull() & (at >= bound)).alias(f"__new_{c}") for c in columns])
    first = [F.when(F.col(f"__new_{c}"), F.coalesce(f"__p_{c}", bound - step * limit)) for c in columns]
    start = F.greatest(F.col("__lo"), F.least(bound, *first)) if columns else F.greatest("__lo", bound)
    spans = attach(ends, facts.select(*keys, *[c for c in facts.columns if c not in keys]), keys, "left") if keys else ends.join(facts)
    spans = spans.select(*keys, start.alias("__start"), "__hi")
    ranged = attach(hits, spans, keys, "inner") if keys else hits.join(spans)
    later = ranged.filter(at >= F.col("__start")).select(*hits.columns)
    before = {c: F.when(F.col(c).isNotNull(), at) for c in columns}
    anchors = ranged.filter(at < F.col("__start")).groupBy(*keys).agg(
        *[F.struct(F.max(before[c]).alias(ts), F.max_by(c, before[c]).alias("v")).alias(f"__a_{c}") for c in columns])
    rows = F.array(*[
        F.struct(F.col(f"__a_{c}")[ts].alias(ts), *[(F.col(f"__a_{c}")["v"] if o == c else F.lit(None)).cast(df.schema[o].dataType).alias(o) for o in columns])
        for c in columns])
    anchors = (anchors.select(*keys, F.inline(rows)).filter(F.col(ts).isNotNull())
               .groupBy(*keys, ts).agg(*[F.max(c).alias(c) for c in columns]).withColumn("__anchor", F.lit(True)))
    slots = grid_instants(spans.filter(F.col("__start") <= F.col("__hi")).select(*keys, F.col("__start").alias("lo"), F.col("__hi").alias("hi")), keys, ts, step_seconds)
    grid = slots.join(later, [*keys, ts], "left").withColumn("__anchor", F.lit(False))
    filled = interpolate_linear(grid.unionByName(anchors, allowMissingColumns=True), keys, ts, columns, step_seconds, limit, digits)
    fresh = filled.filter(~F.col("__anchor")).select(*table.columns)
    # Rows before a series' start stay; a series that df does not hold goes, as it would in the full fill.
    kept = attach(table, spans, keys, "inner") if keys else table.join(spans)
    return kept.filter(at < F.col("__start")).select(*table.columns).unionByName(fresh)


def interpolate_onto(
    instants: DataFrame,
    sparse: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    buckets: FixedBuckets | CutBuckets,
    digits: int | None = 4,
) -> DataFrame:
    """Attach a sparse series to a table's own instants, filling in between.

    Sparse readings that fall on none of the instants are ignored, as in a left
    join followed by a fill by row position.
    """
    wanted = instants.select(*keys, ts).distinct()
    both = wanted.join(sparse.select(*keys, ts, *columns), [*keys, ts], "left")
    numbered = row_position(both, keys, [ts], buckets, name="__pos")
    filled = interpolate_linear(
        numbered, keys, ts, columns, digits=digits, buckets=buckets, by_position="__pos"
    )
    return filled.drop("__pos")


def known_points(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str]) -> DataFrame:
    """(keys, ts, __c, __v): the non-null values of all columns as rows; ``__c`` is the place in ``columns``."""
    points = F.array(*[F.struct(F.lit(i).alias("__c"), F.col(c).cast("double").alias("__v")) for i, c in enumerate(columns)])
    return df.select(*keys, ts, F.inline(points)).filter(F.col("__v").isNotNull())


def with_points(df: DataFrame, points: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], value: str) -> DataFrame:
    """``df`` with the column ``value`` of :func:`known_points` rows as ``__p0``, ``__p1``, ..., one a column."""
    wide = points.groupBy(*keys, ts).agg(
        *[F.first(F.when(F.col("__c") == i, F.col(value)), ignorenulls=True).alias(f"__p{i}") for i in range(len(columns))])
    return attach(df, wide, [*keys, ts])


def interpolate_local(
    grid: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    step_seconds: int,
    order: int = 3,
    digits: int | None = 4,
    buckets: FixedBuckets | CutBuckets | None = None,
) -> DataFrame:
    """Quadratic (``order=2``) or cubic (``order=3``) fill through nearby known points.

    Uses the two known points before the gap and one (quadratic) or two (cubic)
    after it, weighted by Lagrange polynomials in time. With fewer neighbours the
    fill is linear, at the edges the nearest value is extended. All columns share the
    same shuffles: known points are rows of (series, column) until each has its neighbours.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    if buckets is None:
        buckets = grid_buckets(step_seconds)
    # The known points alone carry their own neighbour before and after, so one
    # look-back and one look-ahead per grid row reach two points on each side.
    known = known_points(grid, keys, ts, columns)
    linked = previous_and_next(known, [*keys, "__c"], ts, ["__v"], buckets)
    linked = linked.withColumn("__chain", F.struct("prev", F.struct(ts, "__v").alias("here"), "next"))
    tagged = with_points(grid, linked, keys, ts, columns, "__chain")
    near = nearest_known(tagged, keys, ts, [f"__p{i}" for i in range(len(columns))], buckets, instants=False)
    x = seconds(F.col(ts)).cast("double")

    def lagrange(points):
        xs = [seconds(p[ts]).cast("double") for p in points]
        total = F.lit(0.0)
        for i, p in enumerate(points):
            weight = p["__v"]
            for j in range(len(points)):
                if j != i:
                    weight = weight * (x - xs[j]) / (xs[i] - xs[j])
            total = total + weight
        return total

    def filled(i: int, c: str) -> Column:
        p1, p0 = F.col(f"__p{i}__pv.prev"), F.col(f"__p{i}__pv.here")
        n0, n1 = F.col(f"__p{i}__nv.here"), F.col(f"__p{i}__nv.next")
        curve = [p1, p0, n0] if order == 2 else [p1, p0, n0, n1]
        enough = p1.isNotNull() & n0.isNotNull()
        if order == 3:
            enough = enough & n1.isNotNull()
        value = (
            F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
            .when(p0.isNull(), n0["__v"])
            .when(n0.isNull(), p0["__v"])
            .when(enough, lagrange(curve))
            .otherwise(lagrange([p0, n0]))
        )
        return (value if digits is None else F.round(value, digits)).alias(c)

    made = {c: filled(i, c) for i, c in enumerate(columns)}
    return near.select(*[made.get(c, F.col(c)) for c in grid.columns])


def fill_gaps(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    buckets: FixedBuckets | CutBuckets,
    backward_too: bool = True,
    default: float | None = None,
) -> DataFrame:
    """Forward fill, then backward fill and / or a default."""
    near = nearest_known(df, keys, ts, columns, buckets, forward=backward_too, instants=False)

    def value(c: str) -> Column:
        parts = [F.col(f"{c}__pv")]
        if backward_too:
            parts.append(F.col(f"{c}__nv"))
        if default is not None:
            parts.append(F.lit(default))
        return F.coalesce(*parts).alias(c)

    return near.select(*[value(c) if c in columns else F.col(c) for c in df.columns])


def replicate(df: DataFrame, ts: str, step_seconds: int, copies: int) -> DataFrame:
    """Repeat each row ``copies`` times, ``step_seconds`` apart, starting at its own instant."""
    if copies < 1:
        raise ValueError("copies must be at least 1")
    offsets = F.explode(F.sequence(F.lit(0), F.lit((copies - 1) * step_seconds), F.lit(step_seconds)))
    moved = (F.col(ts) + F.make_dt_interval(secs=F.col("__off").cast("decimal(18,6)"))).alias(ts)
    spread = df.select("*", offsets.alias("__off"))
    return spread.select(*[moved if c == ts else F.col(c) for c in df.columns])


def replicate_to_hours(df: DataFrame, keys: Sequence[str], ts: str, hours: int = 3, tie_break: Sequence[str] = ()) -> DataFrame:
    """Three-hourly rows onto hours, one row per (series, hour); the latest source row wins."""
    values = [c for c in df.columns if c not in (*keys, ts)]
    spread = replicate(df.withColumn("__src", F.col(ts)), ts, 3600, hours)
    rank = F.struct("__src", *(tie_break or values))
    return (
        spread.groupBy(*keys, F.date_trunc("hour", ts).cast("timestamp_ntz").alias(ts))
        .agg(F.max_by(F.struct(*values), rank).alias("__row"))
        .select(*keys, ts, "__row.*")
    )


def rms_gap_rows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    numeric: Sequence[str],
    buckets: FixedBuckets | CutBuckets,
    gap_hours: int = 3,
) -> DataFrame:
    """Synthetic rows inside gaps of exactly ``gap_hours`` between neighbours.

    Numbers are the root mean square of both ends (null if either is null),
    everything else comes from the newer end, ``synthetic`` is true. ``(keys, ts)``
    must be unique.
    """
    others = [c for c in df.columns if c not in (*keys, ts, "synthetic", *numeric)]
    linked = previous_and_next(df.select(*keys, ts, *numeric, *others), keys, ts, numeric, buckets)
    older = F.col("prev")
    gaps = linked.filter(micros(F.col(ts)) - micros(older[ts]) == gap_hours * 3_600_000_000)
    spread = gaps.select("*", F.explode(F.sequence(F.lit(1), F.lit(gap_hours - 1))).alias("__h"))
    return spread.select(
        *keys,
        (older[ts] + F.make_dt_interval(hours=F.col("__h"))).alias(ts),
        *[root_mean_square(older[c].cast("double"), F.col(c).cast("double")).alias(c) for c in numeric],
        *others,
        F.lit(True).alias("synthetic"),
    )


def extend_last_row(df: DataFrame, keys: Sequence[str], ts: str, now: Column, step_seconds: int | None = None) -> DataFrame:
    """Repeat the newest row of a series at ``now`` if the series is behind.

    With ``step_seconds`` it is repeated at every step up to ``now``, so that a feed
    several steps behind leaves no hole in a regular grid.
    """
    values = [c for c in df.columns if c not in (*keys, ts)]
    newest = df.groupBy(*keys).agg(F.max(ts).alias("__last"), F.max_by(F.struct(*values), ts).alias("__row"))
    stale = newest.filter(F.col("__last") < now)
    if step_seconds:
        step = F.make_dt_interval(secs=F.lit(step_seconds).cast("decimal(18,6)"))
        slots = F.explode(F.sequence(F.col("__last") + step, now.cast("timestamp_ntz"), step))
        stale = stale.filter(F.col("__last") + step <= now)
    else:
        slots = now.cast("timestamp_ntz")
    return df.unionByName(stale.select(*keys, slots.alias(ts), "__row.*").select(*df.columns))


def append_future(history: DataFrame, future: DataFrame, ts: str, start: Column, hours: int = 14) -> DataFrame:
    """Past rows plus the exogenous rows of the next ``hours``; absent columns are null."""
    ahead = future.filter((F.col(ts) > start) & (F.col(ts) <= start + F.make_dt_interval(hours=F.lit(hours))))
    return history.unionByName(ahead, allowMissingColumns=True)
