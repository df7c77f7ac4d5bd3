"""Chronological splits, folds, error metrics and audit columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.functions.cleaning import percent_accuracy
from tidewright.operators.scan import CutBuckets, FixedBuckets, halo_window, row_position


def chronological_split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: FixedBuckets | CutBuckets,
    shares: Sequence[tuple[str, float]] = (("train", 0.8), ("validation", 0.1), ("test", 0.1)),
) -> DataFrame:
    """Tag rows by position in time order: the first 80 % train, and so on.

    Cut positions are ``floor(n * share)`` per part, the last part takes the rest.
    """
    placed = row_position(df, keys, order, buckets, name="__pos", total="__n")
    label: Column | None = None
    edge = F.lit(0)
    for name, share in shares[:-1]:
        edge = edge + F.floor(F.col("__n") * F.lit(share))
        test = F.col("__pos") <= edge
        label = F.when(test, name) if label is None else label.when(test, name)
    tagged = label.otherwise(shares[-1][0]) if label is not None else F.lit(shares[-1][0])
    return placed.select(*df.columns, tagged.alias("split"))


def expanding_folds(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: FixedBuckets | CutBuckets,
    folds: int = 5,
) -> DataFrame:
    """Rows tagged (fold, role): each fold tests the next block, trains on all rows before.

    A block has ``n // (folds + 1)`` rows and the last one ends at the last row. A
    row appears at most once per fold.
    """
    placed = row_position(df, keys, order, buckets, name="__pos", total="__n")
    block = F.floor(F.col("__n") / (folds + 1))
    spread = placed.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    start = F.col("__n") - (folds + 1 - F.col("fold")) * block
    role = F.when(F.col("__pos") <= start, "train").when(F.col("__pos") <= start + block, "test")
    return spread.withColumn("role", role).filter(F.col("role").isNotNull()).select(*df.columns, "fold", "role")


def fold_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: FixedBuckets | CutBuckets, folds: int = 5
) -> DataFrame:
    """Every row once with its ``block``: fold ``f`` tests block ``f`` and trains on the blocks below it.

    The folds of :func:`expanding_folds` without a copy of the rows per fold.
    """
    placed = row_position(df, keys, order, buckets, name="__pos", total="__n")
    size = F.floor(F.col("__n") / (folds + 1))
    past = F.col("__pos") - (F.col("__n") - folds * size)
    block = F.when((size > 0) & (past > 0), F.ceil(past / size)).otherwise(F.lit(0))
    return placed.withColumn("block", block.cast("int")).select(*df.columns, "block")


def rolling_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: FixedBuckets | CutBuckets, size: int = 2
) -> DataFrame:
    """Number the evaluation blocks and the row inside each (``+1h``, ``+2h``, ...).

    Blocks start at positions 0, size, 2*size, ... below ``n - size``, so the tail
    that cannot start a block is left out.
    """
    placed = row_position(df, keys, order, buckets, name="__pos", total="__n")
    zero_based = F.col("__pos") - 1
    block = F.floor(zero_based / size)
    kept = placed.filter(block * size < F.col("__n") - size)
    inside = F.pmod(F.col("__pos") - 1, F.lit(size)) + 1
    return kept.select(*df.columns, block.alias("block"), F.concat(F.lit("+"), inside.cast("int").cast("string"), F.lit("h")).alias("step"))


def error_metrics(
    df: DataFrame, keys: Sequence[str], real: str = "real", predicted: str = "pred",
    threshold: float = 0.5, digits: int | None = 3,
) -> DataFrame:
    """MAE, RMSE, R² and share of absolute errors below ``threshold`` (percent).

    R² is ``1 - SSE / SST`` (not the squared correlation); null when the truth is
    constant. Rows missing either side are left out. One partial aggregation.
    """
    known = df.filter(F.col(real).isNotNull() & F.col(predicted).isNotNull())
    error = F.col(real) - F.col(predicted)
    squared = F.sum(error * error)
    spread = F.var_pop(real) * F.count("*")
    measures = {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": 1 - squared / F.nullif(spread, F.lit(0.0)),
        "within_pct": F.avg((F.abs(error) < threshold).cast("double")) * 100,
    }
    shown = [(F.round(m, digits) if digits is not None else m).alias(n) for n, m in measures.items()]
    return known.groupBy(*keys).agg(F.count("*").alias("n"), *shown)


def threshold_accuracy(
    df: DataFrame, keys: Sequence[str], real: str, predicted: str, thresholds: Sequence[float] = (0.3, 0.5)
) -> DataFrame:
    error = F.abs(F.col(real) - F.col(predicted))
    return df.groupBy(*keys).agg(
        *[F.round(F.avg((error < t).cast("double")) * 100, 3).alias(f"within_{str(t).replace('.', '_')}") for t in thresholds]
    )


def naive_forecast(
    grid: DataFrame, keys: Sequence[str], ts: str, step_seconds: int, value: str, horizon: int = 2
) -> DataFrame:
    """Persistence baseline: the value ``horizon`` steps ago predicts the present one."""
    out = halo_window(
        grid, keys, ts, step_seconds, horizon, 0, lambda w: [F.lag(value, horizon).over(w).alias("pred")]
    )
    return out.withColumn("real", F.col(value)).filter(F.col("real").isNotNull() & F.col("pred").isNotNull())


def last_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 300) -> DataFrame:
    """Newest ``n`` rows per key; Spark limits each group before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") <= n).drop("__rn")


def audit(
    forecasts: DataFrame, truth: DataFrame, on: str, dynamic: str, frozen: str, real: str
) -> DataFrame:
    """Forecasts next to the later measurement, with errors and percent accuracy."""
    joined = forecasts.join(truth.select(on, real), on, "left")
    r, d, f = F.col(real), F.col(dynamic), F.col(frozen)
    return joined.select(
        on,
        F.round(d, 3).alias("previsto_dinamico"),
        F.round(f, 3).alias("previsto_2h_congelado"),
        F.round(r, 3).alias("medicao_real_boia"),
        F.round(F.abs(r - d), 3).alias("erro_dinamico_nos"),
        F.round(F.abs(r - f), 3).alias("erro_2h_nos"),
        F.round(percent_accuracy(r, d), 1).alias("acerto_perc_dinamico"),
        F.round(percent_accuracy(r, f), 1).alias("acerto_perc_2h"),
    )


def audit_daily(view: DataFrame, on: str, digits: int = 2) -> DataFrame:
    """Mean frozen-forecast accuracy per day, over hours where both values exist."""
    both = view.filter(F.col("previsto_2h_congelado").isNotNull() & F.col("medicao_real_boia").isNotNull())
    return both.groupBy(F.to_date(on).alias("dia")).agg(
        F.round(F.avg("acerto_perc_2h"), digits).alias("assertividade_media_dia"), F.count("*").alias("horas")
    )
