"""Lag, lead and moving-mean features, targets, sequences and scaling.

All row-count windows run on a regular grid through
:func:`tidewright.operators.scan.halo_window`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.functions.timekeys import micros
from tidewright.operators.scan import attach, halo_window


def lag_columns(window: Window, columns: Sequence[str], lags: Sequence[int]) -> list[Column]:
    """``lags`` may include 0 (the current row)."""
    return [
        (F.col(c) if n == 0 else F.lag(c, n).over(window)).alias(f"{c}_lag{n}") for n in lags for c in columns
    ]


def lead_columns(window: Window, columns: Sequence[str], leads: Sequence[int]) -> list[Column]:
    return [F.lead(c, n).over(window).alias(f"{c}_lead{n}") for n in leads for c in columns]


def moving_mean_columns(window: Window, columns: Sequence[str], widths: Sequence[int]) -> list[Column]:
    """Mean of the ``w`` rows **before** the current one; null unless all are known."""
    out = []
    for w in widths:
        frame = window.rowsBetween(-w, -1)
        for c in columns:
            out.append(F.when(F.count(c).over(frame) == w, F.avg(c).over(frame)).alias(f"{c}_ma{w}"))
    return out


def target_columns(window: Window, columns: Sequence[str], horizons: Sequence[int]) -> list[Column]:
    return [F.lead(c, h).over(window).alias(f"{c}_h{h}") for c in columns for h in horizons]


@dataclass(frozen=True)
class FeatureSpec:
    """What to build; the defaults are the 258-column matrix for 23 base columns."""

    base: tuple[str, ...]
    targets: tuple[str, ...] = ()
    lead_base: tuple[str, ...] = ()
    long_base: tuple[str, ...] = ()
    lags: tuple[int, ...] = (1, 2, 3, 4, 5)
    short_means: tuple[int, ...] = (3, 6)
    long_means: tuple[int, ...] = (12, 24, 48)
    leads: tuple[int, ...] = (1, 2, 3, 4, 5)
    horizons: tuple[int, ...] = (1, 2)

    @property
    def before(self) -> int:
        widths = [*self.lags, *self.short_means] + (list(self.long_means) if self.long_base else [])
        return max(widths, default=0)

    @property
    def after(self) -> int:
        ahead = (list(self.leads) if self.lead_base else []) + (list(self.horizons) if self.targets else [])
        return max(ahead, default=0)

    def feature_names(self) -> list[str]:
        return (
            [f"{c}_lag{n}" for n in self.lags for c in self.base]
            + [f"{c}_ma{w}" for w in self.short_means for c in self.base]
            + [f"{c}_ma{w}" for w in self.long_means for c in self.long_base]
            + [f"{c}_lead{n}" for n in self.leads for c in self.lead_base]
        )

    def target_names(self) -> list[str]:
        return [f"{c}_h{h}" for c in self.targets for h in self.horizons]

    def columns(self, window: Window) -> list[Column]:
        return (
            lag_columns(window, self.base, self.lags)
            + moving_mean_columns(window, self.base, self.short_means)
            + moving_mean_columns(window, self.long_base, self.long_means)
            + lead_columns(window, self.lead_base, self.leads)
            + target_columns(window, self.targets, self.horizons)
        )


def feature_matrix(
    grid: DataFrame,
    keys: Sequence[str],
    ts: str,
    step_seconds: int,
    spec: FeatureSpec,
    complete: bool = True,
    checked: bool = True,
) -> DataFrame:
    """Features and targets per grid row, incomplete rows dropped unless told otherwise.

    ``checked`` fails the job if two neighbouring rows are not one step apart:
    shifts count rows, so a hole would silently move every lag.
    """
    def columns(window: Window) -> list[Column]:
        built = spec.columns(window)
        if checked:
            gap = micros(F.col(ts)) - micros(F.lag(ts).over(window))
            built.append(
                F.when(gap != step_seconds * 1_000_000, F.raise_error(F.lit("rows are not a regular grid")).cast("int"))
                .otherwise(F.lit(0)).alias("__regular")
            )
        return built

    wide = halo_window(grid, keys, ts, step_seconds, max(spec.before, 1), spec.after, columns)
    if checked:
        wide = wide.filter(F.col("__regular") == 0)
    names = spec.feature_names() + spec.target_names()
    out = wide.select(*grid.columns, *names)
    return out.dropna("any", subset=names) if complete else out


def sequence_windows(
    grid: DataFrame, keys: Sequence[str], ts: str, step_seconds: int, columns: Sequence[str], length: int = 6
) -> DataFrame:
    """The previous ``length`` rows as an array of feature arrays (time major)."""
    def build(window: Window) -> list[Column]:
        vector = F.array(*[F.col(c).cast("float") for c in columns])
        return [F.collect_list(vector).over(window.rowsBetween(-length, -1)).alias("sequence")]

    out = halo_window(grid, keys, ts, step_seconds, length, 0, build)
    return out.filter(F.size("sequence") == length)


def fit_min_max(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Minimum and maximum per column (per key): the state of a min-max scaler."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    return df.groupBy(*keys).agg(*aggs)


def _with_fit(df: DataFrame, fit: DataFrame, keys: Sequence[str]) -> DataFrame:
    if keys:
        return attach(df, fit, keys)
    return df.select("*", *[fit.select(c).scalar().alias(c) for c in fit.columns])


def scale_min_max(
    df: DataFrame, fit: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), epsilon: float | None = None
) -> DataFrame:
    """To [0, 1] by a fitted range; a constant column becomes 0.

    With ``epsilon`` the range is widened by it instead, so nothing divides by zero.
    """
    def scaled(c: str) -> Column:
        low, high = F.col(f"{c}__min"), F.col(f"{c}__max")
        if epsilon is not None:
            return ((F.col(c) - low) / (high - low + epsilon)).alias(c)
        span = F.when(high == low, F.lit(1.0)).otherwise(high - low)
        return ((F.col(c) - low) / span).alias(c)

    return _with_fit(df, fit, keys).select([scaled(c) if c in columns else F.col(c) for c in df.columns])


def unscale_min_max(
    df: DataFrame, fit: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), epsilon: float | None = None
) -> DataFrame:
    def original(c: str) -> Column:
        low, high = F.col(f"{c}__min"), F.col(f"{c}__max")
        if epsilon is not None:
            return (F.col(c) * (high - low + epsilon) + low).alias(c)
        span = F.when(high == low, F.lit(1.0)).otherwise(high - low)
        return (F.col(c) * span + low).alias(c)

    return _with_fit(df, fit, keys).select([original(c) if c in columns else F.col(c) for c in df.columns])


def column_variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population variance per column, one pass."""
    wide = df.agg(*[F.var_pop(c).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "variance")


def varying_columns(df: DataFrame, columns: Sequence[str], threshold: float = 1e-4) -> list[str]:
    row = df.agg(*[F.var_pop(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] is not None and row[c] > threshold]
