"""Treated tables: derived directions, regular grid, limited interpolation, tide columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewright.functions.cleaning import safe_number
from tidewright.functions.direction import EBB_POINTS, compass_label, flow_sign
from tidewright.operators.grid import interpolate_linear, interpolate_onto, refresh_interpolated, regular_grid
from tidewright.operators.joins import combine_first
from tidewright.operators.rollup import rollup_by_type
from tidewright.operators.scan import grid_buckets
from tidewright.operators.shaping import numeric_columns
from tidewright.schemas import DEPTHS
from tidewright.sinks.maintain import update_from

# Identifiers and codes that must not be interpolated.
NOT_INTERPOLATED = (
    "ow_city_id", "ow_coord_lon", "ow_coord_lat", "fc_lat", "fc_lon",
    "ow_sys_id", "ow_sys_type", "ow_timezone_offset", "air_aqi",
)
STEP_5MIN, STEP_HOUR = 300, 3600


def derive_directions(df: DataFrame, depths: Sequence[str] = DEPTHS, ebb: Sequence[str] = EBB_POINTS) -> DataFrame:
    """Compass label, flow sign and signed intensity per depth, in one projection."""
    new = []
    for depth in depths:
        if f"direcao_{depth}" not in df.columns:
            continue
        label = compass_label(safe_number(F.col(f"direcao_{depth}")))
        sign = flow_sign(label, ebb)
        new += [label.alias(f"direcao_{depth}_deg"), sign.alias(f"enchente_vazante_{depth}")]
        if f"intensidade_{depth}" in df.columns:
            new.append((safe_number(F.col(f"intensidade_{depth}")) * sign).alias(f"intensidade_{depth}_ajustada"))
    return df.select("*", *new)


def treat(
    df: DataFrame, keys: Sequence[str], ts: str, step_seconds: int, max_hours: int = 6,
    columns: Sequence[str] | None = None, tie_break: Sequence[str] = (), digits: int | None = 4,
) -> DataFrame:
    """Regular grid with limited linear fill of the numeric columns."""
    chosen = list(columns) if columns else numeric_columns(df, [*keys, ts, *NOT_INTERPOLATED])
    typed = df.withColumns({c: safe_number(F.col(c)) for c in chosen})
    grid = regular_grid(typed, keys, ts, step_seconds, tie_break)
    return interpolate_linear(grid, keys, ts, chosen, step_seconds, limit=max_hours * 3600 // step_seconds, digits=digits)


def treated_5min(master: DataFrame, columns: Sequence[str] | None = None, ts: str = "timestamp_br", digits: int | None = 4) -> DataFrame:
    return treat(derive_directions(master), [], ts, STEP_5MIN, columns=columns, digits=digits)


def treated_hour(fine: DataFrame, columns: Sequence[str] | None = None, ts: str = "timestamp_br", mode: str = "sample",
                 digits: int | None = 4) -> DataFrame:
    """Hour rows out of the 5-minute table: the reading at minute 0, or the hour mean."""
    if mode == "sample":
        return treat(fine, [], ts, STEP_HOUR, columns=columns, digits=digits)
    if mode != "mean":
        raise ValueError("mode is 'sample' or 'mean'")
    hours = rollup_by_type(fine, [], ts, bucket="__hour").withColumnRenamed("__hour", ts)
    return treat(hours, [], ts, STEP_HOUR, columns=columns, digits=digits)


def attach_tide_fine(treated: DataFrame, tide: DataFrame, ts: str = "timestamp_br",
                     columns: Sequence[str] = ("altura_prevista", "altura_prev_getmare")) -> DataFrame:
    """Hourly tide forecast interpolated onto the 5-minute instants, new values first."""
    filled = interpolate_onto(treated, tide, [], ts, columns, grid_buckets(STEP_5MIN), digits=None)
    filled = filled.withColumn("timestamp_prev", F.col(ts))
    return combine_first(treated, filled, [ts], [*columns, "timestamp_prev"])


def attach_tide_hour(treated: DataFrame, tide: DataFrame, ts: str = "timestamp_br",
                     columns: Sequence[str] = ("altura_prevista", "altura_prev_getmare"), since=None) -> DataFrame:
    """Tide columns of the matching hour, optionally only from an instant on."""
    source = tide.withColumn("__prev", F.col(ts))
    assign = {c: c for c in columns} | {"timestamp_prev": "__prev"}
    return update_from(treated, source, [ts], assign, None if since is None else F.col(ts) >= since)


def refresh_treated(treated: DataFrame, master: DataFrame, cutoff, columns: Sequence[str],
                    step_seconds: int = STEP_5MIN, max_hours: int = 6, ts: str = "timestamp_br",
                    tie_break: Sequence[str] = (), digits: int | None = 4) -> DataFrame:
    """The treated table after master rows changed from ``cutoff`` on; equal to a full treatment."""
    derived = derive_directions(master)
    typed = derived.withColumns({c: safe_number(F.col(c)) for c in columns})
    return refresh_interpolated(
        treated, typed, [], ts, columns, step_seconds, max_hours * 3600 // step_seconds, cutoff, digits=digits, tie_break=tie_break)
