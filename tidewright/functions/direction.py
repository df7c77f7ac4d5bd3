"""Compass directions and the sign of the flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The 16 compass points, clockwise from north.
COMPASS_POINTS = (
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
)

# Compass points counted as ebb (outgoing) flow.
EBB_POINTS = ("E", "SE", "SSE", "S", "SSW", "SW", "WSW")


def compass_label(degrees: Column) -> Column:
    """16-point label, boundaries rounded half **up**; wraps, null stays null."""
    index = F.floor(F.pmod(degrees.cast("double"), F.lit(360.0)) / 22.5 + 0.5).cast("int") % 16
    # element_at() counts as non-null under ANSI mode even for a null index; get() does not.
    return F.get(F.array(*[F.lit(p) for p in COMPASS_POINTS]), index)


def sector_number(degrees: Column) -> Column:
    """Sector 0-15, boundaries rounded half to **even** (differs at 11.25, 56.25, ...)."""
    return F.rint(degrees.cast("double") / 22.5) % 16


def flow_sign(label: Column, ebb: Sequence[str] = EBB_POINTS) -> Column:
    """-1 for ebb, +1 for flood, null where the direction is unknown."""
    return F.when(label.isNotNull(), F.when(F.upper(label).isin(*ebb), -1).otherwise(1))


def signed_by_label(intensity: Column, label: Column, ebb: Sequence[str] = EBB_POINTS) -> Column:
    return intensity.try_cast("double") * flow_sign(label, ebb)


def signed_by_degrees(intensity: Column, degrees: Column, low: float = 90.0, high: float = 270.0) -> Column:
    """Negate where the direction lies strictly between ``low`` and ``high`` degrees."""
    return F.when((degrees > low) & (degrees < high), -intensity).otherwise(intensity)
