"""Named queries over the test tables, each with an equivalent SQL text where one exists."""

from tidewright.catalog import (  # noqa: F401
    evaluation, features, fills, grids, ingest, jobs, joins, linear, maintenance, models, rollups, streams,
    training,
)
from tidewright.catalog.base import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
