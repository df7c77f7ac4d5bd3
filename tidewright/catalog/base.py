"""Registry and the shared inputs of the query catalogue.

``events`` stands in for the sensor feeds: ``event_type`` is the source,
``value`` the reading and ``props.k * 3.6`` its direction in degrees.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewright.operators.grid import regular_grid
from tidewright.operators.rollup import rollup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SOURCES = ("click", "error", "purchase", "signup", "view")
HOUR = 3600


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL twin."""
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """(event_id, ts, source, user_id, value, degrees)."""
    return table(spark, sf, "events").select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_type").alias("source"),
        "user_id",
        "value",
        (F.get_json_object("props", "$.k").cast("double") * 3.6).alias("degrees"),
    )


def hours(spark: SparkSession, sf: str, columns: Sequence[str] = ("value",)) -> DataFrame:
    """Hour means per source: (source, ts_hour, columns)."""
    return rollup(readings(spark, sf), ["source"], "ts", list(columns))


def grid(spark: SparkSession, sf: str, columns: Sequence[str] = ("value",)) -> DataFrame:
    """Hour means on the regular hourly grid of each source."""
    return regular_grid(hours(spark, sf, columns), ["source"], "ts_hour", HOUR, rolled_up=True)


def samples(spark: SparkSession, sf: str, columns: Sequence[str] = ("value",)) -> DataFrame:
    """First reading of each hour per source; exact decimals, unlike means."""
    return rollup(readings(spark, sf), ["source"], "ts", [], list(columns), tie_break=["event_id"])


def sample_grid(spark: SparkSession, sf: str, columns: Sequence[str] = ("value",)) -> DataFrame:
    """First reading of each hour on the regular hourly grid of each source."""
    return regular_grid(samples(spark, sf, columns), ["source"], "ts_hour", HOUR, rolled_up=True)


def shown(df: DataFrame, columns: Sequence[str], digits: int = 8) -> DataFrame:
    """Round the floating columns for comparison."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# Building blocks of the SQL twins.
R = """r AS (
  SELECT event_id, ts, event_type AS source, user_id, value,
         CAST(props->>'$.k' AS DOUBLE) * 3.6 AS degrees
  FROM events)"""
H = R + """, h AS (
  SELECT source, date_trunc('hour', ts) AS ts_hour, avg(value) AS value, avg(degrees) AS degrees
  FROM r GROUP BY ALL)"""
_GRID = """, bounds AS (SELECT source, min(ts_hour) AS lo, max(ts_hour) AS hi FROM h GROUP BY source),
slots AS (SELECT source, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts_hour FROM bounds),
g AS (SELECT slots.source, slots.ts_hour, h.value, h.degrees
      FROM slots LEFT JOIN h ON h.source = slots.source AND h.ts_hour = slots.ts_hour)"""
G = H + _GRID
S = R + """, h AS (
  SELECT source, date_trunc('hour', ts) AS ts_hour, arg_min(value, ts) AS value, arg_min(degrees, ts) AS degrees
  FROM r GROUP BY ALL)"""
SG = S + _GRID
