"""Table scans, newest-row scans and back-fill block plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewright.operators.shaping import mapped_scan


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None, merge_schema: bool = False) -> DataFrame:
    """Parquet table, pruned to ``columns`` at once."""
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    return df.select(*columns) if columns else df


def scan_mapped(spark: SparkSession, path: str, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    return mapped_scan(spark.read.parquet(path), mapping)


def scan_days(
    spark: SparkSession, path: str, ts: str, start: Column, end: Column, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows in ``[start, end)`` of a day-partitioned table.

    The day predicate prunes folders, the instant predicate reaches the row groups;
    neither can be derived from the other by the optimizer.
    """
    days = spark.read.parquet(path).filter(F.col("dt").between(F.to_date(start), F.to_date(end)))
    rows = days.filter((F.col(ts) >= start) & (F.col(ts) < end)).drop("dt")
    return rows.select(*columns) if columns else rows


def latest_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Newest ``n`` rows, back in ascending order (a top-k, not a full sort)."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def stream_readings(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None) -> DataFrame:
    """Files of a landing folder as a stream of readings."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def year_blocks(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Calendar-year blocks covering ``[start, end]``: one row per request or read."""
    years = spark.sql(
        "SELECT explode(sequence(year(:a), year(:b))) AS y", args={"a": start, "b": end}
    )
    return years.select(
        F.greatest(F.make_date("y", F.lit(1), F.lit(1)), F.lit(start)).alias("block_start"),
        F.least(F.make_date("y", F.lit(12), F.lit(31)), F.lit(end)).alias("block_end"),
    ).filter("block_start < :b".replace(":b", f"DATE'{end.isoformat()}'"))


def day_blocks(bounds: DataFrame, start: str, end: str, days: int = 182) -> DataFrame:
    """Blocks of ``days`` days per row of ``bounds``; the last one ends at ``end``."""
    first = F.explode(
        F.sequence(F.col(start), F.col(end), F.make_interval(days=F.lit(days)))
    )
    spread = bounds.select("*", first.alias("block_start"))
    return spread.withColumn("block_end", F.least(F.date_add("block_start", days - 1), F.col(end)))
