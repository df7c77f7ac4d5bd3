"""Turns of conversations in order, however long one conversation is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.llm.common import saved


def content_keys(role: Column, text: Column) -> list[Column]:
    """Two 64-bit keys ``a`` and ``b`` of a role and a text, from one SHA-256 of both."""
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return [F.xxhash64(digest).alias("a"), F.xxhash64(F.lit("b"), digest).alias("b")]


def numbered(rows: DataFrame, key: str, order: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """Rows numbered within ``key``, nulls of ``order`` first, without one task per key.

    Returns the saved rows with ``part`` and ``local``, and (key, part, before, total): a row stands at
    ``before + local``. Rows are dealt by ranges of (key, order), so a long key lies in several
    parts; only rows that agree in all of these are never split. Narrow rows only.
    """
    placed = rows.repartitionByRange(F.col(key), *order).withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy(key, "part").orderBy(*order)
    local = saved(placed.withColumn("local", F.row_number().over(inside).cast("long")), label)
    counts = local.groupBy(key, "part").agg(F.count("*").alias("n"))
    whole = Window.partitionBy(key)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                           F.sum("n").over(whole).alias("total"))
    return local, starts
