"""Streaming transformations: streaming DataFrame in, streaming DataFrame out.

Event time must be ``timestamp`` (watermarks reject the zone-less type);
:func:`event_time` converts and sets the watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewright.functions.timekeys import minutes_between
from tidewright.operators.grid import rms_gap_rows
from tidewright.operators.rollup import dedupe
from tidewright.operators.scan import grid_buckets
from tidewright.session import scratch_path
from tidewright.sinks.maintain import FREEZE_MINUTES, VersionedTable, complete_folders, remove_folder, write_days


def event_time(stream: DataFrame, ts: str, delay: str = "24 hours") -> DataFrame:
    """Zone-less wall time to event time, late data accepted for ``delay``."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def bucket_means(stream: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], width: str = "5 minutes") -> DataFrame:
    """Tumbling buckets: mean per column and row count."""
    out = stream.groupBy(*keys, F.window(ts, width).alias("w")).agg(
        *[F.avg(c).alias(c) for c in columns], F.count("*").alias("n")
    )
    return out.select(*keys, F.col("w.start").cast("timestamp_ntz").alias("bucket"), *columns, "n")


def sliding_means(
    stream: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], width: str = "6 hours", slide: str = "1 hour"
) -> DataFrame:
    """Moving means over time (row-count windows stay a batch operator)."""
    out = stream.groupBy(*keys, F.window(ts, width, slide).alias("w")).agg(*[F.avg(c).alias(c) for c in columns])
    return out.select(
        *keys,
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        *columns,
    )


def first_per_key(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def enrich_hourly(stream: DataFrame, hourly: DataFrame, ts: str, keys: Sequence[str] = (), hour: str = "ts_hour") -> DataFrame:
    """Stream-static left join on the truncated hour; ``hourly`` has one row per key and hour."""
    keyed = stream.withColumn(hour, F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz"))
    return keyed.join(hourly, [*keys, hour], "left")


def join_hourly_stream(fine: DataFrame, hourly: DataFrame, ts: str, hourly_ts: str, keys: Sequence[str],
                       how: str = "left") -> DataFrame:
    """Stream-stream join: a reading with the hourly row whose hour contains it.

    The left form keeps readings without an hourly row; both streams need a watermark for it.
    """
    right = hourly.select(*[F.col(k).alias(f"h_{k}") for k in keys], *[c for c in hourly.columns if c not in keys])
    same = [F.col(k) == F.col(f"h_{k}") for k in keys]
    inside = (F.col(ts) >= F.col(hourly_ts)) & (F.col(ts) < F.col(hourly_ts) + F.expr("INTERVAL 1 HOUR"))
    condition = inside
    for s in same:
        condition = condition & s
    return fine.join(right, condition, how).drop(*[f"h_{k}" for k in keys])


def old_enough(stream: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str]) -> DataFrame:
    """Hour rows that left the watermark (set it to 3 hours), ready for gap filling."""
    return bucket_means(stream, keys, ts, columns, "1 hour")


def run_to_files(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append-mode file sink."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def upsert_latest(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
    keys: Sequence[str] = (), fold_every: int = 16,
) -> StreamingQuery:
    """Update-mode aggregates into a log of batches; :func:`latest_state` reads it.

    Only the changed keys are written. A batch that is replayed after a failure
    overwrites its own folder, so it is never counted twice. With ``keys`` every
    ``fold_every``-th batch folds the ones before it, so that the log never holds
    more than twice as many batches.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/log/batch={batch_id}")
        if keys and batch_id and batch_id % fold_every == 0:
            fold_log(batch.sparkSession, path, keys, batch_id - 1)

    return (
        stream.writeStream.outputMode("update").foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def fold_log(spark: SparkSession, path: str, keys: Sequence[str], upto: int) -> None:
    """Newest row per key of all batches up to ``upto`` in one folder; what the fold before it covers is deleted.

    A running batch proves that its predecessors are committed, so a folded batch is never replayed. Deleting
    waits for one more fold: a reader that still uses the fold before finds it and all later batches in place, and a
    fold that died half way, or is replayed with its batch, starts again from the same input.
    """
    folds = complete_folders(spark, f"{path}/folds", "upto=")
    earlier = [n for n in folds if n < upto]
    if upto not in folds:
        rows = _logged(spark, path, earlier, upto)
        dedupe(rows, keys, ["batch"], keep="last").write.mode("overwrite").parquet(f"{path}/folds/upto={upto}")
    if earlier:
        for n in complete_folders(spark, f"{path}/log", "batch="):
            if n <= earlier[-1]:
                remove_folder(spark, f"{path}/log/batch={n}")
        for n in earlier[:-1]:
            remove_folder(spark, f"{path}/folds/upto={n}")


def _logged(spark: SparkSession, path: str, folds: Sequence[int], upto: int | None = None) -> DataFrame:
    """Rows of the newest of ``folds`` and of the batches after it, each with its batch number."""
    parts = [spark.read.parquet(f"{path}/folds/upto={folds[-1]}")] if folds else []
    after = folds[-1] if folds else -1
    batches = [n for n in complete_folders(spark, f"{path}/log", "batch=") if n > after and (upto is None or n <= upto)]
    if batches:
        log = spark.read.option("basePath", f"{path}/log").parquet(*[f"{path}/log/batch={n}" for n in batches])
        parts.append(log.withColumn("batch", F.col("batch").cast("long")))
    if not parts:
        raise FileNotFoundError(path)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def latest_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest row per key out of the newest fold and the batches after it."""
    rows = _logged(spark, path, complete_folders(spark, f"{path}/folds", "upto="))
    return dedupe(rows, keys, ["batch"], keep="last").drop("batch")


def freeze_forecasts(
    stream: DataFrame, table: VersionedTable, key: str, value: str, run_at: str, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Apply forecast runs as they arrive: newest value per target, earliest eligible value frozen.

    The table keeps the run that set the frozen value (``frozen_at``), so an earlier eligible run that arrives
    in a later batch still replaces it: the final state does not depend on how runs fall into batches or
    on their order, and a replayed batch changes nothing.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        table.publish(merge_runs(table.read(), batch, key, value, run_at))

    return (
        stream.writeStream.outputMode("append").foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def merge_runs(
    table: DataFrame, runs: DataFrame, key: str, value: str, run_at: str,
    dynamic: str = "dynamic", frozen: str = "frozen", stamp: str = "updated_at", freeze: tuple[int, int] = FREEZE_MINUTES,
    frozen_stamp: str = "frozen_at",
) -> DataFrame:
    """Fold many runs at once into a forecast table (idempotent, in any order)."""
    lead = minutes_between(F.col(key), F.col(run_at))
    rank = F.struct(F.col(run_at).alias("at"), F.col(value).alias("v"))
    eligible = F.when(lead.between(*freeze) & F.col(value).isNotNull(), rank)
    folded = runs.groupBy(key).agg(F.max(rank).alias("__new"), F.min(eligible).alias("__first"))
    stored = F.when(F.col(stamp).isNotNull(), F.struct(F.col(stamp).alias("at"), F.col(dynamic).alias("v")))
    held = F.when(F.col(frozen_stamp).isNotNull(), F.struct(F.col(frozen_stamp).alias("at"), F.col(frozen).alias("v")))
    joined = table.join(folded, key, "full")
    return joined.select(key, F.greatest(stored, "__new").alias("__dyn"), F.least(held, "__first").alias("__frz")).select(
        key, F.col("__dyn.v").alias(dynamic), F.col("__frz.v").alias(frozen), F.col("__dyn.at").alias(stamp),
        F.col("__frz.at").alias(frozen_stamp))


def empty_forecasts(spark: SparkSession, key: str) -> DataFrame:
    return spark.createDataFrame(
        [], f"{key} timestamp_ntz, dynamic double, frozen double, updated_at timestamp_ntz, frozen_at timestamp_ntz")


def rebuild_days(
    stream: DataFrame, path: str, checkpoint: str, ident: Sequence[str], ts: str, bucket: str,
    build: Callable[[DataFrame], DataFrame], late_after: str = "24 hours", trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a day-partitioned table right for rows that come late, out of order or more than once.

    Rows are landed below ``path/raw`` by batch and day. Every batch builds the days that it touches anew from their
    landed rows, one row per ``ident``, and replaces just these days below ``path/days``; ``build`` may look at one
    day only and returns the instant column ``bucket``. Rows older than ``late_after`` before the newest of the earlier
    batches are counted as late in ``path/log``, and used like all others. A replayed batch replaces its own landing.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = spark.read.parquet(f"{path}/log").filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0] if batch_id else None
        at = F.col(ts).cast("timestamp_ntz")
        late = F.coalesce(at < F.lit(earlier).cast("timestamp_ntz") - F.expr(f"INTERVAL {late_after}"), F.lit(False))
        seen = Observation()
        landed = batch.observe(seen, F.count("*").alias("rows"), F.count_if(late).alias("late"), F.max(at).alias("newest"))
        here = f"{path}/raw/batch={batch_id}"
        landed.withColumn("dt", F.to_date(ts)).write.mode("overwrite").partitionBy("dt").parquet(here)
        facts = seen.get
        log = spark.createDataFrame([(facts["rows"], facts["late"], facts["newest"])], "rows long, late long, newest timestamp_ntz")
        log.write.mode("overwrite").parquet(f"{path}/log/batch={batch_id}")
        if not facts["rows"]:
            return
        # The touched days become literals, so the scan lists no other partition.
        days = [r.dt for r in spark.read.parquet(here).select("dt").distinct().collect()]
        rows = spark.read.parquet(f"{path}/raw").filter(F.col("dt").isin(days))
        write_days(build(dedupe(rows, ident, ["batch"], keep="first").drop("batch", "dt")), f"{path}/days", bucket)

    return (
        stream.writeStream.outputMode("append").foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def fill_aged_gaps(
    hours: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str, numeric: Sequence[str], gap_hours: int = 3,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hour rows that left the watermark, with the synthetic rows of gaps of ``gap_hours``, below ``path/rows``.

    Hours leave the watermark in order, so all that a later batch needs of the earlier ones is the newest hour per key,
    which every batch hands on below ``path/last``. A replayed batch reads its predecessor's and replaces its own.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        joined = batch
        if batch_id:
            joined = batch.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/last/batch={batch_id - 1}"))
        made = rms_gap_rows(joined, keys, ts, numeric, grid_buckets(3600), gap_hours)
        rows = batch.withColumn("synthetic", F.lit(False)).unionByName(made, allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        dedupe(joined, keys, [ts]).select(*batch.columns).write.mode("overwrite").parquet(f"{path}/last/batch={batch_id}")

    return (
        hours.writeStream.outputMode("append").foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def collected(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Drain an append-mode stream into files of the working folder and read them back."""
    path = scratch_path(spark, label)
    query = run_to_files(stream, f"{path}/out", f"{path}/state")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")
