"""Upserts, rolling refresh and schema growth as new snapshots.

Plain Parquet has no MERGE, UPDATE or DELETE, so each operator here returns the
new content as a lazy frame; :class:`VersionedTable` publishes it without ever
overwriting files that are being read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewright.functions.timekeys import minutes_between
from tidewright.operators.rollup import dedupe
from tidewright.session import checkpoint_root

FREEZE_MINUTES = (90, 150)


def merge_freeze(
    table: DataFrame,
    run: DataFrame,
    key: str,
    value: str,
    now: Column,
    dynamic: str = "dynamic",
    frozen: str = "frozen",
    stamp: str = "updated_at",
    freeze: tuple[int, int] = FREEZE_MINUTES,
) -> DataFrame:
    """Upsert a forecast run; the first value seen 90-150 min ahead is kept for good.

    ``run`` holds one row per target instant. Applying the same run twice changes
    nothing but the stamp.
    """
    lead = minutes_between(F.col(key), now)
    new = run.select(key, F.col(value).alias("__new"), F.lit(True).alias("__hit"))
    joined = table.join(new, key, "full")
    eligible = F.when(lead.between(*freeze), F.col("__new"))
    replaced = {
        dynamic: F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(dynamic)),
        frozen: F.coalesce(F.col(frozen), eligible),
        stamp: F.when(F.col("__hit"), now).otherwise(F.col(stamp)),
    }
    return joined.select([replaced[c].alias(c) if c in replaced else F.col(c) for c in table.columns])


def merge_keep_first(
    table: DataFrame, run: DataFrame, key: Sequence[str], overwrite: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Upsert: ``overwrite`` columns take the new value, ``keep`` columns only fill nulls."""
    new = run.select(
        *key, *[F.col(c).alias(f"__n_{c}") for c in (*overwrite, *keep)], F.lit(True).alias("__hit")
    )
    joined = table.join(new, list(key), "full")

    def one(c: str) -> Column:
        if c in overwrite:
            return F.when(F.col("__hit"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c)
        if c in keep:
            return F.coalesce(F.col(c), F.col(f"__n_{c}")).alias(c)
        return F.col(c)

    return joined.select([one(c) for c in table.columns])


def upsert_columns(table: DataFrame, rows: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Insert new keys; on a known key only ``columns`` are overwritten."""
    others = [c for c in table.columns if c not in (*key, *columns)]
    present = [c for c in others if c in rows.columns]
    new = rows.select(
        *key, *[F.col(c).alias(f"__n_{c}") for c in (*columns, *present)], F.lit(True).alias("__new")
    )
    joined = table.withColumn("__old", F.lit(True)).join(new, list(key), "full")

    def one(c: str) -> Column:
        if c in columns:
            return F.when(F.col("__new"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c)
        if c in present:
            return F.when(F.col("__old"), F.col(c)).otherwise(F.col(f"__n_{c}")).alias(c)
        return F.col(c)

    return joined.select([one(c) for c in table.columns])


def update_from(
    table: DataFrame, source: DataFrame, key: Sequence[str], assign: Mapping[str, str], condition: Column | None = None
) -> DataFrame:
    """``UPDATE .. SET .. FROM``: matched rows take ``{target: source}`` values (null included).

    ``condition`` limits which table rows may change; all other rows stay.
    """
    new = source.select(
        *key, *[F.col(s).alias(f"__n_{t}") for t, s in assign.items()], F.lit(True).alias("__hit")
    )
    joined = table.join(new, list(key), "left")
    hit = F.col("__hit") if condition is None else F.col("__hit") & condition

    def one(c: str) -> Column:
        if c not in assign:
            return F.col(c)
        old = F.col(c) if c in table.columns else F.lit(None)
        return F.when(hit, F.col(f"__n_{c}")).otherwise(old).alias(c)

    return joined.select([one(c) for c in dict.fromkeys([*table.columns, *assign])])


def rolling_refresh(
    table: DataFrame, rebuilt: DataFrame, ts: str, cutoff: DataFrame | Column
) -> DataFrame:
    """Replace everything from the cutoff on by freshly computed rows.

    ``cutoff`` is a column or a one-row frame (read as a scalar subquery). Rows
    without an instant belong to neither side and are dropped, so they cannot
    pile up.
    """
    bound = cutoff.scalar() if isinstance(cutoff, DataFrame) else cutoff
    kept = table.filter(F.col(ts) < bound)
    fresh = rebuilt.filter(F.col(ts) >= bound)
    return kept.unionByName(fresh.select(*table.columns))


def cutoff_before_newest(df: DataFrame, ts: str, hours: int = 24) -> DataFrame:
    """One row: newest instant minus ``hours``, on the hour."""
    newest = F.date_trunc("hour", F.max(ts)).cast("timestamp_ntz")
    return df.agg((newest - F.make_dt_interval(hours=F.lit(hours))).alias("cutoff"))


def append_and_dedupe(table: DataFrame, rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Append, then keep the last row per key in a total ``order``."""
    return dedupe(table.unionByName(rows, allowMissingColumns=True), key, order, keep="last")


def grow_schema(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows that may bring new columns."""
    return table.unionByName(rows, allowMissingColumns=True)


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def change_type(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df.withColumn(name, F.col(name).try_cast(kind))


def stage_run(df: DataFrame, name: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Register a run as a temp view with a fixed schema, replacing the last one."""
    staged = df.select([F.col(src).cast(kind).alias(c) for c, (src, kind) in columns.items()])
    staged.createOrReplaceTempView(name)
    return staged


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_days(df: DataFrame, path: str, ts: str, mode: str = "overwrite", files_per_day: int = 1) -> None:
    """Date-partitioned table, sorted inside each file.

    Only the dates present in ``df`` are replaced. A salt over ``files_per_day``
    splits busy days over several tasks and files.
    """
    salt = F.pmod(F.xxhash64(ts), F.lit(files_per_day))
    (
        df.withColumn("dt", F.to_date(ts))
        .repartition("dt", salt)
        .sortWithinPartitions("dt", ts)
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)
    )


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def save_table(df: DataFrame, name: str, ts: str | None = None) -> None:
    """``CREATE OR REPLACE TABLE AS``, optionally partitioned by day."""
    if ts is None:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        days = df.withColumn("dt", F.to_date(ts)).repartition("dt").sortWithinPartitions("dt", ts)
        days.write.mode("overwrite").partitionBy("dt").saveAsTable(name)


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def clone_table(spark: SparkSession, source: str, target: str) -> None:
    spark.table(source).write.mode("overwrite").saveAsTable(target)


def define_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def complete_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders ``prefix<number>`` below ``path`` whose write ended, ascending."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    found = []
    for status in system.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(prefix) and system.exists(hadoop.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name[len(prefix):]))
    return sorted(found)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@dataclass(frozen=True)
class VersionedTable:
    """Parquet snapshots ``v=0, v=1, ...`` below ``path``; readers take the newest complete one.

    A version is visible once its ``_SUCCESS`` marker exists, so a writer that
    dies half way leaves the previous content in place. One writer at a time.
    """

    spark: SparkSession
    path: str

    def _versions(self) -> list[int]:
        return complete_folders(self.spark, self.path, "v=")

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self) -> DataFrame:
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(self.path)
        return self.spark.read.parquet(f"{self.path}/v={versions[-1]}")

    def publish(self, df: DataFrame) -> DataFrame:
        versions = self._versions()
        version = versions[-1] + 1 if versions else 0
        # A half-written folder of a dead writer has the same number and no marker.
        df.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        return self.read()


def merge_days(
    spark: SparkSession, path: str, run: DataFrame, ts: str,
    combine: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Apply an upsert to a day-partitioned table, reading and rewriting only the days of ``run``.

    ``combine(touched_rows, run)`` is any of the merge functions above keyed on an
    instant. The result is checkpointed before its days are replaced, because the
    files it was read from go away. Days are swapped one by one; a table that needs
    an all-or-nothing switch belongs in a :class:`VersionedTable`.
    """
    checkpoint_root(spark)
    # The days of one run are few; as literals they prune the partitions that the scan lists.
    days = [r.dt for r in run.select(F.to_date(ts).alias("dt")).distinct().collect() if r.dt is not None]
    touched = spark.read.parquet(path).filter(F.col("dt").isin(days)).drop("dt")
    write_days(combine(touched, run).checkpoint(), path, ts)
