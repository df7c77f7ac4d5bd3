"""Column shaping, schema conformance and row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewright.functions.cleaning import is_numeric_text, null_text_to_blank, zero_filled
from tidewright.functions.timekeys import on_the_hour


def mapped_scan(df: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Select, cast and rename in one projection: ``{source: (name, type)}``."""
    return df.select([F.col(src).try_cast(kind).alias(name) for src, (name, kind) in mapping.items()])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def except_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def drop_prefixed(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefixes)])


def drop_matching(df: DataFrame, names: Iterable[str] = (), containing: Iterable[str] = ()) -> DataFrame:
    exact, parts = set(names), tuple(containing)
    return df.drop(*[c for c in df.columns if c in exact or any(p in c for p in parts)])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop columns without any value (one counting job over the frame)."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if counts[c] == 0])


def suffix_columns(df: DataFrame, tag: str, keep: Sequence[str]) -> DataFrame:
    return df.toDF(*[c if c in keep else f"{c}_{tag}" for c in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add missing columns as null, order and cast to ``schema``; extra columns go."""
    present = set(df.columns)

    def one(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in present else F.lit(None)
        kind = field.dataType
        return (source.try_cast(kind) if isinstance(kind, T.AtomicType) else source.cast(kind)).alias(field.name)

    return df.select([one(f) for f in schema.fields])


def stringify(df: DataFrame) -> DataFrame:
    """All columns as text, null as empty text."""
    return df.select([null_text_to_blank(F.col(c)).alias(c) for c in df.columns])


def numeric_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: share of its non-null values that read as a number."""
    pairs = [F.avg(F.when(F.col(c).isNotNull(), is_numeric_text(F.col(c)).cast("double"))).alias(c) for c in columns]
    filled = [F.count(c).alias(f"{c}__n") for c in columns]
    wide = df.agg(*pairs, *filled)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("filled"), F.col(c).alias("numeric_share"))
        for c in columns
    ])
    return wide.select(F.inline(rows))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (), share: float = 0.6) -> list[str]:
    """Names that count as numeric: by type, or text that parses often enough."""
    typed, text = [], []
    for field in df.schema.fields:
        if field.name in exclude:
            continue
        if isinstance(field.dataType, T.NumericType):
            typed.append(field.name)
        elif isinstance(field.dataType, T.StringType):
            text.append(field.name)
    if text:
        rows = numeric_share(df, text).filter((F.col("filled") >= 2) & (F.col("numeric_share") >= share)).collect()
        typed += [r["column_name"] for r in rows]
    return [c for c in df.columns if c in set(typed)]


def narrow_to_float(df: DataFrame, keep: Sequence[str], to: str = "float") -> DataFrame:
    return df.select([F.col(c) if c in keep else zero_filled(F.col(c), to).alias(c) for c in df.columns])


def ensure_columns(df: DataFrame, names: Sequence[str], default: float = 0.0) -> DataFrame:
    missing = {n: F.lit(default) for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df


def half_open(df: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """Rows in ``[start, end)``; written on the raw column so the scan can prune."""
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))


def current_hour(df: DataFrame, ts: str, now: Column) -> DataFrame:
    start = F.date_trunc("hour", now).cast("timestamp_ntz")
    return half_open(df, ts, start, start + F.make_dt_interval(hours=F.lit(1)))


def last_hours(df: DataFrame, ts: str, now: Column, hours: int) -> DataFrame:
    return df.filter(F.col(ts) >= now - F.make_dt_interval(hours=F.lit(hours)))


def drop_dead_rows(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Drop rows whose target **sum** is zero (so +1 and -1 cancel)."""
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in targets), F.lit(0.0))
    return df.filter(total != 0)


def drop_zero(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) != 0)


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(columns) if columns else None)


def both_present(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())


def gate_hourly(df: DataFrame, ts: str, columns: Sequence[str]) -> DataFrame:
    """Hourly values only on minute 0 of the finer grid, else null."""
    gate = on_the_hour(F.col(ts))
    return df.select([F.when(gate, F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def overlay(base: DataFrame, fresh: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Freshest non-null values over a copy of the last row."""
    new = fresh.select(*on, *[F.col(c).alias(f"__now_{c}") for c in columns])
    joined = base.join(new, list(on), "left")
    return joined.select(
        [F.coalesce(F.col(f"__now_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns]
    )


def require_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Named-column contract between a feature matrix and a model."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"feature columns missing: {missing[:10]}")
    return df.select(*[c for c in df.columns if c not in expected], *expected)


def union_unlike(*frames: DataFrame) -> DataFrame:
    """Union by name; columns absent on one side are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
