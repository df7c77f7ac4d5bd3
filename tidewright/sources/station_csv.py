"""Hourly station files: ``;`` separated text with decimal commas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewright.functions.cleaning import blank_to_null, comma_number
from tidewright.functions.timekeys import parse_date_hour
from tidewright.schemas import STATION_HEADERS, STATION_VALUES


def station_from_file_name(name: Column) -> Column:
    """``A802_20240101_20240630.csv`` -> ``A802``."""
    return F.regexp_extract(name, r"^([^_.]+)", 1)


def station_from_folder(name: str) -> Column:
    """Station of files below ``<name>=A802_20240101_20240630/``, the folders that a partitioned write makes."""
    return station_from_file_name(F.regexp_extract(F.col("_metadata.file_path"), f"/{name}=([^/]+)/", 1))


_BROKEN = "__broken"


def _is_broken(first: str) -> Column:
    # Spark refuses to scan the column of broken lines alone, so the test names another one (its length is never negative).
    return F.col(_BROKEN).isNotNull() & (F.length(F.coalesce(F.col(f"`{first}`"), F.lit(""))) >= 0)


def _scan(spark: SparkSession, path: str | Sequence[str], names: Sequence[str]) -> DataFrame:
    """Every line of the files; ``__broken`` holds the whole line where the number of fields is wrong."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _BROKEN]])
    return (
        spark.read.schema(schema)
        .option("sep", ";").option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN)
        # Pruned columns would let the parser skip the field-count check.
        .option("enforceSchema", True).option("columnPruning", False).csv(path)
    )


def read_station_text(spark: SparkSession, path: str | Sequence[str], headers: Sequence[str] | None = None,
                      station: Column | None = None) -> DataFrame:
    """All columns as text plus the station, by default from the file name.

    The declared header list is the schema, so nothing is inferred; lines with
    the wrong number of fields are left out (:func:`rejected_lines` lists them).
    """
    names = list(headers or STATION_HEADERS)
    cleaned = [blank_to_null(F.col(f"`{n}`")).alias(n) for n in names]
    whole = _scan(spark, path, names).filter(~_is_broken(names[0]))
    code = station_from_file_name(F.col("_metadata.file_name")) if station is None else station
    return whole.select(*cleaned, code.alias("estacao"))


def rejected_lines(spark: SparkSession, path: str | Sequence[str], headers: Sequence[str] | None = None,
                   station: Column | None = None) -> DataFrame:
    """Lines that hold no station row, as they stand in the file: estacao, file_name, reason, line.

    ``fields`` is a wrong number of fields, ``time`` a day or hour that is none. A line with both counts under ``fields``;
    a missing rain value is no fault.
    """
    names = list(headers or STATION_HEADERS)
    text = _scan(spark, path, names)
    at = parse_date_hour(blank_to_null(F.col("`Data`")), blank_to_null(F.col("`Hora (UTC)`")))
    name = F.col("_metadata.file_name")
    fields = [F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names]
    return text.filter(F.col(_BROKEN).isNotNull() | at.isNull()).select(
        (station_from_file_name(name) if station is None else station).alias("estacao"), name.alias("file_name"),
        F.when(F.col(_BROKEN).isNotNull(), "fields").otherwise("time").alias("reason"),
        F.coalesce(_BROKEN, F.concat_ws(";", *fields)).alias("line"),
    )


def station_rows(text: DataFrame) -> DataFrame:
    """Typed station rows; lines without a rain value or without an instant are left out."""
    rain = comma_number(F.col("`Chuva (mm)`"))
    instant = parse_date_hour(F.col("Data"), F.col("`Hora (UTC)`"))
    headers = {new: old for old, new in STATION_HEADERS.items()}
    kept = text.filter(rain.isNotNull()).withColumn("__at", instant).filter(F.col("__at").isNotNull())
    return kept.select(
        "estacao",
        F.col("__at").cast("timestamp").alias("dt_utc"),
        F.to_date("__at").alias("data"),
        F.lpad(F.trim(F.col("`Hora (UTC)`")), 4, "0").alias("hora_utc"),
        *[comma_number(F.col(f"`{headers[v]}`")).alias(v) for v in STATION_VALUES],
    )


def rainy_rows(rows: DataFrame) -> DataFrame:
    """Rain above zero, exact copies removed."""
    return rows.filter(F.col("chuva") > 0).dropDuplicates()
