"""Clock handling: hour and step keys, zone conversion, text and epoch parsing.

Canonical instants are ``timestamp_ntz`` local wall time plus, where a source
has it, a ``timestamp`` in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def micros(ts: Column) -> Column:
    """Wall-clock value as microseconds (exact, order preserving)."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def ntz_from_seconds(sec: Column) -> Column:
    return F.timestamp_seconds(sec).cast("timestamp_ntz")


def floor_step(ts: Column, step_seconds: int) -> Column:
    """Start of the ``step_seconds`` bucket holding ``ts``."""
    sec = seconds(ts)
    return ntz_from_seconds(sec - F.pmod(sec, F.lit(step_seconds)))


def hour_key(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def five_minute_key(ts: Column) -> Column:
    return floor_step(ts, 300)


def shift(ts: Column, **parts: int) -> Column:
    """``shift(ts, hours=-3)``: move an instant by a fixed interval."""
    return ts + F.make_dt_interval(*[F.lit(parts.get(p, 0)) for p in ("days", "hours", "mins")])


def minutes_between(later: Column, earlier: Column) -> Column:
    """Whole minutes from ``earlier`` to ``later``, truncated towards zero."""
    return F.timestamp_diff("MINUTE", earlier, later)


def utc_to_local(ts_utc: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_utc.cast("timestamp_ntz"))


def local_to_utc(ts_local: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts_local.cast("timestamp_ntz")).cast("timestamp")


def now_local(zone: str) -> Column:
    """Wall time of the running query in ``zone``; jobs that must be repeatable pass a literal instead."""
    return utc_to_local(F.current_timestamp(), zone)


def epoch_to_utc(epoch: Column) -> Column:
    return F.timestamp_seconds(epoch)


def epoch_to_local(epoch: Column, zone: str) -> Column:
    return utc_to_local(F.timestamp_seconds(epoch), zone)


def parse_date_hour(date_text: Column, hour_text: Column, date_format: str = "dd/MM/yyyy") -> Column:
    """``31/12/2024`` + ``300`` -> 2024-12-31 03:00 (hours arrive unpadded)."""
    text = F.concat_ws(" ", date_text, F.lpad(F.trim(hour_text), 4, "0"))
    return F.try_to_timestamp(text, F.lit(f"{date_format} HHmm")).cast("timestamp_ntz")


def clock_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def on_the_hour(ts: Column) -> Column:
    """True in the first minute of an hour (the gate of hourly values)."""
    return F.minute(ts) == 0
