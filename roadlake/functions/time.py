"""Time expressions: tolerant epoch readers, event time, day and hour keys."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlake.functions.values import is_number, is_text, strip_ws, vstring

# Pattern of the ISO-like text form accepted for report times (fraction and
# offset are cut away before parsing; one- or two-digit fields accepted).
ISO_SECONDS = "yyyy-M-d'T'H:m:s"


def run_ms_of(run_ts) -> int | None:
    """Epoch milliseconds of an injected run time (datetime, str or int)."""
    if run_ts is None:
        return None
    if isinstance(run_ts, (int, float)):
        return int(run_ts)
    if isinstance(run_ts, str):
        run_ts = _dt.datetime.fromisoformat(run_ts.replace("Z", "+00:00"))
    if run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=_dt.timezone.utc)
    return int(run_ts.timestamp() * 1000)


def now_ms(run_ts=None) -> Column:
    """Processing time in epoch ms: the injected run time, else now."""
    ms = run_ms_of(run_ts)
    if ms is None:
        return F.unix_millis(F.current_timestamp())
    return F.lit(ms).cast("long")


def now_ts(run_ts=None) -> Column:
    """Processing time as a timestamp: the injected run time, else now."""
    ms = run_ms_of(run_ts)
    if ms is None:
        return F.current_timestamp()
    return F.timestamp_millis(F.lit(ms))


def epoch_ms_of_value(v: Column, text_zone: str = "UTC") -> Column:
    """Tolerant epoch-ms of a variant report time.

    * numbers (truncated to integer): > 10^10 are milliseconds as they are;
      > 10^6 are seconds (x1000); smaller -> null;
    * text: whitespace stripped, trailing ``Z`` removed, first 19 characters
      parsed as ``Y-M-DTH:M:S`` wall-clock time of ``text_zone`` (UTC by
      default; any fraction/offset in the text is dropped);
      numeric-looking text is *not* an epoch and gives null;
    * anything else -> null.
    """
    n = F.try_variant_get(v, "$", "bigint")
    txt = F.substring(F.regexp_replace(strip_ws(vstring(v)), "Z+$", ""), 1, 19)
    parsed = F.try_to_timestamp(txt, F.lit(ISO_SECONDS))
    if text_zone and text_zone != "UTC":
        parsed = F.to_utc_timestamp(parsed, text_zone)
    return (
        F.when(is_number(v), F.when(n > 10 ** 10, n).when(n > 10 ** 6, n * 1000))
        .when(is_text(v), F.unix_timestamp(parsed) * 1000)
    ).cast("long")


def seconds_time(ms: Column) -> Column:
    """Epoch ms -> timestamp at second precision (fraction truncated toward
    zero, as an integer division of the milliseconds by 1000)."""
    return F.timestamp_seconds((ms / 1000).cast("long"))


def parse_time(s: Column) -> Column:
    """Text -> timestamp, null when unparseable (ANSI-safe)."""
    return F.try_to_timestamp(s)


def day_key(t: Column) -> Column:
    """``yyyy-MM-dd`` day string of a timestamp (session zone, UTC)."""
    return F.date_format(t, "yyyy-MM-dd")


def hour_bucket(t: Column) -> Column:
    """Start of the hour of a timestamp."""
    return F.date_trunc("hour", t)


def duration_hours(start: Column, end: Column) -> Column:
    """(end - start) in hours at second resolution; may be negative; null
    when either end is null."""
    return (F.unix_timestamp(end.cast("timestamp")) -
            F.unix_timestamp(start.cast("timestamp"))) / 3600.0
