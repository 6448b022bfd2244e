"""Status classes, segment and session keys, time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logharrow.functions.hashing import hashed_id, murmur_column


def status_class(status: Column) -> Column:
    """2xx to 5xx, else "unknown", also for null and text that is no number."""
    hundred = F.floor(status.try_cast("long") / 100)
    return F.when(hundred.between(2, 5), F.concat(hundred.cast("string"), F.lit("xx"))).otherwise("unknown")


def segment_key(endpoint: Column, method: Column, klass: Column, bot: Column, host: Column | None = None) -> Column:
    """Text that segments are told apart by; host, in lower case, only if given and not empty."""
    parts = [endpoint, F.upper(method), klass, bot.cast("string")]
    if host is not None:
        parts.append(F.when(host != "", F.lower(host)))
    return F.concat_ws("|", *parts)


def segment_id(key: Column) -> Column:
    return hashed_id("seg_", key)


def parent_segment_id(endpoint: Column, method: Column) -> Column:
    return hashed_id("pseg_", F.concat_ws("|", endpoint, F.upper(method)))


def session_key(ip: Column, agent: Column, cookie: Column | None = None) -> Column:
    """ip|agent|first 20 characters of the cookie, null as empty."""
    start = F.substring(F.coalesce(cookie, F.lit("")), 1, 20) if cookie is not None else F.lit("")
    return F.concat_ws("|", F.coalesce(ip, F.lit("")), F.coalesce(agent, F.lit("")), start)


def session_base_id(key: Column) -> Column:
    return hashed_id("sess_", key)


def status_triple(status: Column, substatus: Column, win32: Column) -> Column:
    return F.concat_ws("_", *[F.coalesce(c.cast("long"), F.lit(0)).cast("string") for c in (status, substatus, win32)])


def status_hash(triple: Column) -> Column:
    """A stable hash below 1000."""
    return (murmur_column(triple) % 1000).cast("int")


def floor_window(ts: Column, minutes: int) -> Column:
    """Start of the tumbling window (counted from the epoch); keeps the kind of timestamp, null for null.

    No time-window expression: that one drops rows without a time from the whole plan.
    """
    past = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(minutes * 60_000_000)) / 1e6
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), past.cast("decimal(18,6)"))


def sliding_windows(start: Column, end: Column, window_minutes: int = 5, step_minutes: int = 1) -> Column:
    """Array of (window_start, window_end) from the floored start on, while a window ends by `end` plus one step."""
    step, size = F.expr(f"interval {step_minutes} minutes"), F.expr(f"interval {window_minutes} minutes")
    first = F.timestamp_seconds(F.floor(F.unix_timestamp(start) / (60 * window_minutes)) * 60 * window_minutes)
    last = end + step - size
    starts = F.when(last >= first, F.sequence(first, last, step)).otherwise(F.array().cast("array<timestamp>"))
    return F.transform(starts, lambda s: F.struct(s.alias("window_start"), (s + size).alias("window_end")))


def date_partition(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))
