"""First-seen values of a stream: keyed state with event-time timers that expires after the novelty window."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keyed processors with timers need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Times of one value that lie closer than the window: first, last (microseconds), and whether the first was given out.
Run = tuple[int, int, bool]


def add_time(runs: list[Run], t: int, window: int) -> list[Run]:
    """The runs, in order, with one time more: runs that it lies close to become one."""
    i = bisect_left(runs, (t - window + 1,))
    i -= i > 0 and t - runs[i - 1][1] < window
    j, first, last, given = i, t, t, False
    while j < len(runs) and runs[j][0] - t < window:
        first, last, given, j = min(first, runs[j][0]), max(last, runs[j][1]), given or runs[j][2], j + 1
    return [*runs[:i], (first, last, given), *runs[j:]]


def settle(runs: list[Run], watermark: int, window: int) -> tuple[list[int], list[Run], int | None]:
    """Times to give out, the runs to keep, and when to look again. No time at or before the watermark comes any more."""
    out, kept = [], []
    for first, last, given in runs:
        if first <= watermark and not given:
            out.append(first)
            given = True
        if last + window > watermark:
            kept.append((first, last, given))
    return out, kept, min((last + window if given else first for first, last, given in kept), default=None)


class FirstSeen(StatefulProcessor):
    def __init__(self, window: int):
        self.window = window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", "first array<bigint>, last array<bigint>, given array<boolean>, timer bigint")

    def _load(self) -> tuple[list[Run], int]:
        if not self.runs.exists():
            return [], -1
        first, last, given, timer = self.runs.get()
        return list(zip(first, last, given)), timer

    def _store(self, key, runs: list[Run], timer: int, watermark_ms: int) -> Iterator[pd.DataFrame]:
        out, runs, again = settle(runs, watermark_ms * 1000, self.window)
        due = -1 if again is None else -(-again // 1000)
        if timer >= 0 and timer != due and timer > watermark_ms:
            self.handle.deleteTimer(timer)
        if runs:
            if due != timer:
                self.handle.registerTimer(due)
            first, last, given = (list(x) for x in zip(*runs))
            self.runs.update((first, last, given, due))
        else:
            self.runs.clear()
        if out:
            yield pd.DataFrame({"value": [key[0]] * len(out), "first_seen": pd.to_datetime(out, unit="us")})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        runs, timer = self._load()
        for batch in rows:
            for t in sorted(set(batch["micros"].tolist())):
                runs = add_time(runs, t, self.window)
        yield from self._store(key, runs, timer, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        runs, timer = self._load()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        yield from self._store(key, runs, -1 if timer == fired else timer, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def first_seen_stream(stream: DataFrame, value: str, late_minutes: int = 10, window_minutes: int = 7 * 24 * 60) -> DataFrame:
    """value, first_seen: each time of a value that has no other within window_minutes before it.

    A time is given out once the watermark has passed it, so the same rows in any order, none of them later than
    late_minutes, give the same result. Before that a value's times are held as runs that lie closer than the window, mostly
    one; a value's state goes once the window has passed since its last time. Null values are left out. What the watermark
    hasn't passed at the end of the input waits: a source that falls silent needs a heartbeat row (a null value with a time).
    Sets the session's state store, as keyed processors need that one.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    timed = stream.select(F.col(value).cast("string").alias("value"), F.col("timestamp").cast("timestamp").alias("timestamp")).withWatermark("timestamp", f"{late_minutes} minutes")
    # names the time as well, so that it isn't moved below the watermark: heartbeats count there
    rows = timed.where(F.when(F.col("timestamp").isNotNull(), F.col("value").isNotNull())).withColumn("micros", F.unix_micros("timestamp"))
    return rows.groupBy("value").transformWithStateInPandas(FirstSeen(window_minutes * 60_000_000), "value string, first_seen timestamp", "Append", "EventTime")
