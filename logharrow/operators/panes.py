"""Window statistics from panes: short tumbling aggregates with mergeable sketches, rolled up to any window.

A request is aggregated once, into its pane. Longer and sliding windows are unions of panes, so overlapping windows repeat
panes and never requests, and panes that a batch or a stream has stored serve every window length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of the distinct-count sketches (2^12 registers: a standard error of 1.6 %) and of the quantile sketches (a rank error of 1.7 %).
LOG_REGISTERS, QUANTILE_K = 12, 200
SUMS = ["request_count", "n_4xx", "n_5xx", "sum_sc_bytes"]
DISTINCT = {"client_ip": "unique_ip_count", "user_agent": "unique_ua_count"}
QUANTILES = {"time_taken": {"p50_time_taken": 0.5, "p95_time_taken": 0.95, "p99_time_taken": 0.99}, "sc_bytes": {"p95_sc_bytes": 0.95}}


def _pane_aggregates() -> list[Column]:
    return [
        F.count("*").alias("request_count"), *[F.count_if(F.col("status_class") == f"{c}xx").alias(f"n_{c}xx") for c in (4, 5)], F.coalesce(F.sum("sc_bytes"), F.lit(0)).alias("sum_sc_bytes"),
        *[F.hll_sketch_agg(c, LOG_REGISTERS).alias(f"hll_{c}") for c in DISTINCT], *[F.kll_sketch_agg_double(F.col(c).cast("double"), QUANTILE_K).alias(f"kll_{c}") for c in QUANTILES],
    ]


def panes(df: DataFrame, minutes: int = 1, key: str = "segment_id", late_minutes: int | None = None) -> DataFrame:
    """One row for each key, endpoint and pane of so many minutes: exact counts and sums, and sketches.

    With late_minutes, for a stream: a pane is given out once the watermark has passed it. Null keys, endpoints and times are
    left out.
    """
    rows = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows = rows.withWatermark("timestamp", f"{late_minutes} minutes") if late_minutes is not None else rows
    # names the time as well, so that it stays above a stream's watermark
    rows = rows.where(F.when(F.col("timestamp").isNotNull(), F.col(key).isNotNull() & F.col("endpoint_group").isNotNull()))
    found = rows.groupBy(F.window("timestamp", f"{minutes} minutes").alias("_w"), key, "endpoint_group").agg(*_pane_aggregates())
    return found.withColumn("pane_start", F.col("_w.start")).drop("_w")


def roll_up(stored: DataFrame, minutes: int, step: int | None = None, pane_minutes: int = 1, key: str = "segment_id") -> DataFrame:
    """Windows of `minutes`, every `step` minutes (tumbling by default), from panes.

    Counts, sums and rates are exact; distinct counts and quantiles are estimates within the sketches' errors, and exact for
    few values. The step must be a multiple of the panes' length and divide the window's.
    """
    step = step or minutes
    if minutes % step or step % pane_minutes:
        raise ValueError("a window is a whole number of steps, and a step a whole number of panes")
    at = F.unix_seconds("pane_start")
    first = at - F.pmod(at, F.lit(step * 60))
    starts = F.sequence(first - (minutes - step) * 60, first, F.lit(step * 60))
    spread = stored.withColumn("_start", F.explode(starts) if minutes > step else first)
    merged = spread.groupBy(key, "endpoint_group", "_start").agg(
        *[F.sum(c).alias(c) for c in SUMS], *[F.hll_sketch_estimate(F.hll_union_agg(f"hll_{c}")).alias(n) for c, n in DISTINCT.items()], *[F.kll_merge_agg_double(f"kll_{c}").alias(f"kll_{c}") for c in QUANTILES],
    )
    known = {c: F.kll_sketch_get_n_double(f"kll_{c}") > 0 for c in QUANTILES}
    estimates = {n: F.coalesce(F.when(known[c], F.kll_sketch_get_quantile_double(f"kll_{c}", F.lit(q))), F.lit(0.0)) for c, qs in QUANTILES.items() for n, q in qs.items()}
    rates = {f"{c}xx_rate": F.col(f"n_{c}xx") / F.col("request_count") for c in (4, 5)}
    named = merged.withColumns({**estimates, **rates, "window_start": F.timestamp_seconds("_start")})
    return named.select(key, "endpoint_group", "window_start", "request_count", *DISTINCT.values(), *estimates, "sum_sc_bytes", *rates)
