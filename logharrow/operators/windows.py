"""Window-level operators: aggregation by segment and time, burstiness, and the robust or exponential baseline."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logharrow.config import Layer1
from logharrow.functions.segments import floor_window, sigmoid
from logharrow.operators.rolling import robust_z_blocks

SCORE_FEATURES = ["request_count", "unique_ip_count", "unique_ua_count", "4xx_rate", "5xx_rate", "p95_time_taken", "p99_time_taken", "sum_sc_bytes", "burstiness", "error_burstiness"]
#: Rows of the deviation in the exponential score.
EWMA_STD_ROWS = 36


def _aggregates() -> list[Column]:
    rate = lambda klass: F.count_if(F.col("status_class") == klass) / F.greatest(F.count("*"), F.lit(1))
    times = F.percentile("time_taken", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    return [
        F.count("*").alias("request_count"), F.count_distinct("client_ip").alias("unique_ip_count"), F.count_distinct("user_agent").alias("unique_ua_count"),
        times.alias("_times"), F.coalesce(F.sum("sc_bytes"), F.lit(0)).alias("sum_sc_bytes"), F.coalesce(F.percentile("sc_bytes", 0.95), F.lit(0.0)).alias("p95_sc_bytes"),
        rate("4xx").alias("4xx_rate"), rate("5xx").alias("5xx_rate"),
    ]


def _named(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{n}_time_taken": F.coalesce(F.get("_times", F.lit(i)), F.lit(0.0)) for i, n in enumerate(("p50", "p95", "p99"))}).drop("_times")


def window_features(df: DataFrame, minutes: int = 5, key: str = "segment_id") -> DataFrame:
    """One row for each segment, endpoint and tumbling window. Null keys and times are left out."""
    keyed = df.where(F.col(key).isNotNull() & F.col("endpoint_group").isNotNull() & F.col("timestamp").isNotNull())
    return _named(keyed.groupBy(key, "endpoint_group", floor_window(F.col("timestamp"), minutes).alias("window_start")).agg(*_aggregates()))


def sliding_window_features(df: DataFrame, minutes: int = 5, step: int = 1, key: str = "segment_id") -> DataFrame:
    """The same over sliding windows."""
    grouped = df.where(F.col(key).isNotNull()).groupBy(key, "endpoint_group", F.window("timestamp", f"{minutes} minutes", f"{step} minutes").alias("_w")).agg(*_aggregates())
    return _named(grouped.withColumn("window_start", F.col("_w.start"))).drop("_w")


def _by(key: str, rows: int) -> Window:
    return Window.partitionBy(key).orderBy("window_start", "endpoint_group").rowsBetween(1 - rows, 0)


def add_burstiness(windows: DataFrame, rows: int = 36, key: str = "segment_id") -> DataFrame:
    """Count and error rate against their mean over the segment's last `rows` windows (rows, not clock time)."""
    mean = lambda c, low: F.greatest(F.avg(c).over(_by(key, rows)), F.lit(low))
    return windows.withColumns({"burstiness": F.col("request_count") / mean("request_count", 1.0), "error_burstiness": F.col("5xx_rate") / mean("5xx_rate", 0.001)})


def robust_z(df: DataFrame, columns: list[str], rows: int = 36, key: str = "segment_id") -> DataFrame:
    """z_<column>: distance from the rolling median over the rolling median of such distances. One exchange for all.

    Frames are sorted anew for each row; robust_z_blocks() gives the same for large tables.
    """
    frame = _by(key, rows)
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))
    far = df.withColumns({f"_d_{c}": F.abs(value(c) - F.percentile(value(c), 0.5).over(frame)) for c in columns})
    scored = far.withColumns({f"z_{c}": F.col(f"_d_{c}") / F.greatest(1.4826 * F.percentile(f"_d_{c}", 0.5).over(frame), F.lit(1e-8)) for c in columns})
    return scored.drop(*[f"_d_{c}" for c in columns])


def ewma_rows(alpha: float) -> int:
    """Rows of the exponential mean whose weights are at least 1e-16."""
    return max(2, math.ceil(math.log(1e-16) / math.log(1 - alpha))) if alpha < 1 else 1


def ewma_z(df: DataFrame, columns: list[str], alpha: float = 0.3, key: str = "segment_id") -> DataFrame:
    """z_<column>: distance from the exponential mean over the rolling deviation; null in a segment's first window.

    Weights below 1e-16 are left out, which bounds the frame; for alpha 0.3 that is 104 rows.
    """
    rows = ewma_rows(alpha)
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))
    keep = 1 - alpha

    def mean(c: str) -> Column:
        start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w"))
        step = lambda a, x: F.struct((a["s"] * keep + x).alias("s"), (a["w"] * keep + 1).alias("w"))
        return F.aggregate(F.collect_list(value(c)).over(_by(key, rows)), start, step, lambda a: a["s"] / a["w"])

    spread = df.withColumns({f"_s_{c}": F.stddev_samp(value(c)).over(_by(key, EWMA_STD_ROWS)) for c in columns} | {f"_m_{c}": mean(c) for c in columns})
    floor = lambda c: F.when(F.col(f"_s_{c}") > 1e-8, F.col(f"_s_{c}")).when(F.col(f"_s_{c}").isNotNull(), F.lit(1e-8))
    return spread.withColumns({f"z_{c}": F.abs(value(c) - F.col(f"_m_{c}")) / floor(c) for c in columns}).drop(*[f"_{k}_{c}" for c in columns for k in "sm"])


def score_windows(windows: DataFrame, config: Layer1 = Layer1(), key: str = "segment_id", blocks: bool = True) -> DataFrame:
    """layer1_score and window_is_hot from the largest z of the score features that the table has.

    Robust scores go by blocks of rows (see rolling.py); without `blocks`, as window expressions, for a few rows in memory.
    """
    columns = [c for c in SCORE_FEATURES if c in windows.columns]
    if not columns:
        return windows.withColumns({"layer1_score": F.lit(0.0), "window_is_hot": F.lit(False)})
    robust = robust_z_blocks if blocks else robust_z
    z = ewma_z(windows, columns, config.ewma_alpha, key) if config.use_ewma else robust(windows, columns, config.rolling_rows, key)
    names = [F.col(f"`z_{c}`") for c in columns]
    top = F.greatest(*names) if len(names) > 1 else names[0]
    scored = z.withColumn("layer1_score", sigmoid(0.5 * (top - 3))).withColumn("window_is_hot", F.coalesce(F.col("layer1_score") >= config.hot_threshold, F.lit(False)))
    return scored.drop(*[f"z_{c}" for c in columns])


def layer1_features(enriched: DataFrame, config: Layer1 = Layer1(), key: str = "segment_id") -> DataFrame:
    return add_burstiness(window_features(enriched, config.window_size_minutes, key), config.rolling_rows, key)

