"""Streams of requests: windowed aggregates with late data, sessions, and scoring by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from logharrow.config import Layer1
from logharrow.functions.segments import session_key
from logharrow.operators.panes import DISTINCT, LOG_REGISTERS
from logharrow.operators.windows import EWMA_STD_ROWS, add_burstiness, ewma_rows, score_windows


def read_requests(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    return reader.parquet(path)


def window_stream(stream: DataFrame, minutes: int = 5, late_minutes: int = 10, key: str = "segment_id") -> DataFrame:
    """Tumbling aggregates with bounded state: approximate distinct counts and quantiles; a window closes after late_minutes."""
    rate = lambda klass: F.count_if(F.col("status_class") == klass) / F.count("*")
    grouped = stream.withWatermark("timestamp", f"{late_minutes} minutes").groupBy(F.window("timestamp", f"{minutes} minutes").alias("w"), key, "endpoint_group")
    aggregated = grouped.agg(
        F.count("*").alias("request_count"), *[F.hll_sketch_estimate(F.hll_sketch_agg(c, LOG_REGISTERS)).alias(n) for c, n in DISTINCT.items()],
        *[F.coalesce(F.percentile_approx("time_taken", q, 10_000).cast("double"), F.lit(0.0)).alias(f"p{n}_time_taken") for n, q in ((50, 0.5), (95, 0.95), (99, 0.99))],
        F.coalesce(F.sum("sc_bytes"), F.lit(0)).alias("sum_sc_bytes"), F.coalesce(F.percentile_approx("sc_bytes", 0.95, 10_000).cast("double"), F.lit(0.0)).alias("p95_sc_bytes"), rate("4xx").alias("4xx_rate"), rate("5xx").alias("5xx_rate"),
    )
    return aggregated.withColumn("window_start", F.col("w.start")).drop("w")


def session_stream(stream: DataFrame, timeout_minutes: int = 30, late_minutes: int = 10) -> DataFrame:
    """Sessions of each client (address, agent and start of the cookie): start, end, requests; closed after the timeout and the late bound."""
    cookie = F.col("cookie") if "cookie" in stream.columns else None
    keyed = stream.withColumn("client", session_key(F.col("client_ip"), F.col("user_agent"), cookie))
    grouped = keyed.withWatermark("timestamp", f"{late_minutes} minutes").groupBy(F.session_window("timestamp", f"{timeout_minutes} minutes").alias("s"), "client")
    return grouped.agg(F.count("*").alias("requests"), F.first("client_ip").alias("client_ip"), F.first("user_agent").alias("user_agent")).select("client", "client_ip", "user_agent", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "requests")


def frame_rows(config: Layer1) -> int:
    """Earlier windows of a segment that a score depends on: the baseline's frames, over burstiness."""
    own = ewma_rows(config.ewma_alpha) - 1 if config.use_ewma else 2 * (config.rolling_rows - 1)
    return max(own, EWMA_STD_ROWS - 1) + config.rolling_rows - 1


def score_stream(windows: DataFrame, history_path: str, sink: Callable[[DataFrame, int], None], checkpoint: str, config: Layer1 = Layer1(), key: str = "segment_id") -> StreamingQuery:
    """Score closed windows with the rows of their segments before them, as the batch form does.

    State: after each micro-batch the last frame_rows() windows of every segment are written below
    history_path/batch=number; a batch that is run again replaces its own state and reads its predecessor's.
    """
    rows = frame_rows(config)

    def score(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = [n for n in _versions(spark, history_path) if n < number]
        now = batch.withColumn("_new", F.lit(True))
        if known:
            now = now.unionByName(spark.read.parquet(f"{history_path}/batch={known[-1]}").withColumn("_new", F.lit(False)))
        scored = score_windows(add_burstiness(now, config.rolling_rows, key), config, key, blocks=False)
        sink(scored.where("_new").drop("_new"), number)
        latest = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("window_start"), F.desc("endpoint_group")))
        state = now.withColumn("_turn", latest).where(F.col("_turn") <= rows).select(*batch.columns)
        state.write.mode("overwrite").parquet(f"{history_path}/batch={number}")

    return windows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(score).start()


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose state is complete."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
