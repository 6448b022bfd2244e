"""Sessions and the Markov score of their endpoint sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logharrow.functions.segments import session_base_id, session_key, sigmoid
from logharrow.operators.requests import is_critical
from logharrow.sources.workspace import materialise

SMOOTHING = 1e-6


def sessionize(df: DataFrame, timeout_minutes: int = 30, mode: str = "client", tie: str | None = None, ts_col: str = "timestamp", hashed: bool = True) -> DataFrame:
    """session_id and session_seq (from 0). A new session starts after a gap of more than timeout_minutes.

    mode "client": gaps between a client's own requests. mode "global": also at any request of another client in
    between, in the time order of the whole table. For that the rows are written once in ranges of time and tie, of about
    equal size however the rows crowd; each row is compared with the one before it in its range, a range's first row with the
    last row of the range before it (one row a range is carried over).
    The base of the id is the client's key, hashed or (hashed=False) as text. `tie` orders rows of the same time.
    """
    order = [F.col(ts_col), *([F.col(tie)] if tie else [])]
    cookie = F.col("cookie") if "cookie" in df.columns else None
    key = session_key(F.col("client_ip"), F.col("user_agent"), cookie)
    rows = df.withColumn("_base", session_base_id(key) if hashed else key)
    by = Window.partitionBy("_base").orderBy(*order)
    rows = rows.withColumn("_at", F.unix_micros(F.col(ts_col).cast("timestamp")) / 1e6)
    if mode == "client":
        rows = rows.withColumns({"_last": F.lag("_base").over(by), "_last_at": F.lag("_at").over(by)})
    else:
        rows = materialise(rows.repartitionByRange(*order, "_base").withColumn("_range", F.spark_partition_id()), "time-ranges")
        within = Window.partitionBy("_range").orderBy(*order, "_base")
        last = F.max_by(F.struct("_base", "_at"), F.struct(F.col(ts_col), *([F.col(tie)] if tie else []), "_base"))
        ends = rows.groupBy("_range").agg(last.alias("_end")).select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_end"))
        rows = rows.withColumn("_own", F.lag(F.struct("_base", "_at")).over(within)).join(F.broadcast(ends), "_range")  # one row a range
        before = F.coalesce("_own", "_end")
        rows = rows.withColumns({"_last": before["_base"], "_last_at": before["_at"]}).drop("_range", "_end", "_own")
    broken = F.col("_last").isNull() | (F.col("_last") != F.col("_base")) | (F.col("_at") - F.col("_last_at") > timeout_minutes * 60)
    rows = rows.withColumn("_break", broken.cast("long"))
    rows = rows.withColumn("_n", F.sum("_break").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("session_id", F.concat_ws("_", "_base", F.col("_n").cast("string")))
    return rows.withColumn("session_seq", F.row_number().over(Window.partitionBy("_base", "_n").orderBy(*order)) - 1).drop("_base", "_break", "_n", "_at", "_last", "_last_at")


def critical_sessions(df: DataFrame, critical: list[str]) -> DataFrame:
    """All rows of the sessions that touch a critical endpoint; all rows if there is no such list."""
    if not critical:
        return df
    touched = df.where(is_critical(F.col("endpoint_group"), critical)).select("session_id").distinct()
    return df.join(touched, "session_id", "left_semi")


def session_sequences(df: DataFrame, critical: list[str] | None = None) -> DataFrame:
    """session_id and its endpoints in order."""
    rows = critical_sessions(df, critical or [])
    ordered = F.array_sort(F.collect_list(F.struct("session_seq", "endpoint_group")))
    return rows.groupBy("session_id").agg(F.transform(ordered, lambda x: x["endpoint_group"]).alias("endpoints"))


def transitions(df: DataFrame) -> DataFrame:
    """session_id, from_state, to_state of every step."""
    following = F.lead("endpoint_group").over(Window.partitionBy("session_id").orderBy("session_seq"))
    return df.select("session_id", F.col("endpoint_group").alias("from_state"), following.alias("to_state")).where("to_state is not null")


def markov_fit(steps: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """from_state, to_state, cnt, prob, n_states; probabilities smoothed over all states."""
    counts = steps.groupBy("from_state", "to_state").agg(F.count("*").alias("cnt"))
    states = counts.select(F.col("from_state").alias("s")).union(counts.select("to_state")).agg(F.count_distinct("s").alias("n_states"))
    totals = counts.groupBy("from_state").agg(F.sum("cnt").alias("_total"))
    joined = counts.join(totals, "from_state").join(F.broadcast(states), how="cross")  # one row
    prob = (F.col("cnt") + smoothing) / (F.col("_total") + smoothing * F.col("n_states"))
    return joined.select("from_state", "to_state", "cnt", prob.alias("prob"), "n_states")


def save_markov(model: DataFrame, path: str) -> None:
    model.write.mode("overwrite").parquet(path)


def load_markov(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def markov_score(df: DataFrame, model: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """session_id and layer3_score; an unseen step has probability smoothing / n_states, a session of one row scores 0."""
    steps = transitions(df)
    n_states = F.broadcast(model.agg(F.coalesce(F.max("n_states"), F.lit(1)).alias("_states")))  # one row
    known = steps.join(model.select("from_state", "to_state", "prob"), ["from_state", "to_state"], "left").join(n_states, how="cross")
    surprise = -F.log(F.coalesce("prob", F.lit(smoothing) / F.col("_states")))
    scored = known.groupBy("session_id").agg(sigmoid(F.avg(surprise) - 3).alias("_score"))
    sessions = df.select("session_id").distinct()
    return sessions.join(scored, "session_id", "left").select("session_id", F.least(F.greatest(F.coalesce("_score", F.lit(0.0)), F.lit(0.0)), F.lit(1.0)).alias("layer3_score"))


class SequenceAutoencoder:
    """Placeholder of the reserved sequence model."""

    def fit(self, *_: object) -> None:
        raise NotImplementedError("the sequence autoencoder is reserved")

    def score(self, *_: object) -> Column:
        raise NotImplementedError("the sequence autoencoder is reserved")
