"""Request-level operators: validation, filters, enrichment, joins with window scores, and features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logharrow.config import Filter, Hashing, Segmentation, Url, UserAgent
from logharrow.functions import agents, segments, url
from logharrow.functions.hashing import hash_vector

REQUIRED = ("timestamp", "method", "uri_stem", "status")


def require_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Rows with all required values; no row if a required column is absent."""
    if any(c not in df.columns for c in required):
        return df.limit(0)
    return df.dropna(subset=list(required))


def valid_status(df: DataFrame) -> DataFrame:
    return df.where(F.col("status").between(100, 599)) if "status" in df.columns else df


def clamp_time_taken(df: DataFrame) -> DataFrame:
    if "time_taken" not in df.columns:
        return df
    return df.withColumn("time_taken", F.when(F.col("time_taken") < 0, 0).otherwise(F.col("time_taken")).cast(df.schema["time_taken"].dataType))


def validate(df: DataFrame) -> DataFrame:
    return df.transform(require_columns).transform(valid_status).transform(clamp_time_taken)


def is_dynamic(stem: Column, config: Filter = Filter()) -> Column:
    return F.coalesce(url.extension(stem).isin(config.allowed), F.lit(False))


def dynamic_only(df: DataFrame, config: Filter = Filter()) -> DataFrame:
    """Requests of dynamic pages; everything if there is no uri_stem column."""
    return df.where(is_dynamic(F.col("uri_stem"), config)) if "uri_stem" in df.columns else df


def enrich(df: DataFrame, urls: Url = Url(), seg: Segmentation = Segmentation(), ua: UserAgent = UserAgent(), hashed: bool = True) -> DataFrame:
    """endpoint_group, status_class, bot_flag, upper-case method, segment_key and (hashed) segment_id."""
    out = df.withColumns(
        {
            "endpoint_group": F.coalesce(url.endpoint_group(F.col("uri_stem"), urls), F.lit("unknown")),
            "status_class": segments.status_class(F.col("status")),
            "bot_flag": agents.is_bot(F.col("user_agent"), ua).cast("int") if seg.enable_bot_flag else F.lit(0),
            "method": F.coalesce(F.upper("method"), F.lit("UNKNOWN")),
        }
    )
    host = F.col("host") if seg.enable_host and "host" in df.columns else None
    out = out.withColumn("segment_key", segments.segment_key(F.col("endpoint_group"), F.col("method"), F.col("status_class"), F.col("bot_flag"), host))
    return out.withColumn("segment_id", segments.segment_id(F.col("segment_key"))) if hashed else out


def join_window_scores(requests: DataFrame, windows: DataFrame, minutes: int = 5, key: str = "segment_id", carry: tuple[str, ...] = (), small: bool = False, start: str | None = None) -> DataFrame:
    """Score and hot flag of the window that holds a request; 0.0 and false without one. `carry` names more columns.

    start: a column of the requests that holds their window's start. If both tables are bucketed by key and start (see
    sources/buckets.py), neither is shuffled.

    The window table is aggregated by segment and time, but grows with both, so it is broadcast only if the caller says
    that it is small; otherwise the planner chooses by its size, and a skewed segment is split by adaptive execution.
    """
    scores = windows.select(F.col(key), F.col("window_start").alias("_start"), "layer1_score", "window_is_hot", *carry)
    left = requests.withColumn("_start", F.col(start) if start else segments.floor_window(F.col("timestamp"), minutes))
    joined = left.join(F.broadcast(scores) if small else scores, [key, "_start"], "left").drop("_start")
    return joined.withColumns({"layer1_score": F.coalesce("layer1_score", F.lit(0.0)), "window_is_hot": F.coalesce("window_is_hot", F.lit(False))})


def is_critical(endpoint: Column, critical: list[str]) -> Column:
    return F.coalesce(F.lower(endpoint).isin([c.lower() for c in critical]), F.lit(False)) if critical else F.lit(False)


def layer2_gate(df: DataFrame, critical: list[str] | None = None) -> DataFrame:
    """Requests in hot windows or to critical endpoints."""
    return df.where(F.coalesce("window_is_hot", F.lit(False)) | is_critical(F.col("endpoint_group"), critical or []))


def time_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"hour": F.hour("timestamp"), "day_of_week": F.weekday("timestamp")})


#: Rows of one key that a join keeps together; the rows of a more common key are dealt over several groups.
GROUP_ROWS = 50_000


def salted_join(df: DataFrame, aggregates: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Left join of rows to a table with one row a key, where `count` holds the key's rows. The rows of a key with over
    GROUP_ROWS are dealt over as many groups as they need, and only its aggregate is copied: (keys + rows / GROUP_ROWS) in all.
    """
    groups = F.ceil(F.col(count) / GROUP_ROWS).cast("int")
    common = aggregates.where(F.col(count) > GROUP_ROWS).select(*keys, groups.alias("_groups"))  # at most (rows / GROUP_ROWS) keys
    dealt = df.join(F.broadcast(common), keys, "left").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.coalesce("_groups", F.lit(1))).cast("int")).drop("_groups")
    copies = aggregates.withColumn("_salt", F.explode(F.sequence(F.lit(0), groups - 1)))
    return dealt.join(copies, [*keys, "_salt"], "left").drop("_salt")


def ip_stats(df: DataFrame, minutes: int = 5) -> DataFrame:
    """Requests a second and distinct endpoints of a client in its window; null for a null client.

    Aggregated to one row a client and window before a salted join, so a client that sends very many requests is summed
    within each task and its rows are spread over several.
    """
    keyed = df.withColumn("_start", segments.floor_window(F.col("timestamp"), minutes))
    stats = keyed.where("client_ip is not null").groupBy("client_ip", "_start").agg(F.count("*").alias("_n"), F.count_distinct("endpoint_group").alias("ip_unique_endpoints_last_30m"))
    joined = salted_join(keyed, stats, ["client_ip", "_start"], "_n")
    return joined.withColumns({"ip_rps_last_5m": F.col("_n") / (minutes * 60), "first_seen_ip_in_7d": F.lit(0)}).drop("_start", "_n")


def agent_features(df: DataFrame) -> DataFrame:
    ua = df.withColumn("_ua", agents.parse_agent(F.coalesce("user_agent", F.lit(""))))
    return ua.withColumns({**{f"ua_{c}": F.col(f"_ua.{c}") for c in ("browser_family", "os_family", "device_family", "bot_flag")}, "ua_novelty": F.lit(0)}).drop("_ua")


def novelty(df: DataFrame, value_col: str, ts_col: str = "timestamp", days: int = 7) -> DataFrame:
    """is_novel: 1 if the value didn't occur in the `days` days before the row's second.

    One row a value and second is compared with the second before it, so a very common value sorts its distinct seconds
    only, and its rows come back by value and second. A time belongs to the nearest second, halves to the even one, as
    SQL's cast of its epoch does. Null is a value like others; a row without a time is novel.
    """
    rows = df.withColumn("_second", F.rint(F.unix_micros(F.col(ts_col).cast("timestamp")) / 1e6).cast("long"))
    seen = rows.where("_second is not null").select(F.col(value_col).alias("_value"), F.col("_second").alias("_at")).distinct()
    before = F.lag("_at").over(Window.partitionBy("_value").orderBy("_at"))
    known = seen.withColumn("_known", before >= F.col("_at") - days * 86400).where("_known").select("_value", "_at", "_known")
    joined = rows.join(known, F.col(value_col).eqNullSafe(F.col("_value")) & (F.col("_second") == F.col("_at")), "left")
    return joined.withColumn("is_novel", F.col("_known").isNull().cast("int")).drop("_second", "_value", "_at", "_known")


def path_features(df: DataFrame, config: Hashing | None = Hashing()) -> DataFrame:
    stem = F.coalesce("uri_stem", F.lit(""))
    out = df.withColumn("path_depth", url.path_depth(stem))
    return out.withColumn("path_hash", hash_vector(url.path_tokens(stem), config.path_hash_dim)) if config else out


def query_features(df: DataFrame, config: Hashing | None = Hashing()) -> DataFrame:
    stats = df.withColumn("_q", url.query_stats(F.col("uri_query")))
    out = stats.withColumns({f"query_{c}": F.col(f"_q.{c}") for c in ("key_count", "special_char_ratio", "decoded_len", "max_value_len")})
    out = out.withColumn("query_suspicious_flag", ((F.col("query_special_char_ratio") > 0.3) | (F.col("query_max_value_len") > 500)).cast("int"))
    return (out.withColumn("query_hash", hash_vector(F.col("_q.key_set"), config.query_hash_dim)) if config else out).drop("_q")


def performance_features(df: DataFrame) -> DataFrame:
    logs = {f"log_{c}": F.log1p(F.coalesce(c, F.lit(0)).cast("double")) for c in ("time_taken", "sc_bytes", "cs_bytes")}
    return df.withColumns({**logs, "bytes_per_ms": F.coalesce("sc_bytes", F.lit(0)) / F.greatest(F.coalesce("time_taken", F.lit(1)), F.lit(1))})


def status_features(df: DataFrame, hashed: bool = True) -> DataFrame:
    out = df.withColumn("status_triple", segments.status_triple(F.col("status"), F.col("substatus"), F.col("win32_status")))
    return out.withColumn("status_triple_hash", segments.status_hash(F.col("status_triple"))) if hashed else out


def layer2_features(df: DataFrame, config: Hashing | None = Hashing(), novelty_days: int | None = None) -> DataFrame:
    """All request features. Without a hashing config the two vectors and the status hash are left out (no Python).

    With novelty_days, ua_novelty and first_seen_ip_in_7d say whether the agent or address is new in so many days;
    else they are 0.
    """
    out = df.transform(time_features).transform(ip_stats).transform(agent_features).transform(path_features, config).transform(query_features, config)
    out = out.transform(performance_features).transform(status_features, config is not None)
    if novelty_days is not None:
        for value, flag in (("user_agent", "ua_novelty"), ("client_ip", "first_seen_ip_in_7d")):
            out = novelty(out.drop(flag), value, days=novelty_days).withColumnRenamed("is_novel", flag)
    return out


#: Names of the model's numbers, in the order of the model. Fixed values.
SCALARS_BEFORE = ["hour", "day_of_week", "ip_rps_last_5m", "ip_unique_endpoints_last_30m", "first_seen_ip_in_7d", "ua_bot_flag", "ua_novelty", "path_depth"]
SCALARS_BETWEEN = ["query_key_count", "query_special_char_ratio", "query_decoded_len", "query_max_value_len", "query_suspicious_flag"]
SCALARS_AFTER = ["status_triple_hash", "log_time_taken", "log_sc_bytes", "log_cs_bytes", "bytes_per_ms"]


def feature_columns(config: Hashing = Hashing()) -> list[str]:
    """Names of the model's numbers, in order: scalars, path_hash_i, scalars, query_hash_i, scalars."""
    return [*SCALARS_BEFORE, *(f"path_hash_{i}" for i in range(config.path_hash_dim)), *SCALARS_BETWEEN, *(f"query_hash_{i}" for i in range(config.query_hash_dim)), *SCALARS_AFTER]


def feature_vector(df: DataFrame) -> Column:
    """array<float> in the order of feature_columns(); null numbers as 0, absent columns left out."""
    scalar = lambda names: F.array(*[F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")) for c in names if c in df.columns]).cast("array<float>")
    hashes = lambda c: [F.col(c)] if c in df.columns else []
    return F.concat(scalar(SCALARS_BEFORE), *hashes("path_hash"), scalar(SCALARS_BETWEEN), *hashes("query_hash"), scalar(SCALARS_AFTER))


def explode_hashes(df: DataFrame, config: Hashing = Hashing()) -> DataFrame:
    """The two vectors as numbered columns, for readers that want flat tables."""
    flat = {f"{c}_{i}": F.col(c)[i] for c, n in (("path_hash", config.path_hash_dim), ("query_hash", config.query_hash_dim)) for i in range(n)}
    return df.withColumns(flat).drop("path_hash", "query_hash")


def anonymise(df: DataFrame, ip: bool = True, cookie: bool = True, query: bool = True) -> DataFrame:
    """Privacy projections: last IPv4 octet to 0, cookies hashed, query values removed."""
    out = df
    if ip and "client_ip" in df.columns:
        out = out.withColumn("client_ip", F.regexp_replace("client_ip", r"\.\d+$", ".0"))
    if cookie and "cookie" in df.columns:
        out = out.withColumn("cookie", F.sha2("cookie", 256))
    if query and "uri_query" in df.columns:
        out = out.withColumn("uri_query", F.regexp_replace("uri_query", "=[^&]*", "="))
    return out
