"""Queries over the driver's tables, one or more for each operator, and their SQL for DuckDB."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logharrow.config import Layer1, Scoring
from logharrow.functions import agents, segments, url
from logharrow.operators import drift, iforest, requests, scoring, sessions, windows
from logharrow.sources.workspace import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CRITICAL = ["/APP/Purchase/{num}/Page.aspx", "/App/signup/{num}/data.ashx"]
#: Hours between rows are many in the events table, so rolling statistics use windows of an hour.
HOUR = Layer1(window_size_minutes=60, rolling_hours=36)

#: Agents of the request view, and for each what its families are: browser, version, system, version, device, bot.
AGENTS: list[tuple[str | None, tuple[str, str, str, str, str, int]]] = [
    ("Mozilla/5.0+(Windows+NT+10.0;+Win64;+x64)+AppleWebKit/537.36+(KHTML,+like+Gecko)+Chrome/120.0.0.0+Safari/537.36", ("Chrome", "120", "Windows", "10", "Other", 0)),
    ("Mozilla/5.0+(compatible;+Googlebot/2.1;++http://www.google.com/bot.html)", ("Googlebot", "2", "Other", "", "Spider", 1)),
    ("curl/7.68", ("curl", "7", "Other", "", "Other", 1)),
    ("python-requests/2.28.1", ("Python Requests", "2", "Other", "", "Other", 1)),
    (None, ("Other", "", "Other", "", "Other", 0)),
    ("Mozilla/5.0+(iPhone;+CPU+iPhone+OS+17_2+like+Mac+OS+X)+AppleWebKit/605.1.15+Version/17.2+Mobile/15E148+Safari/604.1", ("Mobile Safari", "17", "iOS", "17", "iPhone", 0)),
    ("Mozilla/5.0+(X11;+Linux+x86_64;+rv:121.0)+Gecko/20100101+Firefox/121.0", ("Firefox", "121", "Linux", "", "Other", 0)),
    ("Mozilla/5.0+(Linux;+Android+14;+Pixel)+AppleWebKit/537.36+Chrome/119.0.0.0+Mobile+Safari/537.36", ("Chrome Mobile", "119", "Android", "14", "Generic Smartphone", 0)),
    ("-", ("Other", "", "Other", "", "Other", 0)),
]
AGENT_SQL = "CASE user_id % 9 " + " ".join(f"WHEN {i} THEN '{a}'" for i, (a, _) in enumerate(AGENTS) if a is not None) + " END"
BOT_SQL = "CASE WHEN user_id % 9 IN (" + ", ".join(str(i) for i, (_, f) in enumerate(AGENTS) if f[5]) + ") THEN 1 ELSE 0 END"
PAGE_SQL = "CASE k % 3 WHEN 0 THEN '/Page.aspx' WHEN 1 THEN '/Data.ashx' ELSE '/logo.png' END"

REQUEST_SQL = f"""
req0 AS (SELECT event_id, ts AS timestamp, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
req AS (
  SELECT event_id, timestamp, user_id, event_type, k, '10.' || user_id % 7 || '.' || user_id // 251 || '.' || user_id % 251 AS client_ip,
    CASE WHEN user_id % 11 <> 0 THEN 'session-' || user_id || '-abcdefghijklmnop' END AS cookie,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
    '/App/' || event_type || CASE WHEN k % 4 = 0 THEN '/v2' ELSE '' END || '/' || k || {PAGE_SQL} || CASE WHEN k % 6 = 5 THEN '//' ELSE '' END AS uri_stem,
    CASE WHEN k % 10 <> 0 THEN CASE WHEN k % 9 = 0 THEN 'a b!' WHEN k % 25 = 3 THEN repeat('z', 501) END END AS q,
    CASE WHEN k % 10 <> 0 THEN 'k=' || k || '&type=' || event_type || CASE WHEN k % 9 = 0 THEN '&q=a%20b!' WHEN k % 25 = 3 THEN '&q=' || repeat('z', 501) ELSE '' END END AS uri_query,
    CASE WHEN event_type = 'error' THEN 500 WHEN k % 10 = 7 THEN 404 WHEN event_type = 'signup' THEN 302 ELSE 200 END AS status, k % 4 AS substatus, CASE WHEN k % 5 <> 0 THEN k END AS win32_status,
    {AGENT_SQL} AS user_agent,
    CASE WHEN k <> 13 THEN CAST(floor(value * 10) AS BIGINT) END AS time_taken, CAST(floor(value * 100) AS BIGINT) AS sc_bytes, CASE WHEN k % 11 <> 0 THEN CAST(floor(value * 7) AS BIGINT) END AS cs_bytes
  FROM req0
),
enr AS (
  SELECT *, lower('/App/' || event_type || CASE WHEN k % 4 = 0 THEN '/v2' ELSE '' END || '/{{num}}' || {PAGE_SQL}) AS endpoint_group,
    (status // 100)::VARCHAR || 'xx' AS status_class, {BOT_SQL} AS bot_flag
  FROM req
),
seg AS (SELECT *, endpoint_group || '|' || method || '|' || status_class || '|' || bot_flag AS segment_key FROM enr)
"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql.replace("WITH REQUESTS", f"WITH {REQUEST_SQL}")
        return f

    return add


def requests_of(events: DataFrame) -> DataFrame:
    """Web requests derived from rows of the events table, stored or streamed."""
    ev = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k, kind, user = F.col("k"), F.col("event_type"), F.col("user_id")
    page = F.when(k % 3 == 0, "/Page.aspx").when(k % 3 == 1, "/Data.ashx").otherwise("/logo.png")
    stem = F.concat(F.lit("/App/"), kind, F.when(k % 4 == 0, "/v2").otherwise(""), F.lit("/"), k, page, F.when(k % 6 == 5, "//").otherwise(""))
    more = F.when(k % 9 == 0, "&q=a%20b!").when(k % 25 == 3, F.concat(F.lit("&q="), F.repeat(F.lit("z"), 501))).otherwise("")
    agent = F.get(F.array(*[F.lit(a) for a, _ in AGENTS]), (user % len(AGENTS)).cast("int"))
    return ev.select(
        "event_id", F.col("ts").alias("timestamp"), "user_id", "event_type", "k", F.concat_ws(".", F.lit("10"), user % 7, F.floor(user / 251), user % 251).alias("client_ip"),
        F.when(user % 11 != 0, F.concat(F.lit("session-"), user, F.lit("-abcdefghijklmnop"))).alias("cookie"),
        F.when(kind.isin("purchase", "signup"), "POST").otherwise("GET").alias("method"), stem.alias("uri_stem"),
        F.when(k % 10 != 0, F.concat(F.lit("k="), k, F.lit("&type="), kind, more)).alias("uri_query"),
        F.when(kind == "error", 500).when(k % 10 == 7, 404).when(kind == "signup", 302).otherwise(200).alias("status"), (k % 4).alias("substatus"), F.when(k % 5 != 0, k).alias("win32_status"), agent.alias("user_agent"),
        F.when(k != 13, F.floor(F.col("value") * 10)).alias("time_taken"), F.floor(F.col("value") * 100).alias("sc_bytes"), F.when(k % 11 != 0, F.floor(F.col("value") * 7)).alias("cs_bytes"),
    )


def request_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.enrich(request_view(spark, sf_dir), hashed=False)


def r6(c: str | Column, name: str | None = None) -> Column:
    col = F.col(f"`{c}`") if isinstance(c, str) else c
    return F.round(col.cast("double"), 6).alias(name or c)


def wall(ts: str, name: str | None = None) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias(name or ts)


@query("WITH REQUESTS SELECT event_id, uri_stem FROM seg WHERE k % 3 <> 2")
def dynamic_filter(spark, sf_dir):
    return requests.dynamic_only(request_view(spark, sf_dir)).select("event_id", "uri_stem")


@query("WITH REQUESTS SELECT endpoint_group, count(*) AS n FROM seg GROUP BY 1")
def endpoint_group(spark, sf_dir):
    return enriched(spark, sf_dir).groupBy("endpoint_group").agg(F.count("*").alias("n"))


@query("""WITH REQUESTS SELECT event_id, CASE WHEN k % 3 = 0 THEN 'aspx' WHEN k % 3 = 1 THEN 'ashx' WHEN k % 6 <> 5 THEN 'png' END AS extension, CASE WHEN k % 4 = 0 THEN 5 ELSE 4 END::BIGINT AS path_depth,
 lower(array_to_string(list_filter(string_split(uri_stem, '/'), lambda x: x <> ''), ',')) AS path_tokens FROM seg""")
def path_features(spark, sf_dir):
    stem = F.col("uri_stem")
    return request_view(spark, sf_dir).select("event_id", url.extension(stem).alias("extension"), url.path_depth(stem).cast("long").alias("path_depth"), F.array_join(url.path_tokens(stem), ",").alias("path_tokens"))


@query("""WITH REQUESTS, len AS (SELECT *, uri_query IS NOT NULL AS has, coalesce(length(q), 0) AS lq, 2 + (q IS NOT NULL)::INT AS n, length('k=' || k || '&type=' || event_type) + CASE WHEN q IS NULL THEN 0 ELSE 3 + length(q) END AS dl FROM seg)
 SELECT event_id, CASE WHEN NOT has THEN '' WHEN q IS NULL THEN 'k,type' ELSE 'k,q,type' END AS key_set, CASE WHEN has THEN n ELSE 0 END::BIGINT AS key_count, CASE WHEN has THEN n ELSE 0 END::BIGINT AS value_count,
 CASE WHEN has THEN round((length(k::VARCHAR) + length(event_type) + lq) / n, 6) ELSE 0.0 END AS mean_value_len, CASE WHEN has THEN greatest(length(k::VARCHAR), length(event_type), lq) ELSE 0 END::BIGINT AS max_value_len,
 CASE WHEN has THEN dl ELSE 0 END::BIGINT AS decoded_len, CASE WHEN q = 'a b!' THEN round(2 / dl, 4) ELSE 0.0 END::DOUBLE AS special FROM len""")
def query_features(spark, sf_dir):
    q = request_view(spark, sf_dir).withColumn("q", url.query_stats(F.col("uri_query")))
    longs = [F.col(f"q.{c}").cast("long").alias(c) for c in ("key_count", "value_count", "max_value_len", "decoded_len")]
    return q.select("event_id", F.array_join("q.key_set", ",").alias("key_set"), *longs, r6(F.col("q.mean_value_len"), "mean_value_len"), F.col("q.special_char_ratio").cast("double").alias("special"))


@query("""WITH p AS (SELECT page_id, lower(url_decode(regexp_replace(url, '^https?://[^/]*', ''))) AS path FROM pages), t AS (SELECT page_id, CASE WHEN length(path) > 1 THEN regexp_replace(path, '/+$', '') ELSE path END AS path FROM p)
 SELECT page_id, regexp_replace(regexp_replace(path, '/[0-9]+(/)', '/{num}\\1', 'g'), '/[0-9]+$', '/{num}') AS path FROM t""")
def url_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", url.endpoint_group(F.regexp_replace("url", "^https?://[^/]*", "")).alias("path"))


@query("""SELECT page_id, '/' || page_id || '/{guid}/{hex}/' || page_id || 'a' AS path FROM pages""")
def aggressive_templates(spark, sf_dir):
    """Ids in paths that are made from each page's number."""
    from logharrow.config import Url

    n = F.lpad(F.lower(F.hex("page_id")), 8, "0")
    stem = F.concat(F.lit("/"), F.col("page_id"), F.lit("/"), n, F.lit("-0000-4ABC-8def-0123456789ab/"), n, n, F.lit("F/"), F.col("page_id"), F.lit("A/"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", url.endpoint_group(stem, Url(numeric_template=False, aggressive_template=True)).alias("path"))


@query("WITH REQUESTS SELECT status_class, count(*) AS n FROM seg GROUP BY 1")
def status_class_counts(spark, sf_dir):
    return enriched(spark, sf_dir).groupBy("status_class").agg(F.count("*").alias("n"))


@query("WITH REQUESTS SELECT bot_flag, user_agent, count(*) AS n FROM seg GROUP BY ALL")
def bot_flag_counts(spark, sf_dir):
    return enriched(spark, sf_dir).groupBy("bot_flag", "user_agent").agg(F.count("*").alias("n"))


@query("WITH REQUESTS SELECT segment_key, count(*) AS n FROM seg GROUP BY 1")
def segment_keys(spark, sf_dir):
    return enriched(spark, sf_dir).groupBy("segment_key").agg(F.count("*").alias("n"))


AGG_SQL = """count(*) AS request_count, count(DISTINCT client_ip) AS unique_ip_count, count(DISTINCT user_agent) AS unique_ua_count,
 coalesce(quantile_cont(time_taken, 0.5), 0)::DOUBLE AS p50_time_taken, coalesce(quantile_cont(time_taken, 0.95), 0)::DOUBLE AS p95_time_taken, coalesce(quantile_cont(time_taken, 0.99), 0)::DOUBLE AS p99_time_taken,
 coalesce(sum(sc_bytes), 0)::BIGINT AS sum_sc_bytes, coalesce(quantile_cont(sc_bytes, 0.95), 0)::DOUBLE AS p95_sc_bytes,
 count(*) FILTER (WHERE status_class = '4xx') / count(*) AS "4xx_rate", count(*) FILTER (WHERE status_class = '5xx') / count(*) AS "5xx_rate" """
WINDOWS_SQL = f"""win AS (SELECT segment_key, endpoint_group, time_bucket(INTERVAL 60 MINUTES, timestamp) AS window_start, {AGG_SQL} FROM seg GROUP BY ALL),
brs AS (SELECT *, request_count / greatest(avg(request_count) OVER w, 1) AS burstiness, "5xx_rate" / greatest(avg("5xx_rate") OVER w, 0.001) AS error_burstiness
 FROM win WINDOW w AS (PARTITION BY segment_key ORDER BY window_start ROWS BETWEEN 35 PRECEDING AND CURRENT ROW))"""
COUNTS = ["request_count", "unique_ip_count", "unique_ua_count", "sum_sc_bytes"]
DOUBLES = ["p50_time_taken", "p95_time_taken", "p99_time_taken", "p95_sc_bytes", "4xx_rate", "5xx_rate"]
ROUNDED_SQL = ", ".join([*COUNTS, *(f'round("{c}", 6) AS "{c}"' for c in DOUBLES)])


def hourly(spark, sf_dir) -> DataFrame:
    return windows.window_features(enriched(spark, sf_dir), 60, "segment_key")


def bursts(spark, sf_dir) -> DataFrame:
    return windows.add_burstiness(hourly(spark, sf_dir), 36, "segment_key")


@query(f"WITH REQUESTS, {WINDOWS_SQL} SELECT segment_key, endpoint_group, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, {ROUNDED_SQL} FROM win")
def window_agg(spark, sf_dir):
    return hourly(spark, sf_dir).select("segment_key", "endpoint_group", wall("window_start"), *COUNTS, *map(r6, DOUBLES))


@query(f"""WITH REQUESTS, slid AS (SELECT unnest(generate_series(time_bucket(INTERVAL 30 MINUTES, timestamp) - INTERVAL 30 MINUTES, time_bucket(INTERVAL 30 MINUTES, timestamp), INTERVAL 30 MINUTES)) AS window_start, * FROM seg)
 SELECT segment_key, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, {ROUNDED_SQL} FROM (SELECT segment_key, endpoint_group, window_start, {AGG_SQL} FROM slid GROUP BY ALL)""")
def sliding_window_agg(spark, sf_dir):
    return windows.sliding_window_features(enriched(spark, sf_dir), 60, 30, "segment_key").select("segment_key", wall("window_start"), *COUNTS, *map(r6, DOUBLES))


@query(f"WITH REQUESTS, {WINDOWS_SQL} SELECT segment_key, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, round(burstiness, 6) AS burstiness, round(error_burstiness, 6) AS error_burstiness FROM brs")
def burstiness(spark, sf_dir):
    return bursts(spark, sf_dir).select("segment_key", wall("window_start"), r6("burstiness"), r6("error_burstiness"))


W36 = "(PARTITION BY segment_key ORDER BY window_start ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)"


def robust_sql(columns: list[str]) -> str:
    far = ", ".join(f'abs("{c}" - quantile_cont("{c}"::DOUBLE, 0.5) OVER {W36}) AS "d_{c}"' for c in columns)
    z = ", ".join(f'"d_{c}" / greatest(1.4826 * quantile_cont("d_{c}", 0.5) OVER {W36}, 1e-8) AS "z_{c}"' for c in columns)
    return f"far AS (SELECT *, {far} FROM brs), zed AS (SELECT *, {z} FROM far)"


@query(f"WITH REQUESTS, {WINDOWS_SQL}, {robust_sql(['request_count', 'p95_time_taken'])} SELECT segment_key, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, round(z_request_count, 4) AS z_request_count, round(z_p95_time_taken, 4) AS z_p95_time_taken FROM zed")
def robust_zscore(spark, sf_dir):
    z = windows.robust_z(bursts(spark, sf_dir), ["request_count", "p95_time_taken"], 36, "segment_key")
    return z.select("segment_key", wall("window_start"), F.round("z_request_count", 4).alias("z_request_count"), F.round("z_p95_time_taken", 4).alias("z_p95_time_taken"))


@query(f"""WITH RECURSIVE {REQUEST_SQL}, {WINDOWS_SQL}, num AS (SELECT segment_key, window_start, request_count::DOUBLE AS x, row_number() OVER (PARTITION BY segment_key ORDER BY window_start) AS i,
 stddev_samp(request_count) OVER {W36} AS s FROM win),
 ew AS (SELECT segment_key, i, x AS a, 1.0::DOUBLE AS w FROM num WHERE i = 1 UNION ALL SELECT n.segment_key, n.i, e.a * 0.7 + n.x, e.w * 0.7 + 1 FROM ew e JOIN num n ON n.segment_key = e.segment_key AND n.i = e.i + 1)
 SELECT n.segment_key, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, round(abs(x - a / w) / CASE WHEN s IS NOT NULL THEN greatest(s, 1e-8) END, 4) AS z FROM num n JOIN ew e ON e.segment_key = n.segment_key AND e.i = n.i""")
def ewma_score(spark, sf_dir):
    return windows.ewma_z(hourly(spark, sf_dir), ["request_count"], 0.3, "segment_key").select("segment_key", wall("window_start"), F.round("z_request_count", 4).alias("z"))


Z_SQL = robust_sql(windows.SCORE_FEATURES)
TOP_Z = "greatest(" + ", ".join(f'"z_{c}"' for c in windows.SCORE_FEATURES) + ")"
SCORED_SQL = f"{WINDOWS_SQL}, {Z_SQL}, sco AS (SELECT *, 1 / (1 + exp(-0.5 * ({TOP_Z} - 3))) AS layer1_score, {TOP_Z} > 3 + 2 * ln(4) AS window_is_hot FROM zed)"


def scored_windows(spark, sf_dir) -> DataFrame:
    return windows.score_windows(bursts(spark, sf_dir), HOUR, "segment_key")


@query(f"WITH REQUESTS, {SCORED_SQL} SELECT segment_key, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, round(layer1_score, 4) AS layer1_score, window_is_hot FROM sco")
def layer1_score(spark, sf_dir):
    return scored_windows(spark, sf_dir).select("segment_key", wall("window_start"), F.round("layer1_score", 4).alias("layer1_score"), "window_is_hot")


def joined(spark, sf_dir) -> DataFrame:
    part = scored_windows(spark, sf_dir).where(F.col("request_count") > 1)  # so that some requests have no window
    return requests.join_window_scores(enriched(spark, sf_dir), part, 60, "segment_key")


JOIN_SQL = f"{SCORED_SQL}, jn AS (SELECT s.*, coalesce(o.layer1_score, 0) AS layer1_score, coalesce(o.window_is_hot, false) AS window_is_hot FROM seg s LEFT JOIN (SELECT * FROM sco WHERE request_count > 1) o ON o.segment_key = s.segment_key AND o.window_start = time_bucket(INTERVAL 60 MINUTES, s.timestamp))"
CRIT_SQL = "endpoint_group IN (" + ", ".join(f"'{c.lower()}'" for c in CRITICAL) + ")"


@query(f"WITH REQUESTS, {JOIN_SQL} SELECT event_id, round(layer1_score, 4) AS layer1_score, window_is_hot FROM jn")
def join_window_scores(spark, sf_dir):
    return joined(spark, sf_dir).select("event_id", F.round("layer1_score", 4).alias("layer1_score"), "window_is_hot")


@query(f"WITH REQUESTS, {JOIN_SQL} SELECT event_id, round(layer1_score, 4) AS layer1_score, window_is_hot FROM jn")
def join_colocated(spark, sf_dir):
    """The same from two tables bucketed by segment and window, joined where they lie."""
    found = colocated(spark, sf_dir)
    return found.select("event_id", F.round("layer1_score", 4).alias("layer1_score"), "window_is_hot")


def colocated(spark, sf_dir) -> DataFrame:
    from logharrow.sources.buckets import read_bucketed, write_bucketed
    from logharrow.sources.workspace import new_folder

    requests_at, windows_at = new_folder(spark, "bucketed-requests"), new_folder(spark, "bucketed-windows")
    rows = enriched(spark, sf_dir).withColumn("window_start", segments.floor_window(F.col("timestamp"), 60))
    write_bucketed(rows.select("event_id", "segment_key", "window_start"), requests_at, ["segment_key", "window_start"], 8)
    write_bucketed(scored_windows(spark, sf_dir).where(F.col("request_count") > 1), windows_at, ["segment_key", "window_start"], 8)
    return requests.join_window_scores(read_bucketed(spark, requests_at), read_bucketed(spark, windows_at), 60, "segment_key", start="window_start")


@query(f"WITH REQUESTS, {JOIN_SQL} SELECT event_id, endpoint_group FROM jn WHERE window_is_hot OR {CRIT_SQL}")
def layer2_gate(spark, sf_dir):
    return requests.layer2_gate(joined(spark, sf_dir), CRITICAL).select("event_id", "endpoint_group")


@query("""WITH REQUESTS, st AS (SELECT client_ip, time_bucket(INTERVAL 1440 MINUTES, timestamp) AS b, count(*) AS n, count(DISTINCT endpoint_group) AS e FROM seg GROUP BY ALL)
 SELECT event_id, round(n / 86400, 8) AS ip_rps, e AS ip_endpoints FROM seg JOIN st ON st.client_ip = seg.client_ip AND b = time_bucket(INTERVAL 1440 MINUTES, timestamp)""")
def ip_stats(spark, sf_dir):
    return requests.ip_stats(enriched(spark, sf_dir), 1440).select("event_id", F.round("ip_rps_last_5m", 8).alias("ip_rps"), F.col("ip_unique_endpoints_last_30m").alias("ip_endpoints"))


@query("WITH REQUESTS SELECT event_id, round(ln(1 + coalesce(time_taken, 0)), 6) AS log_time_taken, round(ln(1 + sc_bytes), 6) AS log_sc_bytes, round(ln(1 + coalesce(cs_bytes, 0)), 6) AS log_cs_bytes, round(sc_bytes / greatest(coalesce(time_taken, 1), 1), 6) AS bytes_per_ms FROM seg")
def perf_features(spark, sf_dir):
    rows = requests.performance_features(request_view(spark, sf_dir))
    return rows.select("event_id", *map(r6, ("log_time_taken", "log_sc_bytes", "log_cs_bytes", "bytes_per_ms")))


@query("WITH REQUESTS SELECT event_id, hour(timestamp)::BIGINT AS hour, (isodow(timestamp) - 1)::BIGINT AS day_of_week, strftime(timestamp, '%Y-%m-%d') AS date FROM seg")
def time_features(spark, sf_dir):
    rows = requests.time_features(request_view(spark, sf_dir))
    return rows.select("event_id", F.col("hour").cast("long").alias("hour"), F.col("day_of_week").cast("long").alias("day_of_week"), segments.date_partition(F.col("timestamp")).alias("date"))


@query("WITH REQUESTS SELECT event_id, status || '_' || substatus || '_' || coalesce(win32_status, 0) AS status_triple FROM seg")
def status_features(spark, sf_dir):
    return requests.status_features(request_view(spark, sf_dir), hashed=False).select("event_id", "status_triple")


@query("WITH REQUESTS SELECT event_id, k + 50 AS status, CASE WHEN time_taken - 500 < 0 THEN 0 ELSE time_taken - 500 END AS time_taken FROM seg WHERE k + 50 BETWEEN 100 AND 599 AND uri_query IS NOT NULL")
def validate_chain(spark, sf_dir):
    rows = request_view(spark, sf_dir).withColumns({"status": F.col("k") + 50, "time_taken": F.col("time_taken") - 500, "uri_stem": F.col("uri_query")})
    return requests.validate(rows).select("event_id", "status", "time_taken")


SESSION_SQL = """ses0 AS (SELECT *, client_ip || '|' || coalesce(user_agent, '') || '|' || coalesce(substr(cookie, 1, 20), '') AS base FROM seg),
brk AS (SELECT *, CASE WHEN {lag_base} IS NULL OR {lag_base} <> base OR epoch_ms(timestamp) - epoch_ms({lag_ts}) > 10800000 THEN 1 ELSE 0 END AS b FROM ses0),
ses1 AS (SELECT *, sum(b) OVER (PARTITION BY base ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS num FROM brk),
ses AS (SELECT *, base || '_' || num AS session_id, (row_number() OVER (PARTITION BY base, num ORDER BY timestamp, event_id) - 1)::INTEGER AS session_seq FROM ses1)"""
BY_CLIENT = SESSION_SQL.format(lag_base="lag(base) OVER (PARTITION BY base ORDER BY timestamp, event_id)", lag_ts="lag(timestamp) OVER (PARTITION BY base ORDER BY timestamp, event_id)")
BY_ALL = SESSION_SQL.format(lag_base="lag(base) OVER (ORDER BY timestamp, event_id)", lag_ts="lag(timestamp) OVER (ORDER BY timestamp, event_id)")


def client_sessions(spark, sf_dir, mode: str = "client") -> DataFrame:
    return sessions.sessionize(enriched(spark, sf_dir), 180, mode, "event_id", hashed=False)


@query(f"WITH REQUESTS, {BY_CLIENT} SELECT event_id, session_id, session_seq FROM ses")
def sessionize_client(spark, sf_dir):
    return client_sessions(spark, sf_dir).select("event_id", "session_id", "session_seq")


@query(f"WITH REQUESTS, {BY_ALL} SELECT event_id, session_id, session_seq FROM ses")
def sessionize_global(spark, sf_dir):
    return client_sessions(spark, sf_dir, "global").select("event_id", "session_id", "session_seq")


@query(f"WITH REQUESTS, {BY_CLIENT} SELECT session_id, string_agg(endpoint_group, '>' ORDER BY session_seq) AS endpoints FROM ses WHERE session_id IN (SELECT session_id FROM ses WHERE {CRIT_SQL}) GROUP BY 1")
def session_sequences(spark, sf_dir):
    return sessions.session_sequences(client_sessions(spark, sf_dir), CRITICAL).select("session_id", F.array_join("endpoints", ">").alias("endpoints"))


MARKOV_SQL = f"""{BY_CLIENT}, stp AS (SELECT session_id, endpoint_group AS from_state, lead(endpoint_group) OVER (PARTITION BY session_id ORDER BY session_seq) AS to_state FROM ses),
cnt AS (SELECT from_state, to_state, count(*) AS cnt FROM stp WHERE to_state IS NOT NULL GROUP BY ALL), ns AS (SELECT count(*) AS n FROM (SELECT from_state FROM cnt UNION SELECT to_state FROM cnt)),
mkv AS (SELECT from_state, to_state, cnt, (cnt + 1e-6) / (sum(cnt) OVER (PARTITION BY from_state) + 1e-6 * n) AS prob FROM cnt, ns)"""


@query(f"WITH REQUESTS, {MARKOV_SQL} SELECT from_state, to_state, cnt, round(prob, 8) AS prob FROM mkv")
def markov_transitions(spark, sf_dir):
    model = sessions.markov_fit(sessions.transitions(client_sessions(spark, sf_dir)))
    return model.select("from_state", "to_state", "cnt", F.round("prob", 8).alias("prob"))


@query(f"""WITH REQUESTS, {MARKOV_SQL}, lp AS (SELECT session_id, avg(-ln(coalesce(prob, 1e-6 / n))) AS m FROM stp LEFT JOIN (SELECT * FROM mkv WHERE cnt > 1) k USING (from_state, to_state), ns WHERE to_state IS NOT NULL GROUP BY 1)
 SELECT DISTINCT ses.session_id, round(coalesce(1 / (1 + exp(-m + 3)), 0), 6) AS layer3_score FROM ses LEFT JOIN lp ON lp.session_id = ses.session_id""")
def markov_score(spark, sf_dir):
    rows = client_sessions(spark, sf_dir)
    model = sessions.markov_fit(sessions.transitions(rows)).where("cnt > 1")  # so that some steps are unseen
    return sessions.markov_score(rows, model).select("session_id", r6("layer3_score"))


def fused(spark, sf_dir) -> DataFrame:
    layered = joined(spark, sf_dir).withColumn("layer2_score", F.when(F.col("k") % 7 != 0, F.col("k") / 100))
    return scoring.combine_scores(layered)


FUSED_SQL = f"{JOIN_SQL}, fus AS (SELECT *, CASE WHEN k % 7 <> 0 THEN k / 100 END AS layer2_score, least(greatest(layer1_score * (0.3 / 0.8) + coalesce(CASE WHEN k % 7 <> 0 THEN k / 100 END, 0) * (0.5 / 0.8), 0), 1) AS final_score FROM jn)"
THR_SQL = f"{FUSED_SQL}, thr AS (SELECT segment_key, quantile_cont(final_score, 0.95) AS threshold FROM fus GROUP BY 1), ano AS (SELECT f.*, final_score >= coalesce(threshold, 1) AS is_anomaly FROM fus f LEFT JOIN (SELECT * FROM thr WHERE segment_key NOT LIKE '%signup%') t ON t.segment_key = f.segment_key)"


@query(f"WITH REQUESTS, {FUSED_SQL} SELECT event_id, round(final_score, 6) AS final_score FROM fus")
def combine_scores(spark, sf_dir):
    return fused(spark, sf_dir).select("event_id", r6("final_score"))


@query(f"WITH REQUESTS, {THR_SQL} SELECT segment_key, round(threshold, 6) AS threshold FROM thr")
def segment_threshold(spark, sf_dir):
    return scoring.segment_thresholds(fused(spark, sf_dir), 0.95, key="segment_key").select("segment_key", r6("threshold"))


def flagged(spark, sf_dir) -> DataFrame:
    rows = fused(spark, sf_dir)
    limits = scoring.segment_thresholds(rows, 0.95, key="segment_key").where(~F.col("segment_key").contains("signup"))  # so that some segments are unknown
    return scoring.apply_thresholds(rows, limits, key="segment_key")


@query(f"WITH REQUESTS, {THR_SQL} SELECT is_anomaly, status_class, count(*) AS n FROM ano GROUP BY ALL")
def apply_threshold(spark, sf_dir):
    return flagged(spark, sf_dir).groupBy("is_anomaly", "status_class").agg(F.count("*").alias("n"))


@query("""WITH REQUESTS, dev AS (SELECT event_id, CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS ano, bot_flag / 1e-6 AS ua, abs(ln(1 + coalesce(time_taken, 0)) - 5) / 2.5 AS lat, (ln(1 + sc_bytes) / 1e-6 + 0) AS byt FROM seg),
 g AS (SELECT event_id, ano, unnest([{'k': 1, 'n': 'latency_spike', 'v': lat}, {'k': 2, 'n': 'bytes_spike', 'v': byt}, {'k': 5, 'n': 'ua_novelty', 'v': ua}]) AS s FROM dev),
 r AS (SELECT event_id, ano, s.n AS name, row_number() OVER (PARTITION BY event_id ORDER BY s.v DESC, s.k) AS i FROM g)
 SELECT event_id, CASE WHEN ano = 1 THEN string_agg(name, ',' ORDER BY i) ELSE '' END AS reason_codes FROM r WHERE i <= 2 GROUP BY event_id, ano""")
def reason_codes(spark, sf_dir):
    rows = enriched(spark, sf_dir).select("event_id", F.col("bot_flag").alias("ua_bot_flag"), F.log1p(F.coalesce("time_taken", F.lit(0)).cast("double")).alias("log_time_taken"), F.log1p(F.col("sc_bytes").cast("double")).alias("log_sc_bytes"), (F.col("k") % 4 == 0).alias("is_anomaly"))
    return scoring.add_reason_codes(rows, {"log_time_taken": 5.0}, 2).select("event_id", F.array_join("reason_codes", ",").alias("reason_codes"))


@query("""WITH REQUESTS, a AS (SELECT event_id, endpoint_group, strftime(timestamp, '%Y-%m-%d') AS date, k / 100 AS final_score, endpoint_group IN ('/app/purchase/{num}/page.aspx', '/app/signup/{num}/data.ashx') AS crit FROM seg WHERE k > 20),
 r AS (SELECT *, row_number() OVER (PARTITION BY date, crit ORDER BY final_score DESC, event_id) AS i, least(count(*) FILTER (WHERE crit) OVER (PARTITION BY date), 5) AS taken FROM a)
 SELECT event_id, date, final_score FROM r WHERE CASE WHEN crit THEN i <= 5 ELSE i <= 20 - taken END""")
def topk_alerts(spark, sf_dir):
    rows = enriched(spark, sf_dir).withColumns({"date": segments.date_partition(F.col("timestamp")), "final_score": F.col("k") / 100, "is_anomaly": F.when(F.col("k") > 20, True)})
    return scoring.select_alerts(rows, Scoring(topk_daily=20, topk_critical=5), CRITICAL, "date", "event_id").select("event_id", "date", "final_score")


@query("""WITH REQUESTS SELECT '{"timestamp":"' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '","endpoint_group":"' || endpoint_group || '","method":"' || method || '","status":' || status || ',"status_class":"' || status_class ||
 '","layer1_score":' || (k / 100)::DOUBLE || ',"layer2_score":' || CASE WHEN k % 7 = 0 THEN 'null' ELSE ((100 - k) / 100)::DOUBLE::VARCHAR END || ',"layer3_score":null,"final_score":' || (k / 200)::DOUBLE || ',"reason_codes":["x","' || event_type || '"],"context":{"request_count":' || user_id::DOUBLE ||
 CASE WHEN time_taken IS NULL THEN '' ELSE ',"p99_time_taken":' || time_taken::DOUBLE END || ',"burstiness":' || (k / 8)::DOUBLE || '},"ua_family":"' || status_class || '","bot_flag":' || bot_flag || ',"time_taken":' || coalesce(time_taken::VARCHAR, 'null') || ',"sc_bytes":' || sc_bytes || '}' AS value FROM seg""")
def alert_json(spark, sf_dir):
    k = F.col("k")
    rows = enriched(spark, sf_dir).withColumns({
        "timestamp": F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), "layer1_score": k / 100, "layer2_score": F.when(k % 7 != 0, (100 - k) / 100), "final_score": k / 200, "reason_codes": F.array(F.lit("x"), "event_type"),
        "request_count": F.col("user_id"), "p99_time_taken": F.col("time_taken"), "burstiness": k / 8, "ua_browser_family": F.col("status_class"),
    })
    return scoring.alert_payloads(rows)


def halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """All rows: those of the mornings, and those of the afternoons."""
    rows = enriched(spark, sf_dir).withColumn("final_score", F.col("k") / 100)
    return rows.where(F.hour("timestamp") < 12), rows.where(F.hour("timestamp") >= 12)


HALF_SQL = "hv AS (SELECT *, k / 100 AS final_score, CASE WHEN hour(timestamp) < 12 THEN 0 ELSE 1 END AS side FROM seg)"


@query(f"""WITH REQUESTS, {HALF_SQL}, e AS (SELECT min(sc_bytes)::DOUBLE AS lo, max(sc_bytes)::DOUBLE AS hi FROM hv), b AS (SELECT side, least(floor((sc_bytes - lo) / ((hi - lo) / 20)) + 1, 20) AS bin FROM hv, e),
 s AS (SELECT count(*) FILTER (WHERE side = 0) / (SELECT count(*) FROM hv WHERE side = 0) + 1e-8 AS r, count(*) FILTER (WHERE side = 1) / (SELECT count(*) FROM hv WHERE side = 1) + 1e-8 AS c
 FROM (SELECT unnest(generate_series(1, 20)) AS bin) g LEFT JOIN b ON b.bin = g.bin GROUP BY g.bin) SELECT round(sum((c - r) * ln(c / r)), 6) AS psi FROM s""")
def psi_drift(spark, sf_dir):
    return drift.psi(*halves(spark, sf_dir), "sc_bytes").select(r6("psi"))


@query(f"""WITH REQUESTS, {HALF_SQL}, c AS (SELECT endpoint_group, count(*) FILTER (WHERE side = 0) / (SELECT count(*) FROM hv WHERE side = 0) AS p, count(*) FILTER (WHERE side = 1) / (SELECT count(*) FROM hv WHERE side = 1) AS q FROM hv GROUP BY 1)
 SELECT round(sqrt(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2), 6) AS jsd FROM c""")
def jsd_drift(spark, sf_dir):
    return drift.jsd(*halves(spark, sf_dir), "endpoint_group").select(r6("jsd"))


@query(f"""WITH REQUESTS, {HALF_SQL}, v AS (SELECT sc_bytes AS v, count(*) FILTER (WHERE side = 0) AS r, count(*) FILTER (WHERE side = 1) AS c FROM hv GROUP BY 1), u AS (SELECT sum(r) OVER (ORDER BY v) / (SELECT sum(r) FROM v) AS f, sum(c) OVER (ORDER BY v) / (SELECT sum(c) FROM v) AS g FROM v)
 SELECT round(max(abs(f - g)), 6) AS ks_statistic, (SELECT sum(r) FROM v)::BIGINT AS n_reference, (SELECT sum(c) FROM v)::BIGINT AS n_current FROM u""")
def ks_drift(spark, sf_dir):
    return drift.ks_statistic(*halves(spark, sf_dir), "sc_bytes").select(r6("ks_statistic"), "n_reference", "n_current")


@query(f"""WITH REQUESTS, {HALF_SQL} SELECT round(abs(avg(final_score) FILTER (WHERE side = 1) - avg(final_score) FILTER (WHERE side = 0)), 6) AS mean_shift,
 round(abs(stddev_pop(final_score) FILTER (WHERE side = 1) - stddev_pop(final_score) FILTER (WHERE side = 0)), 6) AS std_shift FROM hv""")
def score_shift(spark, sf_dir):
    return drift.score_shift(*halves(spark, sf_dir)).select(r6("mean_shift"), r6("std_shift"))


@query("""WITH REQUESTS SELECT event_id, CASE WHEN count(*) OVER (PARTITION BY client_ip ORDER BY epoch(timestamp)::BIGINT RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING) = 0 THEN 1 ELSE 0 END AS is_novel FROM seg""")
def novelty_7d(spark, sf_dir):
    return requests.novelty(request_view(spark, sf_dir), "client_ip").select("event_id", "is_novel")


@query(f"WITH REQUESTS, {BY_CLIENT} SELECT event_id, session_id FROM ses WHERE session_id IN (SELECT session_id FROM ses WHERE {CRIT_SQL})")
def semi_join_critical(spark, sf_dir):
    return sessions.critical_sessions(client_sessions(spark, sf_dir), CRITICAL).select("event_id", "session_id")


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::VARCHAR AS comment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier")
def union_by_name(spark, sf_dir):
    from logharrow.sources.tables import union_all

    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit("supplier").alias("comment"))
    return union_all([customers, suppliers])


@query("""WITH REQUESTS SELECT event_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start FROM (SELECT event_id, unnest(generate_series(time_bucket(INTERVAL 5 MINUTES, timestamp), time_bucket(INTERVAL 5 MINUTES, timestamp) + INTERVAL 30 MINUTES, INTERVAL 1 MINUTE)) AS w, timestamp FROM seg) WHERE w + INTERVAL 5 MINUTES <= timestamp + INTERVAL 9 MINUTES + INTERVAL 1 MINUTE""")
def generated_windows(spark, sf_dir):
    ts = F.col("timestamp").cast("timestamp")
    made = request_view(spark, sf_dir).select("event_id", F.explode(segments.sliding_windows(ts, ts + F.expr("interval 9 minutes"))).alias("w"))
    return made.select("event_id", wall("w.window_start", "window_start"))


@query("""WITH REQUESTS SELECT event_id, regexp_replace(client_ip, '\\.[0-9]+$', '.0') AS client_ip, sha256(cookie) AS cookie, regexp_replace(uri_query, '=[^&]*', '=', 'g') AS uri_query FROM seg""")
def privacy_projection(spark, sf_dir):
    return requests.anonymise(request_view(spark, sf_dir)).select("event_id", "client_ip", "cookie", "uri_query")


# --- hashing: MurmurHash3 in SQL, step by step over a list of bytes

M = "4294967295::UBIGINT"


def _scrambled(x: str) -> str:
    turned = lambda y: f"((({y} << 15) | ({y} >> 17)) & {M})"
    first = f"(({x} * 3432918353::UBIGINT) & {M})"
    return f"(({turned(first)} * 461845907::UBIGINT) & {M})"


def murmur_sql(name: str, source: str, seeds: tuple[int, ...] = (42,)) -> str:
    """Tables that end in `name`(s, h42, ...): the hashes of the distinct texts s of `source`."""
    out = [
        f"{name}_b AS (SELECT s, list_transform(generate_series(1, length(hex(s)), 2), lambda i: ('0x' || substr(hex(s), i, 2))::UBIGINT) AS b FROM (SELECT DISTINCT s FROM ({source}))) ",
        f"{name}_w AS (SELECT s, len(b)::UBIGINT AS n, list_transform(generate_series(0, len(b) // 4 - 1), lambda j: b[4 * j + 1] + b[4 * j + 2] * 256 + b[4 * j + 3] * 65536 + b[4 * j + 4] * 16777216) AS w, "
        "CASE WHEN len(b) % 4 > 0 THEN b[4 * (len(b) // 4) + 1] + CASE WHEN len(b) % 4 > 1 THEN b[4 * (len(b) // 4) + 2] * 256 ELSE 0 END + CASE WHEN len(b) % 4 > 2 THEN b[4 * (len(b) // 4) + 3] * 65536 ELSE 0 END ELSE 0 END::UBIGINT AS t "
        f"FROM {name}_b)",
    ]
    for seed in seeds:
        step = f"(((((xor(h, x) << 13) | (xor(h, x) >> 19)) & {M}) * 5 + 3864292196::UBIGINT) & {M})"
        out.append(f"{name}_{seed}a AS (SELECT s, n, t, list_reduce(list_prepend({seed}::UBIGINT, list_transform(w, lambda x: {_scrambled('x')})), lambda h, x: {step}) AS h FROM {name}_w)")
        out.append(f"{name}_{seed}b AS (SELECT s, xor(xor(h, {_scrambled('t')}), n) AS h FROM {name}_{seed}a)")
        out.append(f"{name}_{seed}c AS (SELECT s, (xor(h, h >> 16) * 2246822507::UBIGINT) & {M} AS h FROM {name}_{seed}b)")
        out.append(f"{name}_{seed}d AS (SELECT s, (xor(h, h >> 13) * 3266489909::UBIGINT) & {M} AS h FROM {name}_{seed}c)")
        out.append(f"{name}_{seed} AS (SELECT s, xor(h, h >> 16) AS h FROM {name}_{seed}d)")
    first = seeds[0]
    joins = " ".join(f"JOIN {name}_{x} USING (s)" for x in seeds[1:])
    columns = ", ".join(f"{name}_{x}.h AS h{x}" for x in seeds)
    return ", ".join(out) + f", {name} AS (SELECT {name}_{first}.s, {columns} FROM {name}_{first} {joins})"


def id_sql(prefix: str, h: str = "h42") -> str:
    return f"'{prefix}' || lpad(lower(hex({h}::UBIGINT)), 8, '0')"


VECTOR_SQL = ("WITH REQUESTS, tok AS (SELECT event_id, 'path' AS kind, 256 AS dim, unnest(list_filter(string_split(lower(uri_stem), '/'), lambda x: x <> '')) AS s FROM seg"
 " UNION ALL SELECT event_id, 'query', 128, unnest(['k', 'type']) FROM seg WHERE uri_query IS NOT NULL UNION ALL SELECT event_id, 'query', 128, 'q' FROM seg WHERE q IS NOT NULL), "
 + murmur_sql("mm", "SELECT s FROM tok", (42, 43)) +
 ", hit AS (SELECT event_id, kind, h42 % dim AS bucket, sum(CASE WHEN h43 < 2147483648 THEN 1 ELSE -1 END) AS v FROM tok JOIN mm USING (s) GROUP BY ALL),"
 " lst AS (SELECT event_id, kind, string_agg(bucket || ':' || v::INTEGER, ',' ORDER BY bucket) FILTER (WHERE v <> 0) AS x FROM hit GROUP BY ALL)"
 " SELECT seg.event_id, coalesce(p.x, '') AS path_hash, coalesce(r.x, '') AS query_hash FROM seg LEFT JOIN lst p ON p.event_id = seg.event_id AND p.kind = 'path' LEFT JOIN lst r ON r.event_id = seg.event_id AND r.kind = 'query'")  # fmt: skip


def nonzero(vector: str) -> Column:
    entries = F.filter(F.transform(vector, lambda v, i: F.struct(i.alias("i"), v.cast("int").alias("v"))), lambda x: x["v"] != 0)
    return F.array_join(F.transform(entries, lambda x: F.concat_ws(":", x["i"], x["v"])), ",")


@query(VECTOR_SQL)
def hash_vector(spark, sf_dir):
    rows = requests.query_features(requests.path_features(request_view(spark, sf_dir)))
    return rows.select("event_id", nonzero("path_hash").alias("path_hash"), nonzero("query_hash").alias("query_hash"))


FAMILIES_SQL = ", ".join(f"({i}, " + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in f) + ")" for i, (_, f) in enumerate(AGENTS))


@query(f"""WITH REQUESTS, fam AS (SELECT * FROM (VALUES {FAMILIES_SQL}) AS t(i, browser_family, browser_version, os_family, os_version, device_family, bot_flag))
 SELECT browser_family, browser_version, os_family, os_version, device_family, fam.bot_flag, count(*) AS n FROM seg JOIN fam ON i = user_id % {len(AGENTS)} GROUP BY ALL""")
def ua_families(spark, sf_dir):
    ua = request_view(spark, sf_dir).select("user_agent", agents.parse_agent(F.coalesce("user_agent", F.lit(""))).alias("ua"))
    return ua.groupBy("ua.browser_family", "ua.browser_version", "ua.os_family", "ua.os_version", "ua.device_family", "ua.bot_flag").agg(F.count("*").alias("n"))


@query(f"""WITH REQUESTS, {murmur_sql('mm', "SELECT segment_key AS s FROM seg UNION ALL SELECT endpoint_group || '|' || method FROM seg")}
 SELECT segment_key, {id_sql('seg_', 'a.h42')} AS segment_id, {id_sql('pseg_', 'b.h42')} AS parent_id, count(*) AS n FROM seg JOIN mm a ON a.s = segment_key JOIN mm b ON b.s = endpoint_group || '|' || method GROUP BY ALL""")
def segment_ids(spark, sf_dir):
    rows = requests.enrich(request_view(spark, sf_dir))
    return rows.withColumn("parent_id", segments.parent_segment_id(F.col("endpoint_group"), F.col("method"))).groupBy("segment_key", "segment_id", "parent_id").agg(F.count("*").alias("n"))


@query(f"""WITH REQUESTS, {BY_CLIENT}, {murmur_sql('mm', "SELECT base AS s FROM ses")} SELECT event_id, {id_sql('sess_')} || '_' || num AS session_id, session_seq FROM ses JOIN mm ON s = base""")
def session_ids(spark, sf_dir):
    return sessions.sessionize(enriched(spark, sf_dir), 180, "client", "event_id").select("event_id", "session_id", "session_seq")


@query(f"""WITH REQUESTS, st AS (SELECT client_ip, time_bucket(INTERVAL 5 MINUTES, timestamp) AS b, count(*) AS n, count(DISTINCT endpoint_group) AS e FROM seg GROUP BY ALL), tri AS (SELECT *, status || '_' || substatus || '_' || coalesce(win32_status, 0) AS s FROM seg), {murmur_sql('mm', "SELECT s FROM tri")},
 nov AS (SELECT event_id, count(*) OVER (PARTITION BY user_agent ORDER BY epoch(timestamp)::BIGINT RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING) = 0 AS a, count(*) OVER (PARTITION BY client_ip ORDER BY epoch(timestamp)::BIGINT RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING) = 0 AS c FROM seg)
 SELECT tri.event_id, 402 AS width, (h42 % 1000)::INTEGER AS status_triple_hash, round(n / 300, 8) AS ip_rps, CASE WHEN length(q) > 500 THEN 1 ELSE 0 END AS query_suspicious_flag, a::INTEGER AS ua_novelty, c::INTEGER AS first_seen_ip_in_7d
 FROM tri JOIN mm USING (s) JOIN st ON st.client_ip = tri.client_ip AND b = time_bucket(INTERVAL 5 MINUTES, timestamp) JOIN nov ON nov.event_id = tri.event_id""")
def layer2_features(spark, sf_dir):
    features = requests.layer2_features(enriched(spark, sf_dir), novelty_days=7)
    return features.select("event_id", F.size(requests.feature_vector(features)).alias("width"), "status_triple_hash", F.round("ip_rps_last_5m", 8).alias("ip_rps"), "query_suspicious_flag", "ua_novelty", "first_seen_ip_in_7d")


# --- sources, sinks and stages: written below the shared folder, read again and compared


def log_lines(spark, sf_dir) -> DataFrame:
    """The request view as log lines: file (0 to 3), place, line. Each file has a second header, with the fields in another order."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    values = {"date": F.date_format("timestamp", "yyyy-MM-dd"), "time": F.date_format("timestamp", "HH:mm:ss"), "c-ip": text("client_ip"), "cs-method": text("method"), "cs-uri-stem": text("uri_stem"), "cs-uri-query": text("uri_query"), "sc-status": text("status"), "time-taken": text("time_taken"), "sc-bytes": text("sc_bytes"), "cs(User-Agent)": text("user_agent"), "x-event": text("event_id")}
    fields = list(values)
    late = F.col("k") >= 50
    line = F.when(late, F.concat_ws(" ", *[values[f] for f in reversed(fields)])).otherwise(F.concat_ws("  ", *values.values()))
    data = request_view(spark, sf_dir).select((F.col("event_id") % 4).cast("int").alias("file"), (F.when(late, 1 << 40).otherwise(0) + F.col("event_id") + 10).alias("place"), line.alias("line"))
    heads = [(0, "2024-01-01 00:00:00 before any header"), (1, "#Software: test"), (2, "#Fields: " + " ".join(fields)), (3, "a line with another number of tokens"), ((1 << 40) + 1, "#Fields:  " + " ".join(reversed(fields)))]
    extra = spark.createDataFrame([(f, p, x) for f in range(4) for p, x in heads], "file int, place long, line string")
    return data.unionByName(extra)


LOG_READER_SQL = """WITH REQUESTS SELECT event_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, client_ip, method, uri_stem, uri_query, status, time_taken, sc_bytes, CASE WHEN user_agent <> '-' THEN user_agent END AS user_agent, (uri_query IS NULL)::INTEGER AS uri_query_missing, (time_taken IS NULL)::INTEGER AS time_taken_missing FROM seg"""


@query(LOG_READER_SQL)
def log_reader(spark, sf_dir):
    """Two plain and two compressed log files, written and parsed."""
    from logharrow.sources.w3c import read_w3c
    from logharrow.sources.workspace import new_folder

    out, lines = new_folder(spark, "logs"), log_lines(spark, sf_dir)
    for kind, files in (("none", (0, 1)), ("gzip", (2, 3))):
        lines.where(F.col("file").isin(*files)).repartition("file").sortWithinPartitions("file", "place").select("file", F.col("line").alias("value")).write.option("compression", kind).partitionBy("file").text(f"{out}/{kind}")
    return read_back(read_w3c(spark, out))


def read_back(found: DataFrame) -> DataFrame:
    return found.select(F.col("extras")["x_event"].cast("long").alias("event_id"), wall("timestamp"), "client_ip", "method", "uri_stem", "uri_query", F.col("status").cast("int").alias("status"), "time_taken", "sc_bytes", "user_agent", "uri_query_missing", "time_taken_missing")


@query(LOG_READER_SQL)
def stream_log_reader(spark, sf_dir):
    """The same logs, each cut into eight chunks of which two have headers, as a stream of files in no order."""
    from logharrow.sources.workspace import new_folder
    from logharrow.streaming.logs import read_w3c_stream

    out, lines = new_folder(spark, "log-chunks"), log_lines(spark, sf_dir)
    end = spark.read.parquet(f"{sf_dir}/events.parquet").agg((F.max("event_id") + 11).alias("end"))  # one row
    within = F.floor(4 * (F.col("place") % (1 << 40)) / F.col("end"))
    chunk = F.when(F.col("place") >= 1 << 40, within + 4).otherwise(within)
    cut = lines.join(F.broadcast(end), how="cross").withColumn("chunk", chunk).repartition("file", "chunk").sortWithinPartitions("file", "chunk", "place")
    cut.select("file", "chunk", F.col("line").alias("value")).write.partitionBy("file", "chunk").text(out)
    return read_back(drained(spark, read_w3c_stream(spark, out, files_per_trigger=12, chunks=r"^(.*/file=\d+)/chunk=(\d+)/")))


@query("""WITH REQUESTS SELECT strftime(timestamp, '%Y-%m-%d') AS date, 'all' AS scan, count(*) AS n, sum(sc_bytes)::BIGINT AS bytes FROM seg GROUP BY ALL UNION ALL SELECT strftime(timestamp, '%Y-%m-%d'), 'one date', count(*), sum(sc_bytes)::BIGINT FROM seg WHERE strftime(timestamp, '%Y-%m-%d') = '2024-01-02' GROUP BY ALL""")
def dated_tables(spark, sf_dir):
    """Rows written by date, scanned whole and for one date."""
    from logharrow.sources.tables import read_table, write_by_date
    from logharrow.sources.workspace import new_folder

    out = new_folder(spark, "dated")
    write_by_date(request_view(spark, sf_dir), out, rows_per_file=50_000)
    total = lambda df, scan: df.groupBy(F.col("date").cast("string").alias("date"), F.lit(scan).alias("scan")).agg(F.count("*").alias("n"), F.sum("sc_bytes").alias("bytes"))
    return total(read_table(spark, out), "all").unionByName(total(read_table(spark, out, "2024-01-02"), "one date"))


def staged(spark, sf_dir, name: str) -> tuple[str, str]:
    """The request view as a dated table, and a folder for what stages write."""
    from logharrow.sources.tables import write_by_date
    from logharrow.sources.workspace import new_folder

    out = new_folder(spark, name)
    write_by_date(request_view(spark, sf_dir), f"{out}/parsed")
    return f"{out}/parsed", out


@query(f"""WITH REQUESTS, {SCORED_SQL} SELECT endpoint_group, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, sum(request_count)::BIGINT AS n, sum(sum_sc_bytes)::BIGINT AS bytes, round(max(layer1_score), 4) AS top_score, bool_or(window_is_hot) AS hot
 FROM sco WHERE endpoint_group NOT LIKE '%logo.png' GROUP BY ALL""")
def stage_layer1(spark, sf_dir):
    """filter-dynamic, featurize-layer1 and infer-layer1, table by table."""
    from logharrow.config import Settings
    from logharrow.plans import stages
    from logharrow.sources.tables import read_table

    parsed, out = staged(spark, sf_dir, "layer1")
    cfg = Settings(layer1=HOUR)
    stages.filter_dynamic(spark, parsed, f"{out}/filtered", cfg)
    stages.featurize_layer1(spark, f"{out}/filtered", f"{out}/windows", cfg)
    stages.infer_layer1(spark, f"{out}/windows", f"{out}/scored", cfg)
    found = read_table(spark, f"{out}/scored").groupBy("endpoint_group", "window_start").agg(F.sum("request_count").alias("n"), F.sum("sum_sc_bytes").alias("bytes"), F.round(F.max("layer1_score"), 4).alias("top_score"), F.bool_or("window_is_hot").alias("hot"))
    return found.select("endpoint_group", wall("window_start"), "n", "bytes", "top_score", "hot")


@query(f"""WITH REQUESTS, {SCORED_SQL}, jn AS (SELECT s.*, coalesce(o.window_is_hot, false) AS window_is_hot FROM seg s LEFT JOIN sco o ON o.segment_key = s.segment_key AND o.window_start = time_bucket(INTERVAL 60 MINUTES, s.timestamp))
 SELECT event_id, regexp_replace(client_ip, '\\.[0-9]+$', '.0') AS client_ip, regexp_replace(uri_query, '=[^&]*', '=', 'g') AS uri_query, CASE WHEN k % 4 = 0 THEN 5 ELSE 4 END AS path_depth, CASE WHEN uri_query IS NULL THEN 0 WHEN q IS NULL THEN 2 ELSE 3 END AS query_key_count FROM jn WHERE window_is_hot OR {CRIT_SQL}""")
def stage_layer2(spark, sf_dir):
    """featurize-layer2 behind the gate of layer 1, with the privacy settings applied."""
    from logharrow.config import Settings
    from logharrow.plans import stages
    from logharrow.sources.tables import read_table

    parsed, out = staged(spark, sf_dir, "layer2")
    cfg = Settings(layer1=HOUR, critical_endpoints=CRITICAL)
    stages.featurize_layer1(spark, parsed, f"{out}/windows", cfg)
    stages.infer_layer1(spark, f"{out}/windows", f"{out}/scored", cfg)
    stages.featurize_layer2(spark, parsed, f"{out}/features", cfg, f"{out}/scored")
    return read_table(spark, f"{out}/features").select("event_id", "client_ip", "uri_query", "path_depth", "query_key_count")


@query(f"""WITH REQUESTS, {BY_CLIENT}, crit AS (SELECT * FROM ses WHERE session_id IN (SELECT session_id FROM ses WHERE {CRIT_SQL})), stp AS (SELECT session_id, endpoint_group AS from_state, lead(endpoint_group) OVER (PARTITION BY session_id ORDER BY session_seq) AS to_state FROM crit),
 cnt AS (SELECT from_state, to_state, count(*) AS cnt FROM stp WHERE to_state IS NOT NULL GROUP BY ALL), ns AS (SELECT count(*) AS n FROM (SELECT from_state FROM cnt UNION SELECT to_state FROM cnt)), mkv AS (SELECT from_state, to_state, (cnt + 1e-6) / (sum(cnt) OVER (PARTITION BY from_state) + 1e-6 * n) AS prob FROM cnt, ns),
 lp AS (SELECT session_id, avg(-ln(prob)) AS m FROM stp JOIN mkv USING (from_state, to_state) GROUP BY 1)
 SELECT ses.event_id, CASE WHEN crit.event_id IS NOT NULL THEN round(coalesce(1 / (1 + exp(-m + 3)), 0), 6) END AS layer3_score FROM ses LEFT JOIN crit ON crit.event_id = ses.event_id LEFT JOIN lp ON lp.session_id = crit.session_id""")
def layer3_scores(spark, sf_dir):
    """All requests with the Markov score of their session; null outside critical sessions."""
    from logharrow.config import Layer3, Settings
    from logharrow.plans import stages

    rows = client_sessions(spark, sf_dir)
    found = stages.layer3(rows, Settings(layer3=Layer3(True, 180, CRITICAL)))
    return found.select("event_id", r6("layer3_score"))


@query(f"WITH REQUESTS, {MARKOV_SQL} SELECT from_state, to_state, cnt, round(prob, 8) AS prob, 2 AS version FROM mkv")
def model_registry(spark, sf_dir):
    """A transition model saved, registered twice, and the latest version loaded."""
    from logharrow.registry import ModelRegistry
    from logharrow.sources.workspace import new_folder

    out = new_folder(spark, "models")
    model = sessions.markov_fit(sessions.transitions(client_sessions(spark, sf_dir)))
    sessions.save_markov(model, f"{out}/markov")
    registry = ModelRegistry(spark, f"{out}/registry")
    registry.log("markov", sessions.load_markov(spark, f"{out}/markov").limit(0))
    version = registry.log("markov", sessions.load_markov(spark, f"{out}/markov"), {"smoothing": sessions.SMOOTHING})
    return registry.load("markov").select("from_state", "to_state", "cnt", F.round("prob", 8).alias("prob"), F.lit(version).alias("version"))


@query("""WITH REQUESTS, a AS (SELECT *, k / 100 AS final_score, endpoint_group IN ('/app/purchase/{num}/page.aspx', '/app/signup/{num}/data.ashx') AS crit FROM seg WHERE k > 20 AND strftime(timestamp, '%Y-%m-%d') = '2024-01-01'),
 r AS (SELECT *, row_number() OVER (PARTITION BY crit ORDER BY final_score DESC, event_id) AS i, least(count(*) FILTER (WHERE crit) OVER (), 5) AS taken FROM a)
 SELECT endpoint_group, method, status::BIGINT AS status, final_score, client_ip AS stored_ip FROM r WHERE CASE WHEN crit THEN i <= 5 ELSE i <= 20 - taken END""")
def alert_sink(spark, sf_dir):
    """A day's alerts as JSON lines and as rows, read back and put side by side."""
    from logharrow.sources.tables import write_alerts
    from logharrow.sources.workspace import new_folder

    out = new_folder(spark, "alerts")
    day = enriched(spark, sf_dir).where(F.to_date("timestamp") == F.lit("2024-01-01").cast("date")).withColumns({"final_score": F.col("k") / 100, "is_anomaly": F.when(F.col("k") > 20, True)})
    alerts = scoring.select_alerts(day, Scoring(topk_daily=20, topk_critical=5), CRITICAL, tie="event_id")
    if not write_alerts(alerts, scoring.alert_payloads, out, "2024-01-01"):
        return spark.createDataFrame([], "endpoint_group string, method string, status long, final_score double, stored_ip string")
    lines = spark.read.schema("timestamp string, endpoint_group string, method string, status long, final_score double").json(f"{out}/json")
    rows = spark.read.parquet(f"{out}/parquet").select(F.col("timestamp").cast("string").alias("timestamp"), "endpoint_group", F.col("client_ip").alias("stored_ip"))
    return lines.join(rows, ["timestamp", "endpoint_group"]).select("endpoint_group", "method", "status", "final_score", "stored_ip")


DRIFT_SQL = " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, 'psi' AS metric, round(sum((c - r) * ln((c + 1e-8) / (r + 1e-8))), 6) AS value FROM (SELECT count(*) FILTER (WHERE side = 0) / any_value(nr) AS r, count(*) FILTER (WHERE side = 1) / any_value(nc) AS c FROM "
     f"(SELECT side, least(floor(({c} - lo) / ((hi - lo) / 20)) + 1, 20) AS bin, nr, nc FROM hv, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi, count({c}) FILTER (WHERE side = 0) AS nr, count({c}) FILTER (WHERE side = 1) AS nc FROM hv) WHERE {c} IS NOT NULL) GROUP BY bin)" for c in ("sc_bytes", "time_taken", "final_score")]
    + [f"SELECT '{c}', 'jsd', round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)), 6) FROM (SELECT count(*) FILTER (WHERE side = 0) / any_value(nr) AS p, count(*) FILTER (WHERE side = 1) / any_value(nc) AS q FROM hv, (SELECT count({c}) FILTER (WHERE side = 0) AS nr, count({c}) FILTER (WHERE side = 1) AS nc FROM hv) WHERE {c} IS NOT NULL GROUP BY {c})" for c in ("endpoint_group", "user_agent")]
)


@query(f"WITH REQUESTS, {HALF_SQL} {DRIFT_SQL}")
def drift_report(spark, sf_dir):
    """All features in two passes."""
    return drift.drift_metrics(*halves(spark, sf_dir), ["sc_bytes", "time_taken", "final_score"], ["endpoint_group", "user_agent"]).select("feature", "metric", r6("value"))


@query(f"WITH REQUESTS, {HALF_SQL} SELECT feature, metric, round(value, 4) AS value FROM ({DRIFT_SQL})")
def drift_files(spark, sf_dir):
    """The report as it is written, read back from its JSON file."""
    import json

    from logharrow.sources.versions import Folder
    from logharrow.sources.workspace import new_folder

    out = new_folder(spark, "drift")
    drift.save_report(drift.drift_report(*halves(spark, sf_dir), ["sc_bytes", "time_taken", "final_score"], ["endpoint_group", "user_agent"], score="none"), out, spark)
    found = json.loads(Folder(spark, out).read("drift_report.json"))["features"]  # one entry a feature
    return spark.createDataFrame([(name, metric, float(f[metric])) for name, f in found.items() for metric in ("psi", "jsd") if metric in f], "feature string, metric string, value double")


#: Stored forests of two trees a model, as (feature, threshold, below, above) or a leaf's path length. The features of the
#: first are time, bytes, status and hour; those of the service's are places in its vector: hour, bot, path depth, log of bytes.
TREES = {
    "GLOBAL": [(1, 20_000.0, (0, 2_000.0, 7.0, (3, 11.5, 5.0, 4.0)), (2, 404.0, 3.0, 1.0)), (0, 500.0, (2, 300.0, 8.0, (1, 5_000.0, 4.0, 2.0)), (3, 6.5, 6.0, 3.0))],
    "s:POST": [(3, 12.5, (2, 499.0, 9.0, 2.0), (0, 1_000.0, 6.0, 3.0)), (1, 10_000.0, 8.0, 4.0)],
    "p:/app/view/{num}/page.aspx": [(0, 4_000.0, 10.0, 2.0), (3, 3.5, 2.0, (1, 60_000.0, 9.0, 5.0))],
}
SERVICE_TREES = {"GLOBAL": [(399, 8.5, (0, 11.5, 9.0, 6.0), (5, 0.5, 5.0, (7, 4.5, 2.0, 1.0))), (0, 6.5, (399, 7.25, 7.0, 4.0), (7, 4.5, 10.0, 3.0))]}
OFFSET = -0.5


def tree_rows(models: dict[str, list]) -> list[tuple]:
    """Rows of a table of trees."""
    rows = []
    for key, trees in models.items():
        for number, tree in enumerate(trees):
            feature, threshold, below, above, path = [], [], [], [], []

            def put(node, feature=feature, threshold=threshold, below=below, above=above, path=path):
                at, inner = len(feature), isinstance(node, tuple)
                for values, v in ((feature, node[0] if inner else -1), (threshold, node[1] if inner else 0.0), (below, -1), (above, -1), (path, 0.0 if inner else node)):
                    values.append(v)
                if inner:
                    below[at], above[at] = put(node[2]), put(node[3])
                return at

            put(tree)
            rows.append((key, number, feature, threshold, below, above, path, 256, OFFSET))
    return rows


def forest_sql(trees: list, names: dict[int, str]) -> str:
    case = lambda n: f"CASE WHEN {names[n[0]]}::FLOAT <= {n[1]}::DOUBLE THEN {case(n[2])} ELSE {case(n[3])} END" if isinstance(n, tuple) else f"{n}::DOUBLE"
    return f"1 / (1 + exp(-pow(2, -(({' + '.join(map(case, trees))}) / {len(trees)}) / {iforest.mean_path(256)!r}) - ({OFFSET})))"


NAMED = {0: "coalesce(time_taken, 0)", 1: "sc_bytes", 2: "status", 3: "hour(timestamp)"}
CASCADE_SQL = "CASE WHEN method = 'POST' THEN {0} WHEN endpoint_group = '/app/view/{{num}}/page.aspx' THEN {1} ELSE {2} END".format(*[forest_sql(TREES[k], NAMED) for k in ("s:POST", "p:/app/view/{num}/page.aspx", "GLOBAL")])


def stored_trees(spark, models: dict[str, list]) -> DataFrame:
    return spark.createDataFrame(tree_rows(models), iforest.TREE_SCHEMA)


def stored_cascade(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = enriched(spark, sf_dir).withColumns({"segment_id": F.col("method"), "parent_id": F.col("endpoint_group"), "features": F.array(*[F.coalesce(c, F.lit(0)).cast("float") for c in ("time_taken", "sc_bytes", "status", F.hour("timestamp"))])})
    return rows, stored_trees(spark, TREES)


@query(f"WITH REQUESTS SELECT event_id, round({CASCADE_SQL}, 6) AS layer2_score FROM seg")
def iforest_stored(spark, sf_dir):
    """Segment, parent and global model of a stored table of trees, broadcast."""
    rows, trees = stored_cascade(spark, sf_dir)
    return iforest.predict(rows, trees, parent="parent_id").select("event_id", r6("layer2_score"))


@query(f"WITH REQUESTS SELECT event_id, round({CASCADE_SQL}, 6) AS layer2_score FROM seg")
def iforest_stored_shuffle(spark, sf_dir):
    """The same in the form for trees that are too many to broadcast."""
    rows, trees = stored_cascade(spark, sf_dir)
    return iforest.predict_by_shuffle(rows, trees, parent="parent_id").select("event_id", r6("layer2_score"))


#: A stored autoencoder 4-3-2-3-4 over scaled time, bytes, status and hour, and a stored forest over its two latent numbers.
AE_MEAN, AE_SCALE, AE_MEDIAN = [3_000.0, 20_000.0, 250.0, 12.0], [2_500.0, 15_000.0, 100.0, 7.0], 0.5
AE_SIZES = [4, 3, 2, 3, 4]
AE_WEIGHTS = [[[((3 * i + 5 * j + k) % 7 - 3) / 4 for j in range(b)] for i in range(a)] for k, (a, b) in enumerate(zip(AE_SIZES, AE_SIZES[1:]))]
AE_BIASES = [[((j + 2 * k) % 5 - 2) / 10 for j in range(b)] for k, b in enumerate(AE_SIZES[1:])]
AE_TREES = {"GLOBAL": [(0, 0.3, (1, -0.4, 8.0, 3.0), (1, 0.9, 5.0, 2.0)), (1, 0.1, 4.0, (0, 1.2, 7.0, 1.0))]}


def _ae_sql() -> str:
    """The layers one after the other: x<k>_<j> is number j of layer k."""
    layers = ["x0 AS (SELECT event_id, " + ", ".join(f"({NAMED[i]}::FLOAT::DOUBLE - {m}) / {s} AS x0_{i}" for i, (m, s) in enumerate(zip(AE_MEAN, AE_SCALE))) + " FROM seg)"]
    for k, (w, b) in enumerate(zip(AE_WEIGHTS, AE_BIASES)):
        sums = [" + ".join([f"{b[j]!r}", *(f"({w[i][j]!r}) * x{k}_{i}" for i in range(len(w)))]) for j in range(len(b))]
        layers.append(f"x{k + 1} AS (SELECT *, " + ", ".join((f"greatest({s}, 0)" if k % 2 == 0 else s) + f" AS x{k + 1}_{j}" for j, s in enumerate(sums)) + f" FROM x{k})")
    error = "(" + " + ".join(f"pow(x4_{i} - x0_{i}, 2)" for i in range(4)) + ") / 4"
    forest = forest_sql(AE_TREES["GLOBAL"], {0: "x2_0", 1: "x2_1"}).replace("::FLOAT", "")
    return f"WITH REQUESTS, {', '.join(layers)} SELECT event_id, round(0.3 / (1 + exp({AE_MEDIAN} - {error})) + 0.7 * ({forest}), 6) AS layer2_score FROM x4"


@query(_ae_sql())
def ae_stored(spark, sf_dir):
    """Scores of a stored network and forest, written as a model table and read back."""
    import numpy as np

    from logharrow.config import Autoencoder
    from logharrow.operators import autoencoder
    from logharrow.sources.workspace import new_folder

    network = autoencoder.Network(4, Autoencoder(hidden_dims=[3], latent_dim=2))
    network.weights, network.biases = [np.array(w) for w in AE_WEIGHTS], [np.array(b) for b in AE_BIASES]
    names = [c.split()[0] for c in iforest.TREE_SCHEMA.split(", ")]
    model, out = autoencoder.LatentForest(np.array(AE_MEAN), np.array(AE_SCALE), network, [dict(zip(names, r)) for r in tree_rows(AE_TREES)]), new_folder(spark, "autoencoder")
    model.save(spark, out)
    rows, _ = stored_cascade(spark, sf_dir)
    return autoencoder.predict(rows, autoencoder.LatentForest.load(spark, out), median_error=AE_MEDIAN).select("event_id", r6("layer2_score"))


SERVICE_SQL = forest_sql(SERVICE_TREES["GLOBAL"], {0: "hour(timestamp)", 5: "bot_flag", 7: "(CASE WHEN k % 4 = 0 THEN 5 ELSE 4 END)", 399: "ln(1 + sc_bytes)"})


@query(f"WITH REQUESTS, sc AS (SELECT *, {SERVICE_SQL} AS s FROM seg) SELECT event_id, endpoint_group, segment_key, round(s, 6) AS final_score, s > 0.5 AS is_anomaly, 0 AS reasons FROM sc")
def score_records(spark, sf_dir):
    """The service's scoring of a batch by a stored forest over its whole vector."""
    from logharrow.service import score_batch

    rows = request_view(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("string"))
    return score_batch(rows, stored_trees(spark, SERVICE_TREES)).select("event_id", "endpoint_group", "segment_key", r6("final_score"), "is_anomaly", F.size("reason_codes").alias("reasons"))


# --- streams over the same rows, run until all of them are read


def streamed_events(spark, parts: list[DataFrame]) -> DataFrame:
    """Rows of the events table as a stream of files, two in each micro-batch, the parts one after the other."""
    from logharrow.sources.workspace import new_folder

    out = new_folder(spark, "stream-input")
    for k, part in enumerate(parts):
        if k:
            time.sleep(1.1)  # files are read in the order of their times
        part.write.mode("append").parquet(out)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 2).parquet(out)


def heartbeat(stored: DataFrame, minutes: int) -> DataFrame:
    """A row without anything but a time, so many minutes after the last: it moves a stream's watermark past all others."""
    ts = F.max("ts") + F.expr(f"INTERVAL {minutes} MINUTES")
    return stored.agg(ts.alias("ts")).select("ts", *[F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in stored.columns if c != "ts"]).select(stored.columns)


def streamed(spark, sf_dir) -> DataFrame:
    """Requests in the order of time, and a heartbeat two days later."""
    stored = spark.read.parquet(f"{sf_dir}/events.parquet")
    return requests_of(streamed_events(spark, [stored.repartitionByRange(4, "ts"), heartbeat(stored, 2 * 24 * 60)])).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def drained(spark, stream: DataFrame) -> DataFrame:
    """All rows that a stream appends until its input is read, with closed windows and expired state only."""
    from logharrow.sources.workspace import new_folder

    out = new_folder(spark, "stream-output")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    stream.writeStream.outputMode("append").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).foreachBatch(put).start().awaitTermination()
    return spark.read.parquet(f"{out}/rows").drop("batch")


def held_to_exact(rows: DataFrame, found: DataFrame, minutes: int, step: int) -> DataFrame:
    """Windows with estimates beside what their rows say: distinct within four standard errors, the 95 % quantile within two hundredths of its rank."""
    at = F.unix_seconds(F.col("timestamp").cast("timestamp"))
    first = at - F.pmod(at, F.lit(step * 60))
    each = rows.select("segment_key", "endpoint_group", "client_ip", "user_agent", "time_taken", F.explode(F.transform(F.sequence(first - (minutes - step) * 60, first, F.lit(step * 60)), F.timestamp_seconds)).alias("window_start"))
    joined = each.join(found, ["segment_key", "endpoint_group", "window_start"])
    keep = ["request_count", "sum_sc_bytes", "4xx_rate", "5xx_rate", "unique_ip_count", "unique_ua_count", "p95_time_taken"]
    time, guess = F.col("time_taken"), F.col("p95_time_taken")
    checked = joined.groupBy("segment_key", "endpoint_group", "window_start", *keep).agg(
        F.count_distinct("client_ip").alias("ips"), F.count_distinct("user_agent").alias("uas"), F.count("time_taken").alias("n"), F.count_if(time <= guess).alias("upto"), F.count_if(time < guess).alias("below"), F.max("time_taken").alias("most"),
    )
    close = lambda estimate, exact: F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(0.5), 0.065 * F.col(exact))
    ranked = (F.col("n") == 0) | ((F.col("upto") >= 0.93 * F.col("n")) & (F.col("below") <= 0.97 * F.col("n")))
    return checked.select(
        "segment_key", "endpoint_group", wall("window_start"), "request_count", "sum_sc_bytes", r6("4xx_rate"), r6("5xx_rate"), close("unique_ip_count", "ips").alias("ips_close"), close("unique_ua_count", "uas").alias("uas_close"), ranked.alias("p95_close"),
    )


def counts_sql(spread: str) -> str:
    """Exact counts of windows; their estimates are all close."""
    return f"""SELECT segment_key, endpoint_group, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS request_count, sum(sc_bytes)::BIGINT AS sum_sc_bytes,
 round(count(*) FILTER (WHERE status_class = '4xx') / count(*), 6) AS "4xx_rate", round(count(*) FILTER (WHERE status_class = '5xx') / count(*), 6) AS "5xx_rate", true AS ips_close, true AS uas_close, true AS p95_close FROM {spread} GROUP BY segment_key, endpoint_group, window_start"""


HOURLY_SQL = "(SELECT *, time_bucket(INTERVAL 60 MINUTES, timestamp) AS window_start FROM seg)"
FOUR_HOURS_SQL = "(SELECT unnest(generate_series(time_bucket(INTERVAL 60 MINUTES, timestamp) - INTERVAL 180 MINUTES, time_bucket(INTERVAL 60 MINUTES, timestamp), INTERVAL 60 MINUTES)) AS window_start, * FROM seg)"


@query(f"WITH REQUESTS {counts_sql(FOUR_HOURS_SQL)}")
def pane_windows(spark, sf_dir):
    """Sliding windows of four hours, each hour, from stored panes of five minutes."""
    from logharrow.operators import panes

    rows = enriched(spark, sf_dir)
    stored = materialise(panes.panes(rows, 5, "segment_key"), "panes")
    return held_to_exact(rows, panes.roll_up(stored, 240, 60, 5, "segment_key"), 240, 60)


@query(f"WITH REQUESTS {counts_sql(FOUR_HOURS_SQL)}")
def stream_panes(spark, sf_dir):
    """The same from panes that a stream has closed and stored."""
    from logharrow.operators import panes

    stream = panes.panes(requests.enrich(streamed(spark, sf_dir), hashed=False), 5, "segment_key", late_minutes=10)
    return held_to_exact(enriched(spark, sf_dir), panes.roll_up(drained(spark, stream), 240, 60, 5, "segment_key"), 240, 60)


@query(f"WITH REQUESTS {counts_sql(HOURLY_SQL)}")
def stream_windows(spark, sf_dir):
    """Windows that the watermark has closed, their estimates held to the stored rows."""
    from logharrow.streaming.windows import window_stream

    stream = window_stream(requests.enrich(streamed(spark, sf_dir), hashed=False), 60, key="segment_key")
    return held_to_exact(enriched(spark, sf_dir), drained(spark, stream), 60, 60)


@query("""WITH REQUESTS, o AS (SELECT *, coalesce(client_ip, '') || '|' || coalesce(user_agent, '') || '|' || coalesce(substr(cookie, 1, 20), '') AS client FROM seg),
 b AS (SELECT *, CASE WHEN lag(timestamp) OVER w IS NULL OR timestamp >= lag(timestamp) OVER w + INTERVAL 180 MINUTES THEN 1 ELSE 0 END AS new FROM o WINDOW w AS (PARTITION BY client ORDER BY timestamp)),
 n AS (SELECT *, sum(new) OVER (PARTITION BY client ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS s FROM b)
 SELECT client, strftime(min(timestamp), '%Y-%m-%d %H:%M:%S') AS session_start, strftime(max(timestamp) + INTERVAL 180 MINUTES, '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS requests FROM n GROUP BY client, s""")
def stream_sessions(spark, sf_dir):
    from logharrow.streaming.windows import session_stream

    return drained(spark, session_stream(streamed(spark, sf_dir), 180)).select("client", wall("session_start"), wall("session_end"), "requests")


@query("""WITH REQUESTS, b AS (SELECT client_ip, timestamp, lag(timestamp) OVER (PARTITION BY client_ip ORDER BY timestamp) AS before FROM seg)
 SELECT client_ip AS value, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS first_seen FROM b WHERE before IS NULL OR timestamp >= before + INTERVAL 720 MINUTES""")
def stream_first_seen(spark, sf_dir):
    """Files hold rows of all times, so each micro-batch goes back and forth over the month; a heartbeat file ends the stream."""
    from logharrow.streaming.novelty import first_seen_stream

    month = 31 * 24 * 60
    stored = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = requests_of(streamed_events(spark, [stored.repartition(4, "event_id"), heartbeat(stored, 2 * month)])).withColumn("client_ip", F.when(F.col("event_id").isNotNull(), F.col("client_ip")))
    return drained(spark, first_seen_stream(rows, "client_ip", late_minutes=month, window_minutes=720)).select("value", wall("first_seen"))


# --- fitted models: no SQL; tests hold them against brute force and invariants


def vectors(spark, sf_dir) -> DataFrame:
    """The model's 402 numbers of every request; segments are methods and parents all requests of a page kind."""
    rows = requests.layer2_features(enriched(spark, sf_dir)).withColumns({"segment_id": F.col("method"), "parent_id": F.col("endpoint_group")})
    return rows.withColumn("features", requests.feature_vector(rows))


@query()
def iforest_score(spark, sf_dir):
    rows = materialise(vectors(spark, sf_dir).select("event_id", "segment_id", "parent_id", "features"), "request-vectors")  # fitted and scored
    return iforest.predict(rows, iforest.fit(rows, parent="parent_id"), parent="parent_id").select("event_id", "layer2_score")


@query()
def ae_score(spark, sf_dir):
    from logharrow.operators import autoencoder

    rows = materialise(vectors(spark, sf_dir).select("event_id", "segment_id", "features"), "request-vectors")
    return autoencoder.predict(rows, autoencoder.fit(rows)).select("event_id", "layer2_score")


def tail_scores(spark, sf_dir) -> DataFrame:
    return enriched(spark, sf_dir).withColumn("final_score", F.least(F.col("sc_bytes") / 100_000, F.lit(1.0)))


@query("""WITH REQUESTS, s AS (SELECT event_type, least(sc_bytes / 100000, 1.0)::DOUBLE AS s FROM seg), u AS (SELECT event_type, count(*) AS n, quantile_cont(s, 0.95) AS u, quantile_cont(s, 0.995) AS q FROM s GROUP BY 1),
 x AS (SELECT event_type, s - u AS x, floor(log2(s - u)) AS e FROM s JOIN u USING (event_type) WHERE s > u),
 b AS (SELECT event_type, count(*) AS m, sum(x) AS total, min(x) AS least, max(x) AS most FROM x GROUP BY event_type, e, floor((x / pow(2, e) - 1) * 1024))
 SELECT event_type, u.n, round(u.u, 6) AS u, round(u.q, 6) AS q, sum(b.m)::BIGINT AS exceedances, count(*) AS bins, round(sum(total) / sum(m), 6) AS mean_excess, round(sum(total * total / m) / sum(m), 6) AS second_moment, round(min(least), 6) AS least, round(max(most), 6) AS most
 FROM b JOIN u USING (event_type) GROUP BY ALL""")
def evt_tail(spark, sf_dir):
    """What the tail fit sees: its bins' moments."""
    found = scoring.tail_bins(tail_scores(spark, sf_dir), key="event_type")
    total = lambda f: F.aggregate("bins", F.lit(0.0), lambda a, b: a + f(b))
    m = total(lambda b: b["m"])
    return found.select(
        "event_type", "n", r6("u"), r6("q"), m.cast("long").alias("exceedances"), F.size("bins").cast("long").alias("bins"), r6(total(lambda b: b["total"]) / m, "mean_excess"),
        r6(total(lambda b: b["total"] * b["total"] / b["m"]) / m, "second_moment"), r6(F.array_min("bins.least"), "least"), r6(F.array_max("bins.most"), "most"),
    )


@query()
def evt_threshold(spark, sf_dir):
    return scoring.evt_thresholds(tail_scores(spark, sf_dir), key="event_type")
