"""Log operators on small frames, the cases that SQL queries on the driver's tables don't reach."""

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logharrow.config import Autoencoder, Filter, IsolationForest, Layer1, Scoring, Weights, load_settings
from logharrow.operators import autoencoder, drift, iforest, requests, scoring, sessions, windows

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_validation(spark, rows):
    df = spark.createDataFrame([(T0, "GET", "/a", 200, -5), (None, "GET", "/a", 200, 1), (T0, "GET", "/a", 99, 1), (T0, "GET", "/b", 599, None), (T0, None, "/a", 200, 1)], "timestamp timestamp, method string, uri_stem string, status int, time_taken long")
    assert rows(requests.validate(df).select("uri_stem", "time_taken")) == [("/a", 0), ("/b", None)]
    assert requests.validate(df.drop("method")).count() == 0


def test_dynamic_filter(spark):
    df = spark.createDataFrame([("/a.aspx",), ("/b.ASHX",), ("/c.svc",), ("/d.png",), (None,)], "uri_stem string")
    assert requests.dynamic_only(df).count() == 2 and requests.dynamic_only(df, Filter(enable_optional=True)).count() == 3
    assert requests.dynamic_only(df.withColumnRenamed("uri_stem", "x")).count() == 5


def test_enrich_nulls(spark):
    r = requests.enrich(spark.createDataFrame([(None, None, None, None)], "uri_stem string, method string, status int, user_agent string")).first()
    assert (r.endpoint_group, r.method, r.status_class, r.bot_flag, r.segment_key) == ("unknown", "UNKNOWN", "unknown", 0, "unknown|UNKNOWN|unknown|0")


def test_window_nulls_and_sums(spark):
    df = spark.createDataFrame([("s", "/a", at(0), "i", None, "4xx", None, None), ("s", "/a", at(10), None, None, "5xx", None, None), (None, "/a", at(10), "i", "u", "2xx", 1, 1)], "segment_id string, endpoint_group string, timestamp timestamp, client_ip string, user_agent string, status_class string, time_taken long, sc_bytes long")
    (r,) = windows.window_features(df).collect()
    assert (r.request_count, r.unique_ip_count, r.unique_ua_count, r.p95_time_taken, r.sum_sc_bytes, r["4xx_rate"], r["5xx_rate"]) == (2, 1, 0, 0.0, 0, 0.5, 0.5)


def series(spark, n=60, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"segment_id": np.repeat(["a", "b"], n), "endpoint_group": "/x", "window_start": [at(300 * i) for i in range(n)] * 2, "request_count": rng.integers(1, 50, 2 * n), "5xx_rate": rng.random(2 * n).round(2)})
    return pdf, spark.createDataFrame(pdf)


def test_rolling_statistics_like_pandas(spark):
    pdf, df = series(spark)
    z = windows.robust_z(df, ["request_count"], 36).toPandas().sort_values(["segment_id", "window_start"])
    e = windows.ewma_z(df, ["request_count"], 0.3).toPandas().sort_values(["segment_id", "window_start"])
    b = windows.add_burstiness(df, 36).toPandas().sort_values(["segment_id", "window_start"])
    for seg in "ab":
        x = pdf[pdf.segment_id == seg].request_count.astype(float).reset_index(drop=True)
        med = x.rolling(36, 1).median()
        mad = (x - med).abs().rolling(36, 1).median()
        np.testing.assert_allclose(z[z.segment_id == seg].z_request_count, (x - med).abs() / (1.4826 * mad).clip(lower=1e-8))
        want = (x - x.ewm(alpha=0.3, min_periods=1).mean()).abs() / x.rolling(36, 1).std().clip(lower=1e-8)
        np.testing.assert_allclose(e[e.segment_id == seg].z_request_count, want, rtol=1e-9)
        np.testing.assert_allclose(b[b.segment_id == seg].burstiness, x / x.rolling(36, 1).mean().clip(lower=1))


def test_score_windows(spark):
    _, df = series(spark)
    spike = df.withColumn("request_count", F.when((F.col("segment_id") == "a") & (F.col("window_start") == F.lit(at(300 * 59))), 5000).otherwise(F.col("request_count")))
    got = windows.score_windows(spike, Layer1()).where("window_start = timestamp'2024-01-01 14:55:00'").orderBy("segment_id").collect()
    assert got[0].window_is_hot and got[0].layer1_score > 0.99 and 0 < got[1].layer1_score < 1
    first = windows.score_windows(df, Layer1(use_ewma=True)).where(F.col("window_start") == F.lit(T0)).collect()
    assert all(r.layer1_score is None and r.window_is_hot is False for r in first)
    assert windows.score_windows(spark.createDataFrame([("s",)], "segment_id string")).first().layer1_score == 0.0


def test_join_and_gate(spark, rows):
    req = spark.createDataFrame([("s", at(10), "/A"), ("s", at(400), "/b"), (None, at(10), "/c")], "segment_id string, timestamp timestamp, endpoint_group string")
    win = spark.createDataFrame([("s", T0, 0.9, True), ("s", T0, 0.8, False)], "segment_id string, window_start timestamp, layer1_score double, window_is_hot boolean")
    got = requests.join_window_scores(req, win)
    assert rows(got.select("endpoint_group", "layer1_score", "window_is_hot")) == [("/A", 0.8, False), ("/A", 0.9, True), ("/b", 0.0, False), ("/c", 0.0, False)]
    assert rows(requests.layer2_gate(got, ["/B"]).select("endpoint_group")) == [("/A",), ("/b",)]
    assert requests.layer2_gate(got).count() == 1


def test_rows_without_a_time_stay(spark):
    req = spark.createDataFrame([("s", None, "/c", "1.1.1.1")], "segment_id string, timestamp timestamp, endpoint_group string, client_ip string")
    win = spark.createDataFrame([("s", T0, 0.9, True)], "segment_id string, window_start timestamp, layer1_score double, window_is_hot boolean")
    assert requests.join_window_scores(req, win).first().layer1_score == 0.0 and requests.ip_stats(req).count() == 1


def test_salted_join_copies_only_common_keys(spark, monkeypatch):
    """Sixteen copies of every aggregate were broadcast by a size that was guessed before they were made."""
    monkeypatch.setattr(requests, "GROUP_ROWS", 4)
    df = spark.createDataFrame([(i, "a" if i < 9 else f"b{i}") for i in range(20)] + [(20, None)], "i int, k string")
    sums = df.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.sum("i").alias("s"))
    joined = requests.salted_join(df, sums, ["k"], "n")
    assert sorted((r.i, r.n, r.s) for r in joined.collect() if r.k is not None) == [(i, 9, 36) if i < 9 else (i, 1, i) for i in range(20)]
    assert joined.where("k is null and n is null").count() == 1 and joined.columns == ["k", "i", "n", "s"]
    made = []
    monkeypatch.setattr(type(df), "join", lambda self, other, *a, join=type(df).join, **b: made.append(other) or join(self, other, *a, **b))
    requests.salted_join(df, sums, ["k"], "n")
    assert made[-1].count() == 3 + 11 and made[0].count() == 1


def test_request_features(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 14, 5), "/a/b.aspx", "k=1&j=2", 500, 2048, None, 200, None, 0, None, "curl/7", "/a")], "timestamp timestamp, uri_stem string, uri_query string, time_taken long, sc_bytes long, cs_bytes long, status int, substatus int, win32_status int, client_ip string, user_agent string, endpoint_group string")
    out = requests.layer2_features(df)
    r = out.withColumn("v", requests.feature_vector(out)).first()
    assert (r.hour, r.day_of_week, r.path_depth, r.bytes_per_ms, r.ua_bot_flag, r.query_key_count, r.status_triple) == (14, 0, 2, 2048 / 500, 1, 2, "200_0_0")
    assert r.ip_rps_last_5m is None and len(r.v) == 402 == len(requests.feature_columns()) and len(r.path_hash) == 256 and len(r.query_hash) == 128
    assert set(requests.feature_columns()) <= set(requests.explode_hashes(out).columns)


def test_sessions(spark, rows):
    data = [("1", "u", 0), ("2", "u", 60), ("1", "u", 1800), ("1", "u", 3601), (None, None, 5)]
    df = spark.createDataFrame([(ip, ua, at(s)) for ip, ua, s in data], "client_ip string, user_agent string, timestamp timestamp")
    by = sessions.sessionize(df, 30, hashed=False).select("session_id", "session_seq")
    assert rows(by) == [("1|u|_1", 0), ("1|u|_1", 1), ("1|u|_2", 0), ("2|u|_1", 0), ("||_1", 0)]  # a gap of exactly 30 minutes joins
    glob = sessions.sessionize(df, 30, "global", hashed=False).select("session_id", "session_seq")
    assert rows(glob) == [("1|u|_1", 0), ("1|u|_2", 0), ("1|u|_3", 0), ("2|u|_1", 0), ("||_1", 0)]


def test_markov(spark):
    df = spark.createDataFrame([("s", i, e) for i, e in enumerate("abab")] + [("t", 0, "a"), ("u", 0, "a"), ("u", 1, "z")], "session_id string, session_seq int, endpoint_group string")
    model = sessions.markov_fit(sessions.transitions(df.where("session_id = 's'")))
    probs = {(r.from_state, r.to_state): r.prob for r in model.collect()}
    assert probs[("a", "b")] == pytest.approx((2 + 1e-6) / (2 + 2e-6)) and model.first().n_states == 2
    got = {r.session_id: r.layer3_score for r in sessions.markov_score(df, model).collect()}
    assert got["t"] == 0.0 and got["u"] == pytest.approx(1 / (1 + np.exp(np.log(1e-6 / 2) + 3))) and got["s"] < 0.1
    with pytest.raises(NotImplementedError):
        sessions.SequenceAutoencoder().fit(df)


def test_fusion(spark):
    df = spark.createDataFrame([(0.5, None), (1.0, 1.0)], "layer1_score double, layer2_score double")
    assert [r.final_score for r in scoring.combine_scores(df).collect()] == pytest.approx([0.5 * 0.3 / 0.8, 1.0])
    assert scoring.combine_scores(df.drop("layer2_score")).first().final_score == 0.5
    assert scoring.combine_scores(spark.range(1)).first().final_score == 0.0
    assert scoring.combine_scores(df, Weights(0, 0, 0)).first().final_score == 0.0


def test_thresholds(spark):
    df = spark.createDataFrame([("a", i / 100) for i in range(101)] + [("b", None), (None, 0.5)], "segment_id string, final_score double")
    limits = scoring.segment_thresholds(df, 0.9)
    assert {r.segment_id: r.threshold for r in limits.collect()} == {"a": pytest.approx(0.9), "b": 1.0}
    probe = spark.createDataFrame([("a", 0.9), ("a", 0.89), ("x", 0.99), ("x", 1.0), ("a", None)], "segment_id string, final_score double")
    assert [r.is_anomaly for r in scoring.apply_thresholds(probe, limits).orderBy("segment_id", "final_score").collect()] == [False, False, True, False, True]


def evt_level(scores, tail=0.05, p=0.005):
    """The rule for one segment held in memory."""
    if len(scores) < 100:
        return float(np.quantile(scores, 0.995)) if len(scores) else 1.0
    u = float(np.quantile(scores, 1 - tail))
    excess = scores[scores > u] - u
    if len(excess) < 10:
        return u
    shape, scale = scoring.fit_gpd(excess)
    ratio = len(excess) / (len(scores) * p)
    return float(np.clip(u + scale * np.log(ratio) if shape == 0 else u + scale / shape * (ratio**shape - 1), 0, 1))


def test_exact_quantiles(spark):
    """Like numpy, with ties, values outside [0, 1], nulls and segments of one value."""
    rng = np.random.default_rng(4)
    data = {"a": rng.random(999), "b": np.round(rng.beta(1, 9, 500), 2), "c": rng.normal(0, 5, 301), "d": np.full(70, 0.25), "e": np.array([0.7])}
    rows = [(k, float(x)) for k, v in data.items() for x in v] + [("a", None), ("f", None), (None, 0.1)]
    got = {r.s: r for r in scoring.exact_quantiles(spark.createDataFrame(rows, "s string, v double"), "s", "v", {"q0": 0.0, "q5": 0.5, "q9": 0.995, "q1": 1.0}).collect()}
    for k, v in data.items():
        assert got[k].n == len(v) and [got[k].q0, got[k].q5, got[k].q9, got[k].q1] == pytest.approx(np.quantile(v, [0, 0.5, 0.995, 1]).tolist())
    assert got["f"].n == 0 and got["f"].q5 is None and len(got) == 6


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_rolling_medians_by_blocks(spark, monkeypatch, block):
    """Equal to the window expressions, for segments shorter and longer than a block, ties, nulls and null keys."""
    from logharrow.operators import rolling

    monkeypatch.setattr(rolling, "BLOCK", block)
    rng = np.random.default_rng(block)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(s, f"/{e}", t0 + dt.timedelta(minutes=5 * int(t)), None if rng.random() < 0.1 else int(rng.integers(0, 4)), float(rng.random())) for s, n in (("a", 150), ("b", 1), ("c", 30), (None, 25), ("d", 5)) for e in "xy" for t in range(n)]
    df = spark.createDataFrame(rows, "segment_id string, endpoint_group string, window_start timestamp, request_count long, `5xx_rate` double").repartition(4)
    columns = ["request_count", "5xx_rate"]
    key = lambda out: {(r.segment_id, r.endpoint_group, r.window_start): (r.request_count, round(r.z_request_count, 9), round(r["z_5xx_rate"], 9)) for r in out.collect()}
    got = rolling.robust_z_blocks(df, columns, rows=6)
    assert got.columns == [*df.columns, "z_request_count", "z_5xx_rate"] and key(got) == key(windows.robust_z(df, columns, rows=6)) and got.count() == len(rows)
    assert rolling.robust_z_blocks(df.limit(0), columns).count() == 0


def test_standardisation_keeps_digits(spark):
    """Means a million times the deviation, over many partitions, some of them empty; an empty table."""
    rng = np.random.default_rng(21)
    x = rng.normal(0, 1, (400, 3)) * [1, 1e-3, 0] + [1e6, 1e3, 5]
    mean, scale = autoencoder.standardisation(spark.createDataFrame([(v.tolist(),) for v in x], "features array<double>").repartition(11))
    assert mean == pytest.approx(x.mean(0), rel=1e-12) and scale == pytest.approx([*x[:, :2].std(0), 1.0], rel=1e-6)
    assert [len(a) for a in autoencoder.standardisation(spark.createDataFrame([], "features array<double>"))] == [0, 0]


def test_panes_roll_up_within_bounds(spark):
    """Counts and sums equal those of the rows; distinct counts lie within four standard errors, quantiles within 2 % of their rank, over many panes."""
    from logharrow.operators import panes

    rng = np.random.default_rng(31)
    n = 12_000
    rows = pd.DataFrame({"segment_id": np.where(rng.random(n) < 0.7, "hot", "cold"), "endpoint_group": "/a", "timestamp": [T0 + dt.timedelta(seconds=int(x)) for x in rng.integers(0, 3600, n)], "client_ip": [f"i{x}" for x in rng.integers(0, 4000, n)], "user_agent": [f"u{x}" for x in rng.integers(0, 7, n)], "status_class": rng.choice(["2xx", "4xx", "5xx"], n), "time_taken": np.floor(rng.lognormal(5, 2, n)).astype("int64"), "sc_bytes": rng.integers(0, 10**6, n)})
    df = spark.createDataFrame(rows).union(spark.createDataFrame([(None, "/a", T0, "i", "u", "2xx", 1, 1), ("hot", "/a", None, "i", "u", "2xx", 1, 1)], "segment_id string, endpoint_group string, timestamp timestamp, client_ip string, user_agent string, status_class string, time_taken long, sc_bytes long"))
    stored = panes.panes(df, 1)
    for minutes, step in ((60, 60), (30, 10), (5, 1)):
        got = {(r.segment_id, r.window_start): r for r in panes.roll_up(stored, minutes, step).collect()}
        seen = 0
        for start in [T0 + dt.timedelta(minutes=m) for m in range(-minutes + step, 60, step)]:
            for segment, part in rows[(rows.timestamp >= start) & (rows.timestamp < start + dt.timedelta(minutes=minutes))].groupby("segment_id"):
                r, seen = got[segment, start], seen + 1
                assert r.request_count == len(part) and r.sum_sc_bytes == part.sc_bytes.sum() and r["4xx_rate"] == pytest.approx((part.status_class == "4xx").mean())
                assert abs(r.unique_ip_count - part.client_ip.nunique()) <= max(0.5, 0.065 * part.client_ip.nunique()) and r.unique_ua_count == part.user_agent.nunique()
                for name, q in (("p50_time_taken", 0.5), ("p95_time_taken", 0.95), ("p99_time_taken", 0.99)):
                    assert (part.time_taken < r[name]).mean() - 0.02 <= q <= (part.time_taken <= r[name]).mean() + 0.02
        assert seen == len(got)
    with pytest.raises(ValueError, match="whole number"):
        panes.roll_up(stored, 5, 2)
    assert panes.roll_up(panes.panes(df.limit(0)), 60).count() == 0


def test_quantiles_of_any_distribution(spark):
    """Exactly numpy's, for crowded, outlying, tiny, huge, negative and infinite values."""
    rng = np.random.default_rng(14)
    data = {
        "crowded": 0.5 + 1e-6 * rng.random(700), "next": np.nextafter(0.7, 1) + np.spacing(0.7) * rng.integers(0, 9, 300), "outlier": np.append(rng.random(400) * 1e-9, 1e300), "outside": rng.normal(0, 1e6, 500),
        "tiny": rng.random(200) * 1e-310, "powers": 2.0 ** rng.integers(-1074, 1023, 900), "zeros": np.array([0.0, -0.0, 0.0, 5e-324, -5e-324]), "ends": np.array([np.inf, -np.inf, 1.0, 2.0, 3.0, 4.0, 5.0, 1.7976931348623157e308, -1.7976931348623157e308]),
    }
    rows = [(k, float(x)) for k, v in data.items() for x in v]
    qs = {"a": 0.0, "b": 0.1, "c": 0.37, "d": 0.5, "e": 0.995, "f": 1.0}
    got = {r.s: r for r in scoring.exact_quantiles(spark.createDataFrame(rows, "s string, v double").repartition(5), "s", "v", qs).collect()}
    with np.errstate(invalid="ignore", over="ignore"):
        for k, v in data.items():
            want = {name: np.quantile(v, q) for name, q in qs.items()}
            for name in qs:
                if np.isfinite(want[name]):
                    assert got[k][name] == want[name], (k, name)
    assert got["ends"].a == -np.inf and got["ends"].f == np.inf
    assert np.isnan(scoring.exact_quantiles(spark.createDataFrame([("k", 1.0), ("k", float("nan"))], "s string, v double"), "s", "v", {"q": 1.0}).first().q)


def test_tail_bins(spark):
    """The fit over bins lies within 1e-6 of that over all rows; a tail's bins are bounded."""
    rng = np.random.default_rng(8)
    data = {"heavy": np.minimum(rng.pareto(3, 60_000) / 50, 1), "beta": rng.beta(1, 30, 60_000), "crowded": 0.3 + 1e-9 * rng.random(40_000)}
    df = spark.createDataFrame([(k, float(x)) for k, v in data.items() for x in v], "segment_id string, final_score double")
    got = {r.segment_id: r.threshold for r in scoring.evt_thresholds(df).collect()}
    for k, v in data.items():
        assert got[k] == pytest.approx(evt_level(v), rel=1e-6)
    bins = {r.segment_id: r for r in scoring.tail_bins(df).collect()}
    for k, v in data.items():
        u = np.quantile(v, 0.95)
        assert bins[k].u == u and sum(b.m for b in bins[k].bins) == (v > u).sum() and sum(b.total for b in bins[k].bins) == pytest.approx((v[v > u] - u).sum())
        assert all(b.least <= b.total / b.m * (1 + 1e-12) and b.most * (1 + 1e-12) >= b.total / b.m and b.most <= b.least * (1 + 1 / 1024) for b in bins[k].bins if b.least > scoring.TAIL_FLOOR)


def test_evt(spark):
    rng = np.random.default_rng(3)
    shape, scale = scoring.fit_gpd(rng.pareto(4, 20000))
    assert shape == pytest.approx(0.25, abs=0.05) and scale == pytest.approx(0.25, abs=0.03)
    assert scoring.fit_gpd(rng.exponential(2.0, 20000))[1] == pytest.approx(2.0, abs=0.1)
    big, few, flat = rng.beta(2, 8, 5000), rng.random(50), np.full(200, 0.5)
    df = spark.createDataFrame([("big", float(x)) for x in big] + [("few", float(x)) for x in few] + [("flat", float(x)) for x in flat] + [("none", None)], "segment_id string, final_score double")
    got = {r.segment_id: r.threshold for r in scoring.evt_thresholds(df).collect()}
    for name, values in (("big", big), ("few", few), ("flat", flat), ("none", np.empty(0))):
        assert got[name] == pytest.approx(evt_level(values))
    assert got["big"] == pytest.approx(np.quantile(big, 0.995), abs=0.03) and got["flat"] == 0.5 and got["none"] == 1.0


def test_reasons_and_alerts(spark, rows):
    df = spark.createDataFrame([(i, "/Crit" if i % 2 else "/x", i / 10, True, 5.0, 5.0) for i in range(8)] + [(8, "/x", 0.7, True, None, 1.0), (9, "/x", 1.0, None, 1.0, 1.0)], "i int, endpoint_group string, final_score double, is_anomaly boolean, burstiness double, log_time_taken double")
    codes = {r.i: r.reason_codes for r in scoring.add_reason_codes(df, {"log_time_taken": 4.0}).collect()}
    assert codes[0] == ["burst_rate", "latency_spike"] and codes[8] == ["latency_spike"] and codes[9] == []
    pick = lambda k, c, crit: [r.i for r in scoring.select_alerts(df, Scoring(topk_daily=k, topk_critical=c), crit, tie="i").orderBy("i").collect()]
    assert pick(4, 2, ["/crit"]) == [5, 6, 7, 8] and pick(2, 3, ["/crit"]) == [3, 5, 7][-2:] or pick(2, 3, ["/crit"]) == [3, 5, 7]
    assert pick(3, 1, None) == [6, 7, 8]
    assert scoring.select_alerts(df.where("i > 8")).count() == 0
    payload = json.loads(scoring.alert_payloads(df.where("i = 1")).first().value)
    assert payload["context"] == {"burstiness": 5.0} and payload["layer1_score"] is None and payload["final_score"] == 0.1 and payload["bot_flag"] == 0


def test_drift(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(0, 1, 3000), rng.normal(0.8, 1, 2000)
    ref = spark.createDataFrame([(float(x), "p" if x > 0 else "q", 1.0) for x in a], "v double, c string, k double")
    cur = spark.createDataFrame([(float(x), "p" if x > 0 else "z", 1.0) for x in b], "v double, c string, k double")
    edges = np.linspace(min(a.min(), b.min()), max(a.max(), b.max()), 21)
    p, q = np.histogram(a, edges)[0] / 3000 + 1e-8, np.histogram(b, edges)[0] / 2000 + 1e-8
    assert drift.psi(ref, cur, "v").first()[0] == pytest.approx(float(((q - p) * np.log(q / p)).sum()))
    assert drift.psi(ref, cur, "k").first()[0] == pytest.approx(0) and drift.psi(ref, cur.limit(0), "v").first()[0] is None
    x = np.sort(np.concatenate([a, b]))
    gap = np.abs(np.searchsorted(np.sort(a), x, "right") / 3000 - np.searchsorted(np.sort(b), x, "right") / 2000).max()
    assert drift.ks_statistic(ref, cur, "v").first()[0] == pytest.approx(gap)
    assert drift.ks_pvalue(gap, 3000, 2000) < 1e-6 < 0.9 < drift.ks_pvalue(0.005, 100, 100)
    assert drift.jsd(ref, ref, "c").first()[0] == pytest.approx(0) and drift.jsd(ref.where("c='q'"), cur.where("c='z'"), "c").first()[0] == pytest.approx(np.sqrt(np.log(2)))
    report = drift.drift_report(ref, cur, ["v", "k", "absent"], ["c"], "v")
    assert report["needs_retrain"] and {x.get("feature", "score") for x in report["alerts"]} == {"v", "c", "score"}


def test_drift_files(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    drift.save_report(drift.drift_report(df, df, ["v"], []), str(tmp_path), spark)
    assert json.loads((tmp_path / "drift_report.json").read_text())["needs_retrain"] is False and "| v |" in (tmp_path / "drift_report.md").read_text()


def test_isolation_forest(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(0, 1, (600, 4)), [[9, 9, 9, 9]]]).astype(np.float32)
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", v.tolist()) for i, v in enumerate(x)], "i int, segment_id string, features array<float>")
    trees = iforest.fit(df, config=IsolationForest(n_estimators=40), min_rows=301)
    assert {r[0] for r in trees.select("model_key").distinct().collect()} == {"GLOBAL", "s:b"}
    got = iforest.predict(df, trees).toPandas().set_index("i").layer2_score.sort_index()
    assert got.idxmax() == 600 and ((got > 0) & (got < 1)).all() and got[600] > 0.5 and (got > 0.5).mean() < 0.05
    assert (iforest.predict(df, trees).toPandas().set_index("i").layer2_score.sort_index() == got).all()
    assert iforest.predict(df, trees.limit(0)).first().layer2_score == 0.5
    # the offset is the contamination quantile over all rows of the model
    own = iforest.Forest([r.asDict() for r in trees.where("model_key = 'GLOBAL'").orderBy("tree").collect()])
    assert own.raw_offset == pytest.approx(np.quantile(-own.anomaly(x), 0.01))


def test_model_cascade(spark, monkeypatch):
    """Segment, parent, global; many groups of rows for one model give what one group gives."""
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, "big" if i < 300 else f"s{i % 9}", "p" if i < 450 else "q" if i < 590 else None, rng.random(3).tolist()) for i in range(600)], "i int, segment_id string, parent_id string, features array<double>").repartition(3)
    trees = iforest.fit(df, parent="parent_id", config=IsolationForest(n_estimators=10), min_rows=140)
    assert {r[0] for r in trees.select("model_key").distinct().collect()} == {"GLOBAL", "s:big", "p:p", "p:q"}
    got = {r.i: r.layer2_score for r in iforest.predict(df, trees, parent="parent_id").collect()}
    monkeypatch.setattr(iforest, "GROUP_ROWS", 40)
    assert got == {r.i: r.layer2_score for r in iforest.predict(df, trees, parent="parent_id").collect()} and len(got) == 600
    data = {r.i: np.array(r.features, np.float32) for r in df.collect()}
    forest = lambda key: iforest.Forest([r.asDict() for r in trees.where(F.col("model_key") == key).orderBy("tree").collect()])
    for i, key in ((5, "s:big"), (400, "p:p"), (500, "p:q"), (595, "GLOBAL")):
        assert got[i] == pytest.approx(forest(key).score(data[i][None])[0])


def test_autoencoder(spark, tmp_path):
    rng = np.random.default_rng(8)
    base = rng.normal(0, 1, (500, 2))
    x = np.vstack([base @ rng.normal(0, 1, (2, 6)), [[8, -8, 8, -8, 8, -8]]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, features array<double>")
    model = autoencoder.fit(df.where("i < 500"), config=Autoencoder(latent_dim=2, hidden_dims=[8], epochs=15, batch_size=64), forest=IsolationForest(n_estimators=20))
    got = autoencoder.predict(df, model).toPandas().set_index("i").layer2_score.sort_index()
    assert got.rank(ascending=False)[500] <= 5 and ((got >= 0) & (got <= 1)).all()
    model.save(spark, str(tmp_path / "m"))
    again = autoencoder.predict(df, autoencoder.LatentForest.load(spark, str(tmp_path / "m"))).toPandas().set_index("i").layer2_score.sort_index()
    np.testing.assert_allclose(got, again)


def test_latent_numbers_on_a_split():
    """A tree for each row splits just at the row's number as plain sums give it: the score must take that side, for any batch."""
    rng = np.random.default_rng(3)
    network = autoencoder.Network(6, Autoencoder(hidden_dims=[5], latent_dim=2))
    network.biases = [rng.normal(0, 1, len(b)) for b in network.biases]
    x, want = rng.normal(0, 3, (60, 6)), []
    for row in x:
        for k in range(2):
            sums = []
            for b, column in zip(network.biases[k], network.weights[k].T):
                for w, v in zip(column, row):
                    b = b + v * w
                sums.append(b)
            row = sums if k else [max(v, 0.0) for v in sums]
        want.append(row)
    trees = [{"feature": [0, -1, -1], "threshold": [row[0], 0.0, 0.0], "below": [1, -1, -1], "above": [2, -1, -1], "path": [0.0, 1.0, 9.0], "sub_sample": 256, "raw_offset": -0.5} for row in want]
    model = autoencoder.LatentForest(np.zeros(6), np.ones(6), network, trees)
    scores = iforest.Forest(trees).score(np.array(want))
    assert model.measure(x)[1].tolist() == scores.tolist() == [s for row in x for s in model.measure(row[None])[1]]
    assert len(iforest.Forest(trees).near_splits(np.array(want) + 1e-3, network.rounding(x))) < 5


def test_novelty(spark, rows):
    df = spark.createDataFrame([("u", T0), ("u", at(3600)), ("u", at(8 * 86400)), ("v", T0)], "ua string, timestamp timestamp")
    assert sorted(r.is_novel for r in requests.novelty(df, "ua").collect()) == [0, 1, 1, 1]
    more = df.unionByName(spark.createDataFrame([(None, T0), (None, at(60)), ("v", None), ("u", T0)], "ua string, timestamp timestamp"))
    assert sorted(r.is_novel for r in requests.novelty(more, "ua").collect()) == [0, 0, 1, 1, 1, 1, 1, 1]


def test_novelty_by_the_nearest_second(spark):
    """The window is of rounded seconds: 10.3 and 10.6 are two, 10.5 and 10.3 are one, and 10.6 ends its seven days later than 10.3."""
    week = 7 * 86400
    times = [("a", 10.3), ("a", 10.6), ("b", 10.3), ("b", 10.5), ("c", 10.6), ("c", week + 11.4), ("d", 10.3), ("d", week + 10.7), ("e", 11.5), ("e", 12.4)]
    df = spark.createDataFrame([(i, v, at(s)) for i, (v, s) in enumerate(times)], "i int, ua string, timestamp timestamp")
    assert [r.is_novel for r in requests.novelty(df, "ua").orderBy("i").collect()] == [1, 0, 1, 1, 1, 0, 1, 1, 1, 1]


@pytest.mark.parametrize("moments", [None, 3])
def test_global_sessions_by_brute_force(spark, moments):
    """Over hours with and without rows, ties broken by a number, rows without a time first; also with most rows in a few moments, whose ties lie over the edges of ranges."""
    rng = np.random.default_rng(2)
    seconds = sorted(int(x) for x in (rng.integers(0, 40 * 3600, 120) if moments is None else rng.integers(0, moments, 200) * 1500))
    data = [(k, str(rng.integers(0, 3)), "u", at(s) if k % 40 else None) for k, s in enumerate(seconds)]
    got = sessions.sessionize(spark.createDataFrame(data, "k int, client_ip string, user_agent string, timestamp timestamp"), 30, "global", "k", hashed=False)
    want, last, numbers = {}, None, {}
    for k, ip, _, ts in sorted(data, key=lambda r: (r[3] is not None, r[3] or 0, r[0])):
        gap = last and last[1] and ts and (ts - last[1]).total_seconds() > 1800
        if last is None or last[0] != ip or gap:
            numbers[ip] = numbers.get(ip, 0) + 1
        want[k] = f"{ip}|u|_{numbers[ip]}"
        last = (ip, ts)
    assert {r.k: r.session_id for r in got.collect()} == want


def test_layer3_stage(spark):
    from logharrow.config import Layer3, Settings
    from logharrow.plans import stages

    df = spark.createDataFrame([(i, "ab"[i % 2], "u", at(10 * i), "/crit" if i == 3 else f"/p{i % 3}") for i in range(12)], "i int, client_ip string, user_agent string, timestamp timestamp, endpoint_group string")
    got = {r.i: r.layer3_score for r in stages.layer3(df, Settings(layer3=Layer3(True, 30, ["/Crit"]))).collect()}
    assert len(got) == 12 and all((got[i] is not None) == (i % 2 == 1) for i in got) and max(x or 0 for x in got.values()) < 1
    assert stages.layer3(df, Settings()) is df
    again = stages.layer3(stages.layer3(df, Settings(layer3=Layer3(True))), Settings(layer3=Layer3(True)))
    assert again.where("layer3_score is null").count() == 0 and again.count() == 12


def test_drift_metrics_like_single_ones(spark):
    rng = np.random.default_rng(6)
    ref = spark.createDataFrame([(float(x), float(x) ** 2, str(int(x * 5))) for x in rng.random(400)], "a double, b double, c string")
    cur = spark.createDataFrame([(float(x), 1.0, str(int(x * 4))) for x in rng.random(300)], "a double, b double, c string")
    got = {(r.feature, r.metric): r.value for r in drift.drift_metrics(ref, cur, ["a", "b"], ["c"]).collect()}
    assert got == {("a", "psi"): pytest.approx(drift.psi(ref, cur, "a").first()[0]), ("b", "psi"): pytest.approx(drift.psi(ref, cur, "b").first()[0]), ("c", "jsd"): pytest.approx(drift.jsd(ref, cur, "c").first()[0])}
    assert drift.drift_metrics(ref, cur.limit(0), ["a"], []).first().value is None and drift.drift_metrics(ref, cur, [], []).count() == 0


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "a.yaml").write_text("layer1:\n  rolling_hours: 6\n")
    (tmp_path / "b.yaml").write_text("layer1:\n  hot_threshold: 0.5\n")
    monkeypatch.setenv("LOGHARROW_CONFIG", str(tmp_path / "b.yaml"))
    cfg = load_settings(str(tmp_path / "a.yaml"), {"scoring": {"weights": {"layer1": 0.9}}})
    assert (cfg.layer1.rolling_hours, cfg.layer1.rolling_rows, cfg.layer1.hot_threshold, cfg.scoring.weights.layer1, cfg.scoring.weights.layer2) == (6, 72, 0.5, 0.9, 0.5)
    with pytest.raises(KeyError):
        load_settings(overrides={"nope": 1})


def test_default_file_layer(tmp_path, monkeypatch):
    """configs/default.yaml below the working folder comes before a given file; all sections of such a file are known."""
    from logharrow.sources.w3c import spark_pattern

    (tmp_path / "configs").mkdir()
    (tmp_path / "configs/default.yaml").write_text("ingest:\n  datetime_format: '%d/%m/%y %H:%M:%S'\n  chunk_size: 7\n  compression: zstd\nmlflow:\n  tracking_uri: http://localhost:5000\n  experiment_name: e\n  registry_name: r\ndrift:\n  retrain_schedule: daily\n")
    (tmp_path / "own.yaml").write_text("ingest:\n  chunk_size: 9\n")
    monkeypatch.chdir(tmp_path)
    monkeypatch.delenv("LOGHARROW_CONFIG", raising=False)
    cfg = load_settings("own.yaml")
    assert (cfg.ingest.chunk_size, cfg.ingest.compression, cfg.mlflow.registry_name, cfg.registry_root) == (9, "zstd", "r", "./models/registry")
    assert spark_pattern(cfg.ingest.datetime_format) == "d/M/yy H:m:s"
    assert load_settings(overrides={"mlflow": {"tracking_uri": "/tmp/x"}}).registry_root == "/tmp/x"


def test_log_records():
    import io
    import logging

    from logharrow.logs import configure

    out = io.StringIO()
    configure("info", "json", out)
    logging.getLogger("logharrow.stages").info("done", extra={"rows": 3})
    logging.getLogger("logharrow.stages").debug("not shown")
    record = json.loads(out.getvalue())
    assert record["event"] == "done" and record["rows"] == 3 and record["level"] == "info" and record["logger"] == "logharrow.stages"
    text = io.StringIO()
    configure("INFO", "console", text)
    logging.getLogger("logharrow.x").warning("hm", extra={"a": 1})
    assert text.getvalue().strip().endswith("logharrow.x: hm a=1")
