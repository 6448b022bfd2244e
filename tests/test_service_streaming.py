"""The scoring service and the streaming operators."""

import datetime as dt
import json

import pytest

from pyspark.sql import functions as F

from logharrow.operators import iforest
from logharrow.operators.requests import enrich, feature_vector, layer2_features
from logharrow.config import IsolationForest
from logharrow.service import Scorer
from logharrow.streaming import novelty
from logharrow.streaming import windows as streaming

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def test_service(spark):
    scorer = Scorer(spark)
    assert scorer.health()["models_loaded"] is False
    assert scorer.score([]) == {"results": [], "total": 0, "anomalies": 0}
    got = scorer.score([{"uri_stem": "/A/1.aspx"}, {"uri_stem": "/b", "status": 500, "method": "post", "user_agent": "curl/7"}])
    assert got["total"] == 2 and got["anomalies"] == 0 and [r["endpoint_group"] for r in got["results"]] == ["/a/1.aspx", "/b"]
    assert all(r["final_score"] == 0.0 and r["reason_codes"] == [] for r in got["results"])
    assert 'inference_latency_seconds_count{layer="api"} 1' in scorer.metrics.text() and "alerts_generated_total 0" in scorer.metrics.text()


def test_service_with_forest(spark):
    base = [("/a.aspx", "GET", 200, 0, 0, 100 + i, 1000 + i, 10, f"10.0.0.{i % 9}", "Mozilla/5.0", "k=1", T0) for i in range(60)]
    df = enrich(spark.createDataFrame(base, "uri_stem string, method string, status long, substatus long, win32_status long, time_taken long, sc_bytes long, cs_bytes long, client_ip string, user_agent string, uri_query string, timestamp timestamp"))
    rows = layer2_features(df)
    trees = iforest.fit(rows.withColumn("features", feature_vector(rows)), config=IsolationForest(n_estimators=10)).cache()
    got = Scorer(spark, trees).score([{"uri_stem": "/a.aspx", "timestamp": "2024-01-01 10:00:00"}, {"uri_stem": "/zzz", "time_taken": 10**6}])
    assert got["total"] == 2 and all(0 < r["layer2_score"] < 1 for r in got["results"])


def stream_of(spark, path, batches):
    schema = "segment_id string, endpoint_group string, timestamp timestamp, client_ip string, user_agent string, status_class string, time_taken long, sc_bytes long"
    for i, batch in enumerate(batches):
        spark.createDataFrame([("s", "/a", T0 + dt.timedelta(seconds=s), ip, "u", "5xx", 10, 100) for s, ip in batch], schema).coalesce(1).write.parquet(f"{path}/{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def drain(query):
    query.processAllAvailable()
    query.stop()


def test_windows_and_late_rows(spark, tmp_path):
    stream = stream_of(spark, str(tmp_path / "in"), [[(0, "1"), (10, "2")], [(400, "1")], [(3000, "1")], [(3100, "1")], [(20, "9"), (6000, "1")]])
    drain(streaming.window_stream(stream).writeStream.format("memory").queryName("agg").outputMode("append").start())
    got = {r.window_start: r for r in spark.table("agg").collect()}
    assert got[T0].request_count == 2 and got[T0].unique_ip_count == 2 and got[T0]["5xx_rate"] == 1.0  # the late row is left out
    assert T0 + dt.timedelta(minutes=5) in got


def test_sessions_stream(spark, tmp_path):
    stream = stream_of(spark, str(tmp_path / "in"), [[(0, "1"), (600, "1")], [(600 + 1801, "1")], [(20000, "2")], [(30000, "3")]])
    drain(streaming.session_stream(stream).writeStream.format("memory").queryName("ses").outputMode("append").start())
    assert sorted(r.requests for r in spark.table("ses").where("client_ip = '1'").collect()) == [1, 2]


def first_seen_plain(times, window):
    """Times of each value without another within the window before."""
    out = []
    for v in {v for _, v in times}:
        own = sorted(t for t, x in times if x == v)
        out += [(v, b) for a, b in zip([None, *own], own) if a is None or b - a >= window]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_first_seen_in_any_order(spark, tmp_path, seed):
    """Files in a random order within the late bound; values come back after the window, and late rows fill gaps."""
    import random

    r, window, late = random.Random(seed), 3600, 7200
    times = [(r.randint(0, 40_000), str(r.randint(1, 6))) for _ in range(70)] + [(0, "edge"), (3600, "edge"), (20_000, "edge"), (23_599, "edge")]
    files, rest = [], sorted(set(times))
    while rest:  # a file takes any rows that lie less than the late bound behind what was read
        near = [x for x in rest if x[0] < rest[0][0] + late // 2]
        files.append(r.sample(near, min(len(near), 12)))
        rest = [x for x in rest if x not in files[-1]]
    stream = stream_of(spark, str(tmp_path / "in"), [*files, [(10**6, None)], [(10**6 + 1, None)]])
    query = novelty.first_seen_stream(stream, "client_ip", late_minutes=late // 60, window_minutes=window // 60).writeStream.format("memory").queryName(f"seen{seed}").outputMode("append").start()
    query.processAllAvailable()
    state = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    query.stop()
    got = sorted((x.value, int((x.first_seen - T0).total_seconds())) for x in spark.table(f"seen{seed}").collect())
    assert got == first_seen_plain(set(times), window) and state == 0  # all state has expired


def test_runs_of_times_in_any_order():
    """Runs against sorted times, with the watermark moving on between."""
    import random

    r = random.Random(9)
    for _ in range(300):
        window, late = r.choice([1, 5, 20]), r.choice([0, 8, 50])
        runs, out, kept_times, top, watermark = [], [], [], 0, -1
        for _ in range(r.randint(1, 40)):
            t = max(0, top + r.randint(-late - 3, 15))
            if t > watermark:
                runs, kept_times = novelty.add_time(runs, t, window), [*kept_times, (t, "v")]
            top = max(top, t)
            if r.random() < 0.4:
                watermark = max(watermark, top - late)
                more, runs, _ = novelty.settle(runs, watermark, window)
                out += more
        more, runs, again = novelty.settle(runs, 10**6, window)
        assert sorted(out + more) == [t for _, t in first_seen_plain(set(kept_times), window)] and runs == [] and again is None


def test_scored_stream(spark, tmp_path):
    stream = stream_of(spark, str(tmp_path / "in"), [[(300 * i, "1") for i in range(6)], [(300 * i, "1") for i in range(6, 12)] + [(3300, str(k)) for k in range(30)], [(90000, "1")], [(99000, "1")]])
    out = []
    query = streaming.score_stream(streaming.window_stream(stream), str(tmp_path / "hist"), lambda df, n: out.extend(df.collect()), str(tmp_path / "ck"))
    drain(query)
    best = max(out, key=lambda r: r.layer1_score or 0)
    assert best.window_start == T0 + dt.timedelta(seconds=3300) and best.window_is_hot


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    """Windows that come in many batches, far apart in time, are scored as in one table."""
    import random

    from logharrow.config import Layer1
    from logharrow.operators.windows import add_burstiness, score_windows

    r, config = random.Random(4), Layer1(window_size_minutes=60, rolling_hours=5)
    rows = [(s, "/x", T0 + dt.timedelta(hours=2 * i), r.randint(1, 60), r.random(), r.random()) for i in range(28) for s in ("a", "b")]
    schema = "segment_id string, endpoint_group string, window_start timestamp, request_count long, `5xx_rate` double, p95_time_taken double"
    source = str(tmp_path / "in")
    for k in range(0, 56, 14):
        spark.createDataFrame(rows[k : k + 14], schema).coalesce(1).write.mode("append").parquet(source)
        import time

        time.sleep(1.1)  # files are read in the order of their times
    stream, out = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source), []
    drain(streaming.score_stream(stream, str(tmp_path / "hist"), lambda df, n: out.extend(df.collect()), str(tmp_path / "ck"), config))
    batch = score_windows(add_burstiness(spark.createDataFrame(rows, schema), config.rolling_rows), config).collect()
    key = lambda rs: {(x.segment_id, x.window_start): round(x.layer1_score, 9) for x in rs}
    assert key(out) == key(batch) and len(out) == 56


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4], [3, 1, 4, 2, 0]])
def test_log_stream(spark, tmp_path, order):
    """Rotated chunks without headers of their own, compressed ones, a header that changes midway, in and out of order: as one file read at once."""
    import gzip
    import time

    from logharrow.sources.w3c import read_w3c
    from logharrow.streaming.logs import read_w3c_stream

    line = lambda k, width: " ".join(["2024-01-01", f"10:00:{k:02d}", "GET", f"/p{k}", "200"] + ([str(k)] if width == 6 else []))
    five, six = "#Fields: date time cs-method cs-uri-stem sc-status", "#Fields: date time cs-method cs-uri-stem sc-status time-taken"
    chunks = [["2024-01-01 09:00:00 GET /early 200", "#Software: x", five, line(1, 5), line(2, 5)], [line(3, 5), six, line(4, 6)], [line(5, 6), "", line(6, 6)], ["#Date: y"], [line(7, 6), five, line(8, 5)]]
    names = ["a.log", "a.log.1", "a.log.2.gz", "a.log.3", "a.log.4"]
    whole, source = tmp_path / "whole", tmp_path / "in"
    whole.mkdir()
    source.mkdir()
    (whole / "a.log").write_text("".join(x + "\n" for c in chunks for x in c))
    (source / "b.log").write_text(f"{five}\n{line(9, 5)}\n")
    for k in order:
        text = "".join(x + "\n" for x in chunks[k]).encode()
        (source / names[k]).write_bytes(gzip.compress(text) if names[k].endswith(".gz") else text)
        time.sleep(0.05)  # files are read in the order of their times
    stream = read_w3c_stream(spark, str(source), files_per_trigger=1)
    drain(stream.select("timestamp", "uri_stem", "time_taken").writeStream.format("memory").queryName(f"logs{order[0]}").outputMode("append").start())
    got = sorted((r.uri_stem, str(r.timestamp), r.time_taken) for r in spark.table(f"logs{order[0]}").collect())
    want = [(r.uri_stem, str(r.timestamp), r.time_taken) for r in read_w3c(spark, str(whole)).collect()] + [("/p9", "2024-01-01 10:00:09", None)]
    assert got == sorted(want) and len(got) == 9


def test_http(spark):
    """The three endpoints over a socket."""
    import threading
    import urllib.error
    import urllib.request

    from logharrow.service import Scorer, http_server

    server = http_server(Scorer(spark), "127.0.0.1", 0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"
    call = lambda path, body=None: urllib.request.urlopen(urllib.request.Request(base + path, body and json.dumps(body).encode())).read().decode()
    assert json.loads(call("/health")) == {"status": "ok", "version": __import__("logharrow").__version__, "models_loaded": False}
    got = json.loads(call("/score", {"records": [{"uri_stem": "/A/12"}, {"uri_stem": "/b", "status": 404}]}))
    assert got["total"] == 2 and [x["endpoint_group"] for x in got["results"]] == ["/a/{num}", "/b"]
    assert "requests_scored_total 2" in call("/metrics") and 'inference_latency_seconds_count{layer="api"} 1' in call("/metrics")
    for path, body, status in (("/score", [{"x": 1}], 422), ("/nope", None, 404)):
        with pytest.raises(urllib.error.HTTPError) as error:
            call(path, body)
        assert error.value.code == status
    server.shutdown()
