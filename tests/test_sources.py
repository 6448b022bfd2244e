"""Log reader, tables, registry and the command line."""

import datetime as dt
import gzip
import json

import pytest

from logharrow import cli
from logharrow.registry import ModelRegistry
from logharrow.sources.tables import dates_missing, read_table, write_by_date
from logharrow.sources.w3c import alias, read_w3c

HEAD = "#Software: x\n#Fields: date time c-ip cs-method cs-uri-stem sc-status\n"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_lines_and_headers(spark, tmp_path):
    text = "2024-01-01 00:00:00 1.1.1.1 GET /before 200\n" + HEAD + "2024-01-01 10:00:00 1.2.3.4 GET /a.aspx 200\n#Remark: x\n\n2024-1-2 1:2:3 - POST /b 5x\nshort line\n"
    text += "#Fields: date time cs-uri-stem time-taken x-Own(a) x-Own(a)\r\n2024-02-30 00:00:00 /c 12 p q\r\n"
    got = {r.uri_stem: r for r in read_w3c(spark, write(tmp_path / "x.log", text)).collect()}
    assert set(got) == {"/a.aspx", "/b", "/c"}
    a, b, c = got["/a.aspx"], got["/b"], got["/c"]
    assert (str(a.timestamp), a.client_ip, a.method, a.status, a.client_ip_missing, a.time_taken_missing) == ("2024-01-01 10:00:00", "1.2.3.4", "GET", 200, 0, None)
    assert (str(b.timestamp), b.client_ip, b.client_ip_missing, b.status, b.status_missing) == ("2024-01-02 01:02:03", None, 1, None, 1)
    assert (c.timestamp, c.timestamp_missing, c.time_taken, c.method_missing, c.extras) == (None, 1, 12, None, {"x_Own_a": "q"})


def test_directory_gzip_and_splits(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    lines = "".join(f"2024-01-01 00:00:{i % 60:02d} 1.1.1.1 GET /p{i} 200\n" for i in range(3000))
    write(tmp_path / "a.LOG", HEAD + lines)
    with gzip.open(tmp_path / "sub" / "b.gz", "wt") as f:
        f.write("#Fields: date time cs-uri-stem\n2024-01-01 00:00:00 /gz\n")
    write(tmp_path / "c.csv", HEAD + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # the header is in the first of several splits
    try:
        df = read_w3c(spark, str(tmp_path))
        assert df.count() == 3001 and df.where("uri_stem = '/gz'").count() == 1 and df.select("uri_stem").distinct().count() == 3001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_alias():
    assert (alias("cs(User-Agent)"), alias("x-foo(bar)")) == ("user_agent", "x_foo_bar")


def test_tables_by_date(spark, tmp_path):
    df = read_w3c(spark, write(tmp_path / "x.log", HEAD + "2024-01-01 10:00:00 a GET /a 200\n2024-01-02 10:00:00 a GET /b 200\nbad bad a GET /c 200\n"))
    assert dates_missing(df) == 1
    out = str(tmp_path / "t")
    write_by_date(df, out)
    write_by_date(df.where("uri_stem = '/b'"), out)  # other dates stay
    assert read_table(spark, out).count() == 2
    day = read_table(spark, out, "2024-01-02")
    assert [r.uri_stem for r in day.collect()] == ["/b"]
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().toString()


def test_registry(spark, tmp_path):
    reg = ModelRegistry(spark, f"file://{tmp_path}/reg")
    assert reg.load("m") is None and reg.metadata("m") is None
    assert reg.log("m", spark.range(2), {"a": 1}) == 1 and reg.log("m", spark.range(5), metrics={"auc": 0.5}) == 2
    assert reg.load("m").count() == 5 and reg.load("m", 1).count() == 2
    assert reg.metadata("m")["metrics"] == {"auc": 0.5} and reg.metadata("m", 1)["params"] == {"a": 1}


def test_command_line(spark, tmp_path):
    fields = "#Fields: date time c-ip cs-method cs-uri-stem cs-uri-query sc-status sc-substatus sc-win32-status time-taken sc-bytes cs-bytes cs(User-Agent)\n"
    lines = "".join(f"2024-01-01 {h:02d}:{m:02d}:00 10.0.0.{m % 5} GET /p{m % 3}.aspx a={m} {500 if m == 7 else 200} 0 0 {m * 10} {m * 100} 5 Mozilla/5.0\n" for h in range(6) for m in range(0, 60, 3))
    lines += "2024-01-01 01:00:00 1.1.1.1 GET /logo.png - 200 0 0 1 1 1 -\n"
    write(tmp_path / "x.log", fields + lines)
    (tmp_path / "c.yaml").write_text("layer2:\n  iforest:\n    n_estimators: 5\nlayer1:\n  hot_threshold: 0.0\nscoring:\n  segment_quantile: 0.9\nlayer3:\n  enabled: true\nmlflow:\n  tracking_uri: " + str(tmp_path / "registry") + "\n")
    d = lambda n: str(tmp_path / n)
    run = lambda *a: cli.main(["--config", d("c.yaml"), *a])
    assert run("parse", "--input", d("x.log"), "--output", d("parsed")) == 0
    run("filter-dynamic", "--input", d("parsed"), "--output", d("dynamic"))
    assert read_table(spark, d("dynamic")).count() == read_table(spark, d("parsed")).count() - 1
    run("featurize-layer1", "--input", d("dynamic"), "--output", d("l1"))
    run("infer-layer1", "--input", d("l1"), "--output", d("l1s"))
    run("featurize-layer2", "--input", d("dynamic"), "--windows", d("l1s"), "--output", d("l2"))
    run("train-layer2", "--input", d("l2"), "--output", d("model"))
    run("infer-layer2", "--input", d("l2"), "--model", d("model"), "--output", d("l2s"))
    run("infer-layer2", "--input", d("l2"), "--output", d("l2r"))  # the registered model
    assert read_table(spark, d("l2r")).agg({"layer2_score": "sum"}).first()[0] == pytest.approx(read_table(spark, d("l2s")).agg({"layer2_score": "sum"}).first()[0])
    run("train-layer3", "--input", d("l2"), "--output", d("markov"))
    run("infer-layer3", "--input", d("l2s"), "--output", d("l3s"))
    assert read_table(spark, d("l3s")).where("layer3_score is null").count() == 0 and read_table(spark, d("l3s")).where("client_ip not like '%.0'").count() == 0
    run("drift", "--input", d("l3s"), "--reference", d("l2s"), "--output", d("drift"))
    assert json.loads((tmp_path / "drift/drift_report.json").read_text())["features"]["layer2_score"]["psi"] == 0
    run("score", "--input", d("l3s"), "--output", d("alerts"), "--date", "2024-01-01")
    alerts = [json.loads(r.value) for r in spark.read.text(d("alerts/json")).select("value").collect()]
    assert alerts and all(len(a["reason_codes"]) == 3 and 0 <= a["final_score"] <= 1 and "client_ip" not in a for a in alerts)
    assert cli.main(["train-layer1"]) == 0


def dated(spark, rows):
    return spark.createDataFrame([(dt.datetime(2024, 1, day, 12), x) for day, x in rows], "timestamp timestamp, x long")


def test_table_replaces_itself(spark, tmp_path):
    """A table is read and replaced in one job; a job that dies leaves it as it was; plain writes go on by commits."""
    from pyspark.sql import functions as F

    from logharrow.sources.versions import DatedVersions

    path = str(tmp_path / "t")
    read = lambda: sorted((r.date.day, r.x) for r in read_table(spark, path).collect())
    write_by_date(dated(spark, [(1, 10), (1, 11), (2, 20), (3, 30)]), path)
    own = read_table(spark, path).drop("date")
    write_by_date(own.where("x < 30").withColumn("x", F.col("x") + 1), path, source=path + "/")
    assert read() == [(1, 11), (1, 12), (2, 21), (3, 30)] and DatedVersions(spark, path).commits() == [1]
    with pytest.raises(Exception, match="stop here"):
        write_by_date(read_table(spark, path).drop("date").withColumn("x", F.raise_error(F.lit("stop here")).cast("long")), path, source=path)
    assert read() == [(1, 11), (1, 12), (2, 21), (3, 30)]
    write_by_date(dated(spark, [(2, 99), (4, 40)]), path)  # not its own source, but a table with commits
    assert read() == [(1, 11), (1, 12), (2, 99), (3, 30), (4, 40)]
    assert [r.x for r in read_table(spark, path, "2024-01-02").collect()] == [99] and read_table(spark, path, "2024-05-05").count() == 0
    assert len(DatedVersions(spark, path).vacuum(keep=1)) == 1 and read() == [(1, 11), (1, 12), (2, 99), (3, 30), (4, 40)]


def test_two_writers_of_one_table(spark, tmp_path, monkeypatch):
    """A commit that another writer makes meanwhile is kept: the later one takes the next number and both writers' dates stand."""
    from logharrow.sources.versions import DatedVersions, Folder

    path, create, raced = str(tmp_path / "t"), Folder.create, []

    def late(self, below, text):
        if not raced:
            raced.append(below)
            DatedVersions(spark, path).replace(dated(spark, [(2, 2)]).withColumn("date", F.to_date("timestamp")))
        return create(self, below, text)

    from pyspark.sql import functions as F

    monkeypatch.setattr(Folder, "create", late)
    number = DatedVersions(spark, path).replace(dated(spark, [(1, 1)]).withColumn("date", F.to_date("timestamp")))
    assert raced == ["_commits/1"] and number == 2 and sorted(r.x for r in read_table(spark, path).collect()) == [1, 2]


def test_registry_numbers_are_taken_once(spark, tmp_path):
    """Writers at the same time get versions of their own; a version without metadata is no version."""
    from concurrent.futures import ThreadPoolExecutor

    from logharrow.registry import ModelRegistry

    registry = ModelRegistry(spark, str(tmp_path))
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda k: registry.log("m", spark.range(k + 1)), range(4)))
    assert sorted(got) == [1, 2, 3, 4] == registry.versions("m")
    assert sorted(registry.load("m", v).count() for v in got) == [1, 2, 3, 4]
    number = registry._claim("m")  # a writer that dies after this
    assert number == 5 and registry.versions("m") == [1, 2, 3, 4] and registry.log("m", spark.range(9)) == 6


def test_stage_totals_reach_the_metrics(spark, tmp_path, monkeypatch):
    from logharrow.config import Settings
    from logharrow.metrics import Metrics
    from logharrow.plans import stages

    metrics = Metrics()
    monkeypatch.setattr(stages, "METRICS", metrics)
    rows = [(dt.datetime(2024, 1, 1, 10, i), f"/a{i % 2}.{'aspx' if i % 3 else 'png'}", "GET", 200, 5, 10, 1, "u", "1.1.1.1") for i in range(30)]
    write_by_date(spark.createDataFrame(rows, "timestamp timestamp, uri_stem string, method string, status long, time_taken long, sc_bytes long, cs_bytes long, user_agent string, client_ip string"), str(tmp_path / "p"))
    d = lambda n: str(tmp_path / n)
    stages.filter_dynamic(spark, d("p"), d("p"), Settings())
    stages.featurize_layer1(spark, d("p"), d("w"), Settings())
    totals = stages.infer_layer1(spark, d("w"), d("w"), Settings())  # onto its own input
    assert read_table(spark, d("p")).count() == 20 and read_table(spark, d("w")).count() == totals["windows"] and "layer1_score" in read_table(spark, d("w")).columns
    text = metrics.text()
    for line in ('requests_filtered_total{filter_result="dynamic"} 20', 'requests_filtered_total{filter_result="static"} 10', f'stage_rows_total{{stage="infer-layer1"}} {totals["windows"]}', f"hot_windows_current {totals['hot_windows']}", "# TYPE hot_windows_current gauge"):
        assert line in text


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    """Read back by another name, joined on the buckets' keys: no exchange in the plan; nulls, replaced tables and names with quotes."""
    from pyspark.sql import functions as F

    from logharrow.operators.requests import join_window_scores
    from logharrow.sources.buckets import read_bucketed, write_bucketed

    t0 = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(k, f"s{k % 5}" if k % 7 else None, t0 + dt.timedelta(hours=k % 3)) for k in range(60)], "k int, segment_id string, window_start timestamp")
    windows = spark.createDataFrame([(f"s{i}", t0 + dt.timedelta(hours=h), 0.1 * i + h, h == 2, "/a") for i in range(4) for h in range(3)], "segment_id string, window_start timestamp, layer1_score double, window_is_hot boolean, `odd name` string")
    left, right = str(tmp_path / "it's left"), str(tmp_path / "right")
    keys = ["segment_id", "window_start"]
    write_bucketed(rows.limit(3), left, keys, 4)
    write_bucketed(rows, left, keys, 4)
    write_bucketed(windows, right, keys, 4)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = join_window_scores(read_bucketed(spark, left), read_bucketed(spark, right), start="window_start")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = join_window_scores(rows, windows, start="window_start")
        key = lambda df: sorted((r.k, r.layer1_score, r.window_is_hot) for r in df.collect())
        assert key(got) == key(want) and got.count() == 60 and got.where(F.col("layer1_score") > 0).count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_workspace_is_cleared(spark):
    """Only what was written since a mark goes, and what is older can still be read."""
    from logharrow.sources import workspace

    kept = workspace.materialise(spark.range(3), "kept")
    before = workspace.mark()
    gone = workspace.materialise(spark.range(5), "gone")
    assert gone.count() == 5 and workspace.clear(spark, before) == 1 and kept.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(gone.inputFiles()[0]).count()
