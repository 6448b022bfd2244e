"""The pipeline's stages over date-partitioned tables; each is one lazy plan from read to write."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logharrow.config import Settings
from logharrow.functions.segments import parent_segment_id
from logharrow.metrics import METRICS, SCORE_BOUNDS
from logharrow.operators import autoencoder, iforest
from logharrow.operators.drift import drift_report, save_report
from logharrow.operators.requests import anonymise, dynamic_only, enrich, feature_vector, is_critical, join_window_scores, layer2_features, layer2_gate, salted_join
from logharrow.operators.scoring import add_reason_codes, alert_payloads, apply_thresholds, combine_scores, evt_thresholds, segment_thresholds, select_alerts
from logharrow.operators.sessions import critical_sessions, markov_fit, markov_score, save_markov, sessionize, transitions
from logharrow.operators.windows import layer1_features, score_windows
from logharrow.registry import ModelRegistry
from logharrow.sources.tables import read_table, write_alerts, write_by_date
from logharrow.sources.w3c import read_w3c

LOG = logging.getLogger("logharrow.stages")
#: Columns that a drift report looks at, where both tables have them.
NUMERIC_DRIFT = ["time_taken", "sc_bytes", "cs_bytes", "layer1_score", "layer2_score", "query_special_char_ratio", "query_decoded_len", "ip_rps_last_5m"]
CATEGORICAL_DRIFT = ["endpoint_group", "method", "status_class", "ua_browser_family"]


def _privacy(df: DataFrame, cfg: Settings) -> DataFrame:
    return anonymise(df, cfg.privacy.anonymize_ip, cfg.privacy.hash_cookie, cfg.privacy.redact_query_values)


def parse(spark: SparkSession, source: str, out: str, cfg: Settings) -> None:
    rows = read_w3c(spark, source, cfg.ingest.datetime_format)
    _store("parse", rows, out, None, compression=cfg.ingest.compression, rows_per_file=cfg.ingest.chunk_size)


def filter_dynamic(spark: SparkSession, source: str, out: str, cfg: Settings) -> None:
    seen = Observation("filter-input")
    rows = read_table(spark, source).drop("date").observe(seen, F.count(F.lit(1)).alias("rows"))
    kept = _store("filter-dynamic", dynamic_only(rows, cfg.filter), out, source, compression=cfg.ingest.compression)
    METRICS.stage("filter-dynamic", {"static": seen.get["rows"] - kept["rows"]})


def featurize_layer1(spark: SparkSession, source: str, out: str, cfg: Settings) -> None:
    enriched = enrich(read_table(spark, source).drop("date"), cfg.url, cfg.segmentation, cfg.ua)
    _store("featurize-layer1", layer1_features(enriched, cfg.layer1), out, source, "window_start")


def infer_layer1(spark: SparkSession, source: str, out: str, cfg: Settings) -> dict[str, int]:
    """Scores of windows; out may be the source itself. Returns run totals."""
    scored = score_windows(read_table(spark, source).drop("date"), cfg.layer1)
    totals = _store("infer-layer1", scored, out, source, "window_start", hot_windows=F.count_if("window_is_hot"))
    return {"windows": totals["rows"], "hot_windows": totals["hot_windows"]}


def _store(stage: str, df: DataFrame, out: str, source: str | None, ts_col: str = "timestamp", compression: str = "snappy", rows_per_file: int = 0, **more: Column) -> dict[str, int]:
    """Write a stage's rows by date. Its totals are counted while they are written, and go to the log and the metrics."""
    totals = Observation(stage)
    counts = {"rows": F.count(F.lit(1)), "rows_without_time": F.count_if(F.col(ts_col).isNull()), **more}
    write_by_date(df.observe(totals, *[c.alias(n) for n, c in counts.items()]), out, ts_col, compression, rows_per_file, source)
    return _log(stage, dict(totals.get))


def _log(stage: str, found: dict[str, int]) -> dict[str, int]:
    LOG.info("stage done", extra={"stage": stage, **found})
    METRICS.stage(stage, found)
    return found


def featurize_layer2(spark: SparkSession, source: str, out: str, cfg: Settings, windows: str | None = None, novelty: bool = False) -> None:
    """Features, with the parents' segment ids beside the segments'. Addresses and query values are masked after they were used."""
    rows = enrich(read_table(spark, source).drop("date"), cfg.url, cfg.segmentation, cfg.ua)
    rows = rows.withColumn("parent_id", parent_segment_id(F.col("endpoint_group"), F.col("method")))
    if windows:
        scores = read_table(spark, windows).drop("date")
        rows = layer2_gate(join_window_scores(rows, scores, cfg.layer1.window_size_minutes), cfg.critical_endpoints)
    features = layer2_features(rows, cfg.hashing, cfg.ua.novelty_window_days if novelty else None)
    if cfg.layer3.enabled:  # the session's key is taken before cookies and addresses are masked
        features = sessionize(features, cfg.layer3.session_timeout_minutes)
    _store("featurize-layer2", _privacy(features, cfg), out, source)


def _with_vector(df: DataFrame) -> DataFrame:
    return df.withColumn("features", feature_vector(df))


def _parent(df: DataFrame) -> str | None:
    return "parent_id" if "parent_id" in df.columns else None


def train_layer2(spark: SparkSession, source: str, out: str, cfg: Settings, mode: str | None = None) -> None:
    """Fit on a feature table, write the model to out and register it under the settings' name."""
    rows, mode = _with_vector(read_table(spark, source)), mode or cfg.layer2.mode
    if mode == "iforest":
        iforest.fit(rows, parent=_parent(rows), config=cfg.layer2.iforest, min_rows=cfg.segmentation.min_segment_count).write.mode("overwrite").parquet(out)
    else:
        autoencoder.fit(rows, config=cfg.layer2.autoencoder, forest=cfg.layer2.iforest).save(spark, out)
    _register(spark, cfg, f"layer2-{mode}", out)


def _register(spark: SparkSession, cfg: Settings, kind: str, path: str) -> int:
    version = ModelRegistry.of(spark, cfg).log(f"{cfg.mlflow.registry_name}-{kind}", spark.read.parquet(path), {"experiment": cfg.mlflow.experiment_name, "kind": kind})
    LOG.info("model registered", extra={"kind": kind, "version": version})
    METRICS.gauge("model_info", 1, name=f"{cfg.mlflow.registry_name}-{kind}", version=str(version))
    return version


def model_table(spark: SparkSession, cfg: Settings, kind: str, path: str | None = None) -> DataFrame | None:
    """A model by its path, or the latest of its kind in the registry."""
    return spark.read.parquet(path) if path else ModelRegistry.of(spark, cfg).load(f"{cfg.mlflow.registry_name}-{kind}")


def infer_layer2(spark: SparkSession, source: str, model: str | None, out: str, cfg: Settings, mode: str | None = None) -> None:
    rows, mode = _with_vector(read_table(spark, source).drop("date")), mode or cfg.layer2.mode
    table = model_table(spark, cfg, f"layer2-{mode}", model)
    if table is None:
        raise ValueError(f"no model of kind layer2-{mode} is registered and no path is given")
    if mode == "iforest":
        scored = iforest.predict(rows, table, parent=_parent(rows))
    else:
        scored = autoencoder.predict(rows, autoencoder.LatentForest.from_table(table))
    _store("infer-layer2", scored.drop("features"), out, source)


def layer3(df: DataFrame, cfg: Settings, model: DataFrame | None = None) -> DataFrame:
    """All rows with session_id, session_seq and layer3_score; without the layer's setting the rows as they are.

    Sessions that touch no critical endpoint (if there is a list of them) have a null score, which counts as 0 in the fusion.
    The model is fitted on the scored sessions if none is given.
    """
    if not cfg.layer3.enabled:
        return df
    rows = df if {"session_id", "session_seq"} <= set(df.columns) else sessionize(df.drop("session_id", "session_seq"), cfg.layer3.session_timeout_minutes)
    looked_at = critical_sessions(rows, cfg.layer3.critical_endpoints)
    scores = markov_score(looked_at, markov_fit(transitions(looked_at)) if model is None else model)
    counted = scores.join(looked_at.groupBy("session_id").agg(F.count("*").alias("_n")), "session_id")
    return salted_join(rows.drop("layer3_score"), counted, ["session_id"], "_n").drop("_n")


def train_layer3(spark: SparkSession, source: str, out: str, cfg: Settings) -> None:
    rows = read_table(spark, source)
    rows = rows if "session_seq" in rows.columns else sessionize(rows, cfg.layer3.session_timeout_minutes)
    save_markov(markov_fit(transitions(critical_sessions(rows, cfg.layer3.critical_endpoints))), out)
    _register(spark, cfg, "layer3-markov", out)


def infer_layer3(spark: SparkSession, source: str, model: str | None, out: str, cfg: Settings) -> None:
    """Scores by a stored model, by the latest registered one, or by one of the rows themselves."""
    _store("infer-layer3", layer3(read_table(spark, source).drop("date"), cfg, model_table(spark, cfg, "layer3-markov", model)), out, source)


def score_day(df: DataFrame, cfg: Settings) -> DataFrame:
    """Fusion, thresholds of the scored rows themselves, reason codes."""
    fused = combine_scores(df, cfg.scoring.weights)
    limits = evt_thresholds(fused) if cfg.scoring.use_evt else segment_thresholds(fused, cfg.scoring.segment_quantile)
    return add_reason_codes(apply_thresholds(fused, limits))


def score(spark: SparkSession, source: str, out: str, cfg: Settings, date: str) -> bool:
    """Alerts of a date; the rows get layer 3 scores on the way if that layer is on and they have none."""
    rows = read_table(spark, source, date).drop("date")
    if cfg.layer3.enabled and "layer3_score" not in rows.columns:
        rows = layer3(rows, cfg, model_table(spark, cfg, "layer3-markov"))
    totals, alerts_seen = Observation("score"), Observation("alerts")
    upto = {b: F.count_if(F.col("final_score") <= b) for b in SCORE_BOUNDS}
    counts = {"requests": F.count(F.lit(1)), "anomalies": F.count_if("is_anomaly"), "score_sum": F.coalesce(F.sum("final_score"), F.lit(0.0)), **{f"upto_{b}": c for b, c in upto.items()}}
    scored = score_day(rows, cfg).observe(totals, *[c.alias(n) for n, c in counts.items()])
    critical = is_critical(F.col("endpoint_group"), cfg.critical_endpoints or [])
    alerts = _privacy(select_alerts(scored, cfg.scoring, cfg.critical_endpoints), cfg).observe(alerts_seen, F.count_if(critical).alias("alerts_critical"), F.count_if(~critical).alias("alerts_other"))
    made = write_alerts(alerts, alert_payloads, out, date)
    found = dict(totals.get)
    METRICS.buckets("score_distribution", {b: found.pop(f"upto_{b}") for b in upto}, found["requests"], found.pop("score_sum"))
    _log("score", found | dict(alerts_seen.get))
    return made


def drift(spark: SparkSession, reference: str, current: str, out: str, cfg: Settings) -> dict:
    """Report of two scored tables as JSON and Markdown."""
    report = drift_report(read_table(spark, reference), read_table(spark, current), NUMERIC_DRIFT, CATEGORICAL_DRIFT, config=cfg.drift)
    save_report(report, out, spark)
    for name, found in report["features"].items():
        if "psi" in found:
            METRICS.gauge("drift_psi", found["psi"], feature=name)
    LOG.info("drift report", extra={"alerts": len(report["alerts"]), "needs_retrain": report["needs_retrain"], "schedule": cfg.drift.retrain_schedule})
    return report
