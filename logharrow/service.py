"""Scoring of request batches, health and metrics, as calls and over HTTP (standard library only)."""

from __future__ import annotations

import json
import logging
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logharrow import __version__
from logharrow.config import Settings
from logharrow.functions.segments import parent_segment_id
from logharrow.metrics import METRICS, Metrics
from logharrow.operators import iforest
from logharrow.operators.requests import enrich, feature_vector, layer2_features

SCORE_SCHEMA = "uri_stem string, method string, status long, substatus long, win32_status long, time_taken long, sc_bytes long, cs_bytes long, client_ip string, user_agent string, uri_query string, host string, referer string, timestamp string"
DEFAULTS: dict[str, Any] = {"method": "GET", "status": 200, "substatus": 0, "win32_status": 0, "time_taken": 0, "sc_bytes": 0, "cs_bytes": 0, "client_ip": "0.0.0.0", "user_agent": ""}


def score_batch(df: DataFrame, trees: DataFrame | None = None, cfg: Settings | None = None, forests: dict | None = None) -> DataFrame:
    """Enriched requests with scores: layer 2 by the forests if given, else 0; the final score is layer 2's alone.

    Layers 1 and 3 need history and are 0; a request is anomalous above 0.5; reason codes are empty. Works on a batch
    and inside foreachBatch alike. forests: iforest.packed(trees), for callers that score many batches.
    """
    cfg = cfg or Settings()
    rows = df.na.fill({k: v for k, v in DEFAULTS.items() if k in df.columns}).withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
    rows = enrich(rows, cfg.url, cfg.segmentation, cfg.ua)
    rows = rows.withColumn("parent_id", parent_segment_id(F.col("endpoint_group"), F.col("method")))
    if trees is None:
        scored = rows.withColumn("layer2_score", F.lit(0.0))
    else:
        with_features = layer2_features(rows, cfg.hashing)
        scored = iforest.predict(with_features.withColumn("features", feature_vector(with_features)), trees, parent="parent_id", forests=forests)
    return scored.withColumns({"layer1_score": F.lit(0.0), "layer3_score": F.lit(0.0), "final_score": F.col("layer2_score"), "is_anomaly": F.col("layer2_score") > 0.5, "reason_codes": F.array().cast("array<string>")})


RESULT = ["endpoint_group", "segment_id", "layer1_score", "layer2_score", "layer3_score", "final_score", "is_anomaly", "reason_codes"]


class Scorer:
    """The service's three calls."""

    def __init__(self, spark: SparkSession, trees: DataFrame | None = None, cfg: Settings | None = None):
        self.spark, self.trees, self.cfg, self.metrics = spark, trees, cfg or Settings(), Metrics()
        self.forests = iforest.packed(trees) if trees is not None else None  # once, not for each request

    def health(self) -> dict[str, Any]:
        return {"status": "ok", "version": __version__, "models_loaded": self.trees is not None}

    def score(self, records: list[dict[str, Any]]) -> dict[str, Any]:
        """Records need a uri_stem; results come in the records' order."""
        if not records:
            return {"results": [], "total": 0, "anomalies": 0}
        began, names = time.time(), [f.split()[0] for f in SCORE_SCHEMA.split(", ")]
        rows = [(i, *(r.get(n, DEFAULTS.get(n)) for n in names)) for i, r in enumerate(records)]
        df = self.spark.createDataFrame(rows, "record long, " + SCORE_SCHEMA)
        results = [r.asDict() for r in score_batch(df, self.trees, self.cfg, self.forests).orderBy("record").select(*RESULT).collect()]
        anomalies = sum(r["is_anomaly"] for r in results)
        self.metrics.observe(time.time() - began)
        self.metrics.count("alerts_generated_total", anomalies)
        self.metrics.count("requests_scored_total", len(results))
        return {"results": results, "total": len(results), "anomalies": anomalies}


def http_server(scorer: Scorer, host: str, port: int) -> ThreadingHTTPServer:
    """GET /health, POST /score (a list of records, or {"records": [...]}) and GET /metrics."""

    class Handler(BaseHTTPRequestHandler):
        def _send(self, status: int, body: str, kind: str = "application/json") -> None:
            data = body.encode()
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self) -> None:
            if self.path == "/health":
                self._send(200, json.dumps(scorer.health()))
            elif self.path == "/metrics":
                self._send(200, scorer.metrics.text() + METRICS.text(), "text/plain; version=0.0.4")
            else:
                self._send(404, json.dumps({"detail": "not found"}))

        def do_POST(self) -> None:
            if self.path != "/score":
                return self._send(404, json.dumps({"detail": "not found"}))
            try:
                body = json.loads(self.rfile.read(int(self.headers.get("Content-Length") or 0)))
                records = body["records"] if isinstance(body, dict) else body
                if not isinstance(records, list) or not all(isinstance(r, dict) and isinstance(r.get("uri_stem"), str) for r in records):
                    raise ValueError("a list of records with a uri_stem is expected")
            except (ValueError, KeyError) as error:
                return self._send(422, json.dumps({"detail": str(error)}))
            self._send(200, json.dumps(scorer.score(records)))

        def log_message(self, text: str, *args: Any) -> None:
            logging.getLogger("logharrow.service").info(text % args)

    return ThreadingHTTPServer((host, port), Handler)


def serve(scorer: Scorer, host: str, port: int) -> None:
    with http_server(scorer, host, port) as server:
        server.serve_forever()
