"""Command line: python -m logharrow.cli VERB ..."""

from __future__ import annotations

import argparse
import sys

from logharrow.config import load_settings
from logharrow.logs import configure
from logharrow.plans import stages
from logharrow.session import get_session
from logharrow.sources import workspace


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="logharrow")
    parser.add_argument("--config")
    parser.add_argument("--master")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for name in ("parse", "filter-dynamic", "featurize-layer1", "infer-layer1", "featurize-layer2", "train-layer2", "infer-layer2", "train-layer3", "infer-layer3", "score", "drift"):
        verb = verbs.add_parser(name)
        verb.add_argument("--input", required=True)
        verb.add_argument("--output", required=True)
        if name == "featurize-layer2":
            verb.add_argument("--windows")
            verb.add_argument("--novelty", action="store_true", help="flags of new agents and addresses instead of 0")
        if name in ("train-layer2", "infer-layer2"):
            verb.add_argument("--mode", choices=["iforest", "ae_latent_if"])
        if name in ("infer-layer2", "infer-layer3"):
            verb.add_argument("--model", help="path; by default the latest registered model")
        if name == "score":
            verb.add_argument("--date", required=True)
        if name == "drift":
            verb.add_argument("--reference", required=True)
    verbs.add_parser("train-layer1")
    serve = verbs.add_parser("serve", help="GET /health, POST /score and GET /metrics over HTTP")
    serve.add_argument("--model", help="path; by default the latest registered model")
    serve.add_argument("--host")
    serve.add_argument("--port", type=int)
    return parser


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    cfg = load_settings(args.config)
    configure(cfg.general.log_level, cfg.general.log_format)
    if args.verb == "train-layer1":
        print("The window baseline has no fitted model; run infer-layer1.")
        return 0
    spark, before = get_session(args.master, f"{cfg.general.project_name}-{cfg.general.env}"), workspace.mark()
    if args.verb == "serve":
        from logharrow.service import Scorer, serve

        scorer = Scorer(spark, stages.model_table(spark, cfg, "layer2-iforest", args.model), cfg)
        serve(scorer, args.host or cfg.api.host, cfg.api.port if args.port is None else args.port)
        return 0
    calls = {
        "parse": lambda: stages.parse(spark, args.input, args.output, cfg),
        "filter-dynamic": lambda: stages.filter_dynamic(spark, args.input, args.output, cfg),
        "featurize-layer1": lambda: stages.featurize_layer1(spark, args.input, args.output, cfg),
        "infer-layer1": lambda: stages.infer_layer1(spark, args.input, args.output, cfg),
        "featurize-layer2": lambda: stages.featurize_layer2(spark, args.input, args.output, cfg, args.windows, args.novelty),
        "train-layer2": lambda: stages.train_layer2(spark, args.input, args.output, cfg, args.mode),
        "infer-layer2": lambda: stages.infer_layer2(spark, args.input, args.model, args.output, cfg, args.mode),
        "train-layer3": lambda: stages.train_layer3(spark, args.input, args.output, cfg),
        "infer-layer3": lambda: stages.infer_layer3(spark, args.input, args.model, args.output, cfg),
        "drift": lambda: stages.drift(spark, args.reference, args.input, args.output, cfg),
        "score": lambda: stages.score(spark, args.input, args.output, cfg, args.date),
    }
    try:
        calls[args.verb]()
    finally:
        workspace.clear(spark, before)  # what the verb's plans read has been written
    return 0


if __name__ == "__main__":
    sys.exit(main())
