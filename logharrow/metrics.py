"""Counters, gauges and histograms in the Prometheus text format: of a scorer, and of the stages that ran in this driver."""

from __future__ import annotations

import threading
from collections import Counter

LATENCY_BOUNDS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0)
SCORE_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def _name(name: str, labels: dict[str, str]) -> str:
    escaped = {k: str(v).replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n") for k, v in labels.items()}
    return name + ("{" + ",".join(f'{k}="{v}"' for k, v in escaped.items()) + "}" if labels else "")


class Metrics:
    """Values by name and labels. Histograms are kept as their cumulative buckets, sum and count."""

    def __init__(self) -> None:
        self.lock, self.kinds, self.values = threading.Lock(), {}, Counter()

    def count(self, name: str, n: float = 1, /, **labels: str) -> None:
        with self.lock:
            self.kinds.setdefault(name, "counter")
            self.values[_name(name, labels)] += n

    def gauge(self, name: str, value: float, /, **labels: str) -> None:
        with self.lock:
            self.kinds.setdefault(name, "gauge")
            self.values[_name(name, labels)] = value

    def histogram(self, name: str, bounds: tuple[float, ...], seen: list[float], **labels: str) -> None:
        """Add single values."""
        self.buckets(name, {b: sum(x <= b for x in seen) for b in bounds}, len(seen), sum(seen), **labels)

    def buckets(self, name: str, upto: dict[float, int], n: int, total: float, **labels: str) -> None:
        """Add counts of values up to each bound, taken elsewhere."""
        with self.lock:
            self.kinds.setdefault(name, "histogram")
            for bound, m in [*upto.items(), ("+Inf", n)]:
                self.values[_name(f"{name}_bucket", {**labels, "le": bound})] += m
            self.values[_name(f"{name}_sum", labels)] += total
            self.values[_name(f"{name}_count", labels)] += n

    def observe(self, seconds: float) -> None:
        self.histogram("inference_latency_seconds", LATENCY_BOUNDS, [seconds], layer="api")

    def stage(self, stage: str, totals: dict[str, int]) -> None:
        """A stage's run totals, each under its name and, where one is known by another name, under that as well."""
        for name, n in totals.items():
            self.count(f"stage_{name}_total", n, stage=stage)
        known = {
            ("parse", "rows"): ("logs_parsed_total", {"source": "files"}), ("filter-dynamic", "rows"): ("requests_filtered_total", {"filter_result": "dynamic"}),
            ("filter-dynamic", "static"): ("requests_filtered_total", {"filter_result": "static"}), ("score", "alerts_critical"): ("alerts_generated_total", {"severity": "critical"}),
            ("score", "alerts_other"): ("alerts_generated_total", {"severity": "other"}),
        }
        for (of, name), (metric, labels) in known.items():
            if of == stage and name in totals:
                self.count(metric, totals[name], **labels)
        if "hot_windows" in totals:
            self.gauge("hot_windows_current", totals["hot_windows"])

    def text(self) -> str:
        with self.lock:
            lines = []
            for name, kind in sorted(self.kinds.items()):
                lines.append(f"# TYPE {name} {kind}")
                own = [k for k in self.values if k.split("{")[0] in ((f"{name}_bucket", f"{name}_sum", f"{name}_count") if kind == "histogram" else (name,))]
                lines += [f"{k} {self.values[k]}" for k in (own if kind == "histogram" else sorted(own))]
            return "\n".join(lines) + "\n"


#: Of the stages of this process.
METRICS = Metrics()
