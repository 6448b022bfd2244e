"""Log records of this package as JSON lines or as plain text."""

from __future__ import annotations

import json
import logging
import sys

FIELDS = set(vars(logging.makeLogRecord({})))


class JsonFormatter(logging.Formatter):
    """One JSON object a record; what is passed by `extra` becomes further keys."""

    def format(self, record: logging.LogRecord) -> str:
        out = {"timestamp": self.formatTime(record, "%Y-%m-%dT%H:%M:%S"), "level": record.levelname.lower(), "logger": record.name, "event": record.getMessage()}
        out |= {k: v for k, v in vars(record).items() if k not in FIELDS and k != "message"}
        if record.exc_info:
            out["exception"] = self.formatException(record.exc_info)
        return json.dumps(out, default=str)


class TextFormatter(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        extra = " ".join(f"{k}={v}" for k, v in vars(record).items() if k not in FIELDS and k != "message")
        return f"{self.formatTime(record)} {record.levelname} {record.name}: {record.getMessage()} {extra}".rstrip()


def configure(level: str = "INFO", kind: str = "json", stream=None) -> logging.Logger:
    """Send the package's records to a stream (standard error); a repeated call replaces the settings."""
    logger = logging.getLogger("logharrow")
    logger.handlers.clear()
    handler = logging.StreamHandler(stream or sys.stderr)
    handler.setFormatter(JsonFormatter() if kind == "json" else TextFormatter())
    logger.addHandler(handler)
    logger.setLevel(level.upper())
    logger.propagate = False
    return logger
