"""Spark-native analytics over web-server request logs."""

__version__ = "0.1.0"
