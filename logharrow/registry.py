"""Versioned model tables: <root>/<name>/version=N/ with a Parquet table and metadata beside it."""

from __future__ import annotations

import json
import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from logharrow.sources.versions import Folder


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def of(cls, spark: SparkSession, settings) -> "ModelRegistry":
        """The registry that the settings name."""
        return cls(spark, settings.registry_root)

    def versions(self, name: str) -> list[int]:
        """Complete versions, ascending: those whose metadata was written last."""
        folder = Folder(self.spark, f"{self.root}/{name}")
        found = [int(n.split("=")[1]) for n in folder.names() if n.startswith("version=")]
        return sorted(n for n in found if folder.exists(f"version={n}/metadata/_SUCCESS"))

    def _claim(self, name: str) -> int:
        """The next number, taken by a file that only one writer can create."""
        folder = Folder(self.spark, f"{self.root}/{name}")
        taken = [int(n) for n in folder.names("_numbers") if n.isdigit()]
        version = max([*self.versions(name), *taken], default=0) + 1
        while not folder.create(f"_numbers/{version}", str(time.time())):
            version += 1
        return version

    def log(self, name: str, table: DataFrame, params: dict[str, Any] | None = None, metrics: dict[str, float] | None = None) -> int:
        """Write a new version; returns its number, which no other writer gets."""
        version = self._claim(name)
        base = f"{self.root}/{name}/version={version}"
        table.write.parquet(f"{base}/table")
        meta = json.dumps({"name": name, "version": version, "created": time.time(), "params": params or {}, "metrics": metrics or {}})
        self.spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{base}/metadata")
        return version

    def metadata(self, name: str, version: int | None = None) -> dict[str, Any] | None:
        version = version or max(self.versions(name), default=None)
        if version is None:
            return None
        return json.loads(self.spark.read.text(f"{self.root}/{name}/version={version}/metadata").first()[0])

    def load(self, name: str, version: int | None = None) -> DataFrame | None:
        """A version's table, the latest by default; None if there is none."""
        version = version or max(self.versions(name), default=None)
        return None if version is None else self.spark.read.parquet(f"{self.root}/{name}/version={version}/table")
