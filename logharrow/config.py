"""Settings: dataclasses with defaults, overlaid by YAML files, an environment variable's file and overrides.

The names of sections and settings and their defaults are the settings contract: fixed values.
"""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

CONFIG_VARIABLE = "LOGHARROW_CONFIG"
DEFAULT_FILE = "configs/default.yaml"


@dataclass
class General:
    project_name: str = "logharrow"
    env: str = "dev"
    log_level: str = "INFO"
    log_format: str = "json"
    data_root: str = "./data"
    model_root: str = "./models"


@dataclass
class Ingest:
    datetime_format: str = "%Y-%m-%d %H:%M:%S"
    chunk_size: int = 100_000
    compression: str = "snappy"


@dataclass
class Filter:
    dynamic_extensions: list[str] = field(default_factory=lambda: ["aspx", "ashx"])
    optional_extensions: list[str] = field(default_factory=lambda: ["asmx", "svc"])
    enable_optional: bool = False

    @property
    def allowed(self) -> list[str]:
        return sorted({*self.dynamic_extensions, *(self.optional_extensions if self.enable_optional else ())})


@dataclass
class Segmentation:
    enable_host: bool = False
    enable_bot_flag: bool = True
    min_segment_count: int = 5000


@dataclass
class Url:
    lowercase: bool = True
    strip_trailing_slash: bool = True
    numeric_template: bool = True
    aggressive_template: bool = False


@dataclass
class UserAgent:
    bot_patterns: list[str] = field(default_factory=lambda: ["bot", "crawler", "spider", "slurp", "wget", "curl", "python-requests", "httpx", "scrapy"])
    novelty_window_days: int = 7


@dataclass
class Hashing:
    path_hash_dim: int = 256
    query_hash_dim: int = 128


@dataclass
class Layer1:
    window_size_minutes: int = 5
    step_minutes: int = 1
    rolling_hours: int = 3
    hot_threshold: float = 0.8
    use_ewma: bool = False
    ewma_alpha: float = 0.3

    @property
    def rolling_rows(self) -> int:
        return self.rolling_hours * 60 // self.window_size_minutes


@dataclass
class IsolationForest:
    n_estimators: int = 200
    max_samples: int | str = "auto"
    contamination: float = 0.01
    random_state: int = 42


@dataclass
class Autoencoder:
    latent_dim: int = 32
    hidden_dims: list[int] = field(default_factory=lambda: [128, 64])
    dropout: float = 0.2
    noise_factor: float = 0.1
    learning_rate: float = 0.001
    epochs: int = 50
    batch_size: int = 512


@dataclass
class Layer2:
    mode: str = "iforest"
    iforest: IsolationForest = field(default_factory=IsolationForest)
    autoencoder: Autoencoder = field(default_factory=Autoencoder)


@dataclass
class Layer3:
    enabled: bool = False
    session_timeout_minutes: int = 30
    critical_endpoints: list[str] = field(default_factory=list)


@dataclass
class Weights:
    layer1: float = 0.3
    layer2: float = 0.5
    layer3: float = 0.2


@dataclass
class Scoring:
    weights: Weights = field(default_factory=Weights)
    segment_quantile: float = 0.995
    use_evt: bool = False
    topk_daily: int = 200
    topk_critical: int = 50


@dataclass
class Privacy:
    anonymize_ip: bool = True
    hash_cookie: bool = True
    redact_query_values: bool = True


@dataclass
class Drift:
    psi_threshold: float = 0.2
    jsd_threshold: float = 0.1
    score_shift_threshold: float = 0.15
    retrain_schedule: str = "weekly"


@dataclass
class Mlflow:
    """Where models are registered: a folder in tracking_uri, or general.model_root if that is no folder's path."""

    tracking_uri: str = ""
    experiment_name: str = "logharrow"
    registry_name: str = "logharrow-models"


@dataclass
class Api:
    host: str = "0.0.0.0"
    port: int = 8000
    workers: int = 2


@dataclass
class Settings:
    general: General = field(default_factory=General)
    ingest: Ingest = field(default_factory=Ingest)
    filter: Filter = field(default_factory=Filter)
    segmentation: Segmentation = field(default_factory=Segmentation)
    url: Url = field(default_factory=Url)
    ua: UserAgent = field(default_factory=UserAgent)
    hashing: Hashing = field(default_factory=Hashing)
    layer1: Layer1 = field(default_factory=Layer1)
    layer2: Layer2 = field(default_factory=Layer2)
    layer3: Layer3 = field(default_factory=Layer3)
    scoring: Scoring = field(default_factory=Scoring)
    critical_endpoints: list[str] = field(default_factory=list)
    privacy: Privacy = field(default_factory=Privacy)
    drift: Drift = field(default_factory=Drift)
    mlflow: Mlflow = field(default_factory=Mlflow)
    api: Api = field(default_factory=Api)

    @property
    def registry_root(self) -> str:
        uri = self.mlflow.tracking_uri
        return f"{self.general.model_root}/registry" if not uri or uri.startswith(("http://", "https://")) else uri


def _overlay(target: Any, values: dict[str, Any], where: str = "") -> None:
    for key, value in values.items():
        if not hasattr(target, key):
            raise KeyError(f"unknown setting {where}{key}")
        current = getattr(target, key)
        if dataclasses.is_dataclass(current):
            _overlay(current, value or {}, f"{where}{key}.")
        else:
            setattr(target, key, value)


def load_settings(path: str | None = None, overrides: dict[str, Any] | None = None) -> Settings:
    """Defaults, then configs/default.yaml, the given file, the file named by LOGHARROW_CONFIG, and overrides."""
    import yaml

    settings = Settings()
    for file in (DEFAULT_FILE, path, os.environ.get(CONFIG_VARIABLE)):
        if file and Path(file).exists():
            _overlay(settings, yaml.safe_load(Path(file).read_text()) or {})
    _overlay(settings, overrides or {})
    return settings
