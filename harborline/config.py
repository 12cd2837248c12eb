"""Layered configuration: YAML files merged, environment variables put in, plain dataclasses out."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

_VARIABLE = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def merge(base: Mapping, over: Mapping) -> dict:
    """base with over's values; mappings are merged in depth, all else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def substitute(value: Any, env: Mapping[str, str] = os.environ) -> Any:
    """${NAME} and ${NAME:-default} put in everywhere in texts; an unset name without default gives ''."""
    if isinstance(value, str):
        return _VARIABLE.sub(lambda m: env.get(m[1]) or (m[2] or ""), value)
    if isinstance(value, Mapping):
        return {k: substitute(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [substitute(v, env) for v in value]
    return value


@dataclass
class Streaming:
    window_duration_seconds: int = 300
    allowed_lateness_seconds: int = 86_400
    dedupe_window_hours: int = 24
    early_trigger_seconds: int = 60
    enable_pii_masking: bool = True


@dataclass
class Quality:
    min_daily_events: int = 100
    max_null_rate: float = 0.05
    max_duplicate_rate: float = 0.01


@dataclass
class Config:
    environment: str = "dev"
    log_level: str = "INFO"
    streaming: Streaming = field(default_factory=Streaming)
    quality: Quality = field(default_factory=Quality)
    rest: dict = field(default_factory=dict)


def _known(cls, values: Mapping):
    return cls(**{f.name: values[f.name] for f in fields(cls) if f.name in values})


def load(folder: str | Path, environment: str = "dev", env: Mapping[str, str] = os.environ) -> Config:
    """base.yaml under `environment`.yaml; missing files count as empty, unknown keys are kept in `rest`."""
    import yaml

    values: dict = {}
    for name in ("base", environment):
        path = Path(folder) / f"{name}.yaml"
        if path.exists():
            values = merge(values, yaml.safe_load(path.read_text()) or {})
    values = substitute(values, {**env, "ENVIRONMENT": env.get("ENVIRONMENT", environment)})
    known = {"environment", "log_level", "streaming", "quality"}
    return Config(
        values.get("environment", environment), values.get("log_level", "INFO"), _known(Streaming, values.get("streaming", {})),
        _known(Quality, values.get("quality", {})), {k: v for k, v in values.items() if k not in known},
    )
