"""Settings from defaults, a YAML file, the environment and arguments, each over the one before. Nothing is cached."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class PrepareSettings:
    """How conversations are built, cleaned, split and deduplicated."""

    train_ratio: float = 0.9
    shuffle_seed: int = 42
    system_prompt: str = ""
    agent_names: tuple[str, ...] = ()
    clean_attachments: bool = True
    clean_urls: bool = True
    redact_pii: bool = True
    pii_safe_patterns: tuple[str, ...] = ()
    clean_fillers: bool = True
    drop_filler_only: bool = True
    min_message_length: int = 10
    dedupe_exact: bool = True
    max_duplicate_count: int = 3
    dedupe_sentences: bool = True
    filter_sentences: tuple[str, ...] = ()
    dedupe_canned: bool = True
    python_shuffle: bool = False


@dataclass(frozen=True)
class ExportSettings:
    """Where tickets come from and how they are fetched."""

    base_url: str | None = None
    user: str | None = None
    token: str | None = None
    channel: str = "any"
    start: str | None = None
    end: str | None = None
    page_size: int = 100
    most_rows: int = 1000
    retries: int = 5
    backoff: float = 2.0


@dataclass(frozen=True)
class Settings:
    prepare: PrepareSettings = field(default_factory=PrepareSettings)
    export: ExportSettings = field(default_factory=ExportSettings)
    raw: Mapping[str, Any] = field(default_factory=dict)


def _typed(kind: type, values: Mapping[str, Any]) -> dict[str, Any]:
    """Known, given values as the dataclass has them; a string from the environment is read as its default's type."""
    out = {}
    for f in fields(kind):
        value = values.get(f.name)
        if value is None:
            continue
        default = f.default
        if isinstance(value, str) and isinstance(default, bool):
            value = value.strip().lower() in ("1", "true", "yes", "on")
        elif isinstance(value, str) and isinstance(default, (int, float)):
            value = type(default)(value)
        elif isinstance(default, tuple):
            value = tuple(value.split(",")) if isinstance(value, str) else tuple(value)
        out[f.name] = value
    return out


def load_settings(path: str | None = None, env: Mapping[str, str] | None = None, prefix: str = "TURNWRIGHT_", **arguments: Any) -> Settings:
    """``TURNWRIGHT_TRAIN_RATIO`` in the environment and ``train_ratio=`` as argument both name a setting of either
    part. A missing file means defaults; a malformed one raises."""
    raw: dict[str, Any] = {}
    if path and Path(path).exists():
        import yaml

        raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    env = os.environ if env is None else env
    given = {k[len(prefix) :].lower(): v for k, v in env.items() if k.startswith(prefix) and v != ""}
    prepare = PrepareSettings(**_typed(PrepareSettings, raw.get("prepare") or raw.get("dataset") or {}))
    export = ExportSettings(**_typed(ExportSettings, raw.get("export") or {}))
    for layer in (given, arguments):
        prepare = replace(prepare, **_typed(PrepareSettings, layer))
        export = replace(export, **_typed(ExportSettings, layer))
    return Settings(prepare, export, raw)


def validate_models(train: str | None, infer: str | None) -> list[str]:
    """Warnings about the models named; raises where one is missing."""
    if not (train or "").strip() or not (infer or "").strip():
        raise ValueError("a base model must be named for training and for inference")
    return [] if train == infer else [f"trained on {train} but served with {infer}"]
