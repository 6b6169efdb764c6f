"""Configuration: a dict from JSON (or YAML, where a parser is installed), with defaults."""

from __future__ import annotations

import copy
import json
import os
from typing import Any

from ..sources.specs import DATASETS, spec

ENV = "EVENTLOOM_CONFIG"
DEFAULT_PATH = "eventloom.json"


def defaults() -> dict[str, Any]:
    return {
        "root": "data",
        "compression": "zstd",
        "workers": 8,
        "converted_columns": dict.fromkeys(DATASETS),
        "columns_to_check": {d: list(s.required) for d, s in DATASETS.items()},
        "output_columns": dict.fromkeys(DATASETS),
        "float32_columns": {d: [] for d in DATASETS},
        "historical": False,
        "hive_by": {"yearly": ["Year", "MonthYear"], "monthly": ["Year", "MonthYear"]},
        "lists": dict.fromkeys(DATASETS),
        "timeout_s": 30,
        "retries": 3,
        "retry_wait_s": 1,
        "code_lists": None,
    }


def _read(path: str) -> dict[str, Any]:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise ValueError("no YAML parser is installed; write the configuration as JSON") from e
        return yaml.safe_load(text) or {}
    return json.loads(text)


def given(path: str | None = None) -> bool:
    """Is there a configuration to read, without writing one?"""
    return bool(path or os.environ.get(ENV) or os.path.exists(DEFAULT_PATH))


def load(path: str | None = None) -> dict[str, Any]:
    """From the path, else the environment, else the default place, where the defaults are written if nothing is there."""
    chosen = path or os.environ.get(ENV)
    if chosen and not os.path.exists(chosen):
        raise FileNotFoundError(chosen)
    chosen = chosen or DEFAULT_PATH
    base = defaults()
    if not os.path.exists(chosen):
        with open(chosen, "w", encoding="utf-8") as f:
            json.dump(base, f, indent=2)
        return base
    return merge(base, _read(chosen))


def merge(base: dict[str, Any], over: dict[str, Any]) -> dict[str, Any]:
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def folder(config: dict[str, Any], dataset: str, stage: str) -> str:
    """Where a dataset's files of a stage (raw, converted, filtered, historical) lie."""
    return os.path.join(config["root"], f"{spec(dataset).path_prefix}{stage}")
