"""Configuration: a YAML file with required sections, read into nested mappings with dot-path access."""

from __future__ import annotations

from pathlib import Path
from typing import Any

import yaml

#: Sections that every configuration has (fixed values).
SECTIONS = ("dataset", "paths", "corpus", "bm25", "dense", "llm", "agent", "output")


class Config:
    def __init__(self, data: dict[str, Any]):
        missing = [s for s in SECTIONS if s not in data]
        if missing:
            raise ValueError(f"missing sections: {', '.join(missing)}")
        for part in ("corpus", "queries"):
            for key in ("name", "split"):
                if key not in (data["dataset"].get(part) or {}):
                    raise ValueError(f"missing dataset.{part}.{key}")
        self.data = data

    def get(self, path: str, default: Any = None) -> Any:
        """The value at a dotted path, or default where a step is missing or is no mapping."""
        at: Any = self.data
        for step in path.split("."):
            if not isinstance(at, dict) or step not in at:
                return default
            at = at[step]
        return at

    def make_folders(self) -> None:
        for path in (self.data["paths"] or {}).values():
            Path(path).mkdir(parents=True, exist_ok=True)


def load(path: str) -> Config:
    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(path)
    data = yaml.safe_load(file.read_text())
    if not isinstance(data, dict):
        raise ValueError(f"{path} holds no mapping")
    return Config(data)
