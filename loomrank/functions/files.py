"""Driver-side helpers for local files, and logging."""

from __future__ import annotations

import logging
import sys
from logging.handlers import RotatingFileHandler
from pathlib import Path


def ensure_dir(path: str) -> Path:
    folder = Path(path)
    folder.mkdir(parents=True, exist_ok=True)
    return folder


def file_exists(path: str) -> bool:
    """Whether there is such a file and it is not empty."""
    file = Path(path)
    return file.is_file() and file.stat().st_size > 0


def file_size_mb(path: str) -> float:
    file = Path(path)
    return file.stat().st_size / (1 << 20) if file.exists() else 0.0


def log_to(folder: str, name: str = "agent.log", rotate_bytes: int = 100 << 20) -> logging.Logger:
    """INFO to the standard error, DEBUG to a file that is rotated by size."""
    logger = logging.getLogger("loomrank")
    logger.setLevel(logging.DEBUG)
    form = logging.Formatter("%(asctime)s | %(levelname)-8s | %(name)s - %(message)s")
    screen = logging.StreamHandler(sys.stderr)
    screen.setLevel(logging.INFO)
    file = RotatingFileHandler(ensure_dir(folder) / name, maxBytes=rotate_bytes, backupCount=5)
    for handler in (screen, file):
        handler.setFormatter(form)
    logger.handlers = [screen, file]
    return logger
