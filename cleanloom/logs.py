"""Log files of the driver: one per logger and run, the newest few kept."""

from __future__ import annotations

import datetime as dt
import logging
from pathlib import Path

LINE = "%(asctime)s %(levelname)s %(name)s: %(message)s"


def get_logger(name: str, folder: str | Path, most: int = 5) -> logging.Logger:
    log = logging.getLogger(f"cleanloom.{name}")
    if log.handlers:
        return log
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    at = dt.datetime.now().strftime("%Y%m%d-%H%M%S-%f")
    for handler in (logging.FileHandler(folder / f"{name}-{at}.log", encoding="utf-8"), logging.StreamHandler()):
        handler.setFormatter(logging.Formatter(LINE))
        log.addHandler(handler)
    log.setLevel(logging.INFO)
    for old in sorted(folder.glob(f"{name}-*.log"))[:-most]:
        old.unlink()
    return log


def shutdown() -> None:
    """Closes what get_logger opened."""
    for name in list(logging.Logger.manager.loggerDict):
        if name.startswith("cleanloom."):
            log = logging.getLogger(name)
            for handler in list(log.handlers):
                handler.close()
                log.removeHandler(handler)
