"""Logging of a run: to the console and, where a folder is given, to a file of the run's own."""

from __future__ import annotations

import logging
import os
import sys
import time

FORMAT = "%(asctime)s - %(name)s - %(levelname)s - %(message)s"


def run_logger(name: str = "lumenprep", folder: str | None = None, level: int | str = logging.INFO) -> logging.Logger:
    """The logger of this name with one console handler and, with a folder, one file handler; asked again, no more are added."""
    log = logging.getLogger(name)
    log.setLevel(level)
    log.propagate = False
    kinds = {type(h) for h in log.handlers}
    if logging.StreamHandler not in kinds:
        log.addHandler(_with_format(logging.StreamHandler(sys.stdout)))
    if folder and logging.FileHandler not in kinds:
        os.makedirs(folder, exist_ok=True)
        log.addHandler(_with_format(logging.FileHandler(os.path.join(folder, f"{name}_{time.strftime('%Y%m%d_%H%M%S')}.log"), encoding="utf-8")))
    return log


def _with_format(handler: logging.Handler) -> logging.Handler:
    handler.setFormatter(logging.Formatter(FORMAT))
    return handler
