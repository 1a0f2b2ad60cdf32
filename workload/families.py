"""Imports every module that registers queries."""

from __future__ import annotations

import importlib

MODULES = ("source_queries", "tables", "features", "alert_queries", "evaluation", "model_queries")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"workload.{name}")
