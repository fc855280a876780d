"""Import every plan module once and expose the registry."""

from __future__ import annotations

import importlib

from quillspark.plans.registry import ORACLES, QUERIES

_MODULES = (
    "quillspark.plans.text_plans",
    "quillspark.plans.log_plans",
    "quillspark.plans.feature_plans",
    "quillspark.plans.grid_plans",
    "quillspark.plans.image_plans",
)

_loaded = False


def _load() -> None:
    global _loaded
    if not _loaded:
        for m in _MODULES:
            importlib.import_module(m)
        _loaded = True


def queries():
    _load()
    return dict(QUERIES)


def oracle_sql():
    _load()
    return dict(ORACLES)
