"""The driver-table query catalog: every registered query and its oracle SQL."""

from __future__ import annotations

from telemetra.plans.registry import QUERIES  # noqa: F401
from telemetra.plans import q_rules  # noqa: F401  (registers on import)

GROUPS = ["q_rules", "q_typed", "q_tables", "q_hierarchy", "q_extract", "q_files"]


def load_all() -> dict:
    import importlib
    for g in GROUPS:
        importlib.import_module(f"telemetra.plans.{g}")
    return QUERIES
