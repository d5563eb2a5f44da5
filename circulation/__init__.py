"""Circulation analytics on Spark: a lending star schema and its marts as DataFrame plans.

The main entry points, importable from the package root:

    from circulation import Warehouse, run_monthly, run_daily, refresh, popular_subjects
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_EXPORTS = {
    "build_session": "circulation.session",
    "Warehouse": "circulation.sinks",
    "read_delimited": "circulation.sources",
    "write_delimited": "circulation.sinks",
    "extract_window": "circulation.sources",
    "run_monthly": "circulation.plans.jobs",
    "run_daily": "circulation.plans.jobs",
    "start_daily_catchup": "circulation.streaming",
    "date_bounds": "circulation.plans.marts",
    "loans_per_day": "circulation.plans.marts",
    "popular_subjects": "circulation.plans.marts",
    "popular_titles": "circulation.plans.marts",
    "refresh": "circulation.plans.marts",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'circulation' has no attribute {name!r}")
