"""Driver-table bindings: ``QUERIES`` (name -> (spark, sf_dir) -> DataFrame) and the
matching DuckDB oracle SQL in ``ORACLE``."""

from __future__ import annotations

import importlib

from .common import expand_round

MODULES = ["q_events", "q_commerce", "q_revenue", "q_ledger", "q_payments", "q_support",
           "q_crm", "q_marketing", "q_operations", "q_primitives", "q_checks", "q_logistics", "q_content",
           "q_activity", "q_trends", "q_staging", "q_profile", "q_more", "q_json", "q_scale", "q_changes", "q_audit", "q_service"]


def _collect():
    queries, oracle = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"{__name__}.{m}")
        queries.update(mod.QUERIES)
        oracle.update({k: expand_round(v) for k, v in getattr(mod, "ORACLE", {}).items()})
    return queries, oracle


QUERIES, ORACLE = _collect()
