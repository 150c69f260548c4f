"""All registered queries and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib
import textwrap

_MODULES = ["reconciliation", "rollups", "loads", "cleaning", "documents", "ledger", "events", "replenishment", "erp", "jobs", "rejects"]


_EXTRA = ["ledgerline.streaming.incremental"]


def _load():
    queries, oracle = {}, {}
    for m in [f"ledgerline.plans.{m}" for m in _MODULES] + _EXTRA:
        mod = importlib.import_module(m)
        queries.update(mod.QUERIES)
        oracle.update(mod.ORACLE)
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    q, o = _load()
    return {k: textwrap.dedent(v).strip() for k, v in o.items() if k in q}
