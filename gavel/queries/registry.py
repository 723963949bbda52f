"""All registered queries: name → (function, oracle SQL or None)."""

from __future__ import annotations

from importlib import import_module

MODULES = ("timeline", "warehouse", "finance", "text", "entities", "align", "reports", "streams", "build", "searching", "sqltext", "scans")


def registered() -> dict:
    out: dict = {}
    for name in MODULES:
        for query, pair in import_module(f"gavel.queries.{name}").QUERIES.items():
            if query in out:
                raise ValueError(f"query registered twice: {query}")
            out[query] = pair
    return out
