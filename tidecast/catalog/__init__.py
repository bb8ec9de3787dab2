"""Named queries over the test tables, each with the SQL that must give the same answer."""

from __future__ import annotations

from importlib import import_module

MODULES = ("forecasts", "series", "learning", "mixed", "files", "requests")


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(import_module(f"tidecast.catalog.{name}"), attribute))
    return out


def all_queries() -> dict:
    return _merged("QUERIES")


def all_sql() -> dict[str, str]:
    return _merged("SQL")
