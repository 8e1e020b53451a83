"""Queries over the given tables and the SQL that checks them, by area."""

from __future__ import annotations

from importlib import import_module

AREAS = ("monitoring", "metrics", "tables", "storage", "learning", "streams")


def collect(attribute: str) -> dict:
    """Merge one dict attribute of all area modules."""
    merged: dict = {}
    for area in AREAS:
        merged.update(getattr(import_module(f"registered.{area}"), attribute))
    return merged
