"""The registered queries, by area. Each area has QUERIES and the matching SQL in ORACLES."""

from __future__ import annotations

import importlib

AREAS = ("validation", "records", "texts", "search", "maps", "documents", "streams", "builds")


def _collect(attribute: str) -> dict:
    merged: dict = {}
    for area in AREAS:
        merged.update(getattr(importlib.import_module(f"corpusmap.catalog.{area}"), attribute))
    return merged


def queries() -> dict:
    return _collect("QUERIES")


def oracles() -> dict:
    return _collect("ORACLES")
