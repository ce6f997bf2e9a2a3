"""Imports every query suite and exposes the registry."""

from __future__ import annotations

from . import registry
from . import suite_rowwise, suite_profile, suite_split, suite_metrics, suite_neighbors, suite_models, suite_attrib, suite_sources  # noqa: F401


def queries():
    return dict(registry.QUERIES)


def oracle_sql():
    return dict(registry.ORACLE)
