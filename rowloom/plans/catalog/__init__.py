"""Checked queries: each operator run over whole tables, beside the SQL that must agree."""

from rowloom.plans.catalog import (  # noqa: F401
    aggregates,
    encoders,
    ensembles,
    joins,
    models,
    preset_sums,
    preset_sums_main,
    presets,
    projections,
    sources,
    windows,
)
from rowloom.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
