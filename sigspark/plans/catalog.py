"""All registered queries: importing a module below registers its queries."""

from __future__ import annotations

from . import (
    ingest_queries,
    metric_queries,
    model_queries,
    report_queries,
    signal_queries,
    source_queries,
    text_queries,
)
from .registry import ORACLES, QUERIES

MODULES = (
    text_queries,
    signal_queries,
    metric_queries,
    ingest_queries,
    report_queries,
    source_queries,
    model_queries,
)

flagship = signal_queries.signal_eval

__all__ = ["MODULES", "ORACLES", "QUERIES", "flagship"]
