"""Imports every module that registers queries."""

import importlib

from areapulse.checks.registry import QUERIES, SQL

MODULES = ["rollup_checks", "tool_checks", "ingest_checks", "record_checks", "query_checks", "dimension_checks", "wide_checks"]

for _module in MODULES:
    importlib.import_module(f"areapulse.checks.{_module}")

__all__ = ["QUERIES", "SQL"]
