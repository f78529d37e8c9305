"""All queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliant.plans import checks, convert, index, intake, pages, planning, records, render, structure
from foliant.streaming import ingest

MODULES = [records, index, structure, planning, checks, convert, intake, render, pages, ingest]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
