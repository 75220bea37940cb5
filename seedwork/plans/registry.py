"""All queries of the core by name, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seedwork.plans import assay_queries, cohort_queries, data_queries, table_queries

_PARTS = (data_queries, assay_queries, cohort_queries, table_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for part in _PARTS for name, f in part.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
