"""All queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from platemark.plans import box_queries, curation_queries, io_queries, problem_queries, rule_queries, sequence_queries

MODULES = [problem_queries, box_queries, curation_queries, rule_queries, sequence_queries, io_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.oracle_sql().items()}
