"""All queries over the reference's operators, with the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pairloom.plans import curation, evaluation, formatting

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (curation, formatting, evaluation)


def queries() -> dict[str, Query]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
