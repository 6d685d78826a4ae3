"""Registry of the library's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketweave.operators import nested_queries
from docketweave.plans import cleaning, clustering, evaluation, extraction, merging, normalisation, repair, similarity, vetoes

MODULES = [nested_queries, normalisation, extraction, merging, similarity, clustering, evaluation, repair, vetoes, cleaning]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in getattr(m, "SQL", {}).items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.entity_record(spark, sf_dir)
