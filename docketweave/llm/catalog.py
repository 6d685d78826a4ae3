"""Registry of the training-data queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketweave.llm import addresses, groups, history, linkage, mixture, names, sentences, survivor, tokens

MODULES = [names, groups, history, addresses, survivor, linkage, mixture, tokens, sentences]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in getattr(m, "SQL", {}).items()}
