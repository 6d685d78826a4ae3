"""Queries over case_docs by the nested-record operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketweave.operators.nested import flatten_json
from docketweave.session import read


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per party, counsel and docket object of every readable delivery."""
    nodes = flatten_json(read(spark, sf_dir, "case_docs"), "case_key", "case_json", fields=False)
    party = F.col("node_kind") == "party"
    return nodes.select(
        "case_key",
        "node_kind",
        F.when(party, F.col("item_index")).otherwise(F.col("parent_index")).alias("party_index"),
        F.when(party, F.lit(-1)).otherwise(F.col("item_index")).alias("item_index"),
    )


def p6_party(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat party table, with its case as parent."""
    f = lambda name: F.col("fields")[name]
    nodes = flatten_json(read(spark, sf_dir, "case_docs"), "case_key", "case_json")
    return nodes.filter("node_kind = 'party'").select(
        "case_key",
        F.col("item_index").alias("party_index"),
        f("name").alias("name"),
        f("role").alias("role"),
        f("pacer_id").alias("pacer_id"),
        f("entity_info.address").alias("address"),
        f("entity_info.email").alias("email"),
    )


def p6_counsel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat counsel table, each row with its case and party."""
    f = lambda name: F.col("fields")[name]
    nodes = flatten_json(read(spark, sf_dir, "case_docs"), "case_key", "case_json")
    return nodes.filter("node_kind = 'counsel'").select(
        "case_key",
        F.col("parent_index").alias("party_index"),
        F.col("item_index").alias("counsel_index"),
        f("name").alias("name"),
        f("entity_info.office_name").alias("office_name"),
        f("entity_info.address").alias("address"),
    )


QUERIES = {"p6_found": p6_found, "p6_party": p6_party, "p6_counsel": p6_counsel}
