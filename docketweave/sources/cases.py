"""Case files in, entity tables and triples out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketweave.functions import text as T
from docketweave.operators.nested import flatten_json

CASE_FILE = "case_key string, source_file string, case_json string"


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """One row per *.json file: its name as key, and its whole text. Unreadable texts are kept; they give no objects later."""
    files = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(path)
    name = F.col("_metadata.file_name")
    return files.select(name.alias("case_key"), F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("case_json"))


def stream_cases(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """The same rows as an unbounded source; each file is read once, by the stream's checkpoint."""
    files = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_per_trigger).load(path)
    return files.select(F.col("_metadata.file_name").alias("case_key"), F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("case_json"))


def extract_mentions(cases: DataFrame) -> DataFrame:
    """Party and firm mentions of case documents; offices of self-represented parties are left out.

    A counsel row marked "see above" without an office of its own takes the office of the fullest row of the same name in its case.
    """
    f = lambda name: T.nz(F.col("fields")[name])
    nodes = flatten_json(cases, "case_key", "case_json")
    parties = nodes.filter("node_kind = 'party'").select(
        "case_key", F.lit("party").alias("entity_type"), F.col("item_index").alias("party_index"), F.lit(-1).alias("counsel_index"), f("name").alias("raw_name"), f("entity_info.address").alias("address"), f("entity_info.email").alias("email"),
        f("entity_info.phone").alias("phone"), F.lower(f("role")).alias("role"),
    )
    counsel = nodes.filter("node_kind = 'counsel' and coalesce(fields['is_pro_se'], 'false') <> 'true'").select(
        "case_key", F.col("parent_index").alias("party_index"), F.col("item_index").alias("counsel_index"), f("name").alias("counsel"), f("entity_info.office_name").alias("raw_name"), f("entity_info.address").alias("address"),
        f("entity_info.email").alias("email"), f("entity_info.phone").alias("phone"), (F.coalesce(F.col("fields")["has_see_above"], F.lit("false")) == "true").alias("see_above"),
    )
    fill = sum(F.col(c).isNotNull().cast("int") for c in ("address", "email", "phone"))
    donors = counsel.filter("raw_name is not null and counsel is not null").groupBy("case_key", "counsel").agg(
        F.min(F.struct((-fill).alias("k"), "party_index", "counsel_index", F.col("raw_name").alias("o"), F.col("address").alias("a"), F.col("email").alias("e"), F.col("phone").alias("p"))).alias("d")
    )
    filled = counsel.join(donors, ["case_key", "counsel"], "left")
    take = lambda c, d: F.coalesce(F.col(c), F.when(F.col("see_above"), F.col(f"d.{d}"))).alias(c)
    firms = filled.select("case_key", F.lit("firm").alias("entity_type"), "party_index", "counsel_index", take("raw_name", "o"), take("address", "a"), take("email", "e"), take("phone", "p"), F.lit("counsel").alias("role"))
    rows = parties.unionByName(firms).filter("raw_name is not null and length(raw_name) > 1")
    key = T.mention_key(F.col("case_key"), F.col("entity_type"), F.col("raw_name"), F.col("party_index"), F.col("counsel_index"), F.col("role"))
    return rows.select(key.alias("mention_id"), "*", T.squeeze(F.lower(F.regexp_replace(T.strip_corp_suffixes(F.col("raw_name")), r"[.,]", " "))).alias("normalized_name"), T.office_class(F.col("raw_name")).alias("office_class"))


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_turtle(triples: DataFrame, path: str) -> None:
    """(s, p, o) rows as N-Triples-style text, subjects and linked objects as URIs."""
    o = F.when(F.col("o").startswith("urn:"), F.concat(F.lit("<"), F.col("o"), F.lit(">"))).otherwise(F.concat(F.lit('"'), F.col("o"), F.lit('"')))
    triples.select(F.concat(F.lit("<"), F.col("s"), F.lit("> <urn:dw:p:"), F.col("p"), F.lit("> "), o, F.lit(" .")).alias("value")).write.mode("overwrite").text(path)
