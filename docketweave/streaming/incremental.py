"""Case files as a stream, resolved against a registry that grows batch by batch.

A batch's mentions reduce to their keys (type, name, and case or office class); known keys take their entity, others get a new one. The
registry is a table of parts named by batch, so a batch that is run again replaces its own part and nothing else:
replay changes nothing. Entities once made are never merged with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketweave.sources.cases import extract_mentions, stream_cases

REGISTRY = "entity_key string, sjid string"
PREFIX = {"party": "SP", "firm": "SF", "judge": "SJ"}


def entity_key() -> Column:
    """Firms are told apart by their office class, people and other parties by their case."""
    scope = F.when(F.col("entity_type") == "firm", F.col("office_class")).otherwise(F.col("case_key"))
    return F.concat_ws("|", "entity_type", "normalized_name", scope)


def read_registry(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Registry rows of all batches, or of those before a batch."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):  # so before the first batch; any other fault is raised
        return spark.createDataFrame([], REGISTRY + ", batch int")
    parts = spark.read.schema(REGISTRY + ", batch int").parquet(path)
    return parts if before is None else parts.filter(F.col("batch") < before)


def resolve_batch(batch: DataFrame, batch_id: int, registry: str, output: str) -> None:
    """Writes the batch's part of the registry and of the resolved mentions."""
    spark = batch.sparkSession
    mentions = extract_mentions(batch).withColumn("entity_key", entity_key())
    known = read_registry(spark, registry, before=batch_id).select("entity_key", "sjid")
    keys = mentions.select("entity_type", "entity_key").distinct()
    prefix = F.create_map(*[F.lit(x) for kv in PREFIX.items() for x in kv])[F.col("entity_type")]
    # Ids come from the key itself, so they depend neither on the order of rows nor on a shared counter.
    fresh = keys.join(known, "entity_key", "left_anti").select("entity_key", F.concat(prefix, F.substring(F.sha1("entity_key"), 1, 12)).alias("sjid"))
    fresh.write.mode("overwrite").parquet(f"{registry}/batch={batch_id}")
    everything = read_registry(spark, registry).filter(F.col("batch") <= batch_id).select("entity_key", "sjid")
    mentions.join(everything, "entity_key").write.mode("overwrite").parquet(f"{output}/batch={batch_id}")


def resolve_stream(spark: SparkSession, source: str, registry: str, output: str, checkpoint: str) -> StreamingQuery:
    """Runs over all files that are there and stops; called again, it goes on with new files only."""
    cases = stream_cases(spark, source)
    return (
        cases.writeStream.foreachBatch(lambda df, batch_id: resolve_batch(df, batch_id, registry, output)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
