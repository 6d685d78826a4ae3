"""Session, table reading and lineage cutting shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docketweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites of columns cost more than the columns
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); one of our own only where that is unset and all runs on this machine."""
    sc = spark.sparkContext
    if configured := sc.getConf().get("spark.checkpoint.dir"):
        return configured
    if chosen := sc._jsc.sc().getCheckpointDir():
        if chosen.isDefined():
            return chosen.get()
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"docketweave-{uuid.uuid4().hex}")
    sc.setCheckpointDir(own)
    return sc._jsc.sc().getCheckpointDir().get()


class Scratch:
    """Tables written once into the shared folder: they cut lineage and survive lost executors.

    Each is columnar and compressed, so it costs less disk than a row checkpoint, and
    its file statistics let the planner size later joins. drop() frees one that is no longer read.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def table(self, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        path = f"{self.base}/{self.count}"
        self.count += 1
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm = self.spark.sparkContext._jvm
            hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(hadoop).delete(target, True)


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
