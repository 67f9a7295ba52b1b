"""Streams over a table's files, run to the end of what is there (availableNow), and what they leave."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_dir(spark: SparkSession) -> str:
    """The folder shared by the cluster, from spark.checkpoint.dir; a local one only for a local session, an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return (base or f"file:///tmp/checkpoints/vacatia-{spark.sparkContext.applicationId}").rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: a step's output is a table, and its plan ends there."""
    path = f"{work_dir(df.sparkSession)}/vacatia/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def events(spark: SparkSession, path: str) -> DataFrame:
    """A parquet file or folder as a stream."""
    schema = spark.read.parquet(path).schema
    folder, name = path.rstrip("/").rsplit("/", 1)
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 4).parquet(path) if _is_folder(spark, path) else spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run an append stream to its end into parquet files of the shared folder, and read them."""
    spark = stream.sparkSession
    out = f"{work_dir(spark)}/vacatia/{name}-{uuid.uuid4().hex}"
    q = stream.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def merge_stream(stream: DataFrame, name: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> DataFrame:
    """A state table under a stream: each micro-batch makes a new version from the last and itself.

    The version's folder is named by the batch, so a batch that is run again after a failure writes the same version."""
    spark = stream.sparkSession
    out = f"{work_dir(spark)}/vacatia/{name}-{uuid.uuid4().hex}"
    last: dict[str, int] = {}

    def step(batch: DataFrame, n: int) -> None:
        session = batch.sparkSession
        before = session.read.parquet(f"{out}/v{n - 1}") if n else None
        merge(before, batch).write.mode("overwrite").parquet(f"{out}/v{n}")
        last["n"] = n

    stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/v{last['n']}")


def register(before: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The ledger (user_id, first_at, last_at, last_event, seen, status) after a batch of (user_id, ts, event_id, event_type).

    New keys are PENDING, a purchase makes DONE; CLOSED stays closed; the newest event sets the rest."""
    new = batch.groupBy("user_id").agg(
        F.min("ts").alias("first_at"), F.max("ts").alias("last_at"), F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event"), F.count("*").alias("seen"),
        F.when(F.bool_or(F.col("event_type") == "purchase"), "DONE").otherwise("PENDING").alias("status"),
    )
    if before is None:
        return new
    both = before.unionByName(new)
    status = F.when(F.bool_or(F.col("status") == "CLOSED"), "CLOSED").when(F.bool_or(F.col("status") == "DONE"), "DONE").otherwise("PENDING")
    return both.groupBy("user_id").agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.max_by("last_event", F.struct("last_at", "last_event")).alias("last_event"), F.sum("seen").alias("seen"), status.alias("status"))
