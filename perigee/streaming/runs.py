"""Starting streams over tables and files, and keeping what they give."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.sources.scratch import delete_table, list_folders, shared_folder


def replay(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """A table's Parquet files as a stream, some files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all that is there, and return what it appended as a table."""
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/log")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def keep_latest(stream: DataFrame, path: str, by: list[str], order: list[str], latest: Callable[..., DataFrame]) -> object:
    """Keep a table of the newest row of each key, rewritten with each batch under the batch's number as version."""

    def write(batch: DataFrame, version: int) -> None:
        spark = batch.sparkSession
        both = batch
        if version > 0:
            both = spark.read.parquet(f"{path}/version={version - 1}").select(batch.columns).unionByName(batch)
        latest(both, by, order).write.mode("overwrite").parquet(f"{path}/version={version}")
        if version > 1:  # readers may still be at the version before
            delete_table(spark, f"{path}/version={version - 2}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/_log")


def newest_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table that keep_latest keeps."""
    versions = [int(name.split("=")[1]) for name in list_folders(spark, path) if name.startswith("version=")]
    return spark.read.parquet(f"{path}/version={max(versions)}")


def run_updates(stream: DataFrame, name: str, by: list[str]) -> DataFrame:
    """Run an aggregating stream over all that is there, and return the newest row of each key.

    Each batch's changed rows are written under the batch's number, so a batch that is run again replaces its own.
    """
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    writer = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/log")
    writer.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{folder}/out")
    rest = [c for c in stream.columns if c not in by]
    return rows.groupBy(*by).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*by, "r.*")
