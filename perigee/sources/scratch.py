"""Tables that are written between steps, in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of at most so many counted rows may be broadcast.
FEW_ROWS = 100_000

_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a local master without it gets a temporary folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = "file://" + tempfile.mkdtemp(prefix="perigee-")
    return _OWN_FOLDERS[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, with its rows fixed and its lineage cut."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_table(spark: SparkSession, path: str) -> None:
    """Delete a table's folder, in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in whatever store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [x.getPath().getName() for x in found]


#: A table whose size the planner bounds by so many bytes may be broadcast without counting its rows.
FEW_BYTES = 16 << 20


def estimated_bytes(df: DataFrame) -> int | None:
    """The planner's estimate of a table's size, for which no job runs; None if it knows nothing."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 62 else None


def small(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if its size is bounded: by the planner, or by its rows, of which FEW_ROWS + 1 at most are counted.

    A larger table is left to a shuffled join.
    """
    size = estimated_bytes(df)
    if (size is not None and size <= FEW_BYTES) or df.limit(FEW_ROWS + 1).count() <= FEW_ROWS:
        return F.broadcast(df)
    return df


#: Estimated bytes of a partition that is to be sorted; in memory, rows of compressed columns take some thirty times as much.
PART_BYTES, MOST_PARTS = 2 << 20, 8192


def dealt_by(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to as many partitions as its estimated size asks for, so that they don't grow with it.

    A table for which the session's number of partitions is enough is returned as it is.
    """
    parts = min(-(-(estimated_bytes(df) or 0) // PART_BYTES), MOST_PARTS)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def gathered(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """df with all rows of equal keys in one task, one key after another, each in order.

    Dealt by a hash of the keys: behind a join by the keys themselves Spark leaves the exchange out as done already, and
    may then turn the join into a broadcast at run time, which keeps nothing together.
    """
    return df.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, *order)
