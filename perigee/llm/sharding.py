"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import materialize

ORDER = ("doc_id", "size", "text_crc32", "tie")


def shard_by_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = 16) -> DataFrame:
    """Deal all rows into n_shards contiguous runs (by id) of nearly equal bytes.

    The text is read once, for its size and checksum. The narrow rows are range-partitioned and sorted;
    one total per partition gives each partition its base, and a running sum inside the partition gives every
    row its global offset. A row goes to the shard in which its middle byte lies, so no shard is further from
    the equal target than one row at either end.

    Size is the UTF-8 length plus 1; null and empty texts have size 1 and checksum 0. Null ids come first. Rows
    of equal id are ordered by size, then checksum; rows equal in all of these may swap places. Repeated rows are
    kept. An empty table gives an empty result. Other columns of df are not looked at.

    Returns doc_id, size, text_crc32, law, shard, slot (place inside the shard, from 0), grown_shard (null: the
    law `bytes` cuts anew when a shard is added).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = materialize(
        df.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "shard-sizes",
    )
    ranged = materialize(
        sized.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("part", F.spark_partition_id()),
        "shard-ranges",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        ranged.groupBy("part")
        .agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
        .select(  # one row for each partition
            "part",
            F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("base_bytes"),
            F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("base_rows"),
            F.sum("part_bytes").over(Window.partitionBy()).alias("total"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*ORDER)
    placed = (
        ranged.select(
            "*",
            (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("run_bytes"),
            (F.row_number().over(inside) - 1).alias("run_rows"),
        )
        .join(F.broadcast(bases), "part")
        .withColumn("at", (F.col("base_rows") + F.col("run_rows")).cast("long"))
        .withColumn("middle", (2 * (F.col("base_bytes") + F.col("run_bytes")) + F.col("size")).cast("decimal(30,0)"))
        .withColumn("shard", F.expr(f"cast(middle * {int(n_shards)} div (2 * total) as int)"))
    )
    starts = placed.groupBy("shard").agg(F.min("at").alias("start"))  # one row for each shard
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("at") - F.col("start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", n_shards: int = 16) -> None:
    """Write df's texts as one folder per shard. Ids must be unique, since they join the rows to their shards."""
    placed = shard_by_bytes(df, id_col, text_col, n_shards).select(F.col("doc_id").alias(id_col), "shard", "slot")
    df.select(id_col, text_col).join(placed, id_col).write.partitionBy("shard").parquet(path)
