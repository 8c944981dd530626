"""Numbers and running sums in an order of all rows, without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.sources.scratch import written


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """df in range partitions, sorted and written, which fixes them: with _part and _in_part (from 0)."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    return written(parts.withColumn("_in_part", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ordered")


def bases(parts: DataFrame, total: Column) -> DataFrame:
    """_part and _base: the totals of the partitions before. One row for each partition."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(total.alias("_total"))
    return totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))


def number_rows(df: DataFrame, order: list[str], name: str = "packet_index", start: int = 0) -> DataFrame:
    """df with consecutive numbers in an order: places in partitions plus the rows of earlier ones."""
    parts = in_order(df, order)
    joined = parts.join(F.broadcast(bases(parts, F.count("*"))), "_part")
    return joined.withColumn(name, F.col("_base") + F.col("_in_part") + start).drop("_part", "_in_part", "_base")


def running_sums(df: DataFrame, order: list[str], size: str, name: str) -> DataFrame:
    """df with the sum of the sizes of the rows before each in an order (0 for the first); a null size adds nothing."""
    parts = in_order(df, order)
    before = Window.partitionBy("_part").orderBy("_in_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(size).over(before), F.lit(0))
    joined = parts.withColumn("_inside", inside).join(F.broadcast(bases(parts, F.coalesce(F.sum(size), F.lit(0)))), "_part")
    return joined.withColumn(name, F.col("_base") + F.col("_inside")).drop("_part", "_in_part", "_base", "_inside")
