"""Public projection of packets: only reviewed bit ranges are read, and what lies between them stays closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.operators.packets import decode_long


def public_faults(fields: DataFrame) -> DataFrame:
    """What is wrong with public fields (apid, public_name, kind, bit_offset, bit_length): one row for each fault.

    Ranges must not overlap, need a width and must not begin before the packet; names must be there and be unique.
    """
    along = Window.partitionBy("apid").orderBy("bit_offset", "bit_length", "public_name")
    end = F.max(F.col("bit_offset") + F.col("bit_length")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    checks = F.array(
        F.when(F.col("bit_offset") < end, "overlap"),
        F.when(F.coalesce(F.col("bit_offset") < 0, F.lit(True)) | F.coalesce(F.col("bit_length") < 1, F.lit(True)), "range"),
        F.when(F.coalesce(F.trim("public_name") == "", F.lit(True)), "name"),
        F.when(F.count("*").over(Window.partitionBy("apid", "public_name")) > 1, "repeated_name"),
    )
    return fields.withColumn("_faults", F.array_compact(checks)).select("apid", "public_name", F.explode("_faults").alias("fault"))


def public_values(packets: DataFrame, fields: DataFrame) -> DataFrame:
    """Typed values of the public fields of packets (apid, packet, and what identifies them), one row for each.

    Public fields that public_faults finds wrong are refused with a ValueError. The packet itself isn't in the result,
    and no column is made of bits outside the public ranges. A packet that ends before a field makes it decode_failed.
    """
    wrong = public_faults(fields).limit(5).collect()
    if wrong:
        raise ValueError("; ".join(f"{r['apid']} {r['public_name']}: {r['fault']}" for r in wrong))
    layout = fields.select("apid", F.col("public_name").alias("field"), "kind", "bit_offset", "bit_length")
    decoded = decode_long(packets, layout).withColumnRenamed("field", "public_name")
    return decoded.drop("packet", "kind", "bit_offset", "bit_length", "raw_value")


def opaque_ranges(fields: DataFrame, sizes: DataFrame) -> DataFrame:
    """apid, start_bit and bit_length of what is not public of packets of a known size (apid, total_bits): the complement
    of the public ranges."""
    ranges = fields.select("apid", "bit_offset", (F.col("bit_offset") + F.col("bit_length")).alias("end"))
    ends = sizes.select("apid", F.col("total_bits").cast("int").alias("bit_offset"), F.col("total_bits").cast("int").alias("end"))
    along = Window.partitionBy("apid").orderBy("bit_offset", "end").rowsBetween(Window.unboundedPreceding, -1)
    both = ranges.join(sizes.select("apid"), "apid", "left_semi").unionByName(ends)
    before = both.withColumn("start_bit", F.coalesce(F.max("end").over(along), F.lit(0)))
    return before.filter("bit_offset > start_bit").select("apid", "start_bit", (F.col("bit_offset") - F.col("start_bit")).alias("bit_length"))
