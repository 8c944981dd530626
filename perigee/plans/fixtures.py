"""Telemetry derived from the given tables, by the same rules in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions import bits
from perigee.sources.scratch import written

# APIDs of the packets made from each type of event.
APIDS = {"view": 1, "click": 16, "signup": 35, "purchase": 536, "error": 538}

PACKET_BYTES = 20

_PACKETS: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; times that are stored without a zone are read as UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of packets, written once for each session and folder, as a store of recovered packets would be."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _PACKETS:
        _PACKETS[at] = written(make_packets(spark, sf_dir), "packets")
    return _PACKETS[at]


def make_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One packet for each event: header, coarse and fine time, value in hundredths, checksum (spoilt in some)."""
    events = table(spark, sf_dir, "events")
    apid = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in APIDS.items()])
    events = events.withColumn("apid", apid).withColumn("ms", F.unix_millis("ts") - 946_684_800_000)
    raw = F.format_string(
        "%04x%04x%04x%08x%04x%08x",
        F.col("apid") + 2048,
        F.col("event_id") % 16384 + 49152,
        F.lit(PACKET_BYTES - 7),
        F.expr("ms div 1000"),
        F.col("ms") % 1000,
        F.round(F.col("value") * 100).cast("long"),
    )
    events = events.withColumn("body", F.unhex(raw))
    events = events.withColumn("checksum", F.when(F.octet_length("body") == PACKET_BYTES - 4, sum_of_fields()).otherwise(sum_of_body()))
    plain = F.unhex(F.format_string("%08x", "checksum"))
    stored = (
        F.when(F.col("event_id") % 37 == 0, F.unhex(F.lit("00000000")))
        .when(F.col("event_id") % 11 == 0, bits.reverse_words(plain, 4))
        .otherwise(plain)
    )
    return events.select("event_id", "ts", "user_id", "event_type", "value", "apid", "ms", F.concat("body", stored).alias("packet"))


def sum_of_body() -> Column:
    """The checksum of a body of any length."""
    return F.when(F.col("apid") == 536, bits.additive32(F.substring("body", 13, 4))).otherwise(bits.fletcher32(F.col("body")))


def sum_of_fields() -> Column:
    """The same of a body in which each field has its own width, from the numbers that were written into it."""
    coarse, value = F.expr("ms div 1000"), F.round(F.col("value") * 100).cast("long")
    words = [F.col("apid") + 2048, F.col("event_id") % 16384 + 49152, F.lit(PACKET_BYTES - 7)]
    words += [F.shiftright(coarse, 16), coarse % 65536, F.col("ms") % 1000, F.shiftright(value, 16), value % 65536]
    swapped = [(w % 256 * 256 + F.shiftright(w, 8)).cast("long") for w in words]
    first = sum(swapped, F.lit(0)) % bits.FLETCHER_MODULUS
    second = sum((w * (len(words) - i) for i, w in enumerate(swapped)), F.lit(0)) % bits.FLETCHER_MODULUS
    return F.when(F.col("apid") == 536, value).otherwise(second * 65536 + first)


#: The same packets in DuckDB, as lower-case hexadecimal text `hex`.
PACKETS_SQL = """
bodies AS (
    SELECT event_id, ts, user_id, event_type, value, epoch_us(ts) // 1000 - 946684800000 AS ms,
           CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 16 WHEN 'signup' THEN 35 WHEN 'purchase' THEN 536 ELSE 538 END AS apid,
           printf('%04x%04x%04x%08x%04x%08x', 2048 + apid, 49152 + event_id % 16384, 13, ms // 1000, ms % 1000, round(value * 100)::BIGINT) AS body
    FROM events),
sums AS (
    SELECT *, [('0x' || substr(body, 4 * i + 3, 2) || substr(body, 4 * i + 1, 2))::BIGINT FOR i IN range(8)] AS le,
           [('0x' || substr(body, 4 * i + 1, 4))::BIGINT FOR i IN range(8)] AS be,
           ('0x' || substr(body, 25, 8))::BIGINT AS additive
    FROM bodies),
fletcher AS (
    SELECT *, list_sum([(8 - i) * le[i + 1] FOR i IN range(8)])::BIGINT % 65535 * 65536 + list_sum(le)::BIGINT % 65535 AS fletcher_le,
           list_sum([(8 - i) * be[i + 1] FOR i IN range(8)])::BIGINT % 65535 * 65536 + list_sum(be)::BIGINT % 65535 AS fletcher_be
    FROM sums),
stored AS (
    SELECT *, printf('%08x', CASE WHEN apid = 536 THEN additive ELSE fletcher_le END) AS checksum FROM fletcher),
packets AS (
    SELECT *, body || CASE WHEN event_id % 37 = 0 THEN '00000000'
                           WHEN event_id % 11 = 0 THEN substr(checksum, 7, 2) || substr(checksum, 5, 2) || substr(checksum, 3, 2) || substr(checksum, 1, 2)
                           ELSE checksum END AS hex
    FROM stored)
"""
