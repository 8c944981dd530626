"""Streams replayed over events, compared with their batch forms."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators import series
from perigee.plans.base import query
from perigee.plans.fixtures import PACKETS_SQL, packets, table
from perigee.plans.value_queries import JUMPS, SIGMA
from perigee.sources.scratch import shared_folder
from perigee.streaming import framing, runs, state

BATCHES = 4


def in_batches(rows: DataFrame, place: str, name: str) -> DataFrame:
    """Rows as a stream of several batches in order of place; a batch is a range of places in several files, or in one of a small table."""
    spark = rows.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    lo, hi, n = rows.agg(F.min(place), F.max(place), F.count("*")).first()
    files = 4 if n > 1_000 * BATCHES else 1  # all files of a batch must have rows
    width = (hi - lo) // BATCHES + 1 if lo is not None else 1
    for i in range(BATCHES):
        part = rows.filter(F.floor((F.col(place) - (lo or 0)) / width) == i)
        part.repartition(files).write.mode("append").parquet(folder)
    return runs.replay(spark, folder, rows.schema.simpleString()[7:-1].replace(":", " "), files_per_batch=files)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of several batches in order of time."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_micros("ts").alias("us"), "value")
    return in_batches(rows, "us", "stream-source")


@query("st4_jump_rejection_stream", JUMPS)
def st4_jump_rejection_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rule as the batch fold, with state carried from batch to batch."""
    wild = F.when(F.col("event_id") % 17 == 0, 1e6).otherwise(0.0)
    packets = events(spark, sf_dir).select("event_id", F.concat(F.lit("u"), F.col("user_id") % 7).alias("packet_name"), (F.col("us") / 1e6 - 946_684_800 + wild).alias("packet_time"), F.lit("ccsds_secondary_header").alias("time_source"), (F.col("us") / 1e6).alias("received"))
    return runs.run_to_table(state.reject_jumps(packets, "packet_name", max_jump=600.0), "st4").select("event_id", "packet_name", "reject_reason")


@query(
    "st3_latest_history_stream",
    """
SELECT event_id, event_type AS field, false AS rejected, least(row_number() OVER (PARTITION BY event_type ORDER BY ts), 300)::INT AS n_history, value AS latest FROM events""",
)
def st3_latest_history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = events(spark, sf_dir).select("event_id", F.col("event_type").alias("field"), "us", "value")
    return runs.run_to_table(state.field_history(points), "st3").select("event_id", "field", "rejected", "n_history", "latest")


@query("st5_sigma_filter_stream", SIGMA)
def st5_sigma_filter_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = events(spark, sf_dir).select("event_id", F.col("event_type").alias("field"), "us", "value")
    return runs.run_to_table(state.field_history(points, threshold=4.0), "st5").select("event_id", "field", "us", "value", "rejected")


@query("st8_counters_stream", "SELECT event_type AS packet_name, count(*) AS seen FROM events GROUP BY event_type")
def st8_counters_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts kept by a streaming aggregation; the last version of each is the one of the largest count."""
    rows = events(spark, sf_dir).select(F.col("event_type").alias("packet_name"), F.lit("decoded").alias("status"), F.lit(None).cast("string").alias("checksum_status"), F.lit(None).cast("string").alias("reject_reason"))
    return runs.run_updates(state.counters(rows), "st8", ["packet_name"]).select("packet_name", "seen")


@query("s18_latest_snapshot", "SELECT event_type, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value FROM events GROUP BY event_type")
def s18_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of newest values that a stream leaves for its readers."""
    folder = f"{shared_folder(spark)}/snapshot-{uuid.uuid4().hex}"
    stream = events(spark, sf_dir).select("event_type", "event_id", "us", "value")
    runs.keep_latest(stream, folder, ["event_type"], ["us"], series.latest).trigger(availableNow=True).start().awaitTermination()
    return runs.newest_version(spark, folder).select("event_type", "event_id", "value")


AX25_HEAD = b"SUN1    LASP    \x03\xf0"
PREFIXES = {0: "1acffc1d", 1: "1badcafe" + "00" * 12, 2: AX25_HEAD.hex(), 3: ""}
LINK_KINDS = ["sync", "ground", "ax25", "bare"]


@query(
    "st1_framing_stream",
    "WITH " + PACKETS_SQL.strip() + """,
framed AS (SELECT user_id % 8 AS l, user_id % 4 AS kind, event_id, apid, hex, row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) - 1 AS number FROM packets)
SELECT 'link' || l AS link, number, CASE kind WHEN 0 THEN 'sync' WHEN 1 THEN 'ground' WHEN 2 THEN 'ax25' ELSE 'bare' END AS kind, apid, hex AS packet,
       event_id % 3 AS dropped, 20 + CASE kind WHEN 0 THEN 4 WHEN 1 THEN 16 WHEN 2 THEN 18 ELSE 0 END::BIGINT AS taken, NULL::BIGINT AS faults
FROM framed
UNION ALL SELECT 'link' || l, count(*), 'end', NULL, NULL, 40, 0, 0 FROM framed GROUP BY l""",
)
def st1_framing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of four kinds, their frames cut into chunks anywhere, over several batches; 40 bytes of nothing and an end."""
    rows = packets(spark, sf_dir).select(F.concat(F.lit("link"), F.col("user_id") % 8).alias("link"), "event_id", "user_id", F.hex("packet").alias("h"))
    prefix = F.get(F.array(*[F.lit(x) for x in PREFIXES.values()]), (F.col("user_id") % 4).cast("int"))
    frame = F.concat(F.repeat(F.lit("55"), (F.col("event_id") % 3).cast("int")), prefix, F.col("h"))
    cut = (F.col("event_id") % 19 + 1).cast("int") * 2
    halves = F.array(F.struct((F.col("event_id") * 2).alias("position"), F.substring(frame, F.lit(1), cut).alias("h")), F.struct((F.col("event_id") * 2 + 1).alias("position"), F.substring(frame, cut + 1, F.length(frame)).alias("h")))
    chunks = rows.select("link", F.inline(halves)).select("link", "position", F.unhex("h").alias("content"))
    last = rows.groupBy("link").agg((F.max("event_id") * 2 + 2).alias("position"))
    ends = F.array(F.struct("position", F.unhex(F.repeat(F.lit("AA"), F.lit(40))).alias("content")), F.struct((F.col("position") + 1).alias("position"), F.lit(None).cast("binary").alias("content")))
    stream = in_batches(chunks.unionByName(last.select("link", F.inline(ends))), "position", "st1-source")
    link = framing.Framing(frozenset({1, 16, 35, 536, 538}), ax25_heads=(AX25_HEAD,))
    found = runs.run_to_table(framing.frame_links(stream, link), "st1")
    return found.select("link", "number", "kind", "apid", F.lower(F.hex("content")).alias("packet"), "dropped", "taken", "faults")


@query(
    "st2_segment_stream",
    "WITH " + PACKETS_SQL.strip() + """,
whole AS (SELECT event_id // 30 AS sequence, count(*) AS n, string_agg(hex, '' ORDER BY event_id) AS body FROM packets GROUP BY event_id // 30)
SELECT sequence::INT AS sequence, printf('0801%04x%04x', 49152 + sequence % 16384, 20 * n - 1) || body AS packet FROM whole WHERE 20 * n + 6 > 244 AND sequence % 7 <> 3""",
)
def st2_segment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets of some 600 bytes in segments over several batches, out of order inside a batch; some spoilt copies come
    before the right ones, and of every seventh packet the second segment never comes."""
    group = F.expr("event_id div 30")
    bodies = packets(spark, sf_dir).groupBy(group.alias("s")).agg(F.array_sort(F.collect_list(F.struct("event_id", F.hex("packet").alias("h")))).alias("p"))  # 30 of each
    size = F.size("p") * 20
    whole = bodies.select("s", (size + 6).alias("length"), F.concat(F.format_string("0801%04X%04X", F.col("s") % 16384 + 49152, size - 1), F.array_join(F.col("p.h"), "")).alias("h")).filter("length > 244")
    last = F.floor((F.col("length") - 1) / 244).cast("int")
    parts = whole.withColumn("segment_index", F.explode(F.sequence(F.lit(0), last))).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    i = F.col("segment_index")
    right = F.unhex(F.substring("h", i * 488 + 1, F.lit(488)))
    content = F.when((F.col("copy") == 0) & (i == 1) & (F.col("s") % 5 == 1), F.unhex(F.repeat(F.lit("00"), F.lit(244)))).otherwise(right)
    flag = F.when(i == 0, framing.START).when(i == last, framing.END).otherwise(0)
    sent = parts.filter(~((F.col("s") % 7 == 3) & (i == 1)) & ((F.col("copy") == 0) | (i == 1)))
    rows = sent.select((i * 10 + F.col("copy")).cast("long").alias("number"), F.lit(2121).alias("packet_id"), F.col("s").cast("int").alias("sequence"), "length", F.lit(1).alias("payload_id"), F.lit(0).alias("payload_sequence"), i.alias("segment_index"), flag.alias("flag"), content.alias("content"))
    stream = in_batches(rows.repartition(4, F.xxhash64("sequence", "segment_index")), "number", "st2-source")
    joined = runs.run_to_table(framing.join_segments(stream, framing.Framing(frozenset({1}))), "st2")
    return joined.select("sequence", F.lower(F.hex("packet")).alias("packet"))


@query(
    "st13_clear_stream",
    """
WITH told AS (SELECT *, count(*) FILTER (event_type = 'error' AND event_id % 40 = 0) OVER (ORDER BY ts RANGE UNBOUNDED PRECEDING) AS epoch FROM events)
SELECT event_id, event_type AS field, false AS rejected, least(row_number() OVER (PARTITION BY event_type, epoch ORDER BY ts), 300)::INT AS n_history, value AS latest FROM told""",
)
def st13_clear_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories that some errors clear as they come, over several batches."""
    point = lambda is_clear: F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("field"), "us", "value", F.lit(is_clear).alias("is_clear"))
    both = F.when(F.expr("event_type = 'error' and event_id % 40 = 0"), F.array(point(True), point(False))).otherwise(F.array(point(False)))
    told = framing.clearable_history(events(spark, sf_dir).select(F.inline(both)), buckets=8)
    return runs.run_to_table(told, "st13").select(F.col("id").alias("event_id"), "field", "rejected", "n_history", "latest")
