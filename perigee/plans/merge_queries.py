"""Queries over packets that three sources have in common, and over what becomes of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators import merge as ops
from perigee.operators import packets as packet_ops
from perigee.plans.base import query
from perigee.plans.fixtures import PACKETS_SQL, packets
from perigee.plans.packet_queries import NAMES, PACKETS, beacon_value, dictionary, repeated

SOURCES = ["src0", "src1", "src2"]


def sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three sources; the first tells how its packets were accepted, the second only its mode, the third nothing."""
    place = F.col("event_id") * 3 + F.col("copy")
    rows = repeated(spark, sf_dir).select(
        F.col("source").alias("source_id"), F.concat("file", F.lit(".bin")).alias("input_file_relative_path"), place.alias("source_packet_index"), (place * 20).alias("source_offset"), "packet"
    )
    own = [rows.filter(F.col("source_id") == s) for s in SOURCES]
    algorithm = F.when(F.col("source_packet_index") % 2 == 0, ops.STRUCTURAL)
    full = own[0].select("*", F.lit("xband").alias("source_mode"), algorithm.alias("acceptance_mode"), (F.col("source_packet_index") % 2 == 1).alias("checksum_validated"))
    return [full, own[1].withColumns({"source_mode": F.lit("uhf"), "source_provenance_quality": F.lit("file")}), own[2]]


SOURCES_SQL = """
repeated AS (
    SELECT *, 'src' || user_id % 3 AS source_id, 'src' || user_id % 3 || '_' || user_id % 7 || '.bin' AS file, event_id * 3 + copy AS place
    FROM packets, unnest(range(event_id % 3 + 1)) AS c(copy)),
marked AS (
    SELECT *, sha256(unhex(hex)) AS sha, count(*) OVER (PARTITION BY hex) AS group_size,
           CASE user_id % 3 WHEN 0 THEN 'xband' WHEN 1 THEN 'uhf' END AS source_mode, CASE WHEN user_id % 3 = 1 THEN 'file' END AS quality,
           CASE WHEN user_id % 3 = 0 AND place % 2 = 0 THEN 'checksum_bypassed_structural' ELSE 'combined_record' END AS acceptance_mode,
           user_id % 3 = 0 AND place % 2 = 1 AS validated,
           CASE WHEN apid <> 536 THEN ms // 1000 END AS coarse, CASE WHEN apid <> 536 THEN ms % 1000 END AS fine,
           CASE apid WHEN 1 THEN 'beacon' WHEN 16 THEN 'sw_stat' WHEN 536 THEN 'csie_data' ELSE 'apid_' || apid END AS packet_name,
           CASE apid WHEN 1 THEN 'registered' WHEN 538 THEN 'none' ELSE 'dictionary' END AS decoder_kind,
           CASE WHEN apid = 538 THEN 'no_decoder' WHEN apid = 1 AND event_id % 16384 % 17 = 0 THEN 'decode_failed' ELSE 'decoded' END AS decode_status
    FROM repeated)"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = packet_ops.field_layout(dictionary(spark)).filter("apid <> 538")
    names = spark.createDataFrame(NAMES, "apid int, packet_name string")
    return ops.full_manifest(ops.combined(sources(spark, sf_dir)), names, layout, {"beacon": beacon_value})


@query(
    "b8_combined_manifest",
    PACKETS + "," + SOURCES_SQL + """
SELECT row_number() OVER (ORDER BY apid = 536, coarse, fine, source_id, file, place) - 1 AS packet_index, place * 20 AS source_offset, source_id, source_mode,
       file AS input_file_relative_path, place AS source_packet_index, NULL::VARCHAR AS source_acceptance_mode, quality AS source_provenance_quality, sha AS packet_hash,
       CASE WHEN group_size > 1 THEN printf('dup_%06d', dense_rank() OVER (ORDER BY CASE WHEN group_size > 1 THEN sha END)) END AS duplicate_group_id,
       group_size AS duplicate_group_size, group_size > 1 AS is_duplicate_packet,
       CASE WHEN apid = 536 THEN 'source_order_fallback' ELSE 'ccsds_secondary_header' END AS combined_time_source, coarse AS combined_time_coarse, fine AS combined_time_fine,
       apid, packet_name, 20 AS packet_len, (event_id % 16384)::INT AS sequence_count, NULL::VARCHAR AS source, acceptance_mode, validated AS checksum_validated,
       'big' AS original_primary_header_endian, false AS primary_header_normalized, false AS payload_16bit_words_swapped, decoder_kind, decode_status,
       CASE decode_status WHEN 'decode_failed' THEN 'unreadable' WHEN 'no_decoder' THEN 'no registered decoder or dictionary fields' END AS decode_error,
       printf('decoded_apid_%04d_%s.csv', apid, packet_name) AS decoded_csv
FROM marked""",
)
def b8_combined_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the packets of three sources to the whole manifest."""
    return manifest(spark, sf_dir)


@query(
    "b8_decode_statistics",
    PACKETS + "," + SOURCES_SQL + """
SELECT apid, count(*) AS packets, count(*) FILTER (decode_status = 'decoded') AS decoded, count(*) FILTER (decode_status = 'decode_failed') AS decode_failed,
       count(*) FILTER (decode_status = 'no_decoder') AS no_decoder, count(*) FILTER (decode_status = 'decoded' AND decoder_kind = 'registered') AS registered,
       count(*) FILTER (decode_status = 'decoded' AND decoder_kind = 'dictionary') AS dictionary, 20 AS min_bytes, 20 AS max_bytes, 20 * count(*) AS packet_bytes
FROM marked GROUP BY apid""",
)
def b8_decode_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.decode_statistics(manifest(spark, sf_dir))


@query(
    "b8_source_table",
    PACKETS + "," + SOURCES_SQL + """,
ordered AS (SELECT *, row_number() OVER (ORDER BY apid = 536, coarse, fine, source_id, file, place) AS nth FROM marked),
per_apid AS (SELECT source_id, apid, count(*) AS n, min(nth) AS first FROM ordered GROUP BY ALL),
best AS (SELECT source_id, string_agg(apid || ':' || n, ' ' ORDER BY n DESC, first) AS top_apids FROM per_apid GROUP BY source_id)
SELECT source_id, count(DISTINCT file) AS input_files, sum(23)::BIGINT AS input_bytes, count(*) AS packets, 20 * count(*) AS packet_bytes, top_apids
FROM marked JOIN best USING (source_id) GROUP BY source_id, top_apids UNION ALL SELECT 'src9', 1, 0, 0, 0, '' FROM (SELECT count(*) FROM events)""",
)
def b8_source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of captures in which three bytes of filler stand before each packet, and one source without packets."""
    rows = repeated(spark, sf_dir).groupBy(F.col("source").alias("source_id"), F.concat("file", F.lit(".bin")).alias("input_file_relative_path"))
    empty = spark.range(1).select(F.lit("src9").alias("source_id"), F.lit("src9.bin").alias("input_file_relative_path"), F.lit(0).cast("long").alias("file_bytes"))
    return ops.source_table(ops.combined(sources(spark, sf_dir)), rows.agg((F.count("*") * 23).alias("file_bytes")).unionByName(empty))


@query(
    "a2_acceptance_statistics",
    "WITH " + PACKETS_SQL.strip() + """,
judged AS (
    SELECT apid, CASE WHEN event_id % 29 = 0 THEN 17 ELSE 20 END AS size,
           CASE WHEN event_id % 29 = 0 THEN NULL WHEN apid IN (16, 35) THEN 'checksum_bypassed_structural'
                WHEN apid = 536 THEN CASE WHEN additive = big THEN 'csie_additive_be' WHEN additive = little THEN 'csie_additive_le' END
                WHEN fletcher_le = big THEN 'fletcher32_le_words_stored_be' WHEN fletcher_le = little THEN 'fletcher32_le_words_stored_le'
                WHEN fletcher_be = big THEN 'fletcher32_be_words_stored_be' WHEN fletcher_be = little THEN 'fletcher32_be_words_stored_le' END AS algorithm,
           event_id % 29 = 0 AS incomplete
    FROM (SELECT *, ('0x' || substr(hex, 33, 8))::BIGINT AS big, ('0x' || substr(hex, 39, 2) || substr(hex, 37, 2) || substr(hex, 35, 2) || substr(hex, 33, 2))::BIGINT AS little FROM packets)),
counted AS (SELECT grouping(apid) = 1 AS total, apid, algorithm, count(*) AS n FROM judged WHERE algorithm IS NOT NULL GROUP BY GROUPING SETS ((apid, algorithm), (algorithm))),
named AS (SELECT total, apid, string_agg(algorithm || '=' || n, ',' ORDER BY algorithm) AS algorithms FROM counted GROUP BY ALL)
SELECT g.*, n.algorithms FROM (
    SELECT grouping(apid) = 1 AS total, apid, count(*) FILTER (NOT incomplete) AS candidate_packets, coalesce(sum(size) FILTER (NOT incomplete), 0)::BIGINT AS candidate_bytes,
           count(algorithm) AS valid_packets, 20 * count(algorithm) AS valid_bytes, count(*) FILTER (algorithm LIKE 'checksum_bypassed%') AS bypassed_packets,
           20 * count(*) FILTER (algorithm LIKE 'checksum_bypassed%') AS bypassed_bytes, count(*) FILTER (NOT incomplete AND algorithm IS NULL) AS failed_packets,
           20 * count(*) FILTER (NOT incomplete AND algorithm IS NULL) AS failed_bytes, count(*) FILTER (incomplete) AS incomplete_packets,
           min(size) FILTER (algorithm IS NOT NULL)::BIGINT AS min_valid_bytes, max(size) FILTER (algorithm IS NOT NULL)::BIGINT AS max_valid_bytes
    FROM judged GROUP BY ROLLUP (apid)) g LEFT JOIN named n ON n.total = g.total AND n.apid IS NOT DISTINCT FROM g.apid""",
)
def a2_acceptance_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of which some are cut short; two APIDs need no checksum."""
    cut = F.when(F.col("event_id") % 29 == 0, F.substring("packet", 1, 17)).otherwise(F.col("packet"))
    judged = ops.outcomes(packets(spark, sf_dir).select("apid", cut.alias("packet")), F.col("apid").isin(16, 35))
    shown = F.transform(F.array_sort(F.map_entries("algorithms")), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return ops.acceptance_statistics(judged).withColumn("algorithms", F.array_join(shown, ","))
