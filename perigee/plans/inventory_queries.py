"""The whole inventory of images, from their metadata packets and the copies of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators import inventory as ops
from perigee.operators import science
from perigee.plans.base import query
from perigee.plans.image_queries import COPIES, copies, images

META_SQL = """
packets AS (
    SELECT image_id, k, CASE WHEN k < 2 THEN 'capture' WHEN k = 2 AND image_id % 3 > 0 THEN 'process' ELSE 'unknown' END AS source,
           CASE WHEN image_id % 2 = 1 THEN k % 2 END AS sensor, CASE WHEN image_id % 7 = 0 OR k % 2 = 0 THEN 35 ELSE 15000 END AS ms,
           CASE WHEN image_id % 11 = 3 AND k = 1 THEN -1 ELSE 2 END AS shift, CASE WHEN image_id % 4 <> 1 THEN k * 10 END AS start
    FROM (SELECT DISTINCT image_id FROM images WHERE image_id % 5 <> 2), unnest(range(2 + image_id % 3)) AS r(k)),
sets AS (
    SELECT *, CASE WHEN image_id % 2 = 1 THEN CASE sensor WHEN 0 THEN 'outer' ELSE 'inner' END WHEN image_id % 7 > 0 THEN CASE ms WHEN 35 THEN 'inner' ELSE 'outer' END END AS part
    FROM packets WHERE source = 'capture'),
told AS (
    SELECT image_id, bool_and(part IS NULL) AS alike, count(start) AS timed, arg_max(shift, k) FILTER (part = 'inner') AS shift_in, arg_max(shift, k) FILTER (part = 'outer') AS shift_out FROM sets GROUP BY image_id),
meta AS (
    SELECT image_id, count(*) AS meta_packets, 63 AS n_rows, 64 AS n_cols, image_id % 6 = 0 AS uneven, CASE WHEN image_id % 8 < 5 THEN image_id % 8 END AS code,
           count(*) FILTER (source = 'unknown') AS unknown, count(*) FILTER (source = 'process') AS process
    FROM packets GROUP BY image_id),
notes AS (
    SELECT image_id, [CASE WHEN unknown > 0 THEN unknown || ' metadata packet(s) of unknown source' END, CASE WHEN process = 0 THEN 'no metadata packet of the process source, the last one is used' END,
                      CASE WHEN alike THEN 'captures can''t be told apart as two sets' END, CASE WHEN shift_in < 0 THEN 'inner set has the invalid shift ' || shift_in || ', 0 is used' END,
                      CASE WHEN shift_out < 0 THEN 'outer set has the invalid shift ' || shift_out || ', 0 is used' END, CASE WHEN timed = 0 THEN 'no capture has a time' END] AS meta_notes
    FROM meta JOIN told USING (image_id))"""


def metadata_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two to four metadata packets of most images, of all sources, with and without sensors, times and valid shifts."""
    image, k = F.col("image_id"), F.col("k")
    known = images(spark, sf_dir).filter("image_id % 5 <> 2").select("image_id").distinct()
    rows = known.withColumn("k", F.explode(F.sequence(F.lit(0), (image % 3).cast("int") + 1)))
    code = F.when(image % 8 < 5, image % 8)
    mode = science.compression_mode(F.lit(None).cast("int"), code)
    return rows.select(
        "image_id",
        k.alias("arrival"),
        F.when(k < 2, "capture").when((k == 2) & (image % 3 > 0), "process").otherwise("unknown").alias("meta_source"),
        F.when(image % 2 == 1, k % 2).alias("sensor"),
        F.when((image % 7 == 0) | (k % 2 == 0), 35).otherwise(15000).alias("integration_ms"),
        F.when((image % 11 == 3) & (k == 1), -1).otherwise(2).alias("right_shift"),
        F.when(image % 4 != 1, k * 10).alias("start"),
        F.lit(63).alias("n_rows"),
        F.lit(64).alias("n_cols"),
        (image % 6 == 0).alias("uneven"),
        mode["compressed"].alias("compressed"),
        mode["bit_depth"].alias("bit_depth"),
        mode["warning"].alias("mode_warning"),
    )


@query(
    "a8_full_inventory",
    f"""{COPIES}, {META_SQL.strip()},
judged AS (
    SELECT c.*, CASE WHEN image_id % 3 = 2 THEN len(pixels) ELSE 64 END AS n, NOT (image_id % 9 = 4 AND arrival % 50 = 7) AS parsed FROM ranked c
    WHERE NOT (image_id % 4 = 0 AND row_index = 0) AND NOT (image_id % 3 = 0 AND row_index % 10 = 5 AND checksum_status <> 'failed')),
marked AS (
    SELECT *, parsed AND rank >= coalesce(max(rank) OVER (PARTITION BY image_id, row_index, parsed ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS accepted,
           parsed AND row_number() OVER (PARTITION BY image_id, row_index, parsed ORDER BY rank DESC, arrival DESC) = 1 AS chosen FROM judged),
modes AS (SELECT image_id, arg_max(n, c * 100000 - first) AS mode FROM (SELECT image_id, n, count(*) AS c, min(arrival) AS first FROM marked WHERE accepted GROUP BY ALL) GROUP BY image_id),
seen AS (
    SELECT image_id, count(*) AS data_packets, count(*) FILTER (NOT parsed) AS skipped, count(*) FILTER (chosen) AS uniq, count(*) FILTER (chosen AND row_index BETWEEN 1 AND 63) AS inside,
           count(*) FILTER (accepted AND n <> 64) AS bad, min(n) FILTER (accepted) AS least, max(n) FILTER (accepted) AS most, sum(n) FILTER (chosen) AS total,
           min(row_index) FILTER (chosen) AS lo, max(row_index) FILTER (chosen) AS hi, count(*) FILTER (rank = 3) AS v, count(*) FILTER (rank = 2) AS m, count(*) FILTER (rank = 1) AS f,
           count(*) FILTER (chosen AND rank = 3) AS sv, count(*) FILTER (chosen AND rank = 2) AS sm, count(*) FILTER (chosen AND rank = 1) AS sf
    FROM marked GROUP BY image_id),
met AS (
    SELECT s.*, mode, n_rows, n_cols, uneven, meta_notes, code, meta_packets IS NOT NULL AS has, coalesce(meta_packets, 0) AS meta_packets, coalesce(code = 3, false) AS packed
    FROM seen s JOIN modes USING (image_id) LEFT JOIN meta USING (image_id) LEFT JOIN notes USING (image_id)),
sized AS (
    SELECT *, CASE WHEN has AND NOT packed THEN 63 - inside END AS missing, CASE WHEN has AND NOT packed THEN uniq - inside ELSE 0 END AS outside,
           CASE WHEN has AND NOT packed THEN bad ELSE 0 END AS wrong FROM met),
done AS (SELECT *, has AND NOT packed AND wrong = 0 AS writable, has AND NOT packed AND wrong = 0 AND missing = 0 AND outside = 0 AND sf = 0 AS whole, data_packets - uniq - skipped AS copies FROM sized),
filled AS (SELECT *, CASE WHEN writable AND NOT whole THEN missing ELSE 0 END AS zm, CASE WHEN writable THEN sf ELSE 0 END AS zf, lo + hi - lo + 1 - uniq AS gone FROM done)
SELECT image_id, meta_packets, data_packets, uniq AS unique_rows, copies AS duplicate_rows, skipped AS skipped_rows, n_rows AS expected_rows, n_cols AS expected_cols, missing AS missing_rows,
       least AS row_length_min, mode AS row_length_mode, most AS row_length_max, wrong AS bad_length_rows, outside AS out_of_range_rows, packed AS compressed,
       CASE WHEN has THEN CASE code WHEN 0 THEN 16 WHEN 1 THEN 8 WHEN 2 THEN 12 ELSE CASE WHEN code IS NULL THEN 16 END END END AS bit_depth,
       v AS checksum_valid_rows, m AS checksum_missing_rows, f AS checksum_failed_rows, sv AS selected_checksum_valid_rows, sm AS selected_checksum_missing_rows, sf AS selected_checksum_failed_rows,
       whole AS complete, writable AND NOT whole AS partial, zm AS zero_filled_missing_rows, zf AS zero_filled_failed_rows, zm + zf AS zero_filled_rows,
       CASE WHEN packed THEN data_packets - skipped END AS chunks, CASE WHEN packed THEN uniq END AS selected_chunks, CASE WHEN packed THEN lo END AS first_chunk, CASE WHEN packed THEN hi END AS last_chunk,
       CASE WHEN packed THEN gone END AS missing_chunks, CASE WHEN packed THEN total END::BIGINT AS stream_bytes,
       array_to_string(list_filter(list_concat(coalesce(meta_notes, []), [
           CASE WHEN NOT has THEN 'no metadata: sizes are unknown and no product is made' END,
           CASE WHEN has AND code IS NULL THEN 'metadata is missing ICM encoding fields; assuming uncompressed 16-bit rows' WHEN code = 4 THEN 'unrecognized ICM encoding value 4; treating as unknown bit depth' END,
           CASE WHEN uneven THEN 'the binning doesn''t divide the region' END, CASE WHEN outside > 0 THEN outside || ' row(s) outside the image' END, CASE WHEN wrong > 0 THEN wrong || ' row(s) of wrong length' END,
           CASE WHEN missing > 0 THEN missing || ' row(s) missing' END, CASE WHEN f > 0 THEN f || ' failed checksum(s)' END, CASE WHEN m > 0 THEN m || ' missing checksum(s)' END,
           CASE WHEN copies > 0 THEN copies || ' copies of rows; the best checksum counts' END, CASE WHEN sf > 0 THEN sf || ' row(s) in use have failed checksums' END,
           CASE WHEN sm > 0 THEN sm || ' row(s) in use have no checksum' END, CASE WHEN packed THEN 'compressed: sequence counts number chunks, not rows' END,
           CASE WHEN packed AND gone > 0 THEN gone || ' chunk(s) missing: first ' || lo || ', last ' || hi END, CASE WHEN writable AND NOT whole AND zm + zf > 0 THEN zm + zf || ' row(s) filled with zeros' END]), lambda x: x IS NOT NULL), ' | ') AS warnings
FROM filled""",
)
def a8_full_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images with and without metadata, compressed, whole and partial ones, with skipped, failed, short and missing rows."""
    skipped = (F.col("image_id") % 9 == 4) & (F.col("arrival") % 50 == 7)
    image, row = F.col("image_id"), F.col("row_index")
    left_out = ((image % 4 == 0) & (row == 0)) | ((image % 3 == 0) & (row % 10 == 5) & (F.col("checksum_status") != "failed"))
    length = F.when(image % 3 == 2, F.size("pixels")).otherwise(64).alias("length")
    rows = copies(spark, sf_dir).filter(~left_out).select("image_id", "row_index", length, "checksum_status", "arrival", F.when(skipped, "bad_header").otherwise("parsed").alias("status"))
    return ops.full_inventory(rows, ops.image_metadata(metadata_packets(spark, sf_dir)))
