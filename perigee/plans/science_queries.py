"""Queries over row packets, metadata, exposure, pointing, beacons and reports made from the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions import bits, clock, status
from perigee.operators import image_scan, packetizer, quality, recovery, science, series
from perigee.plans.base import query
from perigee.plans.fixtures import PACKETS_SQL, packets, table
from perigee.plans.image_queries import IMAGES, SIDE, images
from perigee.streaming import state

EVENTS_SQL = "WITH e AS (SELECT *, epoch_us(ts) AS us FROM events)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("us", F.unix_micros("ts"))


@query(
    "f30_row_packets",
    IMAGES + """
SELECT image_id, y, CASE WHEN (image_id + y) % 11 = 0 THEN 'skipped_incomplete_row_payload' WHEN (image_id + y) % 13 = 0 THEN 'skipped_bad_row_length' ELSE 'parsed' END AS status,
       y AS row_index, CASE WHEN (image_id + y) % 11 = 0 OR (image_id + y) % 13 = 0 THEN NULL ELSE list_sum(pixels)::BIGINT END AS total,
       CASE WHEN (image_id + y) % 11 = 0 THEN 'missing' WHEN (image_id + y) % 13 = 0 THEN 'failed' WHEN y % 5 = 0 THEN 'failed' ELSE 'valid_be' END AS checksum_status
FROM images WHERE NOT (image_id + y) % 13 = 0""",
)
def f30_row_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row packets of images: some cut off, some with a wrong checksum."""
    payload = F.array_join(F.transform("pixels", lambda v: F.format_string("%04x", v)), "")
    rows = images(spark, sf_dir).filter("(image_id + y) % 13 <> 0").withColumn("body", F.unhex(payload))
    head = F.format_string("%04x%04x%04x%08x0000", F.lit(0x0800 + 536), F.lit(0xC000) + F.col("y"), F.octet_length("body") + 9, F.col("image_id"))
    check = F.when(F.col("y") % 5 == 0, F.lit("ffffffff")).otherwise(F.format_string("%08x", bits.additive32(F.col("body"))))
    whole = F.unhex(F.concat(head, F.hex("body"), check))
    packet = F.when((F.col("image_id") + F.col("y")) % 11 == 0, F.substring(whole, 1, 40)).otherwise(whole)
    parsed = science.row_packets(rows.select("image_id", "y", packet.alias("packet")))
    total = F.aggregate("pixels", F.lit(0).cast("long"), lambda a, v: a + v)
    return parsed.select("image_id", "y", "status", "row_index", total.alias("total"), "checksum_status")


META = "SELECT o_orderkey, o_custkey AS image_id, (o_orderkey * 7 % 2300)::INT AS roi_rows, (o_orderkey * 11 % 1600)::INT AS roi_cols, CASE WHEN o_orderstatus = 'P' THEN 'decode_failed' ELSE 'decoded' END AS status FROM orders"


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    state_of = F.when(F.col("o_orderstatus") == "P", "decode_failed").otherwise("decoded")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("image_id"), (key * 7 % 2300).cast("int").alias("roi_rows"), (key * 11 % 1600).cast("int").alias("roi_cols"), state_of.alias("status"))


@query("p17_plausible_metadata", f"SELECT o_orderkey FROM ({META}) WHERE status <> 'decode_failed' AND roi_rows BETWEEN 1 AND 2000 AND roi_cols BETWEEN 1 AND 1504")
def p17_plausible_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return science.plausible(metadata(spark, sf_dir))[0].select("o_orderkey")


@query("p17_rejected_metadata", f"SELECT count(*) FILTER (status = 'decode_failed') AS rejected_decode, count(*) FILTER (status <> 'decode_failed' AND NOT (roi_rows BETWEEN 1 AND 2000 AND roi_cols BETWEEN 1 AND 1504)) AS rejected_dimensions FROM ({META})")
def p17_rejected_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return science.plausible(metadata(spark, sf_dir))[1]


@query(
    "j8_known_rows",
    """SELECT l_orderkey, l_linenumber FROM lineitem JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 50)::INT END AS n_cols FROM orders WHERE o_orderstatus <> 'F') o
ON l_orderkey = o_orderkey WHERE n_cols IS NULL OR l_quantity::INT * 2 = 2 * n_cols""",
)
def j8_known_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image_id"), "l_linenumber", (F.col("l_quantity").cast("int") * 2).alias("row_payload_bytes"))
    key = F.col("o_orderkey")
    known = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'").select(key.alias("image_id"), F.when(key % 3 != 0, (key % 50).cast("int")).alias("n_cols"))
    return science.known_rows(rows, known).select(F.col("image_id").alias("l_orderkey"), "l_linenumber")


RECORDS = "SELECT user_id::BIGINT AS user_id, CASE WHEN event_id % 3 = 0 THEN 'word32' ELSE 'plain' END AS view, (event_id % 3 = 0)::INT AS position, CASE event_type WHEN 'error' THEN 'metadata' ELSE 'row' END AS kind FROM events"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = F.col("event_id") % 3 == 0
    kind = F.when(F.col("event_type") == "error", "metadata").otherwise("row")
    return events(spark, sf_dir).select("user_id", F.when(other, "word32").otherwise("plain").alias("view"), other.cast("int").alias("position"), kind.alias("kind"))


@query(
    "u5_best_view",
    f"""SELECT user_id, view, score FROM (SELECT user_id, view, position, sum(CASE kind WHEN 'metadata' THEN 10 ELSE 1 END)::BIGINT AS score FROM ({RECORDS}) GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, position) = 1""",
)
def u5_best_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return science.best_view(records(spark, sf_dir), "user_id")


@query(
    "u6_more_records",
    f"""SELECT user_id, count(*) FILTER (view = 'plain') AS from_packets, count(*) FILTER (view = 'word32') AS from_stream,
       CASE WHEN count(*) FILTER (view = 'word32') > count(*) FILTER (view = 'plain') THEN 'stream' ELSE 'packets' END AS use FROM ({RECORDS}) GROUP BY user_id""",
)
def u6_more_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir)
    return science.more_records(rows.filter("view = 'plain'"), rows.filter("view = 'word32'"), "user_id")


@query(
    "a7_product_metadata",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS process FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY process DESC, o_orderkey DESC) = 1""",
)
def a7_product_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "F", " Processed ").when(F.col("o_orderstatus") == "O", "0").otherwise("?")
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", science.metadata_source(text).alias("meta_source"))
    return science.product_metadata(rows, "o_custkey", "o_orderkey").select("o_custkey", "o_orderkey")


@query(
    "f25_metadata_source",
    """SELECT p_partkey, CASE WHEN contains(lower(p_type), 'small') OR p_partkey % 5 = 0 THEN 'capture' WHEN p_partkey % 5 = 1 THEN 'process' ELSE 'unknown' END AS source, p_size % 4 = 1 AS filtered FROM part""",
)
def f25_metadata_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("p_partkey") % 5
    text = F.when(F.lower("p_type").contains("small"), F.concat(F.lit("Capture "), "p_type")).when(at == 0, " CAP ").when(at == 1, "proc").otherwise("x")
    flag = F.when(F.col("p_size") % 4 == 1, " Enabled").when(F.col("p_size") % 4 == 2, "off")
    return table(spark, sf_dir, "part").select("p_partkey", science.metadata_source(text).alias("source"), science.filter_on(flag).alias("filtered"))


@query(
    "f29_compression_mode",
    """SELECT p_partkey, coalesce(c = 3, false) AS compressed, CASE c WHEN 0 THEN 16 WHEN 1 THEN 8 WHEN 2 THEN 12 ELSE CASE WHEN c IS NULL THEN 16 END END AS bit_depth,
       CASE WHEN c IS NULL THEN 'missing' WHEN c > 3 THEN 'unrecognized' END AS warning
FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size & 3 WHEN 1 THEN p_size % 6 END AS c FROM part)""",
)
def f29_compression_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, size = F.col("p_partkey") % 3, F.col("p_size")
    mode = science.compression_mode(F.when(at == 0, size), F.when(at == 1, size % 6))
    rows = table(spark, sf_dir, "part").select("p_partkey", mode.alias("m")).select("p_partkey", "m.*")
    return rows.withColumn("warning", F.regexp_extract("warning", "(missing|unrecognized)", 1))


@query(
    "f27_keyword_exposure",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, round(CASE WHEN l_linenumber = 1 THEN l_discount WHEN l_linenumber = 2 THEN NULL ELSE (l_quantity - (l_returnflag = 'R')::INT) * l_tax / (l_suppkey % 4 + 1) END, 9) AS exposure
FROM lineitem""",
)
def f27_keyword_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    found = science.keyword_exposure(F.when(line == 1, F.col("l_discount")), F.when(line != 2, F.col("l_tax")), F.col("l_quantity"), F.col("l_suppkey") % 4 + 1, F.col("l_returnflag") == "R")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.round(found, 9).alias("exposure"))


@query("f31_au_scale", "SELECT event_id, round(CASE WHEN value > 5 THEN pow(1.496e11 / (value * 1e9), 2) END, 6) AS scale FROM events")
def f31_au_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    metres = F.when(F.col("value") > 5, F.col("value") * 1e9).otherwise(-F.col("value"))
    return events(spark, sf_dir).select("event_id", F.round(science.au_scale(metres), 6).alias("scale"))


@query(
    "f32_disk_scaling",
    IMAGES + """
SELECT image_id, y, x, round(v / CASE WHEN sqrt(pow(x - 30, 2) + pow(y - 33, 2)) <= 1.33 * 960 / 80 THEN 0.035 ELSE 15 END - 20 * pow(2, (-10 - 20) / 5.5), 6) AS v FROM cells""",
)
def f32_disk_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = images(spark, sf_dir).select("image_id", "y", F.posexplode("pixels").alias("x", "v"))
    radius = science.disk_radius(F.lit(960.0), F.lit(80.0))
    return science.scale_disk(cells, (F.lit(30), F.lit(33)), radius, F.lit(-10.0)).withColumn("v", F.round("v", 6))


@query(
    "f33_pointing",
    EVENTS_SQL + """,
q AS (SELECT event_id, event_id % 2 = 0 AS up, us / 1e6 / 3155760000 AS c, value / 500 AS x, (user_id % 10 + 1) / 10.0 AS y, (event_id % 7) / 7.0 AS z, 0.5 AS w FROM e),
n AS (SELECT *, sqrt(x * x + y * y + z * z + w * w) AS l, radians(286.13 + 0.00694 * c) AS ra, radians(63.87 - 0.00272 * c) AS de FROM q),
u AS (SELECT *, x / l AS a, y / l AS b, z / l AS g, w / l AS h FROM n)
SELECT event_id, round(degrees(acos((CASE WHEN up THEN 1 ELSE -1 END) * (2 * (a * b + g * h) * cos(de) * cos(ra) + (1 - 2 * (a * a + g * g)) * cos(de) * sin(ra) + 2 * (b * g - a * h) * sin(de)))), 6) AS angle,
       round(cos(radians(value)), 6) AS pc1_1, -round(sin(radians(value)), 6) AS pc1_2
FROM u JOIN events USING (event_id)""",
)
def f33_pointing(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = [F.col("value") / 500, (F.col("user_id") % 10 + 1) / 10, (F.col("event_id") % 7) / 7, F.lit(0.5)]
    angle = science.pointing_angle(F.col("us") / 1e6 / 3_155_760_000, body, F.col("event_id") % 2 == 0)
    turned = science.rotation_matrix(F.col("value"))
    return events(spark, sf_dir).select("event_id", F.round(angle, 6).alias("angle"), turned["pc1_1"].alias("pc1_1"), turned["pc1_2"].alias("pc1_2"))


@query(
    "a17_deconvolution_report",
    IMAGES + """
SELECT image_id, round(sum(v * 1.5 + x) / sum(v), 9) AS ratio, round(avg(v) FILTER (y BETWEEN 20 AND 29 AND x BETWEEN 20 AND 29), 6) AS dark_before,
       round(avg(v * 1.5 + x) FILTER (y BETWEEN 20 AND 29 AND x BETWEEN 20 AND 29), 6) AS dark_after
FROM cells GROUP BY image_id""",
)
def a17_deconvolution_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = images(spark, sf_dir).select("image_id", "y", F.posexplode("pixels").alias("x", "v"))
    found = science.deconvolution_report(cells, cells.withColumn("v", F.col("v") * 1.5 + F.col("x")), 20, 30)
    return found.select("image_id", F.round("ratio", 9).alias("ratio"), F.round("dark_before", 6).alias("dark_before"), F.round("dark_after", 6).alias("dark_after"))


@query(
    "a18_noise_regions",
    IMAGES + """,
boxes AS (SELECT image_id, i, j, i * 21 + 5 AS y0, j * 21 + 5 AS x0, v FROM cells, unnest(range(3)) AS a(i), unnest(range(3)) AS b(j) WHERE y BETWEEN i * 21 + 5 AND i * 21 + 14 AND x BETWEEN j * 21 + 5 AND j * 21 + 14)
SELECT image_id, i::INT AS i, j::INT AS j, (y0 + 5)::INT AS centre_y, (x0 + 5)::INT AS centre_x, round(stddev_pop(v), 6) AS std, round(mad(v) * 1.4826, 6) AS sigma FROM boxes GROUP BY ALL""",
)
def a18_noise_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = science.noise_regions(images(spark, sf_dir), SIDE, SIDE, 9, 10)
    return found.withColumn("std", F.round("std", 6)).withColumn("sigma", F.round("sigma", 6))


@query("i7_deconvolution", IMAGES + " SELECT image_id, y, x, CASE WHEN x IN (0, 63) THEN 0 ELSE v::DOUBLE END AS v FROM cells")
def i7_deconvolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images with dark sides, blurred by a spread of three pixels in a row and brought back: the oracle has them as they were."""
    psf = np.array([[0.0, 0.0, 0.0], [0.15, 0.8, 0.05], [0.0, 0.0, 0.0]])
    at = lambda i: F.when(i.between(1, SIDE - 2), F.get("pixels", i)).otherwise(0)
    spread = F.transform(F.sequence(F.lit(0), F.lit(SIDE - 1)), lambda i: 0.15 * at(i + 1) + 0.8 * at(i) + 0.05 * at(i - 1))
    rows = images(spark, sf_dir)
    found = science.deconvolve(rows.withColumn("pixels", spread), psf, SIDE, SIDE).join(rows.select("image_id", "y"), ["image_id", "y"], "left_semi")
    return found.select("image_id", "y", F.posexplode("pixels").alias("x", "v")).withColumn("v", F.abs(F.round("v", 3)))


@query("i7_scatter_around", IMAGES + " SELECT image_id, y, x, v::DOUBLE AS v FROM cells")
def i7_scatter_around(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images scattered around their edges by a function whose core is set, and brought back without padding."""
    kernel = science.scatter_kernel(np.array([[0.0, 0.0, 0.0], [0.06, 0.5, 0.04], [0.0, 0.0, 0.0]]))
    left, core, right = (float(x) for x in kernel[1])
    at = lambda i: F.get("pixels", F.pmod(i, F.lit(SIDE)))
    spread = F.transform(F.sequence(F.lit(0), F.lit(SIDE - 1)), lambda i: left * at(i + 1) + core * at(i) + right * at(i - 1))
    rows = images(spark, sf_dir)
    found = science.deconvolve(rows.withColumn("pixels", spread), kernel, SIDE, SIDE, padded=False).join(rows.select("image_id", "y"), ["image_id", "y"], "left_semi")
    return found.select("image_id", "y", F.posexplode("pixels").alias("x", "v")).withColumn("v", F.abs(F.round("v", 3)))


@query("i7_archive_chain", IMAGES + " SELECT image_id, y, x, CASE WHEN x IN (0, 1, 62, 63) THEN 0 ELSE v::DOUBLE END AS v FROM cells")
def i7_archive_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images with dark sides, scattered around their edges, then diffracted by two wavelengths, and brought back by the
    whole chain from planes that are larger than the images."""
    across, tall = F.sequence(F.lit(0), F.lit(SIDE - 1)), SIDE + 32
    kernel = science.scatter_kernel(np.array([[0.0, 0.0, 0.0], [0.06, 0.5, 0.04], [0.0, 0.0, 0.0]]))
    left, core, right = (float(x) for x in kernel[1])
    dark = F.transform(across, lambda i: F.when(i.between(2, SIDE - 3), F.get("pixels", i)).otherwise(0))
    around = F.transform(across, lambda i: left * F.get("d", F.pmod(i + 1, F.lit(SIDE))) + core * F.get("d", i) + right * F.get("d", F.pmod(i - 1, F.lit(SIDE))))
    beside = lambda i: F.coalesce(F.when(i >= 0, F.get("s", i)), F.lit(0.0))
    spread = F.transform(across, lambda i: 0.1 * beside(i + 1) + 0.75 * beside(i) + 0.15 * beside(i - 1))
    rows = images(spark, sf_dir)
    seen = rows.withColumn("d", dark).withColumn("s", around).select("image_id", "y", spread.alias("pixels"))

    def plane(height: int, left: float, core: float, right: float) -> DataFrame:
        middle = F.transform(across, lambda i: F.when(i == SIDE // 2 - 1, left).when(i == SIDE // 2, core).when(i == SIDE // 2 + 1, right).otherwise(0.0))
        return spark.range(height).select(F.col("id").cast("int").alias("y"), F.when(F.col("id") == height // 2, middle).otherwise(F.array_repeat(F.lit(0.0), SIDE)).alias("pixels"))

    planes = plane(tall, 0.0, 0.2, 0.05).withColumn("bin", F.lit(0)).unionByName(plane(tall, 0.1, 0.15, 0.0).withColumn("bin", F.lit(1)))
    weights = spark.createDataFrame([(0, 3.0), (1, 1.0)], "bin int, weight double")
    found = science.archive_deconvolution(seen, planes, weights, (tall, SIDE), plane(SIDE, 0.06, 0.5, 0.04), (SIDE, SIDE), SIDE, SIDE, tall)
    held = found.join(rows.select("image_id", "y"), ["image_id", "y"], "left_semi")
    return held.select("image_id", "y", F.posexplode("pixels").alias("x", "v")).withColumn("v", F.abs(F.round("v", 3)))


@query(
    "b11_compressed_streams",
    "WITH " + PACKETS_SQL.strip() + """,
chunks AS (SELECT user_id::BIGINT AS image_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS sequence, event_id, CASE WHEN event_id % 9 = 0 THEN 'ffd8' WHEN event_id % 9 = 5 THEN 'ffd9' ELSE '' END || hex AS payload FROM packets)
SELECT image_id, count(*) AS n, max(sequence) + 1 - count(*) AS missing, string_agg(payload, '' ORDER BY sequence) AS stream FROM chunks WHERE sequence % 6 <> 4 GROUP BY image_id""",
)
def b11_compressed_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks come twice, the second time with a failed checksum and other bytes."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    mark = F.when(F.col("event_id") % 9 == 0, "ffd8").when(F.col("event_id") % 9 == 5, "ffd9").otherwise("")
    good = packets(spark, sf_dir).select(F.col("user_id").alias("image_id"), place.alias("sequence"), F.lit("valid").alias("checksum_status"), F.lit(0).alias("arrival"), F.unhex(F.concat(mark, F.hex("packet"))).alias("payload"))
    good = good.filter("sequence % 6 <> 4")
    bad = good.withColumns({"checksum_status": F.lit("failed"), "arrival": F.lit(1), "payload": F.unhex(F.lit("00"))})
    return science.compressed_streams(good.unionByName(bad)).select("image_id", "n", "missing", F.lower(F.hex("stream")).alias("stream"))


CHAIN_SQL = "WITH " + PACKETS_SQL.strip() + """,
w AS (SELECT event_id, user_id::BIGINT AS capture_id, hex, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM packets),
marked AS (SELECT *, CASE WHEN n % 7 = 0 OR n % 7 = 1 OR n = 1 THEN 1 ELSE 0 END AS start FROM w),
numbered AS (SELECT *, sum(start) OVER (PARTITION BY capture_id ORDER BY n) AS chain FROM marked)"""


@query("b5_unwrapped_chains", CHAIN_SQL + ' SELECT capture_id, (min(n) * 20 + min(n) // 7 * 5)::BIGINT AS "offset", count(*) AS wrappers, string_agg(substr(hex, 33), \'\' ORDER BY n) AS payload FROM numbered GROUP BY capture_id, chain HAVING count(*) >= 2')
def b5_unwrapped_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrappers one behind the other, with a gap before and a wrong count after every seventh."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = packets(spark, sf_dir).select(F.col("user_id").alias("capture_id"), n.alias("n"), "packet")
    rows = rows.select("capture_id", (F.col("n") * 20 + F.expr("n div 7") * 5).cast("long").alias("offset"), F.lit(20).alias("packet_length"), ((F.col("n") + F.when(F.col("n") % 7 == 0, 5).otherwise(0)) % 16384).alias("sequence_count"), "packet")
    return recovery.unwrap_chains(rows).select("capture_id", "offset", "wrappers", F.lower(F.hex("payload")).alias("payload"))


@query(
    "p12_matching_fields",
    """
WITH fields AS (SELECT DISTINCT 'adcs_motor' || p_size % 3 || '_temp' AS field FROM part UNION SELECT DISTINCT lower(replace(p_name, ' ', '_')) || '_TEMP' FROM part),
found AS (SELECT field, CASE WHEN contains(lower(field), 'red') THEN 0 WHEN contains(lower(field), 'adcs') AND contains(field, 'motor') AND contains(field, '1') THEN 1 WHEN contains(lower(field), 'a') AND NOT starts_with(field, 'zz') THEN 2 END AS k FROM fields)
SELECT field, (row_number() OVER (ORDER BY k, field) - 1)::INT AS position FROM found WHERE k IS NOT NULL""",
)
def p12_matching_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    one = parts.select(F.concat(F.lit("adcs_motor"), F.col("p_size") % 3, F.lit("_temp")).alias("field"))
    fields = one.union(parts.select(F.concat(F.lower(F.replace("p_name", F.lit(" "), F.lit("_"))), F.lit("_TEMP")))).distinct()
    return quality.matching_fields(fields, ["red", "ADCS", "a"])


@query(
    "q6_header_rows",
    """
WITH groups AS (SELECT n_nationkey AS ordinal, 'v' || n_nationkey AS variable, 'group ' || n_nationkey % 3 AS grp, upper(n_name) AS keyword, n_name AS description, CASE WHEN n_regionkey > 1 THEN 'u' || n_regionkey END AS units FROM nation),
held AS (SELECT c_custkey % 20 AS image, g.*, max(c_name) AS value FROM customer JOIN groups g ON variable = 'v' || c_nationkey GROUP BY ALL),
lines AS (
    SELECT image, grp, ordinal::DOUBLE AS ordinal, keyword, value, description || coalesce(' (' || units || ')', '') AS comment FROM held
    UNION ALL SELECT DISTINCT image, grp, -1, 'COMMENT', repeat('-', 32) || grp || repeat('-', 33), NULL FROM held)
SELECT image, (row_number() OVER (PARTITION BY image ORDER BY grp, ordinal) + 6)::INT AS position, keyword, value, comment FROM lines""",
)
def q6_header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, region = F.col("n_nationkey"), F.col("n_regionkey")
    groups = table(spark, sf_dir, "nation").select(
        at.alias("ordinal"), F.concat(F.lit("v"), at).alias("variable"), F.concat(F.lit("group "), at % 3).alias("grp"), F.upper("n_name").alias("keyword"), F.col("n_name").alias("description"), F.when(region > 1, F.concat(F.lit("u"), region)).alias("units")
    )
    values = table(spark, sf_dir, "customer").groupBy((F.col("c_custkey") % 20).alias("image"), F.concat(F.lit("v"), "c_nationkey").alias("variable")).agg(F.max("c_name").alias("value"))
    return quality.header_rows(groups, values)


@query(
    "q9_definition_problems",
    """
WITH v AS (SELECT DISTINCT o_custkey AS file, o_orderpriority AS variable FROM orders),
f AS (SELECT DISTINCT file FROM v),
r AS (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM']) AS name)
SELECT file, coalesce(list_sort(list(name) FILTER (name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM v WHERE v.file = f.file AND v.variable = name))), [])::VARCHAR AS missing,
       EXISTS (SELECT 1 FROM v WHERE v.file = f.file AND v.variable = '5-LOW') AS obsolete
FROM f, r GROUP BY file""",
)
def q9_definition_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    variables = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("file"), F.col("o_orderpriority").alias("variable")).distinct()
    required = spark.createDataFrame([("1-URGENT",), ("2-HIGH",), ("3-MEDIUM",)], "name string")
    found = quality.definition_problems(variables, required, {"5-LOW": "4-LOW"}, "file")
    return found.select("file", F.concat(F.lit("["), F.array_join("missing", ", "), F.lit("]")).alias("missing"), F.col("obsolete").isNotNull().alias("obsolete"))


@query(
    "q8_run_manifest",
    """
SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0)::BIGINT AS inputs,
       (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 1 AND o_orderstatus <> 'O')::BIGINT AS outputs, 'completed' AS status, '<redacted>' AS secret, 12.5::DOUBLE AS seconds""",
)
def q8_run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of a run over some orders as files; those of status F are new and those of P changed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("path"), F.col("o_totalprice").alias("size"), F.unix_micros("o_orderdate").alias("mtime"), "o_orderstatus")
    inputs = orders.filter("o_orderkey % 50 = 0").withColumn("sha256", F.sha2(F.col("path").cast("binary"), 256))
    after = orders.filter("o_orderkey % 50 = 1")
    before = after.filter("o_orderstatus <> 'F'").withColumn("mtime", F.when(F.col("o_orderstatus") == "P", F.col("mtime") - 1).otherwise(F.col("mtime")))
    settings = spark.createDataFrame([("api-token", "x"), ("level", "1")], "name string, value string")
    made = quality.run_manifest(before, after, inputs, settings, started=10.0, ended=22.5)
    shape = "inputs array<struct<path:string>>, outputs array<struct<path:string,change:string>>, settings map<string,string>, status string, duration_seconds double"
    m = made.select(F.from_json("manifest", shape).alias("m"))
    return m.select(F.size("m.inputs").cast("long").alias("inputs"), F.size("m.outputs").cast("long").alias("outputs"), "m.status", F.col("m.settings")["api-token"].alias("secret"), F.col("m.duration_seconds").alias("seconds"))


@query("f22_cell_texts", "SELECT event_id, lower(hex(encode(event_type))) AS raw, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS at, '[' || user_id || ',' || event_id || ']' AS nested FROM events")
def f22_cell_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, nested = F.col("event_type").cast("binary"), F.array("user_id", "event_id")
    return events(spark, sf_dir).select("event_id", status.cell_text(raw, "binary").alias("raw"), status.cell_text(F.col("ts"), "timestamp").alias("at"), status.cell_text(nested, "array<bigint>").alias("nested"))


@query("f39_described_units", "SELECT n_nationkey, n_name || CASE WHEN n_regionkey > 1 THEN ' (u' || n_regionkey || ')' ELSE '' END AS comment FROM nation")
def f39_described_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = F.when(F.col("n_regionkey") > 1, F.concat(F.lit("u"), "n_regionkey"))
    return table(spark, sf_dir, "nation").select("n_nationkey", quality.with_units(F.col("n_name"), units).alias("comment"))


def received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as received packets: some not decoded, some with a failed checksum or a wild time, with their fields as a map."""
    at = F.col("event_id")
    state_of = F.when(at % 5 == 0, "no_decoder").when(at % 7 == 0, "decode_failed").otherwise("decoded")
    fields = F.create_map(F.lit("beac_mode_system_mode"), (at % 5).cast("string"), F.lit("beac_eps_pwr_state_uhf"), F.when(at % 2 == 0, "on").otherwise("0"))
    return events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_type") == "view", "Beacon").otherwise(F.col("event_type")).alias("packet_name"),
        state_of.alias("status"),
        F.when(at % 11 == 0, "failed").when(at % 3 == 0, "valid").alias("checksum_status"),
        F.when(at % 13 == 0, "jump").alias("reject_reason"),
        fields.alias("fields"),
        F.array_repeat(F.lit("limit"), (at % 8).cast("int")).alias("filter_reasons"),
        F.col("us").alias("received_time"),
        clock.spacecraft_seconds(F.col("us") / 1e6).alias("packet_time"),
    )


RECEIVED = EVENTS_SQL + """,
r AS (SELECT *, CASE event_type WHEN 'view' THEN 'Beacon' ELSE event_type END AS packet_name, CASE WHEN event_id % 5 = 0 THEN 'no_decoder' WHEN event_id % 7 = 0 THEN 'decode_failed' ELSE 'decoded' END AS status FROM e)"""


@query(
    "a19_counters",
    RECEIVED + """ SELECT packet_name, count(*) AS seen, count(*) FILTER (status = 'decoded') AS decoded, count(*) FILTER (status = 'no_decoder') AS no_decoder, count(*) FILTER (status = 'decode_failed') AS failed,
       count(*) FILTER (event_id % 11 = 0) AS checksum_failed, count(*) FILTER (event_id % 13 = 0) AS time_rejected FROM r GROUP BY packet_name""",
)
def a19_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.counters(received(spark, sf_dir))


@query(
    "st7_beacon_states",
    RECEIVED + """,
b AS (SELECT event_id % 5 AS mode, event_id % 2 = 0 AS uhf, us FROM r WHERE packet_name = 'Beacon' AND status = 'decoded' ORDER BY us DESC LIMIT 1)
SELECT position::INT AS position, label, CASE position WHEN 0 THEN mode::VARCHAR WHEN 2 THEN CASE WHEN uhf THEN 'on' ELSE '0' END END AS value,
       CASE position WHEN 0 THEN ['red', 'yellow', 'green', 'green', 'unknown'][mode + 1] WHEN 2 THEN CASE WHEN uhf THEN 'on' ELSE 'off' END ELSE 'unknown' END AS state, us AS received_time
FROM b, (VALUES (0, 'CDH'), (1, 'ADCS'), (2, 'UHF'), (3, 'X-Band'), (4, 'CSIE'), (5, 'DSPS')) AS l(position, label)""",
)
def st7_beacon_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.beacon_states(received(spark, sf_dir)).drop("field")


@query("st9_onboard_clock", EVENTS_SQL + " SELECT strftime(make_timestamp(arg_max(us, us) // 1000 * 1000 + 0), '%Y-%m-%d') AS day FROM e WHERE event_id % 13 <> 0")
def st9_onboard_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.onboard_clock(received(spark, sf_dir), ["received_time"]).select(F.substring("onboard_utc", 1, 10).alias("day"))


@query("st10_last_packet", RECEIVED + " SELECT event_id, packet_name, status, CASE WHEN event_id % 13 = 0 THEN 'rejected' ELSE 'accepted' END AS time_status, least(event_id % 8, 5)::INT AS reasons FROM r ORDER BY us DESC, event_id DESC LIMIT 1")
def st10_last_packet(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = state.last_packet(received(spark, sf_dir), ["received_time", "event_id"])
    return last.select("event_id", "packet_name", "status", "time_status", F.size("filter_reasons").alias("reasons"))


@query("o4_first_reasons", "SELECT event_id, least(event_id % 8, 5)::INT AS reasons FROM events")
def o4_first_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return received(spark, sf_dir).select("event_id", F.size(F.slice("filter_reasons", 1, 5)).alias("reasons"))


@query("st12_without_failed", "SELECT event_id FROM events WHERE event_id % 11 <> 0")
def st12_without_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.without_failed(received(spark, sf_dir)).select("event_id")


@query(
    "st13_cleared_history",
    EVENTS_SQL + ", c AS (SELECT max(us) AS cleared FROM e WHERE event_type = 'error' AND event_id % 40 = 0) SELECT event_type AS field, count(*) AS points, arg_max(value, us) AS latest FROM e, c WHERE cleared IS NULL OR us > cleared GROUP BY event_type",
)
def st13_cleared_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History and latest values after the last clearing, which some events stand for."""
    rows = events(spark, sf_dir)
    held = state.since_clear(rows, rows.filter("event_type = 'error' and event_id % 40 = 0"), "us")
    return held.groupBy(F.col("event_type").alias("field")).agg(F.count("*").alias("points"), F.max_by("value", "us").alias("latest"))


@query("st6_staleness", EVENTS_SQL + " SELECT user_id, (SELECT max(us) FROM e) // 1000000 - max(us) // 1000000 AS age, (SELECT max(us) FROM e) // 1000000 - max(us) // 1000000 > 3600 AS stale FROM e GROUP BY user_id")
def st6_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    newest = series.latest(rows.select("user_id", F.expr("us div 1000000").alias("received")), ["user_id"], ["received"])
    now = rows.agg(F.max(F.expr("us div 1000000"))).first()[0]
    return state.with_staleness(newest, now, 3600).select("user_id", "age", "stale")


def image_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams of four images each: metadata and rows; some rows of unknown images, some of a wrong length, some metadata
    of impossible size. Every other stream has its 32-bit words reversed."""
    payload = F.array_join(F.transform("pixels", lambda v: F.format_string("%04X", v)), "")
    rows = images(spark, sf_dir).withColumn("h", F.when((F.col("image_id") + F.col("y")) % 13 == 0, F.substring(payload, F.lit(1), F.lit(248))).otherwise(payload))
    named = F.col("image_id") + F.when(F.col("y") % 9 == 4, 1_000_000).otherwise(0)
    row = F.concat(F.format_string("0A18%04X%04X%08X0000", F.lit(0xC000) + F.col("y"), (F.length("h") / 2).cast("int") + 9, named), F.col("h"), F.lit("00000000"))
    size = F.when(F.col("image_id") % 5 == 3, 3_000).otherwise(64)
    meta = F.format_string("0A1AC0000011%08X%04X%04X%020X", F.col("image_id"), size, F.lit(64), F.lit(0))
    own = F.concat(F.when(F.col("y") == 0, meta).otherwise(F.lit("")), F.repeat(F.lit("55555555"), (F.col("y") % 3).cast("int")), row)
    parts = rows.groupBy(F.expr("image_id div 4").alias("capture_id")).agg(F.array_sort(F.collect_list(F.struct("image_id", "y", own.alias("h")))).alias("p"))
    stream = F.unhex(F.array_join(F.col("p.h"), ""))
    return parts.select("capture_id", F.when(F.col("capture_id") % 2 == 1, bits.reverse_words(stream, 4)).otherwise(stream).alias("content"))


def image_metadata(packet: Column) -> dict[str, Column]:
    """The fields of those metadata packets."""
    return {"image_id": bits.unsigned(packet, 6, 4), "roi_rows": bits.unsigned(packet, 10, 2), "roi_cols": bits.unsigned(packet, 12, 2), "n_cols": bits.unsigned(packet, 12, 2), "status": F.lit("decoded")}


@query(
    "b9_image_records",
    IMAGES + """,
sent AS (SELECT image_id // 4 AS capture_id, image_id, y, (image_id + y) % 13 = 0 AS short, CASE WHEN y = 0 THEN 24 ELSE 0 END AS meta, y % 3 * 4 AS fill FROM images),
placed AS (SELECT *, meta + fill + CASE WHEN short THEN 140 ELSE 144 END AS size FROM sent),
ended AS (SELECT *, sum(size) OVER (PARTITION BY capture_id ORDER BY image_id, y)::BIGINT AS stop FROM placed),
records AS (SELECT capture_id, 'metadata' AS kind, image_id, stop - size AS "offset" FROM ended WHERE y = 0 AND image_id % 5 <> 3
            UNION ALL SELECT capture_id, 'row', image_id, stop - CASE WHEN short THEN 140 ELSE 144 END FROM ended e
            WHERE NOT short AND y % 9 <> 4 AND image_id % 5 <> 3 AND EXISTS (SELECT 1 FROM images i WHERE i.image_id = e.image_id AND i.y = 0))
SELECT capture_id, CASE WHEN capture_id % 2 = 1 THEN 'word32' ELSE 'plain' END AS view, kind, image_id, "offset",
       sum(CASE kind WHEN 'metadata' THEN 10 ELSE 1 END) OVER (PARTITION BY capture_id)::BIGINT AS score FROM records""",
)
def b9_image_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From bytes in pieces of 1,000 to the records of the better byte order."""
    pieces = packetizer.pieces_of(image_streams(spark, sf_dir), 1_000)
    return image_scan.scan_records(pieces, image_metadata, meta_bytes=24).select("capture_id", "view", "kind", "image_id", "offset", "score")
