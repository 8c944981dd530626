"""Queries that write files from the given tables and read them back as an ingest does."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators import limits, packets as packet_ops, quality
from perigee.plans.base import query
from perigee.plans.fixtures import PACKETS_SQL, packets, table
from perigee.sources import files
from perigee.sources.scratch import shared_folder, written

NAMES = {1: "view", 16: "click", 35: "signup", 536: "purchase", 538: "error"}


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


LISTING_SQL = """
listing AS (
    SELECT o_orderkey, o_custkey, o_orderdate AS modified, o_orderkey % 7 AS n,
           CASE o_orderkey % 5 WHEN 0 THEN 'csie_' || o_orderkey || '.bin' WHEN 1 THEN 'csie_merged.bin' WHEN 2 THEN 'note.txt'
                WHEN 3 THEN printf('ccsds_2024_%03d_01_02_%02d', (o_orderkey % 366)::INT, (o_orderkey % 60)::INT) ELSE 'uhf_' || o_orderkey END AS name
    FROM orders)"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of files, one for each order, in a folder for each customer."""
    key = F.col("o_orderkey")
    name = (
        F.when(key % 5 == 0, F.concat(F.lit("csie_"), key, F.lit(".bin")))
        .when(key % 5 == 1, "csie_merged.bin")
        .when(key % 5 == 2, "note.txt")
        .when(key % 5 == 3, F.format_string("ccsds_2024_%03d_01_02_%02d", key % 366, key % 60))
        .otherwise(F.concat(F.lit("uhf_"), key))
    )
    path = F.concat(F.lit("/captures/"), "o_custkey", F.lit("/"), name)
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("modified"), path.alias("path"))


@query("s1_prefixed_captures", f"WITH {LISTING_SQL} SELECT o_orderkey, name FROM listing WHERE starts_with(name, 'csie_') AND name <> 'csie_merged.bin'")
def s1_prefixed_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.prefixed_captures(listing(spark, sf_dir), "csie_", ["csie_merged.bin"]).select("o_orderkey", "name")


@query(
    "s2_capture_order",
    f"""WITH {LISTING_SQL} SELECT o_orderkey, row_number() OVER (ORDER BY NOT starts_with(name, 'ccsds_'), CASE WHEN starts_with(name, 'ccsds_') THEN name END, name, o_orderkey) - 1 AS position
FROM listing""",
)
def s2_capture_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packet_ops.number_rows(files.capture_order(listing(spark, sf_dir)), ["sort_key", "o_orderkey"], "position").select("o_orderkey", "position")


@query(
    "s3_input_modes",
    f"""WITH {LISTING_SQL}, kinds AS (
    SELECT o_custkey, list_sort(list(DISTINCT CASE WHEN starts_with(name, 'csie_') THEN 'direct' WHEN starts_with(name, 'ccsds_') THEN 'uhf' END)
               FILTER (starts_with(name, 'csie_') OR starts_with(name, 'ccsds_'))) AS kinds FROM listing GROUP BY o_custkey)
SELECT o_custkey, CASE WHEN len(kinds) = 1 THEN kinds[1] END AS mode, CASE WHEN coalesce(len(kinds), 0) = 0 THEN 'none' WHEN len(kinds) > 1 THEN 'ambiguous' END AS error FROM kinds""",
)
def s3_input_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = files.base_name(F.col("path"))
    kind = F.when(name.startswith("csie_"), "direct").when(name.startswith("ccsds_"), "uhf")
    return files.input_modes(listing(spark, sf_dir).withColumn("kind", kind), "o_custkey", "kind")


@query(
    "s15_current_products",
    """SELECT o_custkey, coalesce(min(o_orderdate) FILTER (o_orderkey % 3 <> 0) >= max(o_orderdate) FILTER (o_orderkey % 3 = 0), false) AS current FROM orders GROUP BY o_custkey""",
)
def s15_current_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.products_current(listing(spark, sf_dir).withColumn("is_input", F.col("o_orderkey") % 3 == 0), "o_custkey")


def decoded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets(spark, sf_dir).select("apid", F.col("event_type").alias("packet_name"), "event_id", "user_id", "value")


@query("s5_decoded_tables", "WITH " + PACKETS_SQL.strip() + " SELECT apid, event_type AS packet_name, event_id, user_id::BIGINT AS user_id, value FROM packets")
def s5_decoded_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "decoded")
    files.write_decoded(decoded_rows(spark, sf_dir), folder)
    parts = [rows.select(F.lit(apid).alias("apid"), F.lit(name).alias("packet_name"), F.col("event_id").cast("long"), F.col("user_id").cast("long"), F.col("value").cast("double")) for apid, (name, rows) in files.decoded_tables(spark, folder).items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("s7_stale_outputs", "WITH " + PACKETS_SQL.strip() + " SELECT apid, count(*) AS rows FROM packets WHERE event_type <> 'error' GROUP BY apid")
def s7_stale_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run has no packets of one APID, and nothing of it is left."""
    folder, rows = new_folder(spark, "outputs"), decoded_rows(spark, sf_dir)
    files.write_decoded(rows, folder)
    files.write_decoded(rows.filter("packet_name <> 'error'"), folder)
    again = spark.read.option("header", True).option("recursiveFileLookup", True).csv(folder)
    apid = F.regexp_extract(F.input_file_name(), files.DECODED_NAME, 1).cast("int")
    return again.select(apid.alias("apid")).groupBy("apid").agg(F.count("*").alias("rows"))


@query(
    "s6_column_order",
    """
WITH cells AS (SELECT l_returnflag AS apid, l_orderkey AS packet_index, l_linenumber AS ordinal, 'f' || l_suppkey % 12 AS field FROM lineitem),
first AS (SELECT apid, field, min((packet_index, ordinal)) AS first FROM cells GROUP BY apid, field)
SELECT apid, field, (row_number() OVER (PARTITION BY apid ORDER BY CASE field WHEN 'f7' THEN 1 WHEN 'f2' THEN 2 ELSE 3 END, first, field) - 1)::INT AS position FROM first""",
)
def s6_column_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("apid"), F.col("l_orderkey").alias("packet_index"), F.col("l_linenumber").alias("ordinal"), F.concat(F.lit("f"), F.col("l_suppkey") % 12).alias("field"))
    return files.column_order(cells, ["f7", "f2"])


@query(
    "s8_packet_manifest",
    "WITH " + PACKETS_SQL.strip() + """
SELECT row_number() OVER (ORDER BY event_id) - 1 AS packet_index, apid, coalesce(CASE apid WHEN 1 THEN 'beacon' WHEN 16 THEN 'sw_stat' END, 'apid_' || apid) AS packet_name,
       20 AS packet_len, (event_id % 16384)::INT AS sequence_count, count(*) OVER (PARTITION BY hex) AS duplicate_group_size,
       CASE WHEN apid IN (1, 16) THEN 'dictionary' ELSE 'none' END AS decoder_kind, CASE WHEN apid IN (1, 16) THEN 'decoded' ELSE 'no_decoder' END AS decode_status,
       CASE WHEN apid IN (1, 16) THEN 'decoded_apid_' || apid || '_' || CASE apid WHEN 1 THEN 'beacon' ELSE 'sw_stat' END || '.csv' END AS decoded_csv
FROM packets""",
)
def s8_packet_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.createDataFrame([(1, "beacon"), (16, "sw_stat")], "apid int, packet_name string")
    numbered = packet_ops.number_rows(packets(spark, sf_dir), ["event_id"])
    return packet_ops.manifest(numbered, names, decoders={"beacon": "dictionary", "sw_stat": "dictionary"})


@query("s11_packet_names", "SELECT (p_partkey % 40)::INT AS apid, arg_min(p_brand, p_partkey) AS packet_name FROM part WHERE p_partkey % 10 <> 3 GROUP BY 1")
def s11_packet_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary files in order of part keys, with numbers and words for APIDs; the first of each number wins."""
    folder = new_folder(spark, "dictionary")
    apid = F.when(F.col("p_partkey") % 10 == 3, F.concat(F.lit("x"), "p_partkey")).otherwise((F.col("p_partkey") % 40).cast("string"))
    table(spark, sf_dir, "part").orderBy("p_partkey").select(F.col("p_brand").alias("Name"), apid.alias("APID")).write.option("header", True).csv(folder)
    return files.packet_names(files.ordered_csv(spark, folder, ["APID", "Name"]))


@query(
    "s12_field_definitions",
    """
WITH rows AS (SELECT l_suppkey % 5 AS apid, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ordinal, 'f' || l_partkey AS name, l_linenumber AS width FROM lineitem WHERE l_orderkey % 20 = 0)
SELECT apid::INT AS apid, ordinal::INT AS ordinal, name, 'U' || width AS data_type, (sum(width) OVER (PARTITION BY apid ORDER BY ordinal) - width)::INT AS bit_offset FROM rows""",
)
def s12_field_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of definition files in their order, which is the order of bits, from the first file to the last."""
    folder, order = new_folder(spark, "definitions"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = table(spark, sf_dir, "lineitem").filter("l_orderkey % 20 = 0").orderBy(*order)
    rows = rows.select((F.col("l_suppkey") % 5).alias("APID"), F.concat(F.lit("f"), "l_partkey").alias("ItemName"), F.concat(F.lit("U"), "l_linenumber").alias("DataType"))
    rows.write.option("header", True).csv(folder)
    read = files.ordered_csv(spark, folder, ["APID", "ItemName", "DataType"])
    read = packet_ops.number_rows(read, ["file", "ordinal"], "ordinal", start=1).withColumn("ordinal", F.col("ordinal").cast("int"))
    fields = read.select(F.col("APID").cast("int").alias("apid"), "ordinal", F.col("ItemName").alias("name"), F.col("DataType").alias("data_type"))
    return packet_ops.field_layout(fields).select("apid", "ordinal", "name", "data_type", "bit_offset")


@query(
    "s13_limit_files",
    """
WITH nodes AS (SELECT c_custkey, 'u' || c_custkey % 7 AS item, (c_nationkey * 12)::DOUBLE AS rh, CASE WHEN c_custkey % 3 <> 0 THEN (c_nationkey + 0.5)::DOUBLE END AS yl FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 < 4),
bands AS (SELECT item, arg_max((rh, yl), c_custkey) AS b FROM nodes GROUP BY item),
judged AS (SELECT event_id, value, b IS NOT NULL AS has, struct_extract(b, 1) AS rh, struct_extract(b, 2) AS yl, user_id % 7 AS u FROM events LEFT JOIN bands ON item = 'u' || user_id % 7)
SELECT event_id,
       CASE WHEN has THEN CASE WHEN value > rh THEN 'red' WHEN value < yl THEN 'yellow' ELSE 'green' END WHEN u = 5 AND value > 100 THEN 'yellow' ELSE 'unknown' END AS limit_state,
       CASE WHEN has THEN CASE WHEN value > rh THEN 'value > red high (' || printf('%g', rh) || ')' WHEN value < yl THEN 'value < yellow low (' || printf('%g', yl) || ')' ELSE 'within green range' END
            WHEN u = 5 AND value > 100 THEN 'value > 100' WHEN u = 5 THEN 'no value rule matched' ELSE 'no color limit configured' END AS limit_reason
FROM judged""",
)
def s13_limit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits in XML files made from customers: bands with missing limits, disabled nodes, one value rule."""
    folder, key = new_folder(spark, "limits"), F.col("c_custkey")
    low = F.when(key % 3 != 0, F.concat(F.lit(' yl="'), F.col("c_nationkey") + 0.5, F.lit('"'))).otherwise(F.lit(' yl="none"'))
    off = F.when(key % 5 == 0, F.lit(' enabled="false"')).otherwise(F.lit(""))
    node = F.concat(F.lit('<monitorRedYellow item="u'), key % 7, F.lit('" rh="'), F.col("c_nationkey") * 12, F.lit('"'), low, off, F.lit("/>"))
    nodes = table(spark, sf_dir, "customer").filter(key % 7 < 4).select(key.alias("place"), node.alias("value"))
    more = ['<monitorValue item="u5" operator="&gt;" value="100" color="Yellow"/>', '<monitorValue item="u5" operator="==" value="x" color="red"/>', '<monitorValue item="" value="1" color="red"/>']
    last = 1 << 60
    around = [(-1, "<limits>"), *[(last + i, x) for i, x in enumerate(more)], (last + len(more), "</limits>")]
    lines = nodes.union(spark.createDataFrame(around, "place long, value string"))
    lines.repartition(1).sortWithinPartitions("place").select("value").write.text(folder)
    points = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("u"), F.col("user_id") % 7).alias("field"), "value")
    return limits.evaluate_limits(points, *limits.limit_rules(spark, folder)).select("event_id", "limit_state", "limit_reason")


@query("s14_metadata_definitions", "SELECT 'n' || n_nationkey AS name, 'group ' || (n_nationkey // 5) AS grp FROM nation WHERE n_nationkey % 5 <> 0")
def s14_metadata_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A definition file with a comment line before each group, scanned in its order."""
    folder, at = new_folder(spark, "metadata"), F.col("n_nationkey")
    first = F.when(at % 5 == 0, "COMMENT").otherwise(F.concat(F.lit("n"), at))
    second = F.when(at % 5 == 0, F.concat(F.lit("COMMENT--- group "), F.expr("n_nationkey div 5"), F.lit(" ---"))).otherwise(F.col("n_name"))
    table(spark, sf_dir, "nation").orderBy("n_nationkey").select(first.alias("Name"), second.alias("Text")).coalesce(1).write.option("header", True).csv(folder)
    read = files.ordered_csv(spark, folder, ["Name", "Text"])
    held = quality.grouped_definitions(read.select("ordinal", F.col("Name").alias("field"), F.col("Text").alias("description")))
    return held.select(F.col("field").alias("name"), F.col("group").alias("grp"))


@query("s16_reloaded_packets", "WITH " + PACKETS_SQL.strip() + " SELECT event_id, apid, hex AS packet FROM packets")
def s16_reloaded_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = written(packets(spark, sf_dir).select("event_id", "apid", "packet"), "reloaded")
    return again.select("event_id", "apid", F.lower(F.hex("packet")).alias("packet"))


@query("x4_sql_over_views", "WITH " + PACKETS_SQL.strip() + " SELECT a.user_id::BIGINT AS user_id, count(*) AS pairs FROM packets a JOIN packets b ON a.apid = 1 AND b.apid = 16 AND a.user_id = b.user_id GROUP BY 1")
def x4_sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packets(spark, sf_dir)
    files.register_views(spark, {apid: (name, rows.filter(F.col("apid") == apid)) for apid, name in NAMES.items()})
    return spark.sql("SELECT a.user_id, count(*) AS pairs FROM apid_1 a JOIN apid_16 b ON a.user_id = b.user_id GROUP BY a.user_id")
