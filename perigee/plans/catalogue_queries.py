"""Queries over the store, catalogues and listings made from the star schema and events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators import quality, store
from perigee.plans.base import query
from perigee.plans.fixtures import table
from perigee.sources.scratch import shared_folder

PRIORITY_FIELDS = "SELECT DISTINCT o_orderstatus AS apid, o_orderpriority AS field FROM orders UNION SELECT DISTINCT l_linestatus, l_returnflag FROM lineitem"


def catalog_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of packet types: priorities by order status, return flags by line status."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    one = orders.select(F.col("o_orderstatus").alias("apid"), F.col("o_orderpriority").alias("field"))
    return one.union(lines.select("l_linestatus", "l_returnflag")).distinct()


@query("p4_field_names", f"SELECT DISTINCT field FROM ({PRIORITY_FIELDS})")
def p4_field_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.field_names(catalog_fields(spark, sf_dir))


@query("p5_field_search", f"SELECT apid, field FROM ({PRIORITY_FIELDS}) WHERE contains(lower(field), 'ur')")
def p5_field_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.fields_containing(catalog_fields(spark, sf_dir), "UR")


@query("p6_field_owners", f"SELECT field, count(*) AS owners, CASE WHEN count(*) = 1 THEN min(apid) END AS apid FROM ({PRIORITY_FIELDS}) GROUP BY field")
def p6_field_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.owners(catalog_fields(spark, sf_dir))


@query("p7_time_vector", "SELECT epoch_us(ts) AS us FROM events WHERE event_type = 'view'")
def p7_time_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.time_vector(table(spark, sf_dir, "events").filter("event_type = 'view'").select(F.unix_micros("ts").alias("us")), "us")


@query("p1_packet_type", "SELECT p_brand AS packet_name, count(*) AS rows FROM part WHERE lower(p_brand) = 'brand#12' GROUP BY 1")
def p1_packet_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("apid"), F.col("p_brand").alias("packet_name"))
    return store.resolve(parts, "bRaNd#12").groupBy("packet_name").agg(F.count("*").alias("rows"))


@query("a4_store_summary", "SELECT CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 16 ELSE 35 END AS apid, min(event_type) AS packet_name, count(*)::BIGINT AS rows FROM events WHERE event_type IN ('view', 'click', 'signup') GROUP BY 1")
def a4_store_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store that took in each file twice, the second time in vain."""
    held = store.TelemetryStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    events = table(spark, sf_dir, "events")
    for name, apid in (("view", 1), ("click", 16), ("signup", 35)):
        for part in (0, 1, 0):
            rows = events.filter((F.col("event_type") == name) & (F.col("event_id") % 2 == part)).select("event_id", "value")
            held.append(apid, name, f"{name}-{part}.csv", f"{name}{part}", rows)
    return held.summary().select("apid", "packet_name", "rows")


@query("s10_upsert_catalog", "SELECT user_id AS apid, arg_max(event_type, event_id) AS packet_name, 'apid_' || user_id AS table_name FROM events GROUP BY user_id")
def s10_upsert_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("apid"), F.col("event_type").alias("packet_name"), F.concat(F.lit("apid_"), "user_id").alias("table_name"), F.col("event_id").alias("arrival"))
    old = rows.filter("arrival % 10 = 0").groupBy("apid").agg(F.max_by("packet_name", "arrival").alias("packet_name"), F.first("table_name").alias("table_name"))
    return store.upsert_catalog(old, rows)


@query(
    "s9_only_new_content",
    """
WITH files AS (SELECT doc_id::VARCHAR AS path, sha256(coalesce(text, '')) AS sha256 FROM documents),
ledger AS (SELECT sha256(coalesce(text, '')) AS sha256 FROM documents WHERE doc_id % 3 = 0)
SELECT sha256, min(path) AS path FROM files WHERE sha256 NOT IN (SELECT sha256 FROM ledger) GROUP BY sha256""",
)
def s9_only_new_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.coalesce("text", F.lit("")).cast("binary")
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), store.sha256_of(content).alias("sha256"), "doc_id")
    return store.only_new(files.drop("doc_id"), files.filter("doc_id % 3 = 0")).select("sha256", "path")


@query("u2_widening_union", "SELECT o_orderkey AS key, o_totalprice AS value, o_orderpriority AS extra FROM orders UNION ALL BY NAME SELECT s_suppkey AS key, s_nationkey::DOUBLE AS value FROM supplier")
def u2_widening_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("value"))
    new = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value"), F.col("o_orderpriority").alias("extra"))
    return store.widen(stored, new)


REQUIRED = [("1-URGENT", 1), ("2-HIGH", 1), ("3-MEDIUM", 2), ("4-NOT SPECIFIED", 2), ("5-LOW", 3)]


@query(
    "j16_missing_metadata",
    """
WITH required AS (SELECT * FROM (VALUES ('1-URGENT', 1), ('2-HIGH', 1), ('3-MEDIUM', 2), ('4-NOT SPECIFIED', 2), ('5-LOW', 3)) AS r(name, needed)),
groups AS (SELECT DISTINCT o_custkey, (o_custkey % 3 + 1)::INT AS level FROM orders)
SELECT g.o_custkey, g.level, coalesce(string_agg(r.name, ',' ORDER BY r.name) FILTER (o.o_custkey IS NULL AND r.name IS NOT NULL), '') AS missing
FROM groups g LEFT JOIN required r ON r.needed <= g.level LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) o ON o.o_custkey = g.o_custkey AND o.o_orderpriority = r.name
GROUP BY g.o_custkey, g.level""",
)
def j16_missing_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_custkey") % 3 + 1).cast("int").alias("level"), F.col("o_orderpriority").alias("name")).distinct()
    found = quality.missing_required(present, spark.createDataFrame(REQUIRED, "name string, level int"), "o_custkey")
    return found.select("o_custkey", "level", F.array_join("missing", ",").alias("missing"))


@query(
    "j17_listing_changes",
    """
SELECT coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NULL THEN 'created' WHEN b.path IS NULL THEN 'deleted' ELSE 'modified' END AS change
FROM (SELECT p_name || p_partkey AS path, p_size AS size FROM part WHERE p_partkey % 5 <> 1) a
FULL JOIN (SELECT p_name || p_partkey AS path, p_size + (p_partkey % 4 = 0)::INT AS size FROM part WHERE p_partkey % 7 <> 2) b ON a.path = b.path
WHERE a.path IS NULL OR b.path IS NULL OR a.size <> b.size""",
)
def j17_listing_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("path", F.concat("p_name", "p_partkey")).withColumn("mtime", F.lit(0))
    before = part.filter("p_partkey % 5 <> 1").select("path", F.col("p_size").alias("size"), "mtime")
    after = part.filter("p_partkey % 7 <> 2").select("path", (F.col("p_size") + (F.col("p_partkey") % 4 == 0).cast("int")).alias("size"), "mtime")
    return quality.listing_changes(before, after)


@query(
    "j18_checksums",
    """
SELECT c_name AS name, CASE WHEN c_custkey % 6 = 0 THEN 'missing' WHEN c_custkey % 11 = 0 THEN 'mismatch' ELSE 'ok' END AS status FROM customer""",
)
def j18_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    recorded = customer.select(F.col("c_name").alias("name"), F.sha2(F.col("c_name"), 256).alias("sha256"))
    actual = customer.filter("c_custkey % 6 <> 0").select(F.col("c_name").alias("name"), F.sha2(F.when(F.col("c_custkey") % 11 == 0, "other").otherwise(F.col("c_name")), 256).alias("sha256"))
    return quality.verify_checksums(recorded, actual)


@query(
    "w12_definition_groups",
    """
SELECT ordinal, field, last_value(CASE WHEN field = 'COMMENT' THEN trim(replace(replace(d, 'COMMENT', ''), '-', '')) END IGNORE NULLS) OVER (ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS "group"
FROM (SELECT n_nationkey AS ordinal, CASE WHEN n_nationkey % 6 = 0 THEN 'COMMENT' ELSE n_name END AS field, CASE WHEN n_nationkey % 6 = 0 THEN 'COMMENT --- ' || n_name || ' ---' ELSE n_name END AS d FROM nation)
QUALIFY field <> 'COMMENT'""",
)
def w12_definition_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    comment = F.col("n_nationkey") % 6 == 0
    rows = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("ordinal"), F.when(comment, "COMMENT").otherwise(F.col("n_name")).alias("field"), F.when(comment, F.concat(F.lit("COMMENT --- "), "n_name", F.lit(" ---"))).otherwise(F.col("n_name")).alias("description")
    )
    return quality.grouped_definitions(rows).select("ordinal", "field", "group")


@query(
    "w13_schema_report",
    """
WITH fields AS (
    SELECT l_orderkey AS packet, (l_linenumber * 1000000 + l_partkey) * 1000 + l_suppkey AS ordinal, (l_linenumber * 16 - CASE WHEN l_partkey % 9 = 0 THEN 20 ELSE 0 END)::BIGINT AS bit_offset,
           (l_linenumber * 2 + CASE WHEN l_suppkey % 13 = 0 THEN 1 ELSE 0 END)::BIGINT AS byte_offset, l_shipmode_like AS name, 16 AS bit_length, CASE WHEN l_partkey % 17 = 0 THEN 8 ELSE 16 END AS width
    FROM (SELECT *, l_returnflag || l_linenumber % 5 AS l_shipmode_like FROM lineitem)),
judged AS (
    SELECT packet, ordinal, concat_ws(',',
        CASE WHEN bit_offset < max(bit_offset + bit_length) OVER (PARTITION BY packet ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 'overlap' END,
        CASE WHEN bit_offset <> 8 * byte_offset THEN 'position' END, CASE WHEN count(*) OVER (PARTITION BY packet, name) > 1 THEN 'name' END, CASE WHEN width <> bit_length THEN 'width' END) AS problems
    FROM fields)
SELECT * FROM judged WHERE problems <> ''""",
)
def w13_schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    fields = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("packet"), ((line * 1000000 + F.col("l_partkey")) * 1000 + F.col("l_suppkey")).alias("ordinal"), F.concat("l_returnflag", line % 5).alias("name"),
        (line * 16 - F.when(F.col("l_partkey") % 9 == 0, 20).otherwise(0)).alias("bit_offset"), (line * 2 + F.when(F.col("l_suppkey") % 13 == 0, 1).otherwise(0)).alias("byte_offset"),
        F.lit(0).alias("bit_in_byte"), F.lit(16).alias("bit_length"), F.when(F.col("l_partkey") % 17 == 0, "U8").otherwise("U16").alias("data_type"),
    )
    return quality.schema_report(fields).select("packet", "ordinal", "problems")


@query("p19_publishable", "SELECT p_partkey, name FROM (SELECT p_partkey, ['TYPE', 'mem_x', 'bat_v', 'my_CheckSum', 'temp'][p_partkey % 5 + 1] AS name FROM part) WHERE name IN ('bat_v', 'temp')")
def p19_publishable(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, ("TYPE", "mem_x", "bat_v", "my_CheckSum", "temp")))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.get(names, (F.col("p_partkey") % 5).cast("int")).alias("name"))
    return rows.filter(quality.publishable(F.col("name")))


@query("p20_triage", "SELECT p_partkey, CASE WHEN regexp_matches(lower(p_name || ' ' || p_type), 'steel|red') THEN 'OMIT' ELSE 'REVIEW' END AS action FROM part")
def p20_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", quality.triage("steel|red", F.col("p_name"), F.col("p_type")).alias("action"))


@query("q5_carry_over", "SELECT o_custkey AS file, 'v_' || o_orderpriority AS internal_name, arg_max(o_orderstatus, o_orderkey) AS value FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '2-HIGH') GROUP BY o_custkey, o_orderpriority")
def q5_carry_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("file"), F.col("o_orderpriority").alias("keyword"), F.col("o_orderstatus").alias("value"), F.col("o_orderkey").alias("ordinal"))
    known = [(n, f"v_{n}") for n, _ in REQUIRED if n != "2-HIGH"]
    return quality.carry_over(cards, spark.createDataFrame(known, "keyword string, internal_name string"), spark.createDataFrame([("5-LOW",)], "keyword string"))


@query("f37_redaction", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN c_name ELSE '<redacted>' END AS shown, CASE WHEN c_custkey % 3 = 1 THEN 'note' WHEN c_custkey % 3 = 0 THEN 'API-Token' ELSE 'db_password' END AS name FROM customer")
def f37_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("c_custkey") % 3
    name = F.when(at == 0, "API-Token").when(at == 1, "note").otherwise("db_password")
    rows = table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), quality.redacted(F.create_map(name, F.col("c_name"))).alias("held"))
    return rows.select("c_custkey", "name", F.element_at("held", F.col("name")).alias("shown"))
