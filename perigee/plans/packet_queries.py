"""Queries over the packets made from events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perigee.functions import bits, clock
from perigee.operators import packets as ops
from perigee.operators import public
from perigee.plans.base import query
from perigee.plans.fixtures import PACKETS_SQL, packets, table
from perigee.sources.scratch import dealt_by

PACKETS = "WITH " + PACKETS_SQL.strip()

NAMES = [(1, "beacon"), (16, "sw_stat"), (536, "csie_data")]

# (apid, ordinal, name, data type) of a small dictionary; the widths of 538 don't make whole bytes.
FIELDS = [
    *[(apid, i, *f) for apid in (1, 16, 35, 536) for i, f in enumerate([("version", "U3"), ("type", "U1"), ("sec", "U1"), ("apid", "U11"), ("flags", "U2"), ("count", "U14"), ("length", "U16"), ("coarse", "U32"), ("fine", "U16"), ("value", "I32"), ("word", "U16"), ("word", "U16")])],
    *[(538, i, *f) for i, f in enumerate([("head", "U48"), ("coarse", "U32"), ("rest", "U5")])],
]


def values(rows: list[tuple]) -> str:
    """Rows as SQL VALUES."""
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)


def dictionary(spark: SparkSession) -> DataFrame:
    """The field dictionary as a table."""
    return spark.createDataFrame(FIELDS, "apid int, ordinal int, name string, data_type string")


LAYOUT_SQL = f"""
fields AS (
    SELECT *, substr(data_type, 2)::INT AS bit_length FROM (VALUES {values(FIELDS)}) AS f(apid, ordinal, name, data_type)),
layout AS (
    SELECT apid, ordinal, bit_length, (sum(bit_length) OVER (PARTITION BY apid ORDER BY ordinal) - bit_length)::INT AS bit_offset,
           name || CASE WHEN row_number() OVER (PARTITION BY apid, name ORDER BY ordinal) > 1
                        THEN '_' || row_number() OVER (PARTITION BY apid, name ORDER BY ordinal) ELSE '' END AS field
    FROM fields)"""


@query(
    "f1_header_bits",
    PACKETS
    + """
SELECT event_id, (w1 >> 13)::INT AS version, (w1 >> 12 & 1)::INT AS packet_type, (w1 >> 11 & 1)::INT AS secondary_header_flag,
       (w1 & 2047)::INT AS apid, (w2 >> 14)::INT AS sequence_flags, (w2 & 16383)::INT AS sequence_count,
       w3::INT AS length_field, (w3 + 7)::INT AS packet_length
FROM (SELECT event_id, ('0x' || hex[1:4])::BIGINT AS w1, ('0x' || hex[5:8])::BIGINT AS w2, ('0x' || hex[9:12])::BIGINT AS w3 FROM packets)""",
)
def f1_header_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in bits.header_fields(F.col("packet")).items()])


@query("f3_fletcher32", PACKETS + " SELECT event_id, fletcher_le, fletcher_be, additive FROM packets")
def f3_fletcher32(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = bits.body(F.col("packet"))
    return packets(spark, sf_dir).select(
        "event_id",
        bits.fletcher32(body).alias("fletcher_le"),
        bits.fletcher32(body, little_endian=False).alias("fletcher_be"),
        bits.additive32(bits.body(F.col("packet"), 12)).alias("additive"),
    )


ALGORITHM_SQL = """
    CASE WHEN apid = 536 THEN CASE WHEN additive = big THEN 'csie_additive_be' WHEN additive = little THEN 'csie_additive_le' END
         WHEN fletcher_le = big THEN 'fletcher32_le_words_stored_be' WHEN fletcher_le = little THEN 'fletcher32_le_words_stored_le'
         WHEN fletcher_be = big THEN 'fletcher32_be_words_stored_be' WHEN fletcher_be = little THEN 'fletcher32_be_words_stored_le' END"""

CHECKED_SQL = f"""
checked AS (
    SELECT *, {ALGORITHM_SQL} AS algorithm
    FROM (SELECT *, ('0x' || substr(hex, 33, 8))::BIGINT AS big,
                 ('0x' || substr(hex, 39, 2) || substr(hex, 37, 2) || substr(hex, 35, 2) || substr(hex, 33, 2))::BIGINT AS little FROM packets))"""


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets with the checksum rule that holds."""
    return packets(spark, sf_dir).withColumn("algorithm", bits.checksum_algorithm(F.col("packet"), F.col("apid")))


@query("f6_checksum_algorithm", f"{PACKETS}, {CHECKED_SQL} SELECT event_id, apid, algorithm FROM checked")
def f6_checksum_algorithm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(spark, sf_dir).select("event_id", "apid", "algorithm")


@query(
    "f8_byte_reversal",
    PACKETS + r"""
SELECT event_id, regexp_replace(hex, '(..)(..)(..)(..)', '\4\3\2\1', 'g') AS words32, regexp_replace(hex, '(..)(..)', '\2\1', 'g') AS words16
FROM packets""",
)
def f8_byte_reversal(spark: SparkSession, sf_dir: str) -> DataFrame:
    reversed_hex = lambda n: F.lower(F.hex(bits.reverse_words(F.col("packet"), n)))
    return packets(spark, sf_dir).select("event_id", reversed_hex(4).alias("words32"), reversed_hex(2).alias("words16"))


#: A dictionary made of order lines: a packet for each order, a field for each line, its width from the quantity.
LINE_FIELDS = """
line_fields AS (
    SELECT l_orderkey AS apid, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)::INT AS ordinal, l_returnflag || l_linestatus AS name, (l_quantity::INT % 16 + 1) * CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 4 END AS bit_length
    FROM lineitem)"""


def line_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = (F.col("l_quantity").cast("int") % 16 + 1) * F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(4)
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return dealt_by(table(spark, sf_dir, "lineitem"), "l_orderkey").select(
        F.col("l_orderkey").alias("apid"), place.alias("ordinal"), F.concat("l_returnflag", "l_linestatus").alias("name"), F.concat(F.lit("U"), width).alias("data_type")
    )


@query(
    "w8_bit_offsets",
    f"""WITH {LINE_FIELDS}
SELECT apid, ordinal, bit_length, (sum(bit_length) OVER (PARTITION BY apid ORDER BY ordinal) - bit_length)::INT AS bit_offset,
       name || CASE WHEN row_number() OVER same > 1 THEN '_' || row_number() OVER same ELSE '' END AS field
FROM line_fields WINDOW same AS (PARTITION BY apid, name ORDER BY ordinal)""",
)
def w8_bit_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.field_layout(line_fields(spark, sf_dir)).select("apid", "ordinal", "bit_length", "bit_offset", "field")


@query(
    "j6_expanding_decode",
    f"""{PACKETS}, {LAYOUT_SQL}
SELECT event_id, p.apid, field,
       (('0x' || substr(hex, 2 * (bit_offset // 8) + 1, 2 * ((bit_offset + bit_length - 1) // 8 - bit_offset // 8 + 1)))::BIGINT
        // (1::BIGINT << (8 * ((bit_offset + bit_length - 1) // 8 + 1) - bit_offset - bit_length))) % (1::BIGINT << bit_length) AS raw_value
FROM packets p JOIN layout l ON p.apid = l.apid""",
)
def j6_expanding_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.decode_long(packets(spark, sf_dir), ops.field_layout(dictionary(spark))).select("event_id", "apid", "field", F.col("raw_value").cast("long").alias("raw_value"))


LAYOUT = [("coarse", "U", 48, 32), ("fine", "U", 80, 16), ("value", "I", 96, 32), ("nibble", "U", 98, 6), ("head", "C", 0, 16), ("real", "F", 48, 32)]


@query(
    "b7_typed_decode",
    PACKETS + """
SELECT event_id, 'decoded' AS status, ('0x' || substr(hex, 13, 8))::BIGINT AS coarse, ('0x' || substr(hex, 21, 4))::BIGINT AS fine,
       ('0x' || substr(hex, 25, 8))::BIGINT AS value, (('0x' || substr(hex, 25, 2))::BIGINT & 63) AS nibble, decode(unhex(substr(hex, 1, 4))) AS head,
       round(CASE WHEN e = 0 THEN f / 8388608 * pow(2, -126) ELSE (1 + f / 8388608) * pow(2, e - 127) END, 12) AS real
FROM (SELECT *, ('0x' || substr(hex, 13, 8))::BIGINT // 8388608 % 256 AS e, (('0x' || substr(hex, 13, 8))::BIGINT % 8388608)::DOUBLE AS f FROM packets)
WHERE apid = 1""",
)
def b7_typed_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = ops.decode(packets(spark, sf_dir).filter("apid = 1"), LAYOUT, ["event_id"])
    return decoded.withColumn("real", F.round("real", 12)).withColumn("head", F.col("head"))


@query("a5_expected_bytes", f"WITH {LINE_FIELDS} SELECT apid, (sum(bit_length) // 8)::INT AS expected_bytes FROM line_fields GROUP BY apid HAVING sum(bit_length) % 8 = 0")
def a5_expected_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.expected_bytes(line_fields(spark, sf_dir))


@query(
    "p16_structural_packets",
    f"""{PACKETS}, {LAYOUT_SQL},
expected AS (SELECT apid, sum(bit_length) // 8 AS n FROM fields GROUP BY apid HAVING sum(bit_length) % 8 = 0)
SELECT event_id, p.apid, 20 AS packet_length FROM packets p JOIN expected e ON p.apid = e.apid AND 20 IN (n, n + 1)""",
)
def p16_structural_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.structural(packets(spark, sf_dir), ops.expected_bytes(dictionary(spark)))
    return found.select("event_id", "apid", "packet_length")


@query(
    "p18_beacon_contract",
    f"""{PACKETS}, {CHECKED_SQL}
SELECT event_id, CASE WHEN apid <> 1 THEN 'apid' WHEN fletcher_le <> big THEN 'checksum' WHEN ms % 1000 > 999 THEN 'fine_time' END AS reason FROM checked""",
)
def p18_beacon_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets(spark, sf_dir).select("event_id", ops.beacon_reason(F.col("packet"), [20, 21]).alias("reason"))


@query(
    "j4_packet_names",
    f"""{PACKETS} SELECT event_id, p.apid, coalesce(packet_name, 'apid_' || p.apid) AS packet_name
FROM packets p LEFT JOIN (VALUES {values(NAMES)}) AS n(apid, packet_name) ON p.apid = n.apid""",
)
def j4_packet_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.createDataFrame(NAMES, "apid int, packet_name string")
    return ops.with_packet_names(packets(spark, sf_dir), names).select("event_id", "apid", "packet_name")


@query(
    "a1_decode_summary",
    f"""{PACKETS}, {CHECKED_SQL}
SELECT apid, count(*) AS packets, count(*) FILTER (status = 'decoded') AS decoded, count(*) FILTER (status = 'decode_failed') AS decode_failed,
       count(*) FILTER (status = 'no_decoder') AS no_decoder, 20.0::DOUBLE AS avg_bytes, 20 AS min_bytes, 20 AS max_bytes
FROM (SELECT *, CASE WHEN apid = 35 THEN 'no_decoder' WHEN algorithm IS NULL THEN 'decode_failed' ELSE 'decoded' END AS status FROM checked)
GROUP BY apid""",
)
def a1_decode_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("apid") == 35, "no_decoder").when(F.col("algorithm").isNull(), "decode_failed").otherwise("decoded")
    decoded = checked(spark, sf_dir).withColumn("status", status).withColumn("packet_bytes", F.octet_length("packet"))
    return ops.decode_summary(decoded)


@query(
    "a2_packet_statistics",
    f"""{PACKETS}, {CHECKED_SQL}
SELECT apid, count(*) AS candidates, 20 * count(*) AS candidate_bytes, count(algorithm) AS valid, 20 * count(algorithm) AS valid_bytes,
       count(*) - count(algorithm) AS failed, 20 AS min_bytes, 20 AS max_bytes
FROM checked GROUP BY ROLLUP (apid)""",
)
def a2_packet_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.packet_statistics(checked(spark, sf_dir))


@query(
    "a2_algorithm_counts",
    f"""{PACKETS}, {CHECKED_SQL},
counted AS (SELECT apid, algorithm, count(*) AS n FROM checked WHERE algorithm IS NOT NULL GROUP BY apid, algorithm)
SELECT apid, string_agg(algorithm || '=' || n, ',' ORDER BY algorithm) AS algorithms FROM counted GROUP BY apid""",
)
def a2_algorithm_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.transform(F.array_sort(F.map_entries("algorithms")), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return ops.algorithm_counts(checked(spark, sf_dir)).select("apid", F.array_join(shown, ",").alias("algorithms"))


def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets, each as often as its event's number asks, from three sources."""
    times = F.explode(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")))
    source = F.concat(F.lit("src"), F.col("user_id") % 3)
    return packets(spark, sf_dir).withColumn("copy", times).withColumn("source", source).withColumn("file", F.concat("source", F.lit("_"), F.col("user_id") % 7))


REPEATED_SQL = """
repeated AS (
    SELECT *, 'src' || user_id % 3 AS source, 'src' || user_id % 3 || '_' || user_id % 7 AS file
    FROM packets, unnest(range(event_id % 3 + 1)) AS c(copy))"""


@query(
    "w2_duplicate_packets",
    f"""{PACKETS}, {REPEATED_SQL}
SELECT event_id, copy::INT AS copy, group_size, group_size > 1 AS is_duplicate,
       CASE WHEN group_size > 1 THEN printf('dup_%06d', dense_rank() OVER (ORDER BY CASE WHEN group_size > 1 THEN sha END)) END AS duplicate_group
FROM (SELECT *, sha256(unhex(hex)) AS sha, count(*) OVER (PARTITION BY hex) AS group_size FROM repeated)""",
)
def w2_duplicate_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = ops.mark_duplicates(repeated(spark, sf_dir))
    return marked.select("event_id", "copy", "group_size", "is_duplicate", "duplicate_group")


@query(
    "o1_time_merge",
    f"""{PACKETS}, {REPEATED_SQL}
SELECT event_id, copy::INT AS copy, source, row_number() OVER (ORDER BY apid = 536,
           CASE WHEN apid <> 536 THEN ms // 1000 END, CASE WHEN apid <> 536 THEN ms % 1000 END, source, event_id, copy) - 1 AS packet_index
FROM repeated""",
)
def o1_time_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    packet = F.col("packet")
    key = clock.merge_key(F.col("apid"), F.octet_length(packet), bits.bit_field(packet, 4, 1), bits.unsigned(packet, 6, 4), bits.unsigned(packet, 10, 2))
    merged = ops.merge_sources(repeated(spark, sf_dir).withColumn("time_key", key), ["event_id", "copy"])
    return merged.select("event_id", "copy", "source", "packet_index")


@query(
    "a3_source_summary",
    f"""{PACKETS}, {REPEATED_SQL},
per_apid AS (SELECT source, apid, count(*) AS n, min(event_id) AS first FROM repeated GROUP BY source, apid),
best AS (SELECT source, string_agg(apid || ':' || n, ' ' ORDER BY n DESC, first) AS top_apids
         FROM (SELECT * FROM per_apid QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, first) <= 3) GROUP BY source)
SELECT source, count(DISTINCT file) AS files, count(*) AS packets, 20 * count(*) AS packet_bytes, top_apids
FROM repeated JOIN best USING (source) GROUP BY source, top_apids""",
)
def a3_source_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.source_summary(repeated(spark, sf_dir).withColumn("arrival", F.col("event_id")), top=3)


@query(
    "j11_source_of_offset",
    """
WITH files AS (
    SELECT user_id AS position, 20 * count(*) AS length, (coalesce(sum(20 * count(*)) OVER (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS base
    FROM events GROUP BY user_id)
SELECT event_id, event_id * 20 AS "offset", position, event_id * 20 - base AS in_file
FROM events JOIN files ON event_id * 20 >= base AND event_id * 20 < base + length""",
)
def j11_source_of_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packets(spark, sf_dir)
    files = found.groupBy(F.col("user_id").alias("position")).agg((F.count("*") * 20).alias("length"))
    located = ops.source_of_offset(found.select("event_id", (F.col("event_id") * 20).alias("offset")), files)
    return located.select("event_id", "offset", "position", (F.col("offset") - F.col("base")).alias("in_file"))


def beacon_value(packet: bytes) -> dict[str, float]:
    """A decoder of one's own: the value of a beacon; those of every 17th sequence count can't be read."""
    if (int.from_bytes(packet[2:4], "big") & 0x3FFF) % 17 == 0:
        raise ValueError("unreadable")
    return {"value": int.from_bytes(packet[12:16], "big") / 100}


@query(
    "x1_registered_decoder",
    PACKETS + """
SELECT event_id, apid, CASE apid WHEN 1 THEN 'beacon' WHEN 16 THEN 'sw_stat' WHEN 536 THEN 'csie_data' ELSE 'apid_' || apid END AS packet_name,
       CASE apid WHEN 1 THEN 'registered' WHEN 538 THEN 'none' ELSE 'dictionary' END AS decoder_kind,
       CASE WHEN apid = 538 THEN 'no_decoder' WHEN apid = 1 AND event_id % 16384 % 17 = 0 THEN 'decode_failed' ELSE 'decoded' END AS status,
       CASE WHEN apid = 1 AND event_id % 16384 % 17 = 0 THEN 'unreadable' END AS error,
       CASE WHEN apid = 538 OR apid = 1 AND event_id % 16384 % 17 = 0 THEN NULL
            WHEN apid = 1 THEN ('0x' || substr(hex, 25, 8))::BIGINT / 100.0 ELSE ('0x' || substr(hex, 25, 8))::BIGINT END::DOUBLE AS value,
       CASE WHEN apid NOT IN (1, 538) THEN event_id % 16384 END::DOUBLE AS count
FROM packets""",
)
def x1_registered_decoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = ops.field_layout(dictionary(spark)).filter("apid <> 538")
    named = ops.with_packet_names(packets(spark, sf_dir).select("event_id", "apid", "packet"), spark.createDataFrame(NAMES, "apid int, packet_name string"))
    decoded = ops.decode_each(named, layout, {"beacon": beacon_value})
    fields = [bits.number_of(F.try_element_at("fields", F.lit(f))).alias(f) for f in ("value", "count")]
    return decoded.select("event_id", "apid", "packet_name", "decoder_kind", "status", "error", *fields)


# (apid, ordinal, name, data type): whole numbers up to 64 bits across bytes, IEEE numbers and text; packets of 35 are too short.
WIDE_FIELDS = [
    *[(1, i, *f) for i, f in enumerate([("head", "U13"), ("wide", "U64"), ("odd", "I61"), ("bit", "U1"), ("last", "I21")])],
    *[(16, i, *f) for i, f in enumerate([("head", "U48"), ("real", "F32"), ("fine", "U16"), ("small", "F32"), ("tail", "C32")])],
    *[(35, i, *f) for i, f in enumerate([("head", "U64"), ("body", "U64"), ("beyond", "U64")])],
    *[(536, i, *f) for i, f in enumerate([("head", "C16"), ("count", "U16"), ("double", "F64"), ("long", "I64")])],
]

WIDE_BITS = """
located AS (
    SELECT apid, ordinal, name AS field, substr(data_type, 1, 1) AS kind, substr(data_type, 2)::INT AS width,
           (sum(substr(data_type, 2)::INT) OVER (PARTITION BY apid ORDER BY ordinal) - substr(data_type, 2)::INT)::INT AS start
    FROM (VALUES """ + values(WIDE_FIELDS) + """) AS f(apid, ordinal, name, data_type)),
joined AS (
    SELECT event_id, p.apid, ordinal, field, kind, width, start, hex[start // 8 * 2 + 1 : (start + width + 7) // 8 * 2] AS h, length(hex) * 4 >= start + width AS there,
           (8 - (start + width) % 8) % 8 AS below
    FROM packets p JOIN located l USING (apid)),
numbered AS (
    SELECT *, CASE WHEN there THEN (list_sum([(('0x' || h[2 * i + 1 : 2 * i + 2])::INT::HUGEINT << (8 * (len(h) // 2 - 1 - i))) FOR i IN range(len(h) // 2)])::HUGEINT >> below) % (1::HUGEINT << width) END AS v
    FROM joined),
parted AS (
    SELECT *, CASE WHEN width = 64 THEN (v >> 52) % 2048 ELSE (v >> 23) % 256 END::INT AS exponent,
           CASE WHEN width = 64 THEN (v % (1::HUGEINT << 52))::DOUBLE / 4503599627370496 ELSE (v % (1::HUGEINT << 23))::DOUBLE / 8388608 END AS fraction
    FROM numbered)"""


@query(
    "b7_dictionary_decode",
    PACKETS + "," + WIDE_BITS + """
SELECT event_id, apid, field, CASE WHEN there THEN 'decoded' ELSE 'decode_failed' END AS status,
       CASE WHEN NOT there THEN '20 bytes, ' || (start + width + 7) // 8 || ' needed' END AS error,
       CASE WHEN kind = 'U' THEN v WHEN kind = 'I' THEN CASE WHEN v >= 1::HUGEINT << (width - 1) THEN v - (1::HUGEINT << width) ELSE v END END::VARCHAR AS whole,
       CASE WHEN kind = 'F' THEN CASE WHEN v >> (width - 1) = 1 THEN -1.0::DOUBLE ELSE 1.0 END * CASE WHEN exponent = 0 THEN fraction * pow(2::DOUBLE, CASE WHEN width = 64 THEN -1022 ELSE -126 END)
            ELSE (1 + fraction) * pow(2::DOUBLE, exponent - CASE WHEN width = 64 THEN 1023 ELSE 127 END) END END AS real,
       CASE WHEN kind = 'C' THEN CASE WHEN regexp_full_match(h, '([0-7][0-9a-f])*') THEN rtrim(decode(unhex(h)), chr(0)) ELSE h END END AS text
FROM parted""",
)
def b7_dictionary_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of all kinds and widths read by the dictionary's rows; what reaches past a packet's end fails alone."""
    layout = ops.field_layout(spark.createDataFrame(WIDE_FIELDS, "apid int, ordinal int, name string, data_type string"))
    decoded = ops.decode_long(packets(spark, sf_dir).select("event_id", "apid", "packet"), layout)
    return decoded.select("event_id", "apid", "field", "status", "error", F.col("value.whole").cast("string").alias("whole"), "value.real", "value.text")


@query(
    "p21_public_values",
    PACKETS + "," + WIDE_BITS + """
SELECT event_id, apid, 'public_' || field AS public_name,
       CASE WHEN kind = 'U' THEN v WHEN kind = 'I' THEN CASE WHEN v >= 1::HUGEINT << (width - 1) THEN v - (1::HUGEINT << width) ELSE v END END::VARCHAR AS whole,
       CASE WHEN kind = 'F' THEN CASE WHEN v >> (width - 1) = 1 THEN -1.0::DOUBLE ELSE 1.0 END * CASE WHEN exponent = 0 THEN fraction * pow(2::DOUBLE, CASE WHEN width = 64 THEN -1022 ELSE -126 END)
            ELSE (1 + fraction) * pow(2::DOUBLE, exponent - CASE WHEN width = 64 THEN 1023 ELSE 127 END) END END AS real
FROM parted WHERE ordinal % 2 = 1 AND apid <> 35""",
)
def p21_public_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second field is public; the others stay closed."""
    layout = ops.field_layout(spark.createDataFrame(WIDE_FIELDS, "apid int, ordinal int, name string, data_type string"))
    fields = layout.filter("ordinal % 2 = 1 and apid <> 35").withColumn("public_name", F.concat(F.lit("public_"), "field"))
    values = public.public_values(packets(spark, sf_dir).select("event_id", "apid", "packet"), fields)
    return values.select("event_id", "apid", "public_name", F.col("value.whole").cast("string").alias("whole"), "value.real")


@query(
    "p21_opaque_ranges",
    "WITH " + LINE_FIELDS.strip() + """,
located AS (SELECT apid, ordinal, bit_length AS n, (sum(bit_length) OVER (PARTITION BY apid ORDER BY ordinal) - bit_length)::INT AS start FROM line_fields),
closed AS (SELECT apid, start, n, ordinal - row_number() OVER (PARTITION BY apid ORDER BY ordinal) AS run FROM located WHERE ordinal % 3 <> 1)
SELECT apid, min(start)::INT AS start_bit, sum(n)::INT AS bit_length FROM closed GROUP BY apid, run""",
)
def p21_opaque_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the packets that order lines describe, every third field is public; what lies between is opaque."""
    layout = ops.field_layout(line_fields(spark, sf_dir))
    sizes = layout.groupBy("apid").agg(F.sum("bit_length").alias("total_bits"))
    return public.opaque_ranges(layout.filter("ordinal % 3 = 1"), sizes)
