"""Queries over byte streams, wrappers and segments made from events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions import bits
from perigee.operators import packetizer
from perigee.operators import recovery as ops
from perigee.plans.base import query
from perigee.plans.fixtures import PACKETS_SQL, packets
from perigee.plans.packet_queries import CHECKED_SQL, PACKETS


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture of each user: packets in order, with event_id % 4 bytes of filler before each."""
    filler = F.repeat(F.lit("55"), (F.col("event_id") % 4).cast("int"))
    rows = packets(spark, sf_dir).select("user_id", F.struct("event_id", F.concat(filler, F.hex("packet")).alias("h")).alias("r"))
    ordered = F.array_sort(F.collect_list("r"))  # a user's capture is one stream
    return rows.groupBy(F.col("user_id").alias("capture_id")).agg(F.unhex(F.array_join(ordered["h"], "")).alias("content"))


def wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrappers of captures of 1,000 events: 20 bytes each, some with a gap before them, some with a wrong sequence count."""
    n = F.col("event_id")
    offset = n * 20 + F.expr("event_id div 9") * 3
    count = (n + F.when(n % 31 == 0, 5).otherwise(0)) % 16384
    return packets(spark, sf_dir).select(F.expr("event_id div 1000").alias("capture_id"), offset.alias("offset"), F.lit(20).alias("packet_length"), count.alias("sequence_count"))


WRAPPERS = "WITH wrappers AS (SELECT event_id // 1000 AS capture_id, event_id * 20 + event_id // 9 * 3 AS \"offset\", (event_id + CASE WHEN event_id % 31 = 0 THEN 5 ELSE 0 END) % 16384 AS sequence_count FROM events)"


@query("j10_successors", WRAPPERS + " SELECT a.capture_id, a.offset AS \"offset\", b.offset AS next_offset FROM wrappers a JOIN wrappers b ON a.capture_id = b.capture_id AND b.offset = a.offset + 20 AND b.sequence_count = (a.sequence_count + 1) % 16384")
def j10_successors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.successors(wrappers(spark, sf_dir))


@query(
    "w7_chains",
    WRAPPERS + """,
marked AS (SELECT *, CASE WHEN lag("offset") OVER w + 20 = "offset" AND (lag(sequence_count) OVER w + 1) % 16384 = sequence_count THEN 0 ELSE 1 END AS start FROM wrappers WINDOW w AS (PARTITION BY capture_id ORDER BY "offset")),
numbered AS (SELECT *, sum(start) OVER (PARTITION BY capture_id ORDER BY "offset") AS chain FROM marked)
SELECT capture_id, "offset", chain::BIGINT AS chain, count(*) OVER (PARTITION BY capture_id, chain) AS chain_length FROM numbered""",
)
def w7_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.chains(wrappers(spark, sf_dir)).select("capture_id", "offset", "chain", "chain_length")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of segments: payloads of two kinds, up to three copies of each, from the packets' bytes."""
    rows = packets(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).filter("(event_id + copy) % 5 <> 2")
    spoilt = F.when((F.col("event_id") + F.col("copy") * 3) % 7 == 0, F.unhex(F.lit("00"))).otherwise(F.col("packet"))
    return rows.select(
        F.lit(72).alias("apid"), F.expr("event_id div 4").alias("sequence"), (F.col("event_id") % 4).cast("int").alias("segment_index"), F.lit(0).alias("flag"), spoilt.alias("payload"), (F.col("event_id") * 3 + F.col("copy")).alias("offset")
    )


@query(
    "w6_majority_segments",
    f"""{PACKETS},
segments AS (SELECT event_id // 4 AS sequence, event_id % 4 AS segment_index, CASE WHEN (event_id + copy * 3) % 7 = 0 THEN '00' ELSE hex END AS payload, event_id * 3 + copy AS "offset"
             FROM packets, unnest(range(3)) AS c(copy) WHERE (event_id + copy) % 5 <> 2),
variants AS (SELECT sequence, segment_index, payload, count(*) AS n, min("offset") AS first FROM segments GROUP BY ALL)
SELECT sequence, segment_index::INT AS segment_index, payload, sum(n) OVER s AS copies, count(*) OVER s > 1 AS conflicting, min(first) OVER s AS first_offset
FROM variants WINDOW s AS (PARTITION BY sequence, segment_index) QUALIFY row_number() OVER (PARTITION BY sequence, segment_index ORDER BY n DESC, first) = 1""",
)
def w6_majority_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = ops.majority_segments(segments(spark, sf_dir))
    return chosen.select("sequence", "segment_index", F.lower(F.hex("payload")).alias("payload"), "copies", "conflicting", "first_offset")


PIECES = "WITH " + PACKETS_SQL.strip() + """,
placed AS (SELECT user_id AS capture_id, event_id, apid, event_id % 4 AS fill, sum(event_id % 4 + 20) OVER (PARTITION BY user_id ORDER BY event_id) - 20 AS "offset", hex FROM packets)"""


PACKETIZED = PIECES + " SELECT capture_id, \"offset\"::BIGINT AS \"offset\", apid, 20 AS packet_length, hex AS packet, row_number() OVER (PARTITION BY capture_id ORDER BY \"offset\") - 1 AS packet_index FROM placed"

APIDS = {1: 20, 16: 20, 35: 20, 536: 20, 538: 20}


@query("b3_packetize", PACKETIZED)
def b3_packetize(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packetizer.packetize(captures(spark, sf_dir), APIDS, list(APIDS), piece_bytes=1_000)
    return found.select("capture_id", "offset", "apid", "packet_length", F.lower(F.hex("packet")).alias("packet"), "packet_index")


@query("x2_packetize_function", PACKETIZED)
def x2_packetize_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops.register_packetize(spark)
    lengths = "map(" + ", ".join(f"{k}, {v}" for k, v in APIDS.items()) + ")"
    columns = "offset, apid, packet_length, lower(hex(packet)) AS packet, packet_index"
    return spark.sql(f"SELECT capture_id, {columns} FROM {{captures}} c, LATERAL packetize(c.content, {lengths})", captures=captures(spark, sf_dir))


def recovered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Captures in small pieces, what the walk takes of them, and where it enters the pieces."""
    pieces = packetizer.pieces_of(captures(spark, sf_dir), 1_000, packetizer.overlap_of(APIDS))
    return pieces, *packetizer.walk(pieces, packetizer.packet_candidates(pieces, APIDS, list(APIDS)))


@query("a13_resync_gaps", PIECES + " SELECT capture_id, count(*) FILTER (fill > 0) AS gaps, sum(fill)::BIGINT AS gap_bytes, max(fill) AS max_gap FROM placed GROUP BY capture_id")
def a13_resync_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packetizer.resync_gaps(recovered(spark, sf_dir)[1])


@query("a14_dropped_bytes", PIECES + " SELECT capture_id, sum(fill)::BIGINT AS filler_bytes, 0::BIGINT AS other_bytes FROM placed GROUP BY capture_id HAVING sum(fill) > 0")
def a14_dropped_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packetizer.dropped_bytes(*recovered(spark, sf_dir))


def wrapped_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of 500 events in parts of 700 bytes: every third packet stands in a wrapper, every 15th of them in one that
    is a byte too long, with other bytes before each."""
    n = F.col("event_id")
    packet = F.concat(F.hex("packet"), F.when(n % 15 == 0, "AA").otherwise(""))
    wrapper = F.concat(F.format_string("0844C000%04X", (F.length(packet) / 2).cast("int") + 9), F.repeat(F.lit("11"), F.lit(10)), packet)
    own = F.concat(F.repeat(F.lit("A7"), (n % 3).cast("int")), F.when(n % 3 == 0, wrapper).otherwise(F.hex("packet")))
    rows = packets(spark, sf_dir).select(F.expr("event_id div 500").alias("capture_id"), F.struct("event_id", own.alias("h")).alias("r"))
    whole = rows.groupBy("capture_id").agg(F.array_join(F.array_sort(F.collect_list("r"))["h"], "").alias("h"))  # of 500 events
    starts = F.posexplode(F.sequence(F.lit(0), F.length("h") - 1, F.lit(1_400))).alias("piece", "start")
    return whole.select("capture_id", "h", starts).select("capture_id", "piece", F.unhex(F.substring(F.col("h"), F.col("start") + 1, F.lit(1_400))).alias("content"))


WRAPPED = "WITH " + PACKETS_SQL.strip() + """,
sized AS (SELECT event_id // 500 AS capture_id, event_id, apid, hex, event_id % 3 = 0 AS wrapped, event_id % 15 = 0 AS malformed,
                 event_id % 3 + CASE WHEN event_id % 15 = 0 THEN 37 WHEN event_id % 3 = 0 THEN 36 ELSE 20 END AS size FROM packets),
placed AS (SELECT *, (sum(size) OVER (PARTITION BY capture_id ORDER BY event_id) - CASE WHEN malformed THEN 21 ELSE 20 END)::BIGINT AS "offset" FROM sized)"""


def walked_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    pieces = packetizer.join_pieces(wrapped_parts(spark, sf_dir), 700, packetizer.overlap_of(APIDS))
    return pieces, *packetizer.walk(pieces, packetizer.packet_candidates(pieces, APIDS, list(APIDS)))


@query("b3_unwrapped_packets", WRAPPED + ' SELECT capture_id, "offset", apid, wrapped, hex AS packet, row_number() OVER (PARTITION BY capture_id ORDER BY event_id) - 1 AS packet_index FROM placed WHERE NOT malformed')
def b3_unwrapped_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets, some inside wrappers, of captures that lie in many parts."""
    found = packetizer.numbered_packets(walked_parts(spark, sf_dir)[1])
    return found.select("capture_id", "offset", "apid", "wrapped", F.lower(F.hex("packet")).alias("packet"), F.col("packet_index").cast("long").alias("packet_index"))


@query("b5_wrapper_counts", WRAPPED + " SELECT capture_id, count(*) AS wrappers, count(*) FILTER (NOT malformed) AS unwrapped, count(*) FILTER (malformed) AS malformed FROM placed WHERE wrapped GROUP BY capture_id")
def b5_wrapper_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packetizer.wrapper_statistics(walked_parts(spark, sf_dir)[1])


@query("a14_dropped_around_wrappers", WRAPPED + " SELECT capture_id, 0::BIGINT AS filler_bytes, sum(event_id % 3)::BIGINT AS other_bytes FROM placed GROUP BY capture_id")
def a14_dropped_around_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packetizer.dropped_bytes(*walked_parts(spark, sf_dir))


FRAMED = "WITH " + PACKETS_SQL.strip() + """,
frame_bodies AS (SELECT event_id // 300 AS capture_id, event_id // 100 AS frame, string_agg(hex, '' ORDER BY event_id) AS h FROM packets GROUP BY ALL),
filled AS (SELECT capture_id, frame, rpad(h, 4080, 'a7') AS h FROM frame_bodies),
joined AS (SELECT capture_id, string_agg(h, '' ORDER BY frame) AS h FROM filled GROUP BY capture_id)"""


def framed_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of three frames of 100 packets each; every third capture begins with three other bytes."""
    rows = packets(spark, sf_dir).select(F.expr("event_id div 300").alias("capture_id"), F.expr("event_id div 100").alias("frame"), F.struct("event_id", F.hex("packet").alias("h")).alias("r"))
    bodies = rows.groupBy("capture_id", "frame").agg(F.array_join(F.array_sort(F.collect_list("r"))["h"], "").alias("h"))  # of 100 packets
    head = ops.SYNC.hex() + "0420" + "00" * 6
    frame = F.concat(F.lit(head), F.rpad("h", 4080, "A7"), F.lit("55555555"))
    whole = bodies.groupBy("capture_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("frame", frame.alias("h"))))["h"], "").alias("h"))  # three
    return whole.select("capture_id", F.unhex(F.concat(F.when(F.col("capture_id") % 3 == 1, "AABBCC").otherwise(""), "h")).alias("content"))


@query(
    "b2_recovered_streams",
    FRAMED + r"""
SELECT capture_id, capture_id % 3 <> 1 AS aligned, md5(regexp_replace(CASE WHEN capture_id % 3 = 1 THEN 'aabbcc' || h || '55555555' ELSE h END, '(..)(..)(..)(..)', '\4\3\2\1', 'g')) AS digest FROM joined""",
)
def b2_recovered_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of both kinds in one job, each recovered in its way."""
    found = ops.recovered_streams(framed_captures(spark, sf_dir))
    return found.select("capture_id", "aligned", F.md5(F.lower(F.hex("content"))).alias("digest"))


@query(
    "a12_frame_statistics",
    FRAMED + """
SELECT capture_id, count(*) AS records, count(*) AS with_sync, count(*) AS expected_headers, 0::BIGINT AS trailer_fletcher32_be, 0::BIGINT AS trailer_fletcher32_le, count(*) AS trailer_filler_55, 0::BIGINT AS idle_frames
FROM filled WHERE capture_id % 3 <> 1 GROUP BY capture_id""",
)
def a12_frame_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.frame_statistics(ops.cut_frames(framed_captures(spark, sf_dir).filter("capture_id % 3 <> 1")))


DATED = "WITH " + PACKETS_SQL.strip() + """,
frames AS (
    SELECT *, event_id * 7919 % 65536 AS w, event_id % 256 AS mc, event_id // 3 % 256 AS cc, event_id * 31 % 65536 AS s, event_id % 2 AS pad,
           CASE event_id % 4 WHEN 0 THEN printf('%08x', fletcher_le) WHEN 2 THEN '55555555' WHEN 3 THEN '00000000'
                ELSE substr(printf('%08x', fletcher_le), 7, 2) || substr(printf('%08x', fletcher_le), 5, 2) || substr(printf('%08x', fletcher_le), 3, 2) || substr(printf('%08x', fletcher_le), 1, 2) END AS tail
    FROM packets)"""


def dated_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame for each event: sync word, head, the packet's body, and a trailer of one of four kinds."""
    n = F.col("event_id")
    head = F.format_string("%04x%02x%02x%04x%04x", n * 7919 % 65536, n % 256, F.expr("event_id div 3 % 256"), n * 31 % 65536, n % 2)
    body = F.substring("packet", 1, 16)
    sums = F.unhex(F.format_string("%08x", bits.fletcher32(body)))
    tail = F.when(n % 4 == 0, sums).when(n % 4 == 1, bits.reverse_words(sums, 4)).when(n % 4 == 2, F.unhex(F.lit("55555555"))).otherwise(F.unhex(F.lit("00000000")))
    return packets(spark, sf_dir).select("event_id", F.concat(F.unhex(F.lit(ops.SYNC.hex())), F.unhex(head)).alias("head"), F.concat(body, tail).alias("data"))


@query(
    "f2_frame_header",
    DATED + """
SELECT event_id, (w >> 14)::INT AS frame_version, (w >> 4 & 1023)::INT AS spacecraft_id, (w >> 1 & 7)::INT AS virtual_channel, (w & 1)::INT AS ocf_flag, mc::INT AS master_count, cc::INT AS channel_count,
       (s >> 15)::INT AS secondary_flag, (s >> 14 & 1)::INT AS sync_flag, (s >> 13 & 1)::INT AS packet_order, (s >> 11 & 3)::INT AS segment_length, (s & 2047)::INT AS first_header_pointer, pad::INT AS padding
FROM frames""",
)
def f2_frame_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated_frames(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in bits.frame_header_fields(F.col("head")).items()])


@query(
    "f7_trailer_kind",
    DATED + """
SELECT event_id, CASE WHEN tail = printf('%08x', fletcher_le) THEN 'fletcher32_be' WHEN substr(tail, 7, 2) || substr(tail, 5, 2) || substr(tail, 3, 2) || substr(tail, 1, 2) = printf('%08x', fletcher_le) THEN 'fletcher32_le'
                      WHEN tail = '55555555' THEN 'filler_55' END AS trailer FROM frames""",
)
def f7_trailer_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated_frames(spark, sf_dir).select("event_id", bits.trailer_kind(F.col("data")).alias("trailer"))


def split_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of packets that hold 40 events each: up to three copies of each segment, one of them spoilt at times; of
    some packets the start, its flag or a segment is missing."""
    rows = packets(spark, sf_dir).select(F.expr("event_id div 40").alias("sequence"), F.struct("event_id", F.hex("packet").alias("h")).alias("r"))
    whole = rows.groupBy("sequence").agg(F.array_join(F.array_sort(F.collect_list("r"))["h"], "").alias("h"))  # of 40 packets
    whole = whole.withColumn("h", F.concat(F.format_string("0848C000%04X", (F.length("h") / 2).cast("int") + 9), F.repeat(F.lit("11"), F.lit(10)), "h"))
    last = F.floor((F.length("h") - 1) / 488).cast("int")
    parts = whole.select("sequence", "h", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("segment_index")).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    i, n = F.col("segment_index"), F.col("sequence")
    kept = parts.filter(~(((n % 11 == 5) & (i == 0)) | ((n % 5 == 3) & (i == 1))))
    flag = F.when(i == 0, F.when(n % 7 == 4, 0).otherwise(1)).when(i == F.col("last"), 2).otherwise(0)
    payload = F.when((F.col("copy") == 1) & ((n + i) % 4 == 0), "00").otherwise(F.substring(F.col("h"), i * 488 + 1, F.lit(488)))
    return kept.select(F.lit(72).alias("apid"), "sequence", "segment_index", flag.alias("flag"), F.unhex(payload).alias("payload"), (n * 100 + i * 10 + F.col("copy")).alias("offset"))


SPLIT = "WITH " + PACKETS_SQL.strip() + """,
wholes AS (SELECT event_id // 40 AS sequence, string_agg(hex, '' ORDER BY event_id) AS h, (len(string_agg(hex, '')) + 32 - 1) // 488 AS last FROM packets GROUP BY ALL),
parts AS (SELECT sequence, i, (sequence + i) % 4 = 0 AS spoilt FROM wholes, unnest(range(last + 1)) AS r(i) WHERE NOT (sequence % 11 = 5 AND i = 0 OR sequence % 5 = 3 AND i = 1)),
joined AS (
    SELECT sequence, CASE WHEN min(i) > 0 THEN 'orphan' WHEN sequence % 7 = 4 THEN 'bad_start' WHEN count(*) < last + 1 THEN 'missing_segments' ELSE 'complete' END AS status,
           sequence * 100 + min(i) * 10 AS first_offset, 3 * count(*) AS copies, count(*) AS unique_segments, count(*) FILTER (spoilt) AS conflicting, h
    FROM wholes JOIN parts USING (sequence) GROUP BY sequence, last, h)"""


@query("b6_reassembled_packets", SPLIT + " SELECT sequence, status, first_offset, copies, unique_segments, conflicting, CASE WHEN status = 'complete' THEN md5(h) END AS digest FROM joined")
def b6_reassembled_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.reassemble(split_packets(spark, sf_dir))
    return found.select("sequence", "status", "first_offset", "copies", "unique_segments", "conflicting", F.md5(F.lower(F.hex("payload"))).alias("digest"))


@query(
    "a11_reassembly_statistics",
    SPLIT + """
SELECT count(*) AS groups, sum(unique_segments)::BIGINT AS unique_segments, sum(copies - unique_segments)::BIGINT AS duplicates, sum(conflicting)::BIGINT AS conflicting,
       count(*) FILTER (status = 'complete') AS complete, count(*) FILTER (status <> 'complete') AS incomplete, count(*) FILTER (status = 'orphan') AS orphans FROM joined""",
)
def a11_reassembly_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.reassembly_statistics(ops.reassemble(split_packets(spark, sf_dir)))


@query(
    "b4_repaired_packets",
    f"""{PACKETS}, {CHECKED_SQL},
placed AS (SELECT *, apid = 536 AND event_id % 3 = 0 AS doubled, (sum(20 + CASE WHEN apid = 536 AND event_id % 3 = 0 THEN 4 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id)
                     - 20 - CASE WHEN apid = 536 AND event_id % 3 = 0 THEN 4 ELSE 0 END)::BIGINT AS "offset" FROM checked)
SELECT user_id AS capture_id, "offset", apid, hex AS packet, algorithm, row_number() OVER (PARTITION BY user_id ORDER BY "offset") - 1 AS packet_index FROM placed WHERE algorithm IS NOT NULL AND NOT (doubled AND algorithm = 'csie_additive_be')""",
)
def b4_repaired_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures that need checksums, in which every third row packet has a word that came twice.

    A checksum that equals the word before it is taken for a repeated word too, so that such packets stay broken. No
    wrappers are looked for, as bytes left of broken packets may look like one.
    """
    digits = F.hex("packet")
    doubled = F.concat(F.substring(digits, 1, 20), F.substring(digits, 13, 8), F.substring(digits, 21, 20))
    own = F.when((F.col("apid") == 536) & (F.col("event_id") % 3 == 0), doubled).otherwise(digits)
    rows = packets(spark, sf_dir).select(F.col("user_id").alias("capture_id"), F.struct("event_id", own.alias("h")).alias("r"))
    whole = rows.groupBy("capture_id").agg(F.unhex(F.array_join(F.array_sort(F.collect_list("r"))["h"], "")).alias("content"))  # one user's stream
    found = packetizer.packetize(whole, APIDS, list(APIDS), need_checksum=True, repair_apid=536, piece_bytes=1_000, unwrap=False)
    return found.select("capture_id", "offset", "apid", F.lower(F.hex("packet")).alias("packet"), "algorithm", F.col("packet_index").cast("long").alias("packet_index"))
