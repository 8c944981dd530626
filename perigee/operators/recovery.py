"""Streams from captured frames, chains of wrappers and segments. Packets are searched in packetizer.py."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perigee.functions import bits
from perigee.operators.packetizer import possible_heads
from perigee.sources.scratch import small

# Fixed values of the frame and segment formats.
SYNC = bytes.fromhex("1acffc1d")
FRAME_BYTES, FRAME_HEAD = 2056, 12
SEGMENT_PAYLOAD = 244


def cut_frames(captures: DataFrame, spacecraft_id: int = 66, sync: bytes = SYNC, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """One row for each record of frame_bytes of a capture (capture_id, content), judged.

    has_sync, expected_header, trailer (kind or null), payload (without head and trailer; the whole record if it has
    no sync word) and idle (payload all 0x55).
    """
    count = F.ceil(F.octet_length("content") / frame_bytes).cast("int")
    rows = captures.filter(F.octet_length("content") > 0).select("capture_id", "content", F.explode(F.sequence(F.lit(0), count - 1)).alias("frame_no"))
    rows = rows.select("capture_id", "frame_no", F.substring(F.col("content"), F.col("frame_no") * frame_bytes + 1, F.lit(frame_bytes)).alias("frame"))
    head = bits.frame_header_fields(F.col("frame"))
    rows = rows.withColumn("has_sync", (F.hex(F.substring("frame", 1, 4)) == sync.hex().upper()) & (F.octet_length("frame") == frame_bytes))
    rows = rows.withColumn("expected_header", F.col("has_sync") & (head["frame_version"] == 0) & (head["spacecraft_id"] == spacecraft_id) & (head["padding"] == 0))
    data = F.substring(F.col("frame"), F.lit(FRAME_HEAD + 1), F.octet_length("frame"))
    rows = rows.withColumn("data", F.when(F.col("has_sync"), data).otherwise(F.col("frame")))
    rows = rows.withColumn("trailer", F.when(F.col("has_sync"), bits.trailer_kind(F.col("data"))))
    kept = F.octet_length("data") - F.when(F.col("trailer").isNotNull(), 4).otherwise(0)
    rows = rows.withColumn("payload", F.substring(F.col("data"), F.lit(1), kept))
    return rows.withColumn("idle", F.col("has_sync") & F.hex("payload").rlike("^(55)+$")).drop("data", "frame")


def frame_statistics(frames: DataFrame) -> DataFrame:
    """Per capture: records with and without sync word, expected headers, trailers by kind, idle frames."""
    kinds = [F.count_if(F.col("trailer") == k).alias(f"trailer_{k}") for k in ("fletcher32_be", "fletcher32_le", "filler_55")]
    return frames.groupBy("capture_id").agg(
        F.count("*").alias("records"), F.count_if("has_sync").alias("with_sync"), F.count_if("expected_header").alias("expected_headers"), *kinds, F.count_if("idle").alias("idle_frames")
    )


def payload_stream(frames: DataFrame, sync: bytes = SYNC, spacecraft_id: int = 66) -> DataFrame:
    """Per capture, its frames' payloads in order, without idle frames and seams, and with 32-bit words reversed.

    A seam is a sync word inside: with a frame head all 12 bytes go, and 4 of 0x55 before it; else just the word.
    """

    def join(frames: pd.DataFrame) -> pd.DataFrame:
        frames = frames.sort_values("frame_no")
        data = b"".join(p for p, idle in zip(frames["payload"], frames["idle"], strict=True) if not idle)
        return pd.DataFrame({"capture_id": [frames["capture_id"].iloc[0]], "content": [reverse_words(remove_seams(data, sync, spacecraft_id))]})

    return frames.select("capture_id", "frame_no", "payload", "idle").groupBy("capture_id").applyInPandas(join, "capture_id long, content binary")


def seam_pattern(sync: bytes, spacecraft_id: int) -> re.Pattern:
    """What a seam is, over bytes: a sync word; with a frame's head behind it (version 0, this spacecraft, empty
    padding) the head too, and a filler word of 0x55 before it."""
    low = (spacecraft_id & 15) << 4
    head = re.escape(bytes([spacecraft_id >> 4])) + b"[" + re.escape(bytes([low])) + b"-" + re.escape(bytes([low | 15])) + b"].{4}\\0\\0"
    return re.compile(b"(?:UUUU)?" + re.escape(sync) + head + b"|" + re.escape(sync), re.DOTALL)


def remove_seams(data: bytes, sync: bytes = SYNC, spacecraft_id: int = 66) -> bytes:
    """data without the sync words inside it, and without the frame heads that follow them."""
    return seam_pattern(sync, spacecraft_id).sub(b"", data)


def strip_unaligned(captures: DataFrame, sync: bytes = SYNC, spacecraft_id: int = 66) -> DataFrame:
    """capture_id and content of captures that aren't whole frames: heads and bare sync words are taken out where they
    are found, and 32-bit words reversed as in payload_stream."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(content=[reverse_words(remove_seams(data, sync, spacecraft_id)) for data in frame["content"]])

    return captures.select("capture_id", "content").mapInPandas(run, "capture_id long, content binary")


def is_aligned(frames: DataFrame) -> DataFrame:
    """capture_id and aligned: whether every record of a capture is a whole frame with a sync word."""
    return frames.groupBy("capture_id").agg(F.bool_and("has_sync").alias("aligned"))


def recovered_streams(captures: DataFrame, sync: bytes = SYNC, spacecraft_id: int = 66) -> DataFrame:
    """capture_id, aligned and content of every capture (capture_id, content) that isn't empty, by the way that fits it.

    A capture of whole frames, each with a sync word, gives its frames' payloads (see payload_stream); any other one is
    searched for heads and sync words (see strip_unaligned). Which it is, is measured from its frames.
    """
    frames = cut_frames(captures, spacecraft_id, sync)
    kinds = is_aligned(frames)
    whole = frames.join(small(kinds.filter("aligned").select("capture_id")), "capture_id", "left_semi")
    others = captures.join(small(kinds.filter("not aligned").select("capture_id")), "capture_id", "left_semi")
    found = payload_stream(whole, sync, spacecraft_id).withColumn("aligned", F.lit(True))
    return found.unionByName(strip_unaligned(others, sync, spacecraft_id).withColumn("aligned", F.lit(False))).select("capture_id", "aligned", "content")


def reverse_words(data: bytes) -> bytes:
    """data with each whole 32-bit word reversed."""
    whole = len(data) - len(data) % 4
    return np.frombuffer(data, np.uint8, whole).reshape(-1, 4)[:, ::-1].tobytes() + data[whole:]


def register_packetize(spark: SparkSession, name: str = "packetize") -> None:
    """Make a table function of SQL, packetize(content, lengths): the packets of one capture, as select_packets finds them.

    lengths: expected bytes by APID. Null content has no packets.
    """

    @F.udtf(returnType="offset long, apid int, packet_length int, packet binary, packet_index long")
    class Packetize:
        def eval(self, content: bytes | None, lengths: dict[int, int]) -> Iterator[tuple]:
            data = bytes(content or b"")
            end, index = 0, 0
            for at, apid, length in possible_heads([*lengths], lengths)(data, len(data)):
                if at >= end:
                    yield at, apid, length, data[at : at + length], index
                    end, index = at + length, index + 1

    spark.udtf.register(name, Packetize)


def unwrap_chains(wrappers: DataFrame, head_bytes: int = 16) -> DataFrame:
    """Per chain of wrappers (see chains; with packet), the payloads behind their heads one after another.

    Wrappers outside chains of two or more are left untouched, that is, they are not here.
    """
    inner = F.hex(F.substring(F.col("packet"), F.lit(head_bytes + 1), F.octet_length("packet")))
    linked = chains(wrappers).filter("chain_length >= 2")
    ordered = F.array_sort(F.collect_list(F.struct("offset", inner.alias("h"))))  # a chain's payload is one stream
    grouped = linked.groupBy("capture_id", "chain").agg(F.min("offset").alias("offset"), F.count("*").alias("wrappers"), ordered.alias("parts"))
    return grouped.select("capture_id", "offset", "wrappers", F.unhex(F.array_join(F.col("parts.h"), "")).alias("payload"))


def chains(wrappers: DataFrame) -> DataFrame:
    """Wrappers (capture_id, offset, packet_length, sequence_count) with chain and chain_length.

    A wrapper follows another that ends where it starts and has the sequence count before; runs of two and more are
    chains, found by numbering the breaks.
    """
    order = Window.partitionBy("capture_id").orderBy("offset")
    follows = (F.lag(F.col("offset") + F.col("packet_length")).over(order) == F.col("offset")) & ((F.lag("sequence_count").over(order) + 1) % 16384 == F.col("sequence_count"))
    numbered = wrappers.withColumn("break", (~F.coalesce(follows, F.lit(False))).cast("int")).withColumn("chain", F.sum("break").over(order))
    return numbered.withColumn("chain_length", F.count("*").over(Window.partitionBy("capture_id", "chain"))).drop("break")


def successors(wrappers: DataFrame) -> DataFrame:
    """Pairs of wrappers of which the second starts where the first ends, with the next sequence count: an equi-join."""
    a, b = wrappers.alias("a"), wrappers.alias("b")
    on = F.expr("a.capture_id = b.capture_id and b.offset = a.offset + a.packet_length and b.sequence_count = (a.sequence_count + 1) % 16384")
    return a.join(b, on).select("a.capture_id", F.col("a.offset").alias("offset"), F.col("b.offset").alias("next_offset"))


def majority_segments(segments: DataFrame) -> DataFrame:
    """Of the copies of a segment (apid, sequence, segment_index, flag, payload, offset) the most frequent one.

    Ties go to the copy that came first; conflicting tells whether copies differ.
    """
    key = ["apid", "sequence", "segment_index"]
    variants = segments.groupBy(*key, "payload", "flag").agg(F.count("*").alias("copies"), F.min("offset").alias("offset"))
    best = F.max_by(F.struct("payload", "flag", "offset"), F.struct("copies", (-F.col("offset")).alias("early"))).alias("best")
    chosen = variants.groupBy(*key).agg(best, F.sum("copies").alias("copies"), (F.count("*") > 1).alias("conflicting"), F.min("offset").alias("first_offset"))
    return chosen.select(*key, "best.payload", "best.flag", "copies", "conflicting", "first_offset")


def reassemble(segments: DataFrame) -> DataFrame:
    """Packets put together from segments: apid, sequence, payload (without its 16 bytes of heads) or null, and status.

    Needs segment 0 with the start flag and a packet head of this APID, and every segment that its length asks for,
    each of the right length and with the flag of its place (1 start, 0 middle, 2 end). first_offset is the arrival.
    """
    parts = majority_segments(segments)
    groups = parts.groupBy("apid", "sequence").agg(
        F.array_sort(F.collect_list(F.struct("segment_index", "flag", "payload"))).alias("parts"),  # at most 256
        F.min("first_offset").alias("first_offset"),
        F.sum("copies").alias("copies"),
        F.count("*").alias("unique_segments"),
        F.count_if("conflicting").alias("conflicting"),
    )
    head = F.get("parts", F.lit(0))
    first, length = head["payload"], bits.unsigned(head["payload"], 4, 2) + 7
    last = F.floor((length - 1) / SEGMENT_PAYLOAD)

    def fits(part: Column) -> Column:
        i = part["segment_index"]
        size = F.when(i == last, length - SEGMENT_PAYLOAD * last).otherwise(F.lit(SEGMENT_PAYLOAD))
        flag = F.when(i == 0, 1).when(i == last, 2).otherwise(0)
        return (F.octet_length(part["payload"]) == size) & (part["flag"] == flag)

    wanted = F.filter("parts", lambda p: p["segment_index"] <= last)
    matching = (bits.bit_field(first, 0, 3) == 0) & (bits.bit_field(first, 5, 11) == F.col("apid")) & length.between(16, SEGMENT_PAYLOAD * 256)
    status = (
        F.when(head["segment_index"] != 0, "orphan")
        .when((head["flag"] != 1) | (F.octet_length(first) < 6), "bad_start")
        .when(~F.coalesce(matching, F.lit(False)), "bad_header")
        .when(F.size(wanted) != last + 1, "missing_segments")
        .when(~F.forall(wanted, fits), "bad_layout")
        .otherwise("complete")
    )
    whole = F.unhex(F.aggregate(wanted, F.lit(""), lambda a, p: F.concat(a, F.hex(p["payload"]))))
    payload = F.when(F.col("status") == "complete", F.substring(whole, F.lit(17), (length - 16).cast("int")))
    return groups.withColumn("status", status).withColumn("payload", payload).drop("parts")


def reassembly_statistics(packets: DataFrame) -> DataFrame:
    """Counts over reassembled packets in one row."""
    return packets.agg(
        F.count("*").alias("groups"),
        F.sum("unique_segments").alias("unique_segments"),
        F.sum(F.col("copies") - F.col("unique_segments")).alias("duplicates"),
        F.sum("conflicting").alias("conflicting"),
        F.count_if(F.col("status") == "complete").alias("complete"),
        F.count_if(F.col("status") != "complete").alias("incomplete"),
        F.count_if(F.col("status") == "orphan").alias("orphans"),
    )
