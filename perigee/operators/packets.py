"""Packets as tables: structure, contracts, dictionaries, decoding and summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from perigee.functions import bits
from perigee.operators.asof import asof_join
from perigee.operators.ordering import number_rows, running_sums
from perigee.sources.scratch import dealt_by, small


def with_header(packets: DataFrame, packet_col: str = "packet") -> DataFrame:
    """packets with the fields of the primary header."""
    return packets.withColumns(bits.header_fields(F.col(packet_col)))


def expected_bytes(fields: DataFrame) -> DataFrame:
    """apid and expected bytes of packets whose fields' bits make whole bytes."""
    width = F.regexp_extract("data_type", r"(\d+)$", 1).try_cast("int")
    total = fields.groupBy("apid").agg(F.sum(width).alias("bits"))
    return total.filter("bits % 8 = 0").select("apid", F.expr("cast(bits div 8 as int)").alias("expected_bytes"))


def structural(packets: DataFrame, expected: DataFrame) -> DataFrame:
    """Packets that can be what they say: version 0, telemetry with a secondary header, a known APID, a length of 7
    or more that is the expected one or one more, and no more bytes than there are. The dictionary is broadcast if it is small."""
    headed = with_header(packets).filter("version = 0 and packet_type = 0 and secondary_header_flag = 1 and packet_length >= 7")
    joined = headed.join(small(expected), "apid")
    return joined.filter("packet_length in (expected_bytes, expected_bytes + 1) and octet_length(packet) >= packet_length")


def beacon_reason(packet: Column, accepted_lengths: list[int], apid: int = 1) -> Column:
    """Why a packet breaks the beacon contract, null if it doesn't; checks run in order and the first counts."""
    head = bits.header_fields(packet)
    return (
        F.when(F.octet_length(packet) < 16, "too_short")
        .when(head["version"] != 0, "version")
        .when(head["packet_type"] != 0, "not_telemetry")
        .when(head["secondary_header_flag"] != 1, "no_secondary_header")
        .when(head["apid"] != apid, "apid")
        .when(head["packet_length"] != F.octet_length(packet), "declared_length")
        .when(~F.octet_length(packet).isin(accepted_lengths), "accepted_length")
        .when(bits.fletcher32(bits.body(packet)) != bits.stored_checksum(packet), "checksum")
        .when(bits.unsigned(packet, 10, 2) > 999, "fine_time")
    )


def with_packet_names(packets: DataFrame, names: DataFrame) -> DataFrame:
    """packets with the name of their APID, `apid_<n>` if it has none. The dictionary (apid, packet_name) is broadcast if it is small."""
    joined = packets.join(small(names), "apid", "left")
    return joined.withColumn("packet_name", F.coalesce("packet_name", F.concat(F.lit("apid_"), F.col("apid"))))


def field_layout(fields: DataFrame) -> DataFrame:
    """fields (apid, ordinal, name, data_type) with kind, bit_length, bit_offset, and a name that is unique in its packet.

    Offsets are running sums of the widths in file order; repeated names get _2, _3 and so on. A field whose type has no
    width has no place in a packet and is left out. A large dictionary is dealt to partitions of bounded size.
    """
    order = Window.partitionBy("apid").orderBy("ordinal")
    width = F.regexp_extract("data_type", r"(\d+)$", 1).try_cast("int")
    copy = F.row_number().over(Window.partitionBy("apid", "name").orderBy("ordinal"))
    return (
        dealt_by(fields, "apid")
        .withColumn("kind", F.upper(F.substring("data_type", 1, 1)))
        .withColumn("bit_length", width)
        .filter("bit_length > 0")
        .withColumn("bit_offset", (F.sum("bit_length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bit_length")).cast("int"))
        .withColumn("field", F.when(copy > 1, F.concat("name", F.lit("_"), copy)).otherwise(F.col("name")))
    )


def field_value(packet: Column, kind: str, offset: int, width: int) -> Column:
    """One field: F as IEEE number where aligned, I as two's complement, C as text (hexadecimal if not ASCII), else unsigned."""
    if kind == "F" and offset % 8 == 0 and width in (32, 64):
        return bits.ieee_float(packet, offset // 8, width)
    if kind == "C" and offset % 8 == 0 and width % 8 == 0:
        raw = F.when(F.octet_length(packet) >= (offset + width) // 8, F.substring(packet, offset // 8 + 1, width // 8))
        digits = F.lower(F.hex(raw))
        text = F.regexp_replace(F.decode(raw, "US-ASCII"), r"\x00+\z", "")
        return F.when(digits.rlike("^([0-7][0-9a-f])*$"), text).otherwise(digits)
    value = bits.bit_field(packet, offset, width)
    return bits.signed(value, width) if kind == "I" else value


def decode(packets: DataFrame, layout: list[tuple[str, str, int, int]], keep: list[str], packet_col: str = "packet") -> DataFrame:
    """Packets of one APID with a column for each (name, kind, bit offset, bits), by one generated select.

    status is decode_failed if a field reaches past the end, else decoded.
    """
    packet = F.col(packet_col)
    last = max((offset + width for _, _, offset, width in layout), default=0)
    status = F.when(F.octet_length(packet) * 8 < last, "decode_failed").otherwise("decoded").alias("status")
    return packets.select(*keep, status, *[field_value(packet, k, o, w).alias(n) for n, k, o, w in layout])


#: Bits of the widest field that isn't text.
MOST_BITS = 64

TYPED = "struct<whole:decimal(20,0),real:double,text:string>"


def too_wide(kind: Column, offset: Column, width: Column) -> Column:
    """Whether a field has more bits than a number may have, and isn't text."""
    as_text = (kind == "C") & (offset % 8 == 0) & (width % 8 == 0)
    return (width > MOST_BITS) & ~as_text


def field_fault(packet: Column, field: Column, kind: Column, offset: Column, width: Column) -> Column:
    """Why a field can't be read, null if it can."""
    size = F.coalesce(F.octet_length(packet), F.lit(0))
    return (
        F.when(too_wide(kind, offset, width), F.format_string("%s has %d bits", field, width))
        .when(size * 8 < offset + width, F.format_string("%d bytes, %d needed", size, F.floor((offset + width + 7) / 8)))
    )


def decode_long(packets: DataFrame, layout: DataFrame) -> DataFrame:
    """One row for each packet and field of its APID (expanding join), with status, error and the typed value.

    Offset, width and kind come from the dictionary's row. raw_value is the whole number, if the field is one. A field
    that can't be read makes its own row decode_failed with a text; the job goes on.
    """
    joined = packets.join(small(layout.select("apid", "field", "kind", "bit_offset", "bit_length")), "apid")
    field, kind, offset, width = (F.col(c) for c in ("field", "kind", "bit_offset", "bit_length"))
    joined = joined.withColumn("error", field_fault(F.col("packet"), field, kind, offset, width))
    readable = F.col("error").isNull()
    typed = joined.withColumn("value", F.when(readable, bits.any_value(F.col("packet"), kind, offset, width)))
    return typed.withColumns({"raw_value": F.col("value.whole"), "status": F.when(readable, "decoded").otherwise("decode_failed")})


def dictionary_fields(packet: Column, fields: Column) -> Column:
    """Typed values by name of the fields (field, kind, bit_offset, bit_length: array of structs) of a packet that holds them all."""
    value = lambda f: bits.any_value(packet, f["kind"], f["bit_offset"], f["bit_length"])
    return F.map_from_entries(F.transform(fields, lambda f: F.struct(f["field"], value(f))))


def decode_each(packets: DataFrame, layout: DataFrame, registered: dict[str, Callable[[bytes], dict[str, float]]]) -> DataFrame:
    """packets (apid, packet_name, packet) with decoder_kind, status, error and fields: typed values by name.

    A decoder registered for the packet's name comes first, then the dictionary (see field_layout), then none. What a
    registered decoder raises, and the first field that can't be read, make decode_failed with a text. Packets without a
    decoder have no_decoder; a null packet counts as an empty one. Packets aren't shuffled if the dictionary is small.
    """
    entry = F.struct("ordinal", "field", "kind", "bit_offset", "bit_length")
    end, wide = F.col("bit_offset") + F.col("bit_length"), too_wide(F.col("kind"), F.col("bit_offset"), F.col("bit_length"))
    dictionary = layout.groupBy("apid").agg(
        F.array_sort(F.collect_list(entry)).alias("_fields"), F.max(end).alias("_end"), F.max(F.coalesce(wide, F.lit(False))).alias("_wide")
    )  # of one packet
    own = F.coalesce(F.col("packet_name").isin(*registered), F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # only names and packets become Python's; all other columns go through as they are
            found = [attempt(registered[name], data or b"") for name, data in zip(batch["packet_name"].to_pylist(), batch["packet"].to_pylist(), strict=True)]
            kinds, statuses = ["registered"] * len(found), ["decode_failed" if e else "decoded" for _, e in found]
            numbers = pa.array([None if f is None else list(f.items()) for f, _ in found], pa.map_(pa.string(), pa.float64()))
            results = [pa.array(kinds, pa.string()), pa.array(statuses, pa.string()), pa.array([e for _, e in found], pa.string()), numbers]
            yield pa.RecordBatch.from_arrays([*batch.columns, *results], [*batch.schema.names, *schema.names[-4:]])

    added = "decoder_kind string, status string, error string"
    plain = packets.filter(~own).join(small(dictionary), "apid", "left")
    faults = F.transform("_fields", lambda f: field_fault(F.col("packet"), f["field"], f["kind"], f["bit_offset"], f["bit_length"]))
    held = ~F.col("_wide") & (F.octet_length("packet") * 8 >= F.col("_end"))  # then no field needs to be looked at
    plain = plain.withColumn("error", F.when(~held | held.isNull(), F.get(F.array_compact(faults), F.lit(0))))
    none, failed = F.col("_fields").isNull(), F.col("error").isNotNull()
    decoded = plain.select(
        *packets.columns,
        F.when(none, "none").otherwise("dictionary").alias("decoder_kind"),
        F.when(none, "no_decoder").when(failed, "decode_failed").otherwise("decoded").alias("status"),
        "error",
        F.when(~none & ~failed, dictionary_fields(F.col("packet"), F.col("_fields"))).cast(f"map<string,{TYPED}>").alias("fields"),
    )
    if not registered:
        return decoded
    schema = StructType([*packets.schema.fields, *StructType.fromDDL(added + ", numbers map<string,double>").fields])
    by_user = packets.filter(own).mapInArrow(run, schema)
    typed = F.transform_values("numbers", lambda _, v: F.struct(F.lit(None).alias("whole"), v.alias("real"), F.lit(None).alias("text")).cast(TYPED))
    return by_user.withColumn("fields", typed).drop("numbers").unionByName(decoded)


def attempt(decoder: Callable[[bytes], dict[str, float]], data: bytes) -> tuple[dict[str, float] | None, str | None]:
    """A decoder's fields, or what went wrong."""
    try:
        return {k: float(v) for k, v in decoder(data).items()}, None
    except Exception as fault:  # noqa: BLE001  a user's function may raise anything; it is reported with its packet
        return None, str(fault) or type(fault).__name__


def decode_summary(decoded: DataFrame) -> DataFrame:
    """Per APID: packets by status and their sizes. Needs apid, status, packet_bytes."""
    count = lambda status: F.count_if(F.col("status") == status).alias(status)
    sizes = [F.round(F.avg("packet_bytes"), 1).alias("avg_bytes"), F.min("packet_bytes").alias("min_bytes"), F.max("packet_bytes").alias("max_bytes")]
    return decoded.groupBy("apid").agg(F.count("*").alias("packets"), count("decoded"), count("decode_failed"), count("no_decoder"), *sizes)


def packet_statistics(packets: DataFrame) -> DataFrame:
    """Per APID and in total (apid null): candidates, valid and failed packets and bytes, sizes, packets by algorithm."""
    n = F.octet_length("packet").cast("long")
    valid = F.col("algorithm").isNotNull()
    of_apid = packets.groupBy("apid").agg(
        F.count("*").alias("candidates"),
        F.sum(n).alias("candidate_bytes"),
        F.count_if(valid).alias("valid"),
        F.sum(F.when(valid, n).otherwise(0)).alias("valid_bytes"),
        F.count_if(~valid).alias("failed"),
        F.min(n).alias("min_bytes"),
        F.max(n).alias("max_bytes"),
    )
    sums = [F.sum(c).alias(c) for c in ("candidates", "candidate_bytes", "valid", "valid_bytes", "failed")]
    return of_apid.rollup("apid").agg(*sums, F.min("min_bytes").alias("min_bytes"), F.max("max_bytes").alias("max_bytes"))


def algorithm_counts(packets: DataFrame) -> DataFrame:
    """Per APID, packets by checksum algorithm as a map."""
    counted = packets.filter("algorithm is not null").groupBy("apid", "algorithm").agg(F.count("*").alias("n"))
    entries = F.array_sort(F.collect_list(F.struct("algorithm", "n")))  # one for each algorithm
    return counted.groupBy("apid").agg(F.map_from_entries(entries).alias("algorithms"))


def mark_duplicates(packets: DataFrame, packet_col: str = "packet") -> DataFrame:
    """packets with the size of their group of equal bytes, a flag, and a group id numbered in order of hash.

    Groups are counted with map-side sums and joined back; only hashes that occur twice or more are numbered and joined,
    by a broadcast if they are few, so that packets then aren't shuffled.
    """
    hashed = packets.withColumn("packet_sha256", F.sha2(packet_col, 256))
    groups = hashed.groupBy("packet_sha256").agg(F.count("*").alias("group_size")).filter("group_size > 1")
    numbered = number_rows(groups, ["packet_sha256"], "number", start=1)
    name = F.format_string("dup_%06d", "number").alias("duplicate_group")
    joined = hashed.join(small(numbered.select("packet_sha256", "group_size", name)), "packet_sha256", "left")
    return joined.withColumn("group_size", F.coalesce("group_size", F.lit(1)).cast("long")).withColumn("is_duplicate", F.col("group_size") > 1)


def merge_sources(packets: DataFrame, tie: list[str], source: str = "source") -> DataFrame:
    """All sources in time order with packet_index: timed packets by (coarse, fine, source, …), untimed ones after them.

    Needs time_key, a STRUCT(coarse, fine) or null, and the column that names the source.
    """
    keyed = packets.withColumns({"_untimed": F.col("time_key").isNull(), "_coarse": F.col("time_key.coarse"), "_fine": F.col("time_key.fine")})
    return number_rows(keyed, ["_untimed", "_coarse", "_fine", source, *tie]).drop("_untimed", "_coarse", "_fine")


def source_summary(packets: DataFrame, top: int = 12) -> DataFrame:
    """Per source: files, packets, bytes, and its most common APIDs as `apid:count`, ties in order of first arrival."""
    per_apid = packets.groupBy("source", "apid").agg(F.count("*").alias("n"), F.min("arrival").alias("first"))
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "first"))
    best = per_apid.withColumn("rank", rank).filter(F.col("rank") <= top).groupBy("source")
    shown = F.transform(F.array_sort(F.collect_list(F.struct("rank", "apid", "n"))), lambda x: F.concat(x["apid"], F.lit(":"), x["n"]))
    totals = packets.groupBy("source").agg(F.count_distinct("file").alias("files"), F.count("*").alias("packets"), F.sum(F.octet_length("packet")).alias("packet_bytes"))
    return totals.join(best.agg(F.array_join(shown, " ").alias("top_apids")), "source")


def source_of_offset(packets: DataFrame, files: DataFrame) -> DataFrame:
    """packets with the file whose bytes [base, base + length) hold their offset, if any.

    Files stand one after another by `position`; their bases are running sums of lengths, so nothing is concatenated.
    A packet takes the last file that begins at or before it, and keeps it if its bytes reach so far.
    """
    based = running_sums(files, ["position"], "length", "base")
    joined = asof_join(packets, based, "offset", "base", prefix="_f", order=["position"])
    inside = F.col("offset") < F.col("_f_base") + F.col("_f_length")
    return joined.select(*packets.columns, *[F.when(inside, F.col(f"_f_{c}")).alias(c) for c in based.columns])


def manifest(packets: DataFrame, names: DataFrame, decoders: dict[str, str]) -> DataFrame:
    """One row for each packet (packet_index, packet) with its header, copies, decoder and the table it is decoded to.

    decoders: kind of decoder by packet name; packets of other names have none and point nowhere.
    """
    headed = with_packet_names(mark_duplicates(with_header(packets)), names)
    kind = F.try_element_at(F.create_map(*[F.lit(x) for kv in decoders.items() for x in kv]), F.col("packet_name"))
    table = F.concat(F.lit("decoded_apid_"), F.col("apid"), F.lit("_"), F.col("packet_name"), F.lit(".csv"))
    return headed.select(
        "packet_index",
        "apid",
        "packet_name",
        F.octet_length("packet").alias("packet_len"),
        "sequence_count",
        F.col("group_size").alias("duplicate_group_size"),
        F.coalesce(kind, F.lit("none")).alias("decoder_kind"),
        F.when(kind.isNull(), "no_decoder").otherwise("decoded").alias("decode_status"),
        F.when(kind.isNotNull(), table).alias("decoded_csv"),
    )
