"""Bytes, bit fields and checksums of packets held in BINARY columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fletcher sums are taken modulo this; both start at it, which is as good as 0.
FLETCHER_MODULUS = 65535

HEADER = {"version": (0, 3), "packet_type": (3, 1), "secondary_header_flag": (4, 1), "apid": (5, 11), "sequence_flags": (16, 2), "sequence_count": (18, 14), "length_field": (32, 16)}

FRAME_HEADER = {"frame_version": (32, 2), "spacecraft_id": (34, 10), "virtual_channel": (44, 3), "ocf_flag": (47, 1), "master_count": (48, 8), "channel_count": (56, 8), "secondary_flag": (64, 1), "sync_flag": (65, 1), "packet_order": (66, 1), "segment_length": (67, 2), "first_header_pointer": (69, 11), "padding": (80, 16)}


def unsigned(packet: Column, start: int | Column, length: int) -> Column:
    """Big-endian unsigned integer of `length` (1 to 7) bytes from `start` (from 0); null past the end."""
    start = F.lit(start) if isinstance(start, int) else start
    value = F.conv(F.hex(F.substring(packet, start + 1, F.lit(length))), 16, 10).cast("long")
    return F.when(F.octet_length(packet) >= start + length, value)


def bit_field(packet: Column, offset: int, width: int) -> Column:
    """Unsigned integer of `width` bits from bit `offset`; null past the end. Above 48 bits the type is DECIMAL."""
    first, last = offset // 8, (offset + width - 1) // 8
    below = 8 * (last + 1) - offset - width
    if last - first < 7:
        return F.shiftright(unsigned(packet, first, last - first + 1), below).bitwiseAND(F.lit((1 << width) - 1))
    digits = F.conv(F.hex(F.substring(packet, first + 1, 4)), 16, 10).cast("decimal(38,0)")
    for at in range(first + 4, last + 1):
        digits = (digits * 256 + F.conv(F.hex(F.substring(packet, at + 1, 1)), 16, 10).cast("decimal(38,0)")).cast("decimal(38,0)")
    power = lambda n: F.lit(str(1 << n)).cast("decimal(38,0)")
    whole = ((digits - digits % power(below)) / power(below)).cast("decimal(38,0)")
    return F.when(F.octet_length(packet) > last, (whole % power(width)).cast("decimal(20,0)"))


def header_fields(packet: Column) -> dict[str, Column]:
    """Primary header of a packet, with its total length (length field and 7)."""
    return {k: bit_field(packet, *v).cast("int") for k, v in HEADER.items()} | {"packet_length": (bit_field(packet, 32, 16) + 7).cast("int")}


def frame_header_fields(frame: Column) -> dict[str, Column]:
    """Primary header of a transfer frame, which stands after the 4-byte sync word."""
    return {k: bit_field(frame, *v).cast("int") for k, v in FRAME_HEADER.items()}


def words16(data: Column, little_endian: bool) -> Column:
    """The 16-bit words of data as an array of BIGINT; an odd last byte is padded with zero."""
    digits = F.hex(F.concat(data, F.when(F.octet_length(data) % 2 == 1, F.unhex(F.lit("00"))).otherwise(F.unhex(F.lit("")))))
    order = (3, 1) if little_endian else (1, 3)
    return F.transform(
        F.regexp_extract_all(digits, F.lit("(....)"), 1),
        lambda word: F.conv(F.concat(*[F.substring(word, at, 2) for at in order]), 16, 10).cast("long"),
    )


def fletcher32(data: Column, little_endian: bool = True) -> Column:
    """Fletcher-32 over 16-bit words, both sums starting at 0xFFFF.

    Both sums may start at 0 instead, which is the same modulo 0xFFFF.
    """
    zero = F.lit(0).cast("long")
    total = F.aggregate(
        words16(data, little_endian),
        F.struct(zero.alias("a"), zero.alias("b")),
        lambda s, w: F.struct(((s["a"] + w) % FLETCHER_MODULUS).alias("a"), ((s["b"] + s["a"] + w) % FLETCHER_MODULUS).alias("b")),
        lambda s: s["b"] * 65536 + s["a"],
    )
    start = F.lit((FLETCHER_MODULUS << 16) | FLETCHER_MODULUS).cast("long")
    return F.when(F.octet_length(data) > 0, total).otherwise(start)


def additive32(data: Column) -> Column:
    """Sum of big-endian 32-bit words modulo 2 ** 32; the last word is padded with zeros."""
    digits = F.concat(F.hex(data), F.repeat(F.lit("00"), F.pmod(-F.octet_length(data), F.lit(4))))
    words = F.transform(F.regexp_extract_all(digits, F.lit("(.{8})"), 1), lambda word: F.conv(word, 16, 10).cast("long"))
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, w: (a + w) % (1 << 32))


def body(packet: Column, start: int = 0) -> Column:
    """A packet's bytes from start to its last four."""
    return F.substring(packet, F.lit(start + 1), F.octet_length(packet) - 4 - start)


def stored_checksum(packet: Column, little_endian: bool = False) -> Column:
    """The last four bytes as an unsigned integer."""
    at = F.octet_length(packet)
    order = [at - i for i in range(4)] if little_endian else [at - 3 + i for i in range(4)]
    return F.conv(F.concat(*[F.hex(F.substring(packet, i, F.lit(1))) for i in order]), 16, 10).cast("long")


def checksum_algorithm(packet: Column, apid: Column, row_apid: int = 536) -> Column:
    """Name of the first checksum rule that holds for a packet, null if none does.

    Packets of row_apid carry an additive sum over the bytes after 12; the others Fletcher-32, tried with words and
    stored value in either byte order.
    """
    big, little = stored_checksum(packet), stored_checksum(packet, little_endian=True)
    rows, words_le, words_be = additive32(body(packet, 12)), fletcher32(body(packet)), fletcher32(body(packet), little_endian=False)
    return F.when(F.octet_length(packet) < 10, F.lit(None).cast("string")).otherwise(
        F.when(
            apid == row_apid,
            F.when(F.octet_length(packet) < 16, F.lit(None)).when(rows == big, "csie_additive_be").when(rows == little, "csie_additive_le"),
        ).otherwise(
            F.when(words_le == big, "fletcher32_le_words_stored_be")
            .when(words_le == little, "fletcher32_le_words_stored_le")
            .when(words_be == big, "fletcher32_be_words_stored_be")
            .when(words_be == little, "fletcher32_be_words_stored_le")
        )
    )


def trailer_kind(data_field: Column) -> Column:
    """Kind of a frame's 4-byte trailer: a valid checksum in either order, filler of 0x55, or null for payload."""
    computed = fletcher32(body(data_field))
    return F.when(
        F.octet_length(data_field) >= 4,
        F.when(computed == stored_checksum(data_field), "fletcher32_be")
        .when(computed == stored_checksum(data_field, little_endian=True), "fletcher32_le")
        .when(stored_checksum(data_field) == 0x55555555, "filler_55"),
    )


def reverse_words(data: Column, word_bytes: int) -> Column:
    """data with the bytes of each whole word reversed; what is left at the end stays."""
    groups, back = "(..)" * word_bytes, "".join(f"${i}" for i in range(word_bytes, 0, -1))
    whole = (F.octet_length(data) - F.octet_length(data) % word_bytes).cast("int")
    swapped = F.regexp_replace(F.hex(F.substring(data, F.lit(1), whole)), groups, back)
    return F.unhex(F.concat(swapped, F.hex(F.substring(data, whole + 1, F.octet_length(data)))))


def signed(value: Column, width: int) -> Column:
    """Two's complement of an unsigned integer of `width` bits."""
    return F.when(value >= (1 << (width - 1)), value - (1 << width)).otherwise(value)


def ieee_float(packet: Column, byte: int, width: int) -> Column:
    """IEEE number of 32 or 64 bits at a byte, by its sign, exponent and fraction."""
    exponent_bits, fraction_bits = (8, 23) if width == 32 else (11, 52)
    bias, at = (1 << (exponent_bits - 1)) - 1, 8 * byte
    sign = F.when(bit_field(packet, at, 1) == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent = bit_field(packet, at + 1, exponent_bits).cast("int")
    fraction = bit_field(packet, at + 1 + exponent_bits, fraction_bits).cast("double") / float(1 << fraction_bits)
    special = F.when(fraction == 0, sign * F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    usual = sign * (1 + fraction) * F.pow(F.lit(2.0), (exponent - bias).cast("double"))
    return (
        F.when(exponent.isNull(), F.lit(None).cast("double"))
        .when(exponent == (1 << exponent_bits) - 1, special)
        .when(exponent == 0, sign * fraction * F.pow(F.lit(2.0), F.lit(float(1 - bias))))
        .otherwise(usual)
    )


def marker_bounds(stream: Column) -> tuple[Column, Column]:
    """Start of the first FFD8 and end of the next FFD9 of a stream in bytes (from 0); null where there is none."""
    digits = F.hex(stream)

    def find(marker: str, start: Column) -> Column:
        bytes_left = F.sequence(start, F.greatest(start, F.octet_length(stream) - 2))
        return F.get(F.filter(bytes_left, lambda i: F.substring(digits, i * 2 + 1, F.lit(4)) == marker), F.lit(0))

    first = find("FFD8", F.lit(0))
    return first, find("FFD9", first + 2) + 2


def halves(packet: Column, offset: Column, width: Column) -> Column:
    """hi and lo, the upper and lower 32 bits of an unsigned field of 1 to 64 bits at any bit; offset and width may be columns."""
    shift = lambda x, n: F.call_function("shiftright", x, n)
    ones = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1
    first, last = F.floor(offset / 8).cast("int"), F.floor((offset + width - 1) / 8).cast("int")
    below = (8 * (last + 1) - offset - width).cast("int")
    digits = F.lpad(F.hex(F.substring(packet, first + 1, last - first + 1)), 18, "0")  # nine bytes at most
    high, low = (F.conv(F.substring(digits, at, n), 16, 10).cast("long") for at, n in ((1, 10), (11, 8)))
    low = shift(low, below).bitwiseOR(F.call_function("shiftleft", high.bitwiseAND(ones(below)), 32 - below))
    lower, upper = F.least(width, F.lit(32)).cast("int"), F.greatest(width - 32, F.lit(0)).cast("int")
    return F.struct(shift(high, below).bitwiseAND(ones(upper)).alias("hi"), low.bitwiseAND(ones(lower)).alias("lo"))


def ieee_of(hi: Column, lo: Column, width: Column) -> Column:
    """The IEEE number of 32 (lo alone) or 64 bits."""
    wide = width == 64
    top = F.when(wide, hi).otherwise(lo)
    sign = F.when(top >= 1 << 31, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent = F.when(wide, F.floor(hi / (1 << 20)) % 2048).otherwise(F.floor(lo / (1 << 23)) % 256).cast("int")
    fraction = F.when(wide, ((hi % (1 << 20)) * (1 << 32) + lo) / float(1 << 52)).otherwise((lo % (1 << 23)) / float(1 << 23))
    largest, bias = F.when(wide, 2047).otherwise(255), F.when(wide, 1023).otherwise(127)
    special = F.when(fraction == 0, sign * float("inf")).otherwise(float("nan"))
    scaled = F.when(exponent == 0, fraction * F.pow(F.lit(2.0), (1 - bias).cast("double"))).otherwise((1 + fraction) * F.pow(F.lit(2.0), (exponent - bias).cast("double")))
    return F.when(exponent == largest, special).otherwise(sign * scaled)


def typed_value(packet: Column, kind: Column, offset: Column, width: Column, parts: Column) -> Column:
    """A field's value as whole DECIMAL(20,0), real DOUBLE or text, of which one is set; parts are its halves.

    F of 32 or 64 aligned bits is real, C of aligned whole bytes text (hexadecimal if not ASCII, without NULs at its
    end), I a two's complement, and all others unsigned.
    """
    hi, lo = parts["hi"], parts["lo"]
    aligned = offset % 8 == 0
    is_real, is_text = (kind == "F") & aligned & width.isin(32, 64), (kind == "C") & aligned & (width % 8 == 0)
    power = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))
    negative = (kind == "I") & F.when(width > 32, hi * 2 >= power(width - 32)).otherwise(lo * 2 >= power(width))
    top = F.when(negative & (width > 32), hi - power(width - 32)).otherwise(hi)
    bottom = F.when(negative & (width <= 32), lo - power(width)).otherwise(lo)
    whole = (top.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + bottom.cast("decimal(20,0)")).cast("decimal(20,0)")
    raw = F.substring(packet, (offset / 8).cast("int") + 1, (width / 8).cast("int"))
    digits = F.lower(F.hex(raw))
    text = F.when(digits.rlike("^([0-7][0-9a-f])*$"), F.regexp_replace(F.decode(raw, "US-ASCII"), r"\x00+\z", "")).otherwise(digits)
    return F.struct(
        F.when(~is_real & ~is_text, whole).alias("whole"),
        F.when(is_real, ieee_of(hi, lo, width)).alias("real"),
        F.when(is_text, text).alias("text"),
    )


def any_value(packet: Column, kind: Column, offset: Column, width: Column) -> Column:
    """typed_value of a field of up to 64 bits, or of text of any width; whole numbers in up to 7 bytes are read as one."""
    first, last = F.floor(offset / 8).cast("int"), F.floor((offset + width - 1) / 8).cast("int")
    below = (8 * (last + 1) - offset - width).cast("int")
    digits = F.conv(F.hex(F.substring(packet, first + 1, last - first + 1)), 16, 10).cast("long")
    shift = lambda name, x, n: F.call_function(name, x, n)
    plain = shift("shiftright", digits, below).bitwiseAND(shift("shiftleft", F.lit(1).cast("long"), width.cast("int")) - 1)
    narrow = kind.isin("U", "I") & (last - first < 7)
    sign = F.when(kind == "I", shift("shiftleft", F.lit(1).cast("long"), (width - 1).cast("int"))).otherwise(0)
    whole = (plain.bitwiseXOR(sign) - sign).cast("decimal(20,0)")
    parts = F.array(F.when(width <= 64, halves(packet, offset, width)))
    wide = F.get(F.transform(parts, lambda p: typed_value(packet, kind, offset, width, p)), F.lit(0))  # halves are made once
    return F.when(narrow, F.struct(whole.alias("whole"), F.lit(None).cast("double").alias("real"), F.lit(None).cast("string").alias("text"))).otherwise(wide)


def number_of(value: Column) -> Column:
    """A typed value as DOUBLE; null for text."""
    return F.coalesce(value["real"], value["whole"].cast("double"))
