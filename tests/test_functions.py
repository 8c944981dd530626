"""Scalar functions, recovery, store and streams on small inputs."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.functions import bits, clock, status
from perigee.operators import asof, packetizer, packets, recovery, series
from perigee.operators.store import TelemetryStore
from perigee.plans.value_queries import st5_sigma_filter_batch


def fletcher(data, order):
    data += b"\0" * (len(data) % 2)
    a = b = 0xFFFF
    for i in range(0, len(data), 2):
        a = (a + int.from_bytes(data[i : i + 2], order)) % 0xFFFF
        b = (b + a) % 0xFFFF
    return b << 16 | a


def test_checksums_and_fields(spark):
    rng = random.Random(1)
    rows = [(rng.randbytes(n),) for n in (0, 1, 2, 3, 7, 20, 251, 1000)]
    frame = spark.createDataFrame(rows, "p binary")
    p = F.col("p")
    for r in frame.select(p, bits.fletcher32(p).alias("le"), bits.fletcher32(p, False).alias("be"), bits.additive32(p).alias("sum"), bits.bit_field(p, 13, 64).alias("wide"), bits.bit_field(p, 3, 5).alias("low")).collect():
        data = bytes(r["p"])
        assert r["le"] == fletcher(data, "little") and r["be"] == fletcher(data, "big")
        padded = data + b"\0" * (-len(data) % 4)
        assert r["sum"] == sum(int.from_bytes(padded[i : i + 4], "big") for i in range(0, len(padded), 4)) % 2**32
        text = "".join(f"{x:08b}" for x in data)
        assert r["wide"] == (int(text[13:77], 2) if len(text) >= 80 else None)
        assert r["low"] == (int(text[3:8], 2) if text else None)


def test_floats(spark):
    values = [0.0, -0.0, 1.5, -2.75, 1e-40, 3e38, math.inf, -math.inf, math.nan, 5e-324, 1.7e308, math.pi]
    as_single = [v if abs(v) < 3.5e38 or not math.isfinite(v) else 1.0 for v in values]
    frame = spark.createDataFrame([(struct.pack(">f", s) + struct.pack(">d", d),) for s, d in zip(as_single, values, strict=True)], "p binary")
    found = frame.select(bits.ieee_float(F.col("p"), 0, 32).alias("s"), bits.ieee_float(F.col("p"), 4, 64).alias("d")).collect()
    for r, s, d in zip(found, as_single, values, strict=True):
        single = struct.unpack(">f", struct.pack(">f", s))[0]
        assert (r["s"] == single or math.isnan(single) and math.isnan(r["s"])) and (r["d"] == d or math.isnan(d) and math.isnan(r["d"]))


def test_clock(spark):
    rows = [(100.0, 234.0), (1.0, 999.0), (1.0, 1000.0), (-1.0, 0.0), (1.0, 0.5), (math.inf, 0.0), (189_388_800.0, 0.0), (189_388_799.0, 0.0)]
    found = spark.createDataFrame(rows, "c double, f double").select(clock.combine_time(F.col("c"), F.col("f")).alias("t")).withColumn("u", clock.utc_text(F.col("t"))).collect()
    assert [r["t"] for r in found] == [100.234, 1.999, None, None, None, None, 189_388_800.0, 189_388_799.0]
    assert found[0]["u"] == "2000-01-01T00:01:40.234Z" and found[6]["u"] == "2006-01-01T00:00:01Z" and found[7]["u"] == "2005-12-31T23:59:59Z"


def test_names(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(status.unit_of(F.lit("bat_temp_v"))) == "Celsius" and get(status.unit_of(F.lit("x"))) is None
    assert get(status.file_stem(F.lit("  "))) == "unknown"
    assert get(status.mode_state(F.lit("safe")))["label"] == "SAFE MODE" and get(status.mode_state(F.lit(None).cast("string")))["label"] == "?"
    assert get(status.polynomial(F.lit("C0=1 C2=3"), F.lit(2.0))) is None


def test_segments(spark):
    payload = bytes(range(256)) * 3
    inner = (0x0848).to_bytes(2, "big") + b"\xc0\x01" + (700 - 7).to_bytes(2, "big") + payload[: 700 - 6]
    parts = [inner[i : i + 244] for i in range(0, 700, 244)]
    rows = [(72, 1, i, 1 if i == 0 else 2 if i == 2 else 0, p, 10 * i + c) for i, p in enumerate(parts) for c in (0, 1)]
    rows += [(72, 1, 1, 0, b"bad", 5), (72, 2, 1, 0, parts[1], 90), (72, 3, 0, 1, parts[0], 91)]
    frame = spark.createDataFrame(rows, "apid int, sequence long, segment_index int, flag int, payload binary, offset long")
    found = {r["sequence"]: r for r in recovery.reassemble(frame).collect()}
    assert found[1]["status"] == "complete" and bytes(found[1]["payload"]) == inner[16:] and found[1]["conflicting"] == 1
    assert (found[2]["status"], found[3]["status"]) == ("orphan", "missing_segments")
    counts = recovery.reassembly_statistics(recovery.reassemble(frame)).first()
    assert (counts["groups"], counts["complete"], counts["orphans"], counts["duplicates"]) == (3, 1, 1, 4)


def test_frames(spark):
    head = recovery.SYNC + (66 << 4).to_bytes(2, "big") + bytes(4) + bytes(2)
    data = bytes(i % 251 for i in range(2040))
    frames = head + data + b"UUUU" + head + b"U" * 2044
    frame = spark.createDataFrame([(1, frames), (2, b"short")], "capture_id long, content binary")
    cut = recovery.cut_frames(frame)
    counted = {r["capture_id"]: r for r in recovery.frame_statistics(cut).collect()}
    assert (counted[1]["records"], counted[1]["expected_headers"], counted[1]["idle_frames"]) == (2, 2, 1) and counted[2]["with_sync"] == 0
    stream = {r["capture_id"]: bytes(r["content"]) for r in recovery.payload_stream(cut).collect()}
    assert stream[1] == recovery.reverse_words(data) and stream[2] == b"rohst"
    assert recovery.remove_seams(b"abUUUU" + head + b"cd" + recovery.SYNC + b"e") == b"abcde"


def test_repair():
    packet = bytes(range(20))
    assert packetizer.without_repeats(packet[:8] + packet[4:8] + packet[8:], 20) == (packet, 24)
    assert packetizer.without_repeats(packet + bytes(range(70, 90)), 20) is None


def test_numbering_is_gapless(spark):
    frame = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    found = packets.number_rows(frame, ["v"]).collect()
    assert sorted((r["v"], r["packet_index"]) for r in found) == [(i, i) for i in range(1000)]


def test_store(spark, tmp_path):
    store = TelemetryStore(spark, f"file://{tmp_path}/store")
    first = spark.createDataFrame([(1.0, 10)], "time double, temperature int")
    second = spark.createDataFrame([(3.0, 12, "x")], "time double, temperature int, note string")
    assert store.append(7, "beacon", "a.csv", "aa", first) and store.append(7, "Beacon2", "b.csv", "bb", second)
    assert not store.append(7, "beacon", "c.csv", "aa", first)
    assert sorted((r["time"], r["temperature"], r["note"]) for r in store.table("BEACON2").collect()) == [(1.0, 10, None), (3.0, 12, "x")]
    assert [(r["apid"], r["rows"]) for r in store.summary().collect()] == [(7, 2)]


def outside(limits, value):
    return not limits[0] <= value <= limits[1]


def test_sigma_filter(spark, small):
    rows = st5_sigma_filter_batch(spark, small).collect()
    accepted: dict = {}
    for r in sorted(rows, key=lambda r: r["us"]):
        last = accepted.setdefault(r["field"], [])
        assert r["rejected"] == outside(series.value_limits(last, 4.0, 50, 12, 0.0, 0.0), r["value"])
        if not r["rejected"]:
            last.append(r["value"])
    values = [10.0, 10.1, 9.9, 10.05, 9.95]
    assert outside(series.value_limits(values, 4.0, 50, 5, 0.0, 0.0), 50.0) and not outside(series.value_limits(values, 4.0, 50, 12, 0.0, 0.0), 10.2)


def test_asof_join_over_many_buckets_equals_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(asof, "BUCKET_BYTES", 48)
    left = [(i, None if i % 11 == 0 else float(i * 7 % 50)) for i in range(60)]
    right = [(i, None if i == 5 else float(i * i % 45)) for i in range(20)] + [(99, 1e12)]
    found = asof.asof_join(spark.createDataFrame(left, "id int, x double"), spark.createDataFrame(right, "n int, x double"), "x", prefix="s", order=["n"])
    expected = {}
    for i, x in left:
        before = [(y, n) for n, y in right if x is not None and y is not None and y <= x]
        expected[i] = max(before)[1] if before else None
    assert {r["id"]: r["s_n"] for r in found.collect()} == expected


def test_percentiles_are_exact_with_ties_and_nulls(spark):
    values = {"a": [float(i * 37 % 1000) for i in range(3000)], "b": [1.0] * 500 + [2.0], "c": [5.0]}
    rows = [(k, v) for k, vs in values.items() for v in [*vs, None]] + [("d", None)]
    found = series.percentiles(spark.createDataFrame(rows, "k string, v double"), "k", "v", [0.005, 0.5, 0.995]).collect()
    assert {r["k"] for r in found} == set(values)
    for r in found:
        assert r["bounds"] == pytest.approx(list(np.percentile(values[r["k"]], [0.5, 50, 99.5])))


def test_asof_join_without_zone_where_clocks_jump(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stamps = ["2024-03-10 01:00:00", "2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-11-03 00:59:59.000001"]
        right = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "n int, s string").select("n", F.col("s").cast("timestamp_ntz").alias("t"))
        left = spark.createDataFrame([("a", "2024-03-10 03:00:00"), ("b", "2024-03-10 02:00:00"), ("c", "2024-11-03 01:00:00")], "id string, s string")
        left = left.select("id", F.col("s").cast("timestamp_ntz").alias("t"))
        for size in (32 << 20, 16):
            asof.BUCKET_BYTES, before = size, asof.BUCKET_BYTES
            found = {r["id"]: r["x_n"] for r in asof.asof_join(left, right, "t", prefix="x").collect()}
            asof.BUCKET_BYTES = before
            assert found == {"a": 1, "b": 0, "c": 3}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_asof_join_on_decimals_dates_and_infinities(spark, monkeypatch):
    monkeypatch.setattr(asof, "BUCKET_BYTES", 16)
    for kind, left, right, expected in (
        ("decimal(20,10)", ["0.00000000015", "5", "-1"], ["0.0000000001", "4.9999999999", "6"], [0, 1, None]),
        ("date", ["2024-02-29", "1969-12-31", "2025-01-01"], ["2024-02-28", "1970-01-01", "2024-03-01"], [0, None, 2]),
        ("double", ["Infinity", "-Infinity", "1"], ["-Infinity", "0.5", "Infinity"], [2, 0, 1]),
        ("timestamp", ["2024-01-01 00:00:01", "2023-01-01 00:00:00", "2024-01-02 00:00:00"], ["2024-01-01 00:00:00", "2024-01-01 00:00:01", "2024-01-03 00:00:00"], [1, None, 1]),
    ):
        make = lambda rows: spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, s string").select("i", F.col("s").cast(kind).alias("t"))  # noqa: E731,B023
        found = {r["i"]: r["x_i"] for r in asof.asof_join(make(left), make(right), "t", prefix="x").collect()}
        assert [found[i] for i in range(len(left))] == expected, kind


def test_typed_fields_of_all_kinds(spark):
    data = struct.pack(">HQqdf4sB", 0xABCD, 2**64 - 3, -5, -1.5, 1.5, b"ok\0\0", 7)
    fields = [("u16", "U16"), ("u64", "U64"), ("i64", "I64"), ("f64", "F64"), ("f32", "F32"), ("c", "C32"), ("u3", "U3"), ("i5", "I5")]
    bad = [("wide", "U72"), ("none", "X")]
    rows = [(1, i, *f) for i, f in enumerate(fields)] + [(2, i, *f) for i, f in enumerate(fields + bad[:1])] + [(3, 0, *bad[1])]
    layout = packets.field_layout(spark.createDataFrame(rows, "apid int, ordinal int, name string, data_type string"))
    given = spark.createDataFrame([(1, "a", bytearray(data)), (1, "a", bytearray(data[:9])), (1, "a", None), (2, "b", bytearray(data * 2)), (3, "c", bytearray(data))], "apid int, packet_name string, packet binary")
    found = packets.decode_each(given, layout, {}).collect()
    first = {k: next(x for x in v if x is not None) for k, v in found[0]["fields"].items()}
    assert first == {"u16": 0xABCD, "u64": 2**64 - 3, "i64": -5, "f64": -1.5, "f32": 1.5, "c": "ok", "u3": 0, "i5": 7}
    assert [r["status"] for r in found] == ["decoded", *["decode_failed"] * 3, "no_decoder"]  # 3 has only a field without a width
    assert [r["error"] for r in found][1:] == ["9 bytes, 10 needed", "0 bytes, 2 needed", "wide has 72 bits", None]
    long = {(r["apid"], r["field"]): r for r in packets.decode_long(given.filter("octet_length(packet) > 20"), layout).collect()}
    assert long[1, "u64"]["raw_value"] == 2**64 - 3 and long[1, "f32"]["value"]["real"] == 1.5 and long[2, "wide"]["status"] == "decode_failed"
    assert long[2, "i5"]["raw_value"] == 7


def test_nul_before_a_line_end_stays_in_a_text(spark):
    rows = [(bytearray(b"ab\0\n"), "ab\0\n"), (bytearray(b"ab\0\0"), "ab"), (bytearray(b"a\0b\r"), "a\0b\r"), (bytearray(b"a\0\r\n"), "a\0\r\n")]
    frame = spark.createDataFrame(rows, "p binary, wanted string")
    by_row = bits.any_value(F.col("p"), F.lit("C"), F.lit(0), F.lit(32))["text"]
    for r in frame.select("wanted", by_row.alias("a"), packets.field_value(F.col("p"), "C", 0, 32).alias("b")).collect():
        assert r["a"] == r["b"] == r["wanted"]


def test_spacecraft_seconds_of_utc_come_back_as_utc(spark):
    moments = ["2005-12-31T23:59:59", "2006-01-01T00:00:01", "2016-12-31T23:59:59", "2017-01-01T00:00:01", "2024-01-30T23:59:59"]
    frame = spark.createDataFrame([(m,) for m in moments], "m string")
    seconds = clock.spacecraft_seconds(F.unix_timestamp("m", "yyyy-MM-dd'T'HH:mm:ss").cast("double"))
    assert all(r["t"] == r["m"] + "Z" for r in frame.select("m", clock.utc_text(seconds).alias("t")).collect())


def test_buckets_of_asof_joins_hold_few_rows(spark):
    sides = [spark.range(lo, lo + 1_000_000).select(F.col("id").alias("x")) for lo in (0, 500_000)]
    cuts = asof.cuts_of(sides)
    assert 6 <= len(cuts) <= 9  # of 16 MB
    sizes = [r["count"] for r in sides[0].unionAll(sides[1]).groupBy(asof.bucket_of(F.col("x"), cuts)).count().collect()]
    assert max(sizes) < 500_000
