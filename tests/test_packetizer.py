"""Captures in pieces of any size against one plain walk."""

import random
import struct

import numpy as np
import pytest

from perigee.operators import packetizer as ops

APIDS = {1: 20, 16: 12, 536: 24}


def fletcher(data):
    a = b = 0
    for i in range(0, len(data), 2):
        a = (a + int.from_bytes(data[i : i + 2], "little")) % 65535
        b = (b + a) % 65535
    return b << 16 | a


def packet(apid, rng, right=True):
    n = APIDS[apid]
    body = struct.pack(">HHH", 2048 | apid, 0xC000 | rng.randrange(999), n - 7) + bytes(rng.choices(range(256), k=n - 10))
    value = sum(struct.unpack(f">{(n - 16) // 4}I", body[12:])) % 2**32 if apid == 536 else fletcher(body)
    return body + struct.pack(">I", value if right else value ^ 1)


def wrapper(inner):
    return struct.pack(">HHH", 68, 7, len(inner) + 9) + b"m" * 10 + inner


def capture(rng):
    out = b""
    for _ in range(rng.randint(0, 40)):
        own = packet(rng.choice(list(APIDS)), rng, rng.random() < 0.8)
        kind = rng.random()
        if kind < 0.15:
            own = wrapper(own)
        elif kind < 0.25:
            own = wrapper(own + b"!" * rng.randint(1, 5))
        elif kind < 0.35:
            own = own[: rng.randint(7, len(own))]  # cut off: what follows may be taken for its end
        out += own + rng.choice([b"", b"", b"U" * rng.randint(1, 9), bytes(rng.choices(range(256), k=7))])
    return out + (wrapper(b"x" * 50)[:40] if rng.random() < 0.3 else b"")


def head(data, at):
    if at + 6 > len(data):
        return None
    first, n = int.from_bytes(data[at : at + 2]), int.from_bytes(data[at + 4 : at + 6]) + 7
    apid = first & 0x7FF
    good = first >> 11 == 1 and apid in APIDS and n - APIDS[apid] in (0, 1) and at + n <= len(data)
    return (apid, n) if good else None


def holds(own, apid):
    if apid == 536:
        rest = own[12:-4] + b"\0" * (-len(own[12:-4]) % 4)
        total = sum(struct.unpack(f">{len(rest) // 4}I", rest)) % 2**32
        return total in (int.from_bytes(own[-4:], "big"), int.from_bytes(own[-4:], "little"))
    def sums(order):
        data = own[:-4] + b"\0" * (len(own) % 2)
        a = b = 0
        for i in range(0, len(data), 2):
            a = (a + int.from_bytes(data[i : i + 2], order)) % 65535
            b = (b + a) % 65535
        return b << 16 | a
    return bool({sums("little"), sums("big")} & {int.from_bytes(own[-4:], "big"), int.from_bytes(own[-4:], "little")})


def plain_walk(data, need):
    at, found, dropped = 0, [], [0, 0]
    while at < len(data):
        if at + 6 <= len(data) and int.from_bytes(data[at : at + 2]) >> 12 == 0 and int.from_bytes(data[at : at + 2]) & 0x7FF == 68:
            n = int.from_bytes(data[at + 4 : at + 6]) + 7
            if 23 <= n <= len(data) - at:
                inner = head(data[: at + n], at + 16)
                if inner and inner[1] == n - 16 and (not need or holds(data[at + 16 : at + n], inner[0])):
                    found.append((at + 16, data[at + 16 : at + n]))
                at += n
                continue
        own = head(data, at)
        if own and (not need or holds(data[at : at + own[1]], own[0])):
            found.append((at, data[at : at + own[1]]))
            at += own[1]
            continue
        dropped[data[at] not in ops.FILLERS] += 1
        at += 1
    return found, dropped


@pytest.mark.parametrize("need", [False, True])
def test_any_piece_size_gives_the_plain_walk(spark, need):
    rng = random.Random(21)
    data = {i: capture(rng) for i in range(30)} | {98: b"", 99: b"U"}
    expected = {i: plain_walk(d, need) for i, d in data.items()}
    frame = spark.createDataFrame([*((i, bytearray(d)) for i, d in data.items()), (97, None)], "capture_id long, content binary").repartition(3)
    for size in (37, 100_000):
        pieces = ops.pieces_of(frame, size)
        items, entries = ops.walk(pieces, ops.packet_candidates(pieces, APIDS, list(APIDS)), need)
        found = {}
        for r in ops.numbered_packets(items).orderBy("capture_id", "packet_index").collect():
            found.setdefault(r["capture_id"], []).append((r["offset"], bytes(r["packet"])))
        assert found == {i: f for i, (f, _) in expected.items() if f}
        dropped = {r["capture_id"]: [r["filler_bytes"], r["other_bytes"]] for r in ops.dropped_bytes(pieces, items, entries).collect()}
        assert dropped == {i: d for i, (_, d) in expected.items() if sum(d)}
        gaps = {r["capture_id"]: (r["gaps"], r["gap_bytes"], r["max_gap"]) for r in ops.resync_gaps(ops.numbered_packets(items)).collect()}
        for i, own in gaps.items():
            ends = np.array([0, *[a + len(p) for a, p in expected[i][0]]])
            sizes = np.array([a for a, _ in expected[i][0]]) - ends[:-1]
            assert own == ((sizes > 0).sum(), sizes.sum(), sizes.max())


def test_captures_in_many_rows(spark):
    rng = random.Random(22)
    data = {i: capture(rng) for i in range(6)}
    rows = [(i, j, bytearray(d[j * 61 : j * 61 + 61])) for i, d in data.items() for j in range(-(-len(d) // 61))]
    pieces = ops.join_pieces(spark.createDataFrame(rows, "capture_id long, piece int, content binary"), 61)
    whole = {(r["capture_id"], r["start"]): bytes(r["content"]) for r in pieces.collect()}
    assert all(content == data[i][at : at + 61 + ops.OVERLAP] for (i, at), content in whole.items())


def test_repair_inside_the_walk(spark):
    rng = random.Random(23)
    right = packet(536, rng)
    spoilt = right[:16] + right[12:16] + right[16:]  # one word comes twice
    data = b"U" + spoilt + packet(1, rng) + right
    frame = spark.createDataFrame([(1, bytearray(data))], "capture_id long, content binary")
    for size in (9, 1_000):
        found = ops.packetize(frame, APIDS, list(APIDS), need_checksum=True, repair_apid=536, piece_bytes=size).orderBy("packet_index").collect()
        assert [(r["offset"], r["taken"]) for r in found] == [(1, 28), (29, 20), (49, 24)] and bytes(found[0]["packet"]) == right
        assert len(ops.packetize(frame, APIDS, list(APIDS), need_checksum=True, piece_bytes=size).collect()) == 2


def test_pieces_stay_whole_when_a_join_becomes_a_broadcast(spark):
    rng = random.Random(25)
    parts = {i: [packet(rng.choice([1, 536]), rng) for _ in range(300)] for i in range(8)}
    spoilt = {i: b"".join(p[:16] + p[12:] if len(p) == 24 else p for p in own) for i, own in parts.items()}  # one word comes twice
    frame = spark.createDataFrame([(i, bytearray(d)) for i, d in spoilt.items()], "capture_id long, content binary").repartition(4)
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}  # known at run time only
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        rows = ops.packetize(frame, APIDS, list(APIDS), need_checksum=True, repair_apid=536, piece_bytes=500).orderBy("capture_id", "packet_index").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert [(r["capture_id"], bytes(r["packet"])) for r in rows] == [(i, p) for i, own in parts.items() for p in own]


def test_pieces_hold_no_more_than_expected_packets_need(spark):
    rng = random.Random(24)
    data = {i: capture(rng) + wrapper(packet(1, rng) * 90) + packet(536, rng) for i in range(8)}
    frame = spark.createDataFrame([(i, bytearray(d)) for i, d in data.items()], "capture_id long, content binary")
    parts = spark.createDataFrame([(i, j, bytearray(d[j * 37 : j * 37 + 37])) for i, d in data.items() for j in range(-(-len(d) // 37))], "capture_id long, piece int, content binary")
    reach = ops.overlap_of(APIDS)
    assert reach < 200 and ops.overlap_of(None) == ops.OVERLAP
    for pieces in (ops.pieces_of(frame, 37, reach), ops.join_pieces(parts, 37, reach)):
        assert all(len(r["content"]) <= 37 + reach for r in pieces.collect())
        items, entries = ops.walk(pieces, ops.packet_candidates(pieces, APIDS, list(APIDS)))
        found = {}
        for r in ops.numbered_packets(items).orderBy("capture_id", "packet_index").collect():
            found.setdefault(r["capture_id"], []).append((r["offset"], bytes(r["packet"])))
        assert found == {i: plain_walk(d, False)[0] for i, d in data.items()}
        dropped = {r["capture_id"]: [r["filler_bytes"], r["other_bytes"]] for r in ops.dropped_bytes(pieces, items, entries).collect()}
        assert dropped == {i: plain_walk(d, False)[1] for i, d in data.items() if sum(plain_walk(d, False)[1])}
