"""Packets from captures in pieces: places are searched in parallel, and the greedy walk from the left is composed.

Where the walk enters a piece decides where it leaves it. Each piece gives that as a function, a few steps long, from its
own bytes alone; a fold over these small functions gives every piece its entry, and all pieces are then walked at once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.functions import bits
from perigee.sources.scratch import gathered, written

#: Bytes of a piece. Behind it come the bytes that its last packet, and the repair of it, may reach.
PIECE_BYTES = 1 << 20
MOST_PACKET, MOST_EXTRA = 65_542, 66
OVERLAP = MOST_PACKET + MOST_EXTRA  # whole 32-bit words

# Bytes that fill gaps; packets that carry one other packet behind their head and ten bytes.
FILLERS = (0x00, 0x55, 0xFF)
WRAPPER_APID, WRAPPER_HEAD = 68, 16

#: Rows that a search holds before it gives them out.
ROWS_OUT = 20_000

PIECES = "capture_id long, piece int, start long, size int, left long, content binary"
FOUND = "capture_id long, piece int, at long, offset long, apid int, packet_length int, taken int, wrapped boolean, packet binary, beyond binary"


def overlap_of(expected: dict[int, int] | None) -> int:
    """Bytes behind a piece that tell what starts in it: where lengths are expected, a wrapper's head, the longest packet and
    the repair of it."""
    longest = MOST_PACKET if expected is None else min(max(expected.values(), default=0) + 1 + WRAPPER_HEAD, MOST_PACKET)
    return longest + MOST_EXTRA


def pieces_of(captures: DataFrame, piece_bytes: int = PIECE_BYTES, overlap: int = OVERLAP) -> DataFrame:
    """Captures (capture_id, content) in pieces: piece, start, size and the bytes left from start on, and content with
    overlap bytes more (see overlap_of)."""
    size = F.octet_length("content")
    rows = captures.filter(size > 0).select("capture_id", "content", size.alias("total"), F.posexplode(F.sequence(F.lit(0), size - 1, F.lit(piece_bytes))).alias("piece", "start"))
    return rows.select(
        "capture_id", "piece", F.col("start").cast("long").alias("start"), F.least(F.col("total") - F.col("start"), F.lit(piece_bytes)).alias("size"),
        (F.col("total") - F.col("start")).cast("long").alias("left"), F.substring(F.col("content"), F.col("start") + 1, F.lit(piece_bytes + overlap)).alias("content"),
    )


def join_pieces(parts: DataFrame, piece_bytes: int, overlap: int = OVERLAP) -> DataFrame:
    """The same of captures that lie in many rows (capture_id, piece from 0, content of piece_bytes, the last one of fewer),
    so that a capture may have any size. Only the first bytes of a part are sent to the parts before it."""
    reach = -(-overlap // piece_bytes)
    ahead = F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("back")
    heads = parts.select("capture_id", "piece", ahead, F.hex(F.substring("content", 1, overlap)).alias("h")).filter("piece >= back")
    heads = heads.select("capture_id", (F.col("piece") - F.col("back")).alias("piece"), F.struct("back", "h").alias("head"))
    after = heads.groupBy("capture_id", "piece").agg(F.array_sort(F.collect_list("head")).alias("heads"))  # reach of them
    joined = parts.join(after, ["capture_id", "piece"], "left")
    more = F.substring(F.unhex(F.coalesce(F.array_join(F.col("heads.h"), ""), F.lit(""))), 1, overlap)
    size, start = F.octet_length("content"), F.col("piece").cast("long") * piece_bytes
    totals = parts.groupBy("capture_id").agg(F.sum(size.cast("long")).alias("total"))
    return joined.join(totals, "capture_id").select("capture_id", "piece", start.alias("start"), size.alias("size"), (F.col("total") - start).alias("left"), F.concat("content", more).alias("content"))


def possible_heads(apids: list[int], expected: dict[int, int] | None):
    """A function that finds where packets can start in the first bytes of data: (place, APID, length) of each.

    Version 0, telemetry, with a secondary header, a known APID, and all bytes there; where lengths are expected, the
    length is the expected one or one more. All places are looked at together.
    """
    known = np.zeros(2048, bool)
    known[[*apids]] = True
    wanted = np.full(2048, -9, np.int64)
    for apid, length in (expected or {}).items():
        wanted[apid] = length

    def find(data: bytes, places: int, left: int | None = None) -> Iterator[tuple[int, int, int]]:
        first, length, apid, whole = heads_of(data, places, len(data) if left is None else left)
        good = (first >> 11 == 1) & known[apid] & whole
        if expected is not None:
            good &= (length - wanted[apid]) >> 1 == 0
        for at in np.flatnonzero(good):
            yield int(at), int(apid[at]), int(length[at])

    return find


def heads_of(data: bytes, places: int, left: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a packet's head at each place would say: first word, length, APID, and whether all its bytes are among the
    `left` ones from the first place on, of which data are the first."""
    view = np.frombuffer(data, np.uint8).astype(np.int64)
    n = max(0, min(places, len(view) - 6))
    first = view[:n] << 8 | view[1 : n + 1]
    length = (view[4 : n + 4] << 8 | view[5 : n + 5]) + 7
    return first, length, first & 0x7FF, np.arange(n) + length <= left


def packet_candidates(pieces: DataFrame, expected: dict[int, int] | None, apids: list[int], unwrap: bool = True) -> DataFrame:
    """All places where a packet or a wrapper can start (see FOUND).

    A wrapper that is all there is taken whole, whatever is in it, and hides a packet at its place; its packet is the one
    behind its head that ends just where it ends, else null. taken is what the walk steps over.
    """
    heads = possible_heads(apids, expected)

    def wrappers(data: bytes, size: int, left: int) -> dict[int, int]:
        if not unwrap:
            return {}
        first, length, apid, whole = heads_of(data, size, left)
        return {int(at): int(length[at]) for at in np.flatnonzero((first >> 12 == 0) & (apid == WRAPPER_APID) & (length >= WRAPPER_HEAD + 7) & whole)}

    def places(capture: int, piece: int, start: int, size: int, left: int, data: bytes) -> Iterator[tuple]:
        held = wrappers(data, size, left)
        for at, apid, length in heads(data, size, left):
            if at not in held:
                end = at + length
                yield capture, piece, start + at, start + at, apid, length, length, False, data[at:end], data[end : end + MOST_EXTRA]
        for at, length in held.items():
            own = length - WRAPPER_HEAD
            fits = [apid for _, apid, n in heads(data[at + WRAPPER_HEAD :], 1, own) if n == own]
            inner = data[at + WRAPPER_HEAD : at + length] if fits else None
            yield capture, piece, start + at, start + at + WRAPPER_HEAD, fits[0] if fits else WRAPPER_APID, own, length, True, inner, b""

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = (x for row in zip(*[frame[c] for c in columns], strict=True) for x in places(*row))
            while rows := list(islice(found, ROWS_OUT)):
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in FOUND.split(", ")])

    columns = [x.split()[0] for x in PIECES.split(", ")]
    return pieces.select(*columns).mapInPandas(search, FOUND)


def judged(candidates: DataFrame, need_checksum: bool, repair_apid: int | None) -> DataFrame:
    """Candidates with algorithm, without those whose checksum is needed and fails; wrappers stay, without their packet.

    With repair_apid, one of that APID that fails is tried again without repeated words (see without_repeats).
    """
    algorithm = bits.checksum_algorithm(F.col("packet"), F.col("apid"))
    checked = candidates.withColumn("algorithm", algorithm)
    if not need_checksum:
        return checked
    if repair_apid is not None:
        failed = F.col("algorithm").isNull() & (F.col("apid") == repair_apid) & ~F.col("wrapped")
        mended = checked.filter(failed).drop("algorithm").mapInPandas(mend, FOUND).withColumn("algorithm", algorithm)
        checked = checked.filter(~failed).unionByName(mended)
    holds = F.col("algorithm").isNotNull()
    return checked.filter(holds | F.col("wrapped")).withColumn("packet", F.when(holds, F.col("packet")))


def mend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidates with what is left of them and the bytes beyond when repeated words are taken out; others go."""
    for frame in frames:
        found = [without_repeats(p + more, n) for p, more, n in zip(frame["packet"], frame["beyond"], frame["packet_length"], strict=True)]
        held = [x is not None for x in found]
        yield frame[held].assign(packet=[x[0] for x in found if x], taken=[x[1] for x in found if x])


def without_repeats(data: bytes, length: int) -> tuple[bytes, int] | None:
    """The first `length` bytes of data that are left when 4-byte words that repeat the one before are taken out.

    Returns them with the number of bytes used, or None if nothing was taken out or too little is left. The caller
    takes them only if their checksum then holds.
    """
    view = np.frombuffer(data, np.uint8)
    if len(view) <= max(length, 8):
        return None
    run = np.convolve(view[4:] == view[:-4], np.ones(4, int), "valid")  # 4 where the word at a place comes again
    kept, free = np.ones(len(view), bool), 0
    for at in np.flatnonzero(run == 4):
        if at >= free:
            kept[at + 4 : at + 8] = False
            free = at + 8
    places = np.flatnonzero(kept)[:length]
    if len(places) < length or places[-1] + 1 == length:
        return None
    return view[places].tobytes(), int(places[-1]) + 1


def steps_of(at: np.ndarray, taken: np.ndarray, end: int, reach: int) -> tuple[list[int], list[int]]:
    """The function of a piece: entering at or before upto[i] (and behind upto[i-1]) the walk leaves at exits[i].

    at, taken: candidates in order. Behind the last one the walk leaves where it is, or at the piece's end. Entries lie
    before `reach`; places from which the walk leaves alike are one step.
    """
    exits: list[int] = [0] * len(at)
    following = np.searchsorted(at, at + taken)
    for i in range(len(at) - 1, -1, -1):
        exits[i] = exits[following[i]] if following[i] < len(at) else max(int(at[i] + taken[i]), end)
    upto, out = [], []
    for place, leaves in zip(at.tolist(), exits, strict=True):
        if out and out[-1] == leaves:
            upto[-1] = place
        else:
            upto.append(place)
            out.append(leaves)
        if place >= reach:
            break
    return upto, out


def in_pieces(rows: DataFrame) -> DataFrame:
    """Rows so that those of a piece follow each other in order of place, in one task."""
    return gathered(rows, ["capture_id", "piece"], ["at"])


def by_piece(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The rows of one piece after another of frames that in_pieces has put in order; a piece's rows are bounded."""
    held: list[pd.DataFrame] = []
    key = None
    for frame in frames:
        for own, rows in frame.groupby(["capture_id", "piece"], sort=False, dropna=False):
            if key is not None and own != key:
                yield key, pd.concat(held)
                held = []
            key = own
            held.append(rows)
    if key is not None:
        yield key, pd.concat(held)


def entries_of(pieces: DataFrame, candidates: DataFrame) -> DataFrame:
    """capture_id, piece, start, size and entry: where the walk enters each piece."""

    def steps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (capture, piece), rows in by_piece(frames):
            start, size = int(rows["start"].iloc[0]), int(rows["size"].iloc[0])
            upto, exits = steps_of(rows["at"].to_numpy(), rows["taken"].to_numpy(), start + size, start + OVERLAP)
            yield pd.DataFrame({"capture_id": [capture], "piece": [piece], "upto": [upto], "exits": [exits]})

    about = pieces.select("capture_id", "piece", "start", "size")
    slim = candidates.select("capture_id", "piece", "at", "taken").join(about, ["capture_id", "piece"])
    functions = in_pieces(slim).mapInPandas(steps, "capture_id long, piece int, upto array<long>, exits array<long>")

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        capture, entry = None, 0
        for frame in frames:
            entries = []
            for own, start, size, upto, exits in zip(*[frame[c] for c in ("capture_id", "start", "size", "upto", "exits")], strict=True):
                if own != capture:
                    capture, entry = own, 0
                entry = max(entry, start)
                entries.append(entry)
                i = bisect_left(upto, entry) if upto is not None else 0
                entry = int(exits[i]) if upto is not None and i < len(upto) else max(entry, start + size)
            yield frame[["capture_id", "piece", "start", "size"]].assign(entry=entries)

    joined = gathered(about.join(functions, ["capture_id", "piece"], "left"), ["capture_id"], ["piece"])
    return joined.mapInPandas(fold, "capture_id long, piece int, start long, size int, entry long")


ITEMS = "capture_id long, piece int, at long, offset long, apid int, packet_length int, taken int, wrapped boolean, packet binary, algorithm string"


def walk(pieces: DataFrame, candidates: DataFrame, need_checksum: bool = False, repair_apid: int | None = None) -> tuple[DataFrame, DataFrame]:
    """What a walk from the left takes: the next candidate not before the end of the last. Items (see ITEMS), with a null
    packet where a wrapper holds none, and the entries of all pieces. A candidate that fails a needed checksum hides nothing."""
    good = written(judged(candidates, need_checksum, repair_apid).drop("beyond"), "packet-candidates")
    entries = written(entries_of(pieces, good), "piece-entries")

    def take(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, end = None, 0
        for frame in frames:
            kept = []
            for own, piece, at, taken, entry in zip(*[frame[c] for c in ("capture_id", "piece", "at", "taken", "entry")], strict=True):
                if (own, piece) != key:
                    key, end = (own, piece), entry
                kept.append(at >= end)
                if at >= end:
                    end = at + taken
            yield frame[kept].drop(columns="entry")

    held = good.join(entries.select("capture_id", "piece", "entry"), ["capture_id", "piece"])
    columns = [x.split()[0] for x in ITEMS.split(", ")]
    return written(in_pieces(held.select(*columns, "entry")).mapInPandas(take, ITEMS), "walked"), entries


def numbered_packets(items: DataFrame) -> DataFrame:
    """The packets of walked items with packet_index, numbered in each capture: counts of pieces are added up first."""
    packets = items.filter("packet is not null")
    counts = packets.groupBy("capture_id", "piece").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("capture_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # one row a piece
    bases = counts.select("capture_id", "piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("capture_id", "piece").orderBy("offset")) - 1
    return packets.withColumn("packet_index", inside).join(bases, ["capture_id", "piece"]).withColumn("packet_index", F.col("packet_index") + F.col("_base")).drop("_base")


def packetize(captures: DataFrame, expected: dict[int, int] | None, apids: list[int], need_checksum: bool = False, repair_apid: int | None = None, piece_bytes: int = PIECE_BYTES, unwrap: bool = True) -> DataFrame:
    """The packets of captures (capture_id, content): see packet_candidates, walk and numbered_packets. Any size of piece
    gives the same packets; null and empty contents have none."""
    pieces = pieces_of(captures, piece_bytes, overlap_of(expected))
    return numbered_packets(walk(pieces, packet_candidates(pieces, expected, apids, unwrap), need_checksum, repair_apid)[0])


def wrapper_statistics(items: DataFrame) -> DataFrame:
    """Per capture: wrappers, those that held one whole packet, and malformed ones."""
    held = F.col("packet").isNotNull()
    return items.filter("wrapped").groupBy("capture_id").agg(F.count("*").alias("wrappers"), F.count_if(held).alias("unwrapped"), F.count_if(~held).alias("malformed"))


def resync_gaps(packets: DataFrame) -> DataFrame:
    """Per capture: gaps between packets (piece, offset, packet_length) and before the first, their number, bytes and largest.

    Only the last end of each piece is carried to the next one.
    """
    end = F.col("offset") + F.col("packet_length")
    last = packets.groupBy("capture_id", "piece").agg(F.max(end).alias("_end"))
    earlier = Window.partitionBy("capture_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # one row a piece
    carried = last.select("capture_id", "piece", F.coalesce(F.max("_end").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("capture_id", "piece").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    gaps = packets.withColumn("_own", F.max(end).over(inside)).join(carried, ["capture_id", "piece"])
    gap = F.greatest(F.col("offset") - F.greatest(F.coalesce("_own", F.lit(0)), F.col("_before")), F.lit(0))
    return gaps.select("capture_id", gap.alias("gap")).groupBy("capture_id").agg(F.count_if(F.col("gap") > 0).alias("gaps"), F.sum("gap").alias("gap_bytes"), F.max("gap").alias("max_gap"))


def dropped_bytes(pieces: DataFrame, items: DataFrame, entries: DataFrame) -> DataFrame:
    """Per capture, the bytes that no walked item took: filler (0x00, 0x55, 0xFF) and others. Pieces are counted apart."""
    spans = items.groupBy("capture_id", "piece").agg(F.collect_list(F.struct("at", "taken")).alias("spans"))  # of one piece
    joined = pieces.join(entries.select("capture_id", "piece", "entry"), ["capture_id", "piece"]).join(spans, ["capture_id", "piece"], "left")
    joined = joined.select("capture_id", "start", F.substring(F.col("content"), F.lit(1), F.col("size")).alias("content"), "entry", "spans.at", "spans.taken")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for capture, start, data, entry, at, taken in frame.itertuples(index=False):
                view, free = np.frombuffer(data, np.uint8), np.ones(len(data), bool)
                free[: max(0, entry - start)] = False
                for place, n in zip(at, taken, strict=True) if at is not None else ():
                    free[place - start : place - start + n] = False
                filler = int((free & np.isin(view, FILLERS)).sum())
                out.append((capture, filler, int(free.sum()) - filler))
            yield pd.DataFrame(out, columns=["capture_id", "filler_bytes", "other_bytes"])

    counted = joined.mapInPandas(count, "capture_id long, filler_bytes long, other_bytes long")
    return counted.groupBy("capture_id").agg(F.sum("filler_bytes").alias("filler_bytes"), F.sum("other_bytes").alias("other_bytes")).filter("filler_bytes + other_bytes > 0")
