"""Packets and segments from streams of bytes, with transformWithState: bytes and counts are kept in each link's state."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

# Fixed values of the link: heads, flags of segments, and bytes that always may be the start of something.
SYNC = bytes.fromhex("1acffc1d")
HEAD, SEGMENT_HEAD = 6, 12
START, END = 1, 2  # flags; 0 is a segment between
HELD_BACK = HEAD + 18 + SEGMENT_HEAD

#: The state store that transformWithState needs.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@dataclass(frozen=True)
class Framing:
    """What a link carries. Markers are looked for in the order sync, ground prefix, AX.25 heads; then bare heads."""

    apids: frozenset[int]
    sync: bytes = SYNC
    ground_marker: bytes = bytes.fromhex("1badcafe")
    ground_bytes: int = 16
    ax25_heads: tuple[bytes, ...] = ()
    bare: bool = True
    segments: bool = False
    segment_payload: int = 244
    most_packet_bytes: int = 65_535
    most_buffer_bytes: int = 1 << 20


@dataclass
class Cut:
    """What was found in a buffer: rows, how many bytes of it are done with, and counts."""

    rows: list[tuple] = field(default_factory=list)
    done: int = 0
    dropped: int = 0
    faults: int = 0


#: Places of a kind in order, how many bytes show that a place is one, the kind, and bytes before the packet.
Places = tuple[list[int], int, str, int]


def strong_markers(data: bytes, framing: Framing) -> list[Places]:
    """Places of markers; of equal places the first kind counts."""
    kinds = [("sync", framing.sync, len(framing.sync)), ("ground", framing.ground_marker, framing.ground_bytes), *[("ax25", h, len(h)) for h in framing.ax25_heads]]
    return [([m.start() for m in re.finditer(b"(?=" + re.escape(marker) + b")", data)], len(marker), kind, before) for kind, marker, before in kinds if marker]


def weak_heads(data: bytes, framing: Framing) -> list[Places]:
    """Places where a packet of a known APID, and where a segment's head can start."""
    view = np.frombuffer(data, np.uint8).astype(np.int64)
    word = lambda at, n: view[at : at + n] << 8 | view[at + 1 : at + 1 + n]
    known = np.zeros(2048, bool)
    known[[*framing.apids]] = True
    heads = segments = np.zeros(0, np.int64)
    if (n := len(view) - HEAD + 1) > 0:
        first, length = word(0, n), word(4, n) + 7
        heads = np.flatnonzero((first >> 11 == 1) & known[first & 0x7FF] & (length <= framing.most_packet_bytes))
    if framing.segments and (n := len(view) - SEGMENT_HEAD + 1) > 0:
        segments = np.flatnonzero(segment_like(word(4, n), view[10 : 10 + n], view[11 : 11 + n], framing))
    return [(heads.tolist(), HEAD, "bare", 0), (segments.tolist(), SEGMENT_HEAD, "segment", 0)]


def first_place(kinds: list[Places], at: int, end: int) -> tuple[int, str, int] | None:
    """The first place from `at` on that bytes up to `end` show, with its kind and the bytes before the packet."""
    found = None
    for places, size, kind, before in kinds:
        if (i := bisect_left(places, at)) < len(places) and places[i] + size <= end and (found is None or places[i] < found[0]):
            found = places[i], kind, before
    return found


def segment_like(length, index, flag, framing: Framing):
    """Whether a segment's head is possible: a packet of more than one segment, a place inside it, a known flag."""
    return (length > framing.segment_payload) & (length <= framing.most_packet_bytes) & (index <= (length - 1) // framing.segment_payload) & (flag <= END)


def packet_at(data: bytes, at: int, framing: Framing, any_apid: bool) -> int | None:
    """Bytes of the packet that starts here, whether or not they are all there; None if none does."""
    if at + HEAD > len(data):
        return None
    first, length = int.from_bytes(data[at : at + 2]), int.from_bytes(data[at + 4 : at + 6]) + 7
    fits = first >> 11 == 1 and (any_apid or first & 0x7FF in framing.apids) and length <= framing.most_packet_bytes
    return length if fits else None


def frame_at(data: bytes, at: int, end: int, kind: str, before: int, framing: Framing) -> tuple[int, tuple] | None:
    """Bytes that a marker's packet or segment takes, and its row; 0 bytes if nothing starts there, None if more must come."""
    own = at + before
    if own + HEAD > end:
        return None
    length = packet_at(data, own, framing, kind in ("sync", "ground")) if kind != "segment" else None
    if length is not None:
        if own + length > end:
            return None
        return before + length, (kind, int.from_bytes(data[own : own + 2]) & 0x7FF, data[own : own + length], *[None] * 7)
    if not framing.segments or kind not in ("ax25", "segment"):
        return 0, ()
    if own + SEGMENT_HEAD > end:
        return None
    words = [int.from_bytes(data[own + j : own + j + 2]) for j in (0, 2, 4, 6, 8)]
    index, flag = data[own + 10], data[own + 11]
    if not segment_like(words[2], index, flag, framing):
        return 0, ()
    content, size = own + SEGMENT_HEAD, min(framing.segment_payload, words[2] - index * framing.segment_payload)
    if content + size > end:
        return None
    return before + SEGMENT_HEAD + size, ("segment" if kind == "segment" else "ax25_segment", None, data[content : content + size], *words, index, flag)


def cut_frames(data: bytes, framing: Framing, final: bool = False, ends: Iterable[int] | None = None) -> Cut:
    """Packets and segments of a buffer.

    Strong markers anywhere in the buffer go before bare heads; of equals the first counts. What isn't whole waits for
    more bytes; a marker that starts nothing costs one byte; without any marker the last HELD_BACK bytes wait. Of what
    waits the oldest goes where it is more than most_buffer_bytes. If it is final, nothing waits. `ends` are the places
    where chunks that came one after another end: each is cut as it came, without knowing the next.
    """
    out = Cut()
    strong, weak = strong_markers(data, framing), weak_heads(data, framing) if framing.bare else []
    at = 0
    for end in [len(data)] if ends is None else ends:
        while True:
            found = first_place(strong, at, end) or first_place(weak, at, end)
            place = found[0] if found else max(at, end - HELD_BACK)
            out.dropped, at = out.dropped + place - at, place
            frame = frame_at(data, at, end, *found[1:], framing) if found else None
            if frame is None:
                over = max(0, end - at - framing.most_buffer_bytes)
                out.dropped, at = out.dropped + over, at + over
                if not over:
                    break
            elif frame[0]:
                out.rows.append((*frame[1], out.dropped, frame[0]))
                out.dropped, at = 0, at + frame[0]
            else:
                out.faults, out.dropped, at = out.faults + 1, out.dropped + 1, at + 1
    if final:
        out.dropped, at = out.dropped + len(data) - at, len(data)
    out.done = at
    return out


COLUMNS = ["kind", "apid", "content", "packet_id", "sequence", "length", "payload_id", "payload_sequence", "segment_index", "flag", "dropped", "taken"]
FRAMES = (
    "link string, number long, kind string, apid int, content binary, packet_id int, sequence int, length int, payload_id int, payload_sequence int, "
    "segment_index int, flag int, dropped long, taken long, faults long"
)


class FrameLinks(StatefulProcessor):
    """State of a link: bytes not used yet, the number of its next row, and bytes dropped and faults not reported yet."""

    def __init__(self, framing: Framing, idle_millis: int | None):
        self.framing, self.idle = framing, idle_millis

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rest binary, number long, dropped long, faults long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [(f["position"].to_numpy(np.int64), f["content"].to_numpy(object)) for f in rows]
        order = np.argsort(np.concatenate([p for p, _ in frames]), kind="stable")
        runs, held = [], 0
        for content in np.concatenate([c for _, c in frames])[order]:  # chunks between two ends of the link are joined, and cut as they came
            if content is None:
                yield from self.told(key, self.cut(runs, final=True))
                runs, held = [], 0
            else:
                runs.append(bytes(content))
                held += len(content)
                if held >= self.framing.most_buffer_bytes:
                    yield from self.told(key, self.cut(runs))
                    runs, held = [], 0
        yield from self.told(key, self.cut(runs))
        if self.idle is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.told(key, self.cut([], final=True))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        pass

    def close(self) -> None:
        pass

    def cut(self, chunks: list[bytes], final: bool = False) -> list[tuple]:
        """Rows of what chunks complete; the rest goes to the state. At the end of a link a row tells what was left."""
        rest, number, dropped, faults = self.held.get() if self.held.exists() else (b"", 0, 0, 0)
        if not chunks and not final:
            return []
        data = bytes(rest) + b"".join(chunks)
        found = cut_frames(data, self.framing, final, accumulate(map(len, chunks), initial=len(rest)))
        faults += found.faults
        out = []
        for *row, before, used in found.rows:
            out.append((number, *row, before + dropped, used, None))
            number, dropped = number + 1, 0
        dropped += found.dropped
        if final:
            out.append((number, "end", *[None] * 9, dropped, 0, faults))
            number, dropped, faults = number + 1, 0, 0
        self.held.update((data[found.done :], number, dropped, faults))
        return out

    @staticmethod
    def told(key: tuple, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            made = pd.DataFrame(rows, columns=["number", *COLUMNS, "faults"], dtype=object)
            made.insert(0, "link", key[0])
            yield made


def frame_links(chunks: DataFrame, framing: Framing, idle: str | None = None) -> DataFrame:
    """Packets and segments of a stream of chunks (link, position, content).

    A row for each, with the bytes dropped before it and the bytes it took; over a link these and what is still held
    add up to the bytes that came. Each chunk is cut as it comes, in whatever batch; of what then still waits at most
    most_buffer_bytes are kept, the oldest go first. Null content ends a link: all that is there is cut, the rest dropped,
    and a row of kind `end` tells faults and dropped bytes not told yet. So does a timer when nothing has come for the
    time `idle`; the stream then waits for the clock and doesn't end by itself.
    Chunks of a batch are taken in order of position; a batch's bytes of one link are held together.
    """
    chunks.sparkSession.conf.set(*STORE)
    millis = int(pd.Timedelta(idle).total_seconds() * 1000) if idle else None
    return chunks.groupBy("link").transformWithStateInPandas(FrameLinks(framing, millis), FRAMES, "Append", "ProcessingTime" if idle else "None")


PACKET = "packet_id int, sequence int, payload_id int, payload_sequence int"


class JoinSegments(StatefulProcessor):
    """State of a packet: its length, whether its end has come, and its parts one after another with their places and sizes."""

    def __init__(self, framing: Framing, live_millis: int | None):
        self.framing, self.live = framing, live_millis

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "length int, ended boolean, places binary, sizes binary, content binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.held.get()
        total, ended, parts = self.unpacked(before) if before is not None else (None, False, {})
        for row in sorted(rows, key=lambda r: r["number"]):
            if row["flag"] == START or total is None:
                total, ended, parts = int(row["length"]), False, {}
            parts[int(row["segment_index"])] = bytes(row["content"])
            ended = ended or row["flag"] == END
            places = range((total - 1) // self.framing.segment_payload + 1)
            if ended and all(i in parts for i in places):
                packet = b"".join(parts[i] for i in places)[:total]
                if packet_at(packet, 0, self.framing, False) == len(packet) == total:
                    yield Row(packet_id=key[0], sequence=key[1], payload_id=key[2], payload_sequence=key[3], packet=packet)
                    total, ended, parts = None, False, {}
        if total is not None:
            sizes = np.array([len(x) for x in parts.values()], np.int32)
            self.held.update((total, ended, np.array([*parts], np.int32).tobytes(), sizes.tobytes(), b"".join(parts.values())))
        elif before is not None:
            self.held.clear()
        if self.live is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if total is not None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.live)

    @staticmethod
    def unpacked(held: tuple) -> tuple[int, bool, dict[int, bytes]]:
        total, ended, places, sizes, content = held
        ends = np.cumsum(np.frombuffer(bytes(sizes), np.int32)).tolist()
        content = bytes(content)
        return total, ended, {place: content[start:end] for place, start, end in zip(np.frombuffer(bytes(places), np.int32).tolist(), [0, *ends], ends, strict=False)}

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        yield from ()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        pass

    def close(self) -> None:
        pass


def join_segments(segments: DataFrame, framing: Framing, time_to_live: str | None = None) -> DataFrame:
    """Packets put together from a stream of segments as frame_links gives them, by their four-part key.

    A start flag begins anew. A packet comes out when its end has come, no part is missing, and the head of what they
    make has a known APID and just this length; else its parts stay, and later copies of a part replace earlier ones.
    Parts of a batch are taken in order of number. A copy that comes after its packet came out begins a new one, which
    a whole set of copies completes again. A packet's state is read once and written once a batch, by rows, as most packets
    have few in a batch. What is incomplete is forgotten when nothing has come for time_to_live; the
    stream then waits for the clock and doesn't end by itself.
    """
    segments.sparkSession.conf.set(*STORE)
    millis = int(pd.Timedelta(time_to_live).total_seconds() * 1000) if time_to_live else None
    keyed = segments.groupBy("packet_id", "sequence", "payload_id", "payload_sequence")
    return keyed.transformWithState(JoinSegments(framing, millis), PACKET + ", packet binary", "Append", "ProcessingTime" if millis else "None")


HISTORY = "id long, field string, us long, value double, rejected boolean, n_history int, latest double"

#: Rows of a history that are given out together.
ROWS_OUT = 20_000


class KeepHistory(StatefulProcessor):
    """State of a bucket of fields: a ring of accepted values of each field and how many it has had since the last clearing."""

    def __init__(self, keep: int, judge):
        self.keep, self.judge = keep, judge

    def init(self, handle) -> None:
        self.ring = handle.getMapState("ring", "field string, slot int", "value double")
        self.counts = handle.getMapState("counts", "field string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = ["us", "is_clear", "field", "id", "value"]
        arrived = pd.concat([frame[columns] for frame in rows])
        order = np.lexsort((~arrived["is_clear"].to_numpy(bool), arrived["us"].to_numpy()))
        held: dict[str, list[float]] = {}
        counts: dict[str, int] = {}
        new: dict[str, int] = {}  # accepted values that the state doesn't hold yet
        for first in range(0, len(order), ROWS_OUT):
            out = []
            for us, is_clear, name, number, value in arrived.iloc[order[first : first + ROWS_OUT]].itertuples(index=False, name=None):
                if is_clear:
                    held, counts, new = {}, {}, {}
                    self.ring.clear()
                    self.counts.clear()
                    continue
                if name not in held:
                    n = counts[name] = self.counts.getValue((name,))[0] if self.counts.containsKey((name,)) else 0
                    held[name] = [self.ring.getValue((name, i % self.keep))[0] for i in range(max(0, n - self.keep), n)]
                accepted = self.judge(held[name], value)
                if accepted:
                    counts[name] += 1
                    new[name] = new.get(name, 0) + 1
                    held[name].append(value)
                    if len(held[name]) > self.keep:
                        del held[name][0]
                out.append((number, name, us, value, not accepted, min(counts[name], self.keep), held[name][-1] if held[name] else None))
            if out:
                yield pd.DataFrame(out, columns=["id", "field", "us", "value", "rejected", "n_history", "latest"])
        for name, n in new.items():  # what later values of the batch overwrote is never written
            last = held[name][-n:]
            for slot, value in enumerate(last, counts[name] - len(last)):
                self.ring.updateValue((name, slot % self.keep), (float(value),))
            self.counts.updateValue((name,), (counts[name],))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from ()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        pass

    def close(self) -> None:
        pass


def accept_all(accepted: list[float], value: float) -> bool:
    """A judge that accepts every value."""
    return True


def clearable_history(rows: DataFrame, judge: Callable[[list[float], float], bool] = accept_all, keep: int = 300, buckets: int = 200) -> DataFrame:
    """A stream of points (id, field, us, value, is_clear) with rejected, n_history and latest value after each.

    A row with is_clear is no point: it empties all fields' histories, before points of the same moment. Fields are dealt
    to buckets, and each clearing to all buckets. judge(accepted values, value) says whether a value is accepted. A field's
    state is read once and written once a batch, `keep` values at most. Rows of a batch are taken in order of time.
    """
    rows.sparkSession.conf.set(*STORE)
    own = F.array(F.pmod(F.xxhash64("field"), F.lit(buckets)).cast("int"))
    bucket = F.explode(F.when(F.col("is_clear"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(own)).alias("bucket")
    dealt = rows.select("id", "field", "us", "value", "is_clear", bucket)
    return dealt.groupBy("bucket").transformWithStateInPandas(KeepHistory(keep, judge), HISTORY, "Append", "None")
