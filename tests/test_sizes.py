"""Partitions and state that don't grow with the tables."""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import Row
from pyspark.sql import functions as F

from perigee.operators import packets
from perigee.sources import scratch
from perigee.streaming import framing


def test_a_large_dictionary_is_dealt_to_more_partitions(spark, tmp_path, monkeypatch):
    fields = spark.range(4_000).select(
        (F.col("id") % 1_000).cast("int").alias("apid"), (F.col("id") / 1_000).cast("int").alias("ordinal"), F.lit("f").alias("name"), F.concat(F.lit("U"), F.col("id") % 7 + 1).alias("data_type")
    )
    fields.write.parquet(f"{tmp_path}/fields")
    columns = ["apid", "ordinal", "bit_length", "bit_offset", "field"]
    stored = spark.read.parquet(f"{tmp_path}/fields")
    whole = sorted(packets.field_layout(stored).select(columns).collect())
    monkeypatch.setattr(scratch, "PART_BYTES", 256)
    dealt = packets.field_layout(stored).select(columns)
    assert dealt.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(dealt.collect()) == whole
    assert [tuple(r[1:]) for r in whole if r["apid"] == 3] == [(0, 4, 0, "f"), (1, 3, 4, "f_2"), (2, 2, 7, "f_3"), (3, 1, 9, "f_4")]


class Held:
    """A value state that counts its calls."""

    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None


class Handle:
    def __init__(self):
        self.states = {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Held())


def test_a_packet_s_state_is_read_and_written_once_a_batch():
    whole = struct.pack(">HHH", 0x0801, 0xC000, 893) + bytes(i % 251 for i in range(894))
    handle, joined = Handle(), framing.JoinSegments(framing.Framing(frozenset({1})), None)
    joined.init(handle)
    part = lambda n, i: Row(number=n, segment_index=i, flag=framing.START if i == 0 else framing.END if i == 3 else 0, length=900, content=whole[i * 244 : i * 244 + 244])
    for batch, packets_out in (([part(1, 1), part(0, 0)], []), ([part(2, 3)], []), ([part(3, 2), part(4, 2)], [whole])):
        held = handle.states["held"]
        held.calls = 0
        assert [r["packet"] for r in joined.handleInputRows((21, 7, 1, 0), iter(batch), None)] == packets_out
        assert held.calls == 2
    assert handle.states["held"].value[2] == np.array([2], np.int32).tobytes()  # the copy that came behind its packet begins a new one
