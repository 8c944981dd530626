"""Dictionaries of any width, the store's types, public ranges, and inverse filters with zeros."""

import numpy as np
import pytest

from perigee.operators import public, science
from perigee.operators.store import TelemetryStore, TypeRefused
from perigee.sources import files


def test_wide_dictionaries_and_quoted_cells(spark, tmp_path):
    names = [f"c{i}" for i in range(200)]
    (tmp_path / "wide.csv").write_text(",".join(names) + "\n" + ",".join(f"v{i}" for i in range(200)) + "\r\n\n" + ",".join(["x"] * 199) + ',"a, ""b""\nc"\n')
    (tmp_path / "other.csv").write_text("c150,c1\n,only\n")
    found = {(r["file"].rsplit("/", 1)[1], r["ordinal"]): r for r in files.ordered_csv(spark, str(tmp_path), ["c1", "c150", "c199", "none"]).collect()}
    first, second, other = found["wide.csv", 1], found["wide.csv", 2], found["other.csv", 1]
    assert (first["c1"], first["c150"], first["c199"], first["none"]) == ("v1", "v150", "v199", None)
    assert (second["c1"], second["c199"]) == ("x", 'a, "b"\nc')
    assert (other["c1"], other["c150"], other["c199"]) == ("only", None, None)


def test_dictionaries_larger_than_a_block_are_read_in_blocks(spark, tmp_path):
    rows = [(f'"n{i}\n""x"""' if i % 50 == 7 else f"n{i}", i) for i in range(3_000)]
    for name, own in (("a.csv", rows[:1_000]), ("b.csv", rows[1_000:])):
        (tmp_path / name).write_text("\ufeffName,APID\n" + "".join(f"{n},{i}\n" + "\n" * (i % 3 == 0) for n, i in own))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = files.ordered_csv(spark, str(tmp_path), ["APID", "Name"])
        found = sorted((r["file"].rsplit("/", 1)[1], r["ordinal"], int(r["APID"]), r["Name"]) for r in read.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    name = lambda i: f'n{i}\n"x"' if i % 50 == 7 else f"n{i}"
    assert found == [("a.csv", i + 1, i, name(i)) if i < 1_000 else ("b.csv", i - 999, i, name(i)) for i in range(3_000)]


def test_store_settles_types_at_append(spark, tmp_path):
    store = TelemetryStore(spark, f"file://{tmp_path}/store")
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    big = 2**53 + 1
    assert store.append(7, "beacon", "a.csv", "aa", frame([(1, big)], "time long, count long"))
    assert store.append(7, "beacon", "b.csv", "bb", frame([(2.0, 5.0, "x")], "time double, count double, note string"))
    for rows, schema in (([(3, "many")], "time long, count string"), ([(3.5, 1)], "time double, count long")):
        with pytest.raises(TypeRefused):
            store.append(7, "beacon", "c.csv", "cc", frame(rows, schema))
    assert store.append(7, "beacon", "d.csv", "dd", frame([("4", None, "7")], "time string, count string, note string"))
    assert store.append(8, "other", "e.csv", "ee", frame([("text",)], "count string"))
    table = store.table("beacon")
    assert dict(table.dtypes) == {"time": "bigint", "count": "bigint", "note": "string"}
    assert sorted((r["time"], r["count"], r["note"]) for r in table.collect()) == [(1, big, None), (2, 5, "x"), (4, None, "7")]
    assert {(r["apid"], r["field"], r["type"]) for r in store.fields.collect()} == {(7, "time", "bigint"), (7, "count", "bigint"), (7, "note", "string"), (8, "count", "string")}
    assert [r["note"] for r in store.fetch("note", order_by="time").collect()] == [None, "x", "7"]
    for name in ("count", "nothing"):
        with pytest.raises(KeyError):
            store.fetch(name)
    assert [r["count"] for r in store.fetch("count", packet_type=8).collect()] == ["text"]


def test_public_fields_that_overlap_are_refused(spark):
    schema = "apid int, public_name string, kind string, bit_offset int, bit_length int"
    packets = spark.createDataFrame([(1, bytearray(b"\x12\x34\x56"))], "apid int, packet binary")
    good = spark.createDataFrame([(1, "a", "U", 4, 8), (1, "b", "U", 16, 8), (1, "c", "U", 20, 8)][:2], schema)
    values = public.public_values(packets, good)
    assert "packet" not in values.columns and {r["public_name"]: int(r["value"]["whole"]) for r in values.collect()} == {"a": 0x23, "b": 0x56}
    sizes = spark.createDataFrame([(1, 24)], "apid int, total_bits int")
    assert sorted(map(tuple, public.opaque_ranges(good, sizes).collect())) == [(1, 0, 4), (1, 12, 4)]
    for wrong in ([(1, "a", "U", 0, 8), (1, "b", "U", 7, 2)], [(1, "a", "U", 0, 8), (1, "a", "U", 8, 8)], [(1, " ", "U", 0, 8)], [(1, "a", "U", 0, 0)], [(1, None, "U", 0, None)]):
        with pytest.raises(ValueError):
            public.public_values(packets, spark.createDataFrame(wrong, schema))


def test_inverse_filter_with_zeros_gives_numbers(spark):
    image = np.random.default_rng(2).uniform(1, 9, (8, 8))
    rows = spark.createDataFrame([(1, y, [float(v) for v in image[y]]) for y in range(8)], "image_id long, y int, pixels array<double>")
    zeros = np.array([[0.25, 0.5, 0.25]])
    for padded in (True, False):
        found = np.array([r["pixels"] for r in science.deconvolve(rows, zeros, 8, 8, padded).orderBy("y").collect()])
        assert np.isfinite(found).all()
    kernel = science.scatter_kernel(np.array([[0.1, 0.3, 0.1]]))
    assert kernel.sum() == pytest.approx(1) and kernel[0, 1] == pytest.approx(0.2 / 0.4)


def test_archive_deconvolution_equals_plain_filters(spark):
    rng, height, width, tall = np.random.default_rng(5), 6, 8, 10
    image, scatter = rng.random((height, width)), rng.random((height, width)) * 0.004
    planes = rng.random((2, tall, width)) * 0.001
    planes[:, tall // 2, width // 2] = 0.25
    merged = (planes[0] * 2 + planes[1]) / 4  # the third wavelength has no plane
    diffraction = merged[2:8] * 4
    core = np.array(scatter)
    core[height // 2, width // 2] = (1 - scatter.sum()) * 0.4
    core /= core.sum()

    def placed(a):
        out = np.zeros((2 * height, 2 * width))
        out[height // 2 : height // 2 + height, width // 2 : width // 2 + width] = a
        return out

    wide = np.roll(np.fft.ifft2(np.fft.fft2(placed(image)) / np.fft.fft2(placed(diffraction))).real, (height, width), (0, 1))
    first = wide[height // 2 : height // 2 + height, width // 2 : width // 2 + width]
    wanted = np.roll(np.fft.ifft2(np.fft.fft2(first) / np.fft.fft2(core)).real, (height // 2, width // 2), (0, 1))

    lines = lambda a: [(y, row.tolist()) for y, row in enumerate(a)]
    frame = spark.createDataFrame([(7, *x) for x in lines(image)], "image_id long, y int, pixels array<double>")
    parts = spark.createDataFrame([(b, *x) for b in (0, 1) for x in lines(planes[b])], "bin int, y int, pixels array<double>")
    weights = spark.createDataFrame([(0, 2.0), (1, 1.0), (2, 1.0)], "bin int, weight double")
    spread = spark.createDataFrame(lines(scatter), "y int, pixels array<double>")
    found = science.archive_deconvolution(frame, parts, weights, (tall, width), spread, (height, width), height, width, tall)
    assert np.allclose(science.plane_of(found, height, width), wanted)
    assert science.archive_deconvolution(frame.limit(0), parts, weights, (tall, width), spread, (height, width), height, width, tall).count() == 0
