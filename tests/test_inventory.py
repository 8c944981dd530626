"""The inventory of images: nothing there, metadata alone, rows alone, nulls, repeated copies, clashing columns."""

import pytest

from perigee.operators import images, inventory

ROWS = "image_id long, row_index int, length int, checksum_status string, status string, arrival long"
META = "image_id long, meta_source string, sensor int, integration_ms int, right_shift int, start double, arrival long, n_rows int, n_cols int, uneven boolean, compressed boolean, bit_depth int, mode_warning string"


def made(spark, rows, meta):
    found = inventory.full_inventory(spark.createDataFrame(rows, ROWS), inventory.image_metadata(spark.createDataFrame(meta, META)))
    return {r.image_id: r for r in found.collect()}


def packet(image, source="process", arrival=0, shift=0, size=2, packed=False):
    return (image, source, None, 35, shift, 1.0, arrival, size, 4, False, packed, 16, None)


def row(image, index, length=4, checksum="valid", status="parsed", arrival=0):
    return (image, index, length, checksum, status, arrival)


def test_nothing_gives_nothing(spark):
    assert made(spark, [], []) == {}


def test_sides_that_stand_alone(spark):
    found = made(spark, [row(1, 1)], [packet(2)])
    assert (found[1].meta_packets, found[1].unique_rows, found[1].missing_rows, found[1].complete, found[1].partial) == (0, 1, None, False, False)
    assert (found[2].data_packets, found[2].missing_rows, found[2].complete, found[2].partial) == (0, 2, False, False)


def test_complete_partial_and_broken(spark):
    rows = [row(1, 1), row(1, 2), row(2, 1), row(2, 2, checksum="failed"), row(3, 1), row(3, 2, length=5), row(4, 1), row(4, 1, arrival=1), row(4, None, status="short"), row(4, 9)]
    found = made(spark, rows, [packet(i) for i in (1, 2, 3, 4)])
    assert [(found[i].complete, found[i].partial) for i in (1, 2, 3, 4)] == [(True, False), (False, True), (False, False), (False, True)]
    assert [found[i].zero_filled_rows for i in (1, 2, 3, 4)] == [0, 1, 0, 1]
    assert (found[4].duplicate_rows, found[4].skipped_rows, found[4].out_of_range_rows, found[4].missing_rows) == (1, 1, 1, 1)


def test_the_better_copy_counts_and_worse_ones_leave_no_length(spark):
    found = made(spark, [row(1, 1, 4, "valid", arrival=0), row(1, 1, 7, "failed", arrival=1), row(1, 2, 4, None, arrival=2)], [packet(1)])
    assert (found[1].bad_length_rows, found[1].selected_checksum_valid_rows, found[1].selected_checksum_failed_rows) == (0, 1, 0)
    assert (found[1].row_length_min, found[1].row_length_max) == (4, 4)


def test_chunks_have_gaps_and_a_start(spark):
    found = made(spark, [row(1, 2), row(1, 5, length=3)], [packet(1, packed=True)])
    assert (found[1].chunks, found[1].first_chunk, found[1].last_chunk, found[1].missing_chunks, found[1].stream_bytes) == (2, 2, 5, 4, 7)


@pytest.mark.parametrize(("packets", "said"), [([packet(1, "capture", 0), packet(1, "capture", 1)], "told apart"), ([packet(1, "unknown")], "unknown source"), ([packet(1, "process")], "no capture has a time")])
def test_warnings_of_metadata(spark, packets, said):
    assert said in made(spark, [], packets)[1].warnings


def test_rows_two_apart_are_no_neighbours(spark):
    rows = [(1, 0, [1.0] * 3), (1, 1, [1.0, 50.0, 1.0]), (1, 3, [1.0] * 3), (2, 0, [1.0] * 3), (2, 2, [50.0] * 3), (2, 4, [1.0] * 3)]
    found = images.find_outliers(spark.createDataFrame(rows, "image_id long, y int, pixels array<double>"))
    assert [(r.image_id, r.y, r.x) for r in found.collect()] == [(1, 1, 1)]  # row 2 of image 2 stands alone
