"""What came of every image: metadata packets, rows or compressed chunks, what is missing, and warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.operators.images import CHECKSUM_RANK, capture_sets, checksum_rank
from perigee.operators.science import product_metadata

#: Between the warnings of an image.
SEPARATOR = " | "


def counted(n: Column, text: str) -> Column:
    """A warning with a number, null if the number is 0 or null."""
    return F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {text}")))


def image_metadata(packets: DataFrame) -> DataFrame:
    """Per image of metadata packets (image_id, meta_source, sensor, integration_ms, right_shift, start, arrival and more),
    the packet that products use (see product_metadata), numbers of packets by source, and meta_warnings (an array).

    Captures are the packets of the capture source or, if there are none, those of unknown source. The last arrival of
    a set tells its shift. Packets should have arrivals of their own within an image.
    """
    source = F.col("meta_source")
    numbers = packets.groupBy("image_id").agg(
        F.count("*").alias("meta_packets"), *[F.count_if(source == s).alias(f"{s}_packets") for s in ("capture", "process", "unknown")]
    )
    wanted = F.when(F.col("capture_packets") > 0, "capture").otherwise("unknown")
    captures = capture_sets(packets.join(numbers.select("image_id", wanted.alias("_wanted")), "image_id").filter(source == F.col("_wanted")))
    shift = lambda name: F.max_by(F.when(F.col("set") == name, F.coalesce("right_shift", F.lit(0))), F.when(F.col("set") == name, F.col("arrival"))).alias(f"_shift_{name}")
    sets = captures.groupBy("image_id").agg(
        ((F.max("explicit") == 0) & ~F.coalesce(F.max("short") < F.max("long"), F.lit(False))).alias("_alike"),
        F.count_if(F.col("start").isNotNull()).alias("_timed"),
        shift("inner"),
        shift("outer"),
    )
    wrong = [F.when(F.col(f"_shift_{s}") < 0, F.format_string(f"{s} set has the invalid shift %d, 0 is used", F.col(f"_shift_{s}"))) for s in ("inner", "outer")]
    notes = F.array(
        counted(F.col("unknown_packets"), "metadata packet(s) of unknown source"),
        F.when(F.col("process_packets") == 0, "no metadata packet of the process source, the last one is used"),
        F.when(F.col("_alike"), "captures can't be told apart as two sets"),
        *wrong,
        F.when(F.coalesce(F.col("_timed"), F.lit(0)) == 0, "no capture has a time"),
    )
    joined = product_metadata(packets, "image_id", "arrival").join(numbers, "image_id").join(sets, "image_id", "left")
    return joined.withColumn("meta_warnings", F.array_compact(notes)).drop(*[c for c in joined.columns if c.startswith("_")])


def full_inventory(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row for each image of rows or metadata.

    rows: image_id, row_index, length (pixels or bytes), checksum_status, status (parsed or why not), arrival. A row that
    isn't parsed is counted and skipped. Of the copies of a row the best checksum counts, then the latest; a copy that is not
    worse than all before it counts for the lengths. For compressed images a row is a chunk, counted from 0.

    metadata (see image_metadata): also n_rows, n_cols, uneven, compressed, bit_depth and mode_warning (all may be null).
    Without it nothing is known of sizes, and no product is made. An uncompressed image is complete if nothing is missing,
    failed, too long or short, or outside; it is partial if rows are to be filled with zeros; it is neither if lengths are
    wrong. Rows are reduced to their sizes before they are shuffled, by image and row, then summed by image and length.
    """
    slim = rows.select("image_id", "row_index", "length", "checksum_status", "arrival", F.coalesce(F.col("status") == "parsed", F.lit(False)).alias("parsed"))
    slim = slim.withColumn("rank", checksum_rank(F.col("checksum_status")))
    copies = Window.partitionBy("image_id", "row_index", "parsed")
    earlier = copies.orderBy("arrival", "length").rowsBetween(Window.unboundedPreceding, -1)
    marked = slim.withColumn("accepted", F.col("parsed") & (F.col("rank") >= F.coalesce(F.max("rank").over(earlier), F.lit(-1))))
    first = F.row_number().over(copies.orderBy(F.desc("rank"), F.desc("arrival"), F.desc("length"))) == 1
    marked = marked.withColumn("chosen", F.col("parsed") & first)
    sizes = metadata.select("image_id", "n_rows", "n_cols", F.coalesce("compressed", F.lit(False)).alias("packed"))
    known = marked.join(sizes, "image_id", "left")
    chosen, plain = F.col("chosen"), ~F.coalesce(F.col("packed"), F.lit(False))
    inside = F.col("row_index").between(1, F.col("n_rows"))
    tallies = [F.count_if(F.col("checksum_status") == s).alias(f"checksum_{s}_rows") for s in CHECKSUM_RANK]
    used = [F.count_if(chosen & (F.col("checksum_status") == s)).alias(f"selected_checksum_{s}_rows") for s in CHECKSUM_RANK]
    by_length = known.groupBy("image_id", "length").agg(
        F.count("*").alias("data_packets"),
        F.count_if(~F.col("parsed")).alias("skipped_rows"),
        F.count_if(chosen).alias("unique_rows"),
        F.count_if(chosen & inside).alias("rows_inside"),
        F.count_if(chosen & plain & F.col("n_rows").isNotNull() & ~inside).alias("out_of_range_rows"),
        F.count_if("accepted").alias("accepted_rows"),
        F.min(F.when(F.col("accepted"), F.col("arrival"))).alias("_first"),
        F.count_if(F.col("accepted") & plain & (F.col("length") != F.col("n_cols"))).alias("bad_length_rows"),
        F.sum(F.when(chosen, F.col("length")).otherwise(0)).alias("chosen_length"),
        F.min(F.when(chosen, F.col("row_index"))).alias("first_row"),
        F.max(F.when(chosen, F.col("row_index"))).alias("last_row"),
        *tallies,
        *used,
    )
    sums = ["data_packets", "skipped_rows", "unique_rows", "rows_inside", "out_of_range_rows", "bad_length_rows", "accepted_rows", "chosen_length"]
    sums += [f"{p}checksum_{s}_rows" for p in ("", "selected_") for s in CHECKSUM_RANK]
    length = F.when(F.col("accepted_rows") > 0, F.col("length"))
    seen = by_length.groupBy("image_id").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min(length).alias("row_length_min"),
        F.max_by(length, F.when(length.isNotNull(), F.struct("accepted_rows", (-F.col("_first")).alias("f")))).alias("row_length_mode"),
        F.max(length).alias("row_length_max"),
        F.min("first_row").alias("first_row"),
        F.max("last_row").alias("last_row"),
    )
    both = metadata.join(seen, "image_id", "full_outer").fillna(0, [*sums, "meta_packets"])
    return described(both)


def described(both: DataFrame) -> DataFrame:
    """The inventory's columns from its sums and metadata."""
    col = F.col
    has = col("meta_packets") > 0
    packed = F.coalesce(col("compressed"), F.lit(False))
    sized = has & ~packed & col("n_rows").isNotNull()
    missing = F.when(sized, col("n_rows") - col("rows_inside")).cast("long")
    writable = F.coalesce(sized & col("n_cols").isNotNull() & (col("bad_length_rows") == 0) & (col("unique_rows") > 0), F.lit(False))
    failed = col("selected_checksum_failed_rows")
    whole = writable & (missing == 0) & (col("out_of_range_rows") == 0) & (failed == 0)
    found = both.withColumns({"missing_rows": missing, "complete": whole, "partial": writable & ~whole})
    found = found.withColumns(
        {
            "duplicate_rows": F.greatest(F.lit(0), col("data_packets") - col("unique_rows") - col("skipped_rows")),
            "zero_filled_missing_rows": F.when(col("partial"), col("missing_rows")).otherwise(0),
            "zero_filled_failed_rows": F.when(writable, failed).otherwise(0),
        }
    ).withColumn("zero_filled_rows", col("zero_filled_missing_rows") + col("zero_filled_failed_rows"))
    chunked = packed & (col("unique_rows") > 0)
    gaps = col("last_row") - col("first_row") + 1 - col("unique_rows")
    chunks = {"chunks": col("data_packets") - col("skipped_rows"), "selected_chunks": col("unique_rows"), "first_chunk": col("first_row"), "last_chunk": col("last_row")}
    chunks |= {"missing_chunks": col("first_row") + gaps, "stream_bytes": col("chosen_length")}
    found = found.withColumns({k: F.when(chunked, v) for k, v in chunks.items()})
    notes = F.array(
        F.when(~has, "no metadata: sizes are unknown and no product is made"),
        col("mode_warning"),
        F.when(col("uneven"), "the binning doesn't divide the region"),
        counted(col("out_of_range_rows"), "row(s) outside the image"),
        counted(col("bad_length_rows"), "row(s) of wrong length"),
        counted(col("missing_rows"), "row(s) missing"),
        counted(col("checksum_failed_rows"), "failed checksum(s)"),
        counted(col("checksum_missing_rows"), "missing checksum(s)"),
        counted(col("duplicate_rows"), "copies of rows; the best checksum counts"),
        counted(failed, "row(s) in use have failed checksums"),
        counted(col("selected_checksum_missing_rows"), "row(s) in use have no checksum"),
        F.when(packed, "compressed: sequence counts number chunks, not rows"),
        F.when(chunked & (col("missing_chunks") > 0), F.format_string("%d chunk(s) missing: first %d, last %d", "missing_chunks", "first_row", "last_row")),
        counted(F.when(col("partial"), col("zero_filled_rows")), "row(s) filled with zeros"),
    )
    every = F.concat(F.coalesce("meta_warnings", F.array().cast("array<string>")), F.array_compact(notes))
    shaped = found.withColumns({"warnings": F.array_join(every, SEPARATOR), "compressed": packed})
    tallies = [f"{p}checksum_{s}_rows" for p in ("", "selected_") for s in CHECKSUM_RANK]
    return shaped.select(
        "image_id", "meta_packets", "data_packets", "unique_rows", "duplicate_rows", "skipped_rows", col("n_rows").alias("expected_rows"), col("n_cols").alias("expected_cols"),
        "missing_rows", "row_length_min", "row_length_mode", "row_length_max", "bad_length_rows", "out_of_range_rows", "compressed", "bit_depth", *tallies,
        "complete", "partial", "zero_filled_missing_rows", "zero_filled_failed_rows", "zero_filled_rows", *chunks, "warnings",
    )
