"""Images as tables of rows (image_id, y, pixels ARRAY): assembly, calibration, repair and measures.

Work on a pixel's own row stays in arrays; only outliers, which are few, become rows of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.sources.scratch import small

# Ranks of a row's checksum.
CHECKSUM_RANK = {"valid": 3, "missing": 2, "failed": 1}


def checksum_rank(status: Column) -> Column:
    """Rank of a checksum status; others have 0."""
    return F.coalesce(*[F.when(status == k, v) for k, v in CHECKSUM_RANK.items()], F.lit(0))


def accepted_rows(rows: DataFrame) -> DataFrame:
    """rows (image_id, row_index, checksum_status, arrival) with rank, and accepted: not below any earlier copy's rank."""
    earlier = Window.partitionBy("image_id", "row_index").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("rank", checksum_rank(F.col("checksum_status")))
    return ranked.withColumn("accepted", F.col("rank") >= F.coalesce(F.max("rank").over(earlier), F.lit(-1)))


def best_rows(rows: DataFrame) -> DataFrame:
    """The copy of each image's row that is used: the best checksum, then the latest arrival."""
    ranked = rows.withColumn("rank", checksum_rank(F.col("checksum_status")))
    rest = [c for c in ranked.columns if c not in ("image_id", "row_index")]
    best = F.max_by(F.struct(*rest), F.struct("rank", "arrival")).alias("best")
    return ranked.groupBy("image_id", "row_index").agg(best).select("image_id", "row_index", "best.*")


def row_lengths(rows: DataFrame) -> DataFrame:
    """Least, most common (first met on ties) and greatest length of each image's accepted rows, superseded ones too."""
    sized = accepted_rows(rows).filter("accepted").select("image_id", F.size("pixels").alias("n"), "arrival")
    counted = sized.groupBy("image_id", "n").agg(F.count("*").alias("rows"), F.min("arrival").alias("first"))
    mode = F.max_by("n", F.struct("rows", (-F.col("first")).alias("first"))).alias("mode_length")
    return counted.groupBy("image_id").agg(F.min("n").alias("min_length"), mode, F.max("n").alias("max_length"))


def inventory(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row for each image in rows or metadata (image_id, n_rows, n_cols): what came, what is missing, and warnings.

    Rows 1 to n_rows count; a row is used if its best copy has the right length and no failed checksum.
    """
    best = best_rows(rows)
    seen = rows.groupBy("image_id").agg(F.count("*").alias("rows_seen"), *[F.count_if(F.col("checksum_status") == s).alias(f"{s}_rows") for s in CHECKSUM_RANK])
    joined = best.join(metadata, "image_id", "left")
    inside = F.col("row_index").between(1, F.col("n_rows"))
    right = F.size("pixels") == F.col("n_cols")
    used = joined.groupBy("image_id").agg(
        F.count("*").alias("unique_rows"),
        F.count_if(inside).alias("rows_in_range"),
        F.count_if(~inside).alias("out_of_range"),
        F.count_if(inside & ~right).alias("bad_length"),
        F.count_if(inside & right & (F.col("checksum_status") != "failed")).alias("used_rows"),
    )
    both = metadata.join(seen.join(used, "image_id"), "image_id", "full_outer")
    zero = {c: 0 for c in both.columns if c not in ("image_id", "n_rows", "n_cols")}
    both = both.fillna(zero).withColumn("duplicate_rows", F.col("rows_seen") - F.col("unique_rows"))
    both = both.withColumn("missing_rows", F.col("n_rows") - F.col("rows_in_range")).withColumn("zero_rows", F.col("n_rows") - F.col("used_rows"))
    notes = F.array(
        F.when(F.col("n_rows").isNull(), "no metadata"),
        F.when(F.col("missing_rows") > 0, "rows missing"),
        F.when(F.col("bad_length") > 0, "rows of wrong length"),
        F.when(F.col("failed_rows") > 0, "failed checksums"),
    )
    return both.withColumn("complete", F.coalesce(F.col("zero_rows") == 0, F.lit(False))).withColumn("warnings", F.array_join(F.array_compact(notes), "; "))


def missing_rows(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Numbers of the rows 1 to n_rows that an image lacks."""
    seen = rows.groupBy("image_id").agg(F.collect_set(F.col("row_index").cast("int")).alias("seen"))  # of one image
    missing = F.array_sort(F.array_except(F.sequence(F.lit(1), F.col("n_rows")), F.coalesce("seen", F.array().cast("array<int>"))))
    return metadata.join(seen, "image_id", "left").select("image_id", missing.alias("missing"))


def assemble(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """All rows 1 to n_rows of every image; rows that are missing, failed or of wrong length are zeros."""
    frame = metadata.select("image_id", "n_cols", F.explode(F.sequence(F.lit(1), F.col("n_rows"))).alias("row_index"))
    joined = frame.join(best_rows(rows).select("image_id", "row_index", "pixels", "checksum_status"), ["image_id", "row_index"], "left")
    good = (F.size("pixels") == F.col("n_cols")) & (F.col("checksum_status") != "failed")
    zeros = F.array_repeat(F.lit(0), F.col("n_cols"))
    return joined.select("image_id", "row_index", F.when(F.coalesce(good, F.lit(False)), F.col("pixels")).otherwise(zeros).alias("pixels"))


def chunk_coverage(chunks: DataFrame) -> DataFrame:
    """Of the compressed chunks (image_id, sequence; counted from 0): first, last, gaps inside, and all missing."""
    at = chunks.groupBy("image_id").agg(F.min("sequence").alias("first"), F.max("sequence").alias("last"), F.count_distinct("sequence").alias("chunks"))
    gaps = F.col("last") - F.col("first") + 1 - F.col("chunks")
    return at.select("*", gaps.alias("gaps"), (F.col("first") + gaps).alias("missing"))


def calibrate(images: DataFrame, frames: DataFrame) -> DataFrame:
    """images less dark, divided by flat, null where the bad-pixel mask is 1. frames: y, dark, flat, bad (arrays)."""
    fixed = F.transform(
        F.arrays_zip("pixels", "dark", "flat", "bad"),
        lambda p: F.when(p["bad"] != 1, (p["pixels"] - p["dark"]) / p["flat"]),
    )
    return images.join(frames, "y").select("image_id", "y", fixed.alias("pixels"))


def find_outliers(images: DataFrame, threshold: float = 20.0) -> DataFrame:
    """Pixels (image_id, y, x, value, middle) that are far from the median of their 3 by 3 neighbours, itself included.

    Edges repeat, and so do rows beside one that isn't there. A row is joined with the rows above and below it through a
    window over its image.
    """
    along = Window.partitionBy("image_id").orderBy("y")

    def beside(found: Callable, step: int) -> Column:
        adjoins = found("y").over(along) == F.col("y") + step
        return F.coalesce(F.when(adjoins, found("pixels").over(along)), "pixels")

    rows = images.select("*", beside(F.lag, -1).alias("up"), beside(F.lead, 1).alias("down"))
    last = F.size("pixels")

    def near(i: Column) -> Column:
        return F.flatten(F.array(*[F.array(*[F.element_at(r, F.least(F.greatest(i + d, F.lit(1)), last)) for d in (-1, 0, 1)]) for r in ("up", "pixels", "down")]))

    middle = F.transform(F.sequence(F.lit(1), last), lambda i: F.element_at(F.array_sort(near(i)), 5))
    cells = F.arrays_zip(F.col("pixels").alias("value"), middle.alias("middle"))
    pixels = rows.select("image_id", "y", F.posexplode(cells).alias("x", "p")).select("image_id", "y", "x", "p.value", "p.middle")
    return pixels.filter(F.abs((F.col("value") - F.col("middle")) / (F.col("middle") + 1e-12)) > threshold)


def repair_outliers(images: DataFrame, outliers: DataFrame, neighbours: int = 4, first_reach: int = 3) -> DataFrame:
    """Ledger of outliers with old and new value: the mean of the nearest good pixels, weighed by inverse distance.

    Good pixels are looked for in squares around an outlier; the reach doubles for those that have not yet `neighbours`
    of them no further than it, so each is settled by exactly its nearest. Ties go by row, then column.
    """
    size = images.agg(F.max("y").alias("h"), F.max(F.size("pixels")).alias("w")).first()
    widest = max(size["h"] or 0, size["w"] or 0) + 1
    bad = outliers.select("image_id", "y", F.col("x").alias("bad_x")).distinct()
    masks = bad.groupBy("image_id", "y").agg(F.collect_set("bad_x").alias("bad"))  # of one row
    good = images.join(masks, ["image_id", "y"], "left").withColumn("bad", F.coalesce("bad", F.array().cast("array<int>")))
    left, reach, settled = outliers.select("image_id", "y", "x", "value"), first_reach, None
    while True:
        rows = left.withColumn("ny", F.explode(F.sequence(F.col("y") - reach, F.col("y") + reach)))
        rows = rows.join(good.select("image_id", F.col("y").alias("ny"), "pixels", "bad"), ["image_id", "ny"])
        span = F.sequence(F.greatest(F.col("x") - reach, F.lit(0)), F.least(F.col("x") + reach, F.size("pixels") - 1))
        near = rows.select("image_id", "y", "x", "value", "ny", F.explode(F.array_except(span, "bad")).alias("nx"), "pixels")
        d2 = F.pow(F.col("ny") - F.col("y"), 2) + F.pow(F.col("nx") - F.col("x"), 2)
        near = near.select("image_id", "y", "x", "value", F.sqrt(d2).alias("d"), "ny", "nx", F.element_at("pixels", F.col("nx") + 1).alias("v"))
        rank = F.row_number().over(Window.partitionBy("image_id", "y", "x").orderBy("d", "ny", "nx"))
        near = near.withColumn("rank", rank).filter(F.col("rank") <= neighbours)
        weight = 1 / (F.col("d") + 1e-12)
        new = near.groupBy("image_id", "y", "x", "value").agg(
            (F.sum(weight * F.col("v")) / F.sum(weight)).alias("new_value"), F.count("*").alias("found"), F.max("d").alias("furthest")
        )
        whole = reach >= widest
        done = new.filter((F.col("found") >= neighbours) & (F.col("furthest") <= reach)) if not whole else new
        done = done.select("image_id", "y", "x", F.col("value").alias("old_value"), "new_value")
        settled = done if settled is None else settled.union(done)
        left = left.join(done, ["image_id", "y", "x"], "left_anti")
        if whole or left.limit(1).count() == 0:
            return settled
        reach *= 2


def rotate(pixels: DataFrame, quarter_turns: int, height: int, width: int) -> DataFrame:
    """Exploded pixels (image_id, y, x, v) turned counter-clockwise by quarter turns."""
    y, x = F.col("y"), F.col("x")
    for _ in range(quarter_turns % 4):
        y, x = F.lit(width - 1) - x, y
        height, width = width, height
    return pixels.select("image_id", y.alias("y"), x.alias("x"), "v")


def normalise_exposure(images: DataFrame, inner: float | None, outer: float | None, mask: DataFrame | None = None) -> DataFrame:
    """Counts per second. Two different exposures need a mask (y, inner ARRAY of booleans) of the inner pixels."""
    given = [x for x in (inner, outer) if x is not None]
    if not given:
        raise ValueError("an exposure is needed")
    if len(set(given)) == 1:
        return images.withColumn("pixels", F.transform("pixels", lambda v: v / given[0]))
    if mask is None:
        raise ValueError("two exposures need a mask of the inner pixels")
    scaled = F.zip_with("pixels", "inner", lambda v, i: v / F.when(i, inner).otherwise(outer))
    return images.join(mask, "y").select("image_id", "y", scaled.alias("pixels"))


def rebin(images: DataFrame, height: int, width: int, new_height: int, new_width: int) -> DataFrame:
    """Bilinear resampling with aligned end points. Each new row takes two old ones, by a join on their numbers."""
    scale = lambda old, new: (old - 1) / (new - 1) if new > 1 else 0.0
    at = F.col("ny") * scale(height, new_height)
    rows = images.select("image_id").distinct().withColumn("ny", F.explode(F.sequence(F.lit(0), F.lit(new_height - 1))))
    rows = rows.withColumn("y0", F.floor(at + 1e-9).cast("int")).withColumn("fy", F.greatest(at - F.col("y0"), F.lit(0.0)))
    one = images.select("image_id", F.col("y").cast("int").alias("y0"), F.col("pixels").alias("p0"))
    two = images.select("image_id", (F.col("y") - 1).cast("int").alias("y0"), F.col("pixels").alias("p1"))
    joined = rows.join(one, ["image_id", "y0"]).join(two, ["image_id", "y0"], "left").withColumn("p1", F.coalesce("p1", "p0"))
    mixed = joined.withColumn("row", F.zip_with("p0", "p1", lambda a, b: a * (1 - F.col("fy")) + b * F.col("fy")))
    step = scale(width, new_width)

    def value(i: Column) -> Column:
        x = i * step
        x0 = F.floor(x + 1e-9).cast("int")
        fx = F.greatest(x - x0, F.lit(0.0))
        right = F.element_at("row", F.least(x0 + 2, F.lit(width)))
        return F.element_at("row", x0 + 1) * (1 - fx) + right * fx

    return mixed.select("image_id", F.col("ny").alias("y"), F.transform(F.sequence(F.lit(0), F.lit(new_width - 1)), value).alias("pixels"))


def preview(images: DataFrame, height: int, width: int) -> DataFrame:
    """Pixels (image_id, y, x, v) of each image turned by 90 degrees and scaled to 0 to 1; a constant image is 0."""
    bounds = images.groupBy("image_id").agg(F.min(F.array_min("pixels")).alias("lo"), F.max(F.array_max("pixels")).alias("hi"))
    cells = images.select("image_id", "y", F.posexplode("pixels").alias("x", "v"))
    turned = rotate(cells, 1, height, width).join(bounds, "image_id")
    scaled = F.when(F.col("hi") > F.col("lo"), (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)
    return turned.select("image_id", "y", "x", scaled.alias("v"))


def histogram(images: DataFrame, offset: int = 0, width: int = 32) -> DataFrame:
    """Pixels by bin: bin i holds offset + i width up to the next bin."""
    pixels = images.select("image_id", F.explode("pixels").alias("v"))
    return pixels.groupBy("image_id", F.floor((F.col("v") - offset) / width).alias("bin")).agg(F.count("*").alias("pixels"))


def merge_planes(planes: DataFrame, weights: DataFrame) -> DataFrame:
    """Mean of planes (bin, y, pixels) weighed by their bins; the divisor is the weight of all bins, with a plane or not."""
    total = weights.agg(F.sum("weight").alias("total"))
    cells = planes.join(small(weights), "bin").select("y", "weight", F.posexplode("pixels").alias("x", "v"))
    merged = cells.groupBy("y", "x").agg(F.sum(F.col("weight") * F.col("v")).alias("sum"))
    return merged.crossJoin(F.broadcast(total)).select("y", "x", (F.col("sum") / F.col("total")).alias("v"))  # one row


def section_mean(stack: DataFrame) -> DataFrame:
    """Mean over the sections of a stack (image_id, section, y, pixels) of every pixel."""
    cells = stack.select("image_id", "y", F.posexplode("pixels").alias("x", "v"))
    return cells.groupBy("image_id", "y", "x").agg(F.avg("v").alias("v"))


def effective_exposure(seconds: Column, count: Column, normalisation: Column, filtered: Column) -> Column:
    """Exposure that a stack stands for; a filter leaves one integration out. Null for values that can't be."""
    used = count - F.when(filtered, 1).otherwise(0)
    return F.when((seconds >= 0) & (count >= 1) & (normalisation >= 1), used * seconds / normalisation)


def processing_mode(config: Column) -> Column:
    """STRUCT(compressed, bit_depth, threshold, position) of the processing configuration's bits."""
    encoding = config.bitwiseAND(F.lit(3))
    depth = F.when(encoding == 0, 16).when(encoding == 1, 8).when(encoding == 2, 12)
    return F.struct(
        (encoding == 3).alias("compressed"),
        depth.alias("bit_depth"),
        F.shiftright(config, 4).bitwiseAND(F.lit(3)).alias("threshold"),
        F.shiftright(config, 6).bitwiseAND(F.lit(3)).alias("position"),
    )


def dimensions(roi_rows: Column, roi_cols: Column, config: Column, row_bin: Column, col_bin: Column) -> Column:
    """STRUCT(n_rows, n_cols, uneven) of a region of interest and its binning, from the packed configuration, else two
    fields, else none; bins count from 0."""
    fields = row_bin.isNotNull() & col_bin.isNotNull()
    down = F.when(config.isNotNull(), config.bitwiseAND(F.lit(255)) + 1).when(fields, row_bin + 1).otherwise(F.lit(1))
    across = F.when(config.isNotNull(), F.shiftright(config, 8).bitwiseAND(F.lit(255)) + 1).when(fields, col_bin + 1).otherwise(F.lit(1))
    return F.struct(F.floor(roi_rows / down).alias("n_rows"), F.floor(roi_cols / across).alias("n_cols"), ((roi_rows % down != 0) | (roi_cols % across != 0)).alias("uneven"))


def capture_sets(captures: DataFrame) -> DataFrame:
    """captures (image_id, sensor, integration_ms) with set: inner, outer or null.

    Sensor 0 is outer and 1 inner; where no capture of an image says, the shortest integrations are inner and the
    longest outer, if there are two lengths.
    """
    bounds = captures.groupBy("image_id").agg(F.count_if(F.col("sensor").isin(0, 1)).alias("explicit"), F.min("integration_ms").alias("short"), F.max("integration_ms").alias("long"))
    by_time = F.when(F.col("short") < F.col("long"), F.when(F.col("integration_ms") == F.col("short"), "inner").when(F.col("integration_ms") == F.col("long"), "outer"))
    by_sensor = F.when(F.col("sensor") == 0, "outer").when(F.col("sensor") == 1, "inner")
    return captures.join(bounds, "image_id").withColumn("set", F.when(F.col("explicit") > 0, by_sensor).otherwise(by_time))


def capture_summary(captures: DataFrame) -> DataFrame:
    """Per image, its captures (sensor, integration_ms, right_shift, filtered, start) as inner and outer sets (see capture_sets).

    Counts, normalisation (of the last arrival), filter (any), effective exposure, and time from the first start to
    the end of the last.
    """
    marked = capture_sets(captures)
    out = []
    for name in ("inner", "outer"):
        own = F.col("set") == name
        seconds = F.min_by(F.when(own, F.col("integration_ms")), F.when(own, F.col("arrival"))) / 1000
        norm = F.pow(F.lit(2), F.greatest(F.coalesce(F.max_by(F.when(own, F.col("right_shift")), F.when(own, F.col("arrival"))), F.lit(0)), F.lit(0)))
        any_filter = F.coalesce(F.bool_or(F.when(own, F.col("filtered"))), F.lit(False))
        count = F.count_if(own)
        out += [count.alias(f"stacked_{name}"), norm.alias(f"normalisation_{name}"), effective_exposure(seconds, count, norm, any_filter).alias(f"exposure_{name}")]
    last = F.max_by("integration_ms", F.struct("start", (-F.col("arrival")).alias("a")))
    return marked.groupBy("image_id").agg(F.count("*").alias("captures"), *out, (F.max("start") + last / 1000 - F.min("start")).alias("elapsed"))
