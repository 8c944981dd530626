"""Row packets, image metadata, exposure, pointing and deconvolution, as expressions and joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.functions import bits
from perigee.operators.images import checksum_rank, merge_planes, rebin

# The detector's size, and the parts of a row packet.
MOST_ROWS, MOST_COLS = 2000, 1504
ROW_HEAD, ROW_CHECKSUM = 6, 4

# Metres of an astronomical unit, and the exposures inside and outside the disk in seconds.
AU_METRES = 1.496e11
SHORT_SECONDS, LONG_SECONDS = 0.035, 15.0


def row_packets(packets: DataFrame) -> DataFrame:
    """packets (packet) of image rows with image_id, row_index, pixels, checksum_status and status.

    The payload lies between the secondary header and the checksum and holds 16-bit pixels. A packet shorter than its
    head, with an odd or empty payload, or without all of it is skipped, and has no pixels.
    """
    packet = F.col("packet")
    size = F.octet_length(packet)
    field = bits.unsigned(packet, 4, 2) + 1
    payload = (field - ROW_HEAD - ROW_CHECKSUM).cast("int")
    data = F.substring(packet, F.lit(6 + ROW_HEAD + 1), F.greatest(payload, F.lit(0)))
    there = size >= 6 + ROW_HEAD + payload + ROW_CHECKSUM
    stored = F.substring(packet, 6 + ROW_HEAD + 1 + payload, F.lit(ROW_CHECKSUM))
    total = bits.additive32(data)
    checksum = (
        F.when(~there, "missing")
        .when(bits.stored_checksum(stored) == total, "valid_be")
        .when(bits.stored_checksum(stored, little_endian=True) == total, "valid_le")
        .otherwise("failed")
    )
    status = (
        F.when(size < F.least(6 + field, F.lit(6 + ROW_HEAD)), "skipped_short_packet")
        .when((payload <= 0) | (payload % 2 != 0), "skipped_bad_row_length")
        .when(F.octet_length(data) != payload, "skipped_incomplete_row_payload")
        .otherwise("parsed")
    )
    pixels = F.transform(F.regexp_extract_all(F.hex(data), F.lit("(.{4})"), 1), lambda x: F.conv(x, 16, 10).cast("int"))
    return packets.withColumns(
        {
            "image_id": bits.unsigned(packet, 6, 4),
            "row_index": bits.header_fields(packet)["sequence_count"],
            "row_payload_bytes": payload,
            "checksum_status": checksum,
            "status": status,
            "pixels": F.when(status == "parsed", pixels),
        }
    )


def plausible(metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metadata (roi_rows, roi_cols, status) that can be true, and one row of how many were rejected and why."""
    decoded = F.col("status") != "decode_failed"
    sized = F.col("roi_rows").between(1, MOST_ROWS) & F.col("roi_cols").between(1, MOST_COLS)
    reason = F.when(~decoded, "decode").when(~F.coalesce(sized, F.lit(False)), "dimensions")
    marked = metadata.withColumn("reject_reason", reason)
    counts = marked.agg(F.count_if(F.col("reject_reason") == "decode").alias("rejected_decode"), F.count_if(F.col("reject_reason") == "dimensions").alias("rejected_dimensions"))
    return marked.filter("reject_reason is null").drop("reject_reason"), counts


def known_rows(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Image rows (image_id, row_payload_bytes) whose image the metadata (image_id, n_cols) knows, and whose payload has
    its columns where these are known."""
    of_image = metadata.groupBy("image_id").agg(F.max("n_cols").alias("expected_cols"))
    joined = rows.join(of_image, "image_id")
    return joined.filter("expected_cols is null or row_payload_bytes = 2 * expected_cols").drop("expected_cols")


def best_view(records: DataFrame, by: str) -> DataFrame:
    """Per group the byte order (view, position) whose records score best: 10 for metadata, 1 for a row; ties go to the first."""
    score = F.sum(F.when(F.col("kind") == "metadata", 10).otherwise(1))
    scored = records.groupBy(by, "view").agg(score.alias("score"), F.min("position").alias("position"))
    best = F.max_by(F.struct("view", "score"), F.struct("score", (-F.col("position")).alias("first")))
    return scored.groupBy(by).agg(best.alias("b")).select(by, "b.*")


def more_records(packets: DataFrame, scanned: DataFrame, by: str) -> DataFrame:
    """Per group, which records to use: those scanned from the stream only if there are strictly more of them."""
    a, b = packets.groupBy(by).agg(F.count("*").alias("from_packets")), scanned.groupBy(by).agg(F.count("*").alias("from_stream"))
    both = a.join(b, by, "full_outer").na.fill(0)
    return both.withColumn("use", F.when(F.col("from_stream") > F.col("from_packets"), "stream").otherwise("packets"))


def product_metadata(packets: DataFrame, by: str, order: str) -> DataFrame:
    """Per image the metadata packet to use: the last of the process source, else the last."""
    rest = [c for c in packets.columns if c != by]
    last = F.max_by(F.struct(*rest), F.struct(F.col("meta_source") == "process", order))
    return packets.groupBy(by).agg(last.alias("p")).select(by, "p.*")


def metadata_source(value: Column) -> Column:
    """capture, process or unknown of a source given as number or name."""
    name = F.lower(F.trim(value))
    return F.when(name.isin("0", "cap") | name.contains("capture"), "capture").when(name.isin("1", "proc") | name.contains("process"), "process").otherwise("unknown")


def filter_on(value: Column) -> Column:
    """Whether a particle filter's flag, given as text, is on."""
    return F.coalesce(F.lower(F.trim(value)).isin("1", "true", "enabled", "enable", "ena", "on"), F.lit(False))


def compression_mode(combined: Column, encoding: Column) -> Column:
    """STRUCT(compressed, bit_depth, warning) of the packed configuration, else of the encoding field, else 16 bits."""
    code = F.coalesce(combined.bitwiseAND(F.lit(3)), encoding)
    depth = F.when(code == 0, 16).when(code == 1, 8).when(code == 2, 12).when(code.isNull(), 16)
    warning = F.when(code.isNull(), "metadata is missing ICM encoding fields; assuming uncompressed 16-bit rows").when(
        ~code.isin(0, 1, 2, 3), F.concat(F.lit("unrecognized ICM encoding value "), code, F.lit("; treating as unknown bit depth"))
    )
    return F.struct(F.coalesce(code == 3, F.lit(False)).alias("compressed"), depth.alias("bit_depth"), warning.alias("warning"))


def keyword_exposure(direct: Column, seconds: Column, count: Column, normalisation: Column, filtered: Column) -> Column:
    """Effective exposure by keywords: the direct value, else from the stack; null where parts are missing."""
    used = count - F.when(F.coalesce(filtered, F.lit(False)), 1).otherwise(0)
    wrong = (used < 0) | (normalisation <= 0)
    return F.coalesce(direct, F.when(wrong, F.raise_error(F.lit("invalid exposure metadata"))).otherwise(used * seconds / normalisation))


def au_scale(metres: Column) -> Column:
    """Factor that brings an intensity seen from a distance to one astronomical unit; null unless the distance is above 0."""
    return F.when(metres > 0, F.pow(F.lit(AU_METRES) / metres, F.lit(2.0)))


def dark_current(celsius: Column) -> Column:
    """Mean dark current of a detector at a temperature."""
    return 20 * F.pow(F.lit(2.0), (celsius - 20) / 5.5)


def scale_disk(cells: DataFrame, centre: tuple[Column, Column], radius: Column, celsius: Column) -> DataFrame:
    """Pixels (y, x, v) per second less the dark current: the short exposure inside the disk, the long one outside."""
    inside = F.sqrt(F.pow(F.col("x") - centre[0], F.lit(2)) + F.pow(F.col("y") - centre[1], F.lit(2))) <= radius
    return cells.withColumn("v", F.col("v") / F.when(inside, SHORT_SECONDS).otherwise(LONG_SECONDS) - dark_current(celsius))


def disk_radius(rsun: Column, pixel_scale: Column) -> Column:
    """Radius in pixels of the field that the short exposure covers."""
    return 1.33 * rsun / pixel_scale


def pointing_angle(centuries: Column, quaternion: list[Column], plus_y_up: Column) -> Column:
    """Degrees between solar north and the detector's axis, for Julian centuries since 2000 and a body quaternion (x, y, z, w).

    The direction of solar north drifts slowly in right ascension and declination; light's travel and the Earth's
    motion, some 20 arc seconds, are left out.
    """
    ra, dec = F.radians(286.13 + 0.00694 * centuries), F.radians(63.87 - 0.00272 * centuries)
    north = [F.cos(dec) * F.cos(ra), F.cos(dec) * F.sin(ra), F.sin(dec)]
    norm = F.sqrt(sum((q * q for q in quaternion[1:]), quaternion[0] * quaternion[0]))
    x, y, z, w = (q / norm for q in quaternion)
    along = 2 * (x * y + z * w) * north[0] + (1 - 2 * (x * x + z * z)) * north[1] + 2 * (y * z - x * w) * north[2]
    signed = F.when(plus_y_up, along).otherwise(-along)
    return F.degrees(F.acos(F.greatest(F.least(signed, F.lit(1.0)), F.lit(-1.0))))


def rotation_matrix(degrees: Column, decimals: int = 6) -> Column:
    """STRUCT(pc1_1, pc1_2, pc2_1, pc2_2) of a rotation."""
    cos, sin = F.round(F.cos(F.radians(degrees)), decimals), F.round(F.sin(F.radians(degrees)), decimals)
    return F.struct(cos.alias("pc1_1"), (-sin).alias("pc1_2"), sin.alias("pc2_1"), cos.alias("pc2_2"))


def deconvolution_report(before: DataFrame, after: DataFrame, low: int = 80, high: int = 100) -> DataFrame:
    """Per image (image_id, y, x, v): sum after over sum before, and the means of the dark window in both."""
    window = F.col("y").between(low, high - 1) & F.col("x").between(low, high - 1)

    def side(cells: DataFrame, name: str) -> DataFrame:
        return cells.groupBy("image_id").agg(F.sum("v").alias(f"sum_{name}"), F.avg(F.when(window, F.col("v"))).alias(f"dark_{name}"))

    joined = side(before, "before").join(side(after, "after"), "image_id")
    return joined.select("image_id", (F.col("sum_after") / F.col("sum_before")).alias("ratio"), "dark_before", "dark_after")


def noise_regions(images: DataFrame, height: int, width: int, regions: int, size: int) -> DataFrame:
    """Per image (image_id, y, pixels) and cell of a square grid: centre, standard deviation and a robust sigma.

    A box of size x size stands in the middle of each cell, moved inside the image. regions must be a square number.
    The robust sigma is 1.4826 times the median distance from the median.
    """
    across = round(regions**0.5)
    if across * across != regions:
        raise ValueError("the number of regions must be a square number")
    inside = lambda at, most: max(0, min(at, most - size))
    top = [inside(i * (height // across) + (height // across - size) // 2, height) for i in range(across)]
    left = [inside(j * (width // across) + (width // across - size) // 2, width) for j in range(across)]
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(top[i]).alias("y0"), F.lit(left[j]).alias("x0")) for i in range(across) for j in range(across)])
    boxes = images.select("image_id", "y", "pixels", F.inline(grid)).filter(F.col("y").between(F.col("y0"), F.col("y0") + size - 1))
    cells = boxes.select("image_id", "i", "j", "y0", "x0", F.explode(F.slice("pixels", F.col("x0") + 1, F.lit(size))).alias("v"))
    by = ["image_id", "i", "j", "y0", "x0"]
    middle = cells.groupBy(*by).agg(F.median("v").alias("middle"), F.stddev_pop("v").alias("std"))  # of size * size pixels
    spread = cells.join(middle, by).groupBy(*by, "middle", "std").agg((F.median(F.abs(F.col("v") - F.col("middle"))) * 1.4826).alias("sigma"))
    return spread.select("image_id", "i", "j", (F.col("y0") + size // 2).alias("centre_y"), (F.col("x0") + size // 2).alias("centre_x"), "std", "sigma")


#: Transforms smaller than this share of the largest are taken to be as large, so that noise there isn't blown up.
LEAST_TRANSFORM = 1e-3

# Fixed value: how much of what isn't scattered is put into the core.
CORE_FACTOR = 0.4


def scatter_kernel(psf: np.ndarray, factor: float = CORE_FACTOR) -> np.ndarray:
    """A scatter function with its core set to a share of what it doesn't scatter, and its sum to 1."""
    kernel = np.array(psf, float)
    kernel[kernel.shape[0] // 2, kernel.shape[1] // 2] = (1 - kernel.sum()) * factor
    return kernel / kernel.sum()


def inverse_transform(psf: np.ndarray, shape: tuple[int, int], least: float = LEAST_TRANSFORM) -> np.ndarray:
    """What the transform of an image of this shape is multiplied with. A transform below `least` times the largest is
    divided by as if it were that large, in its own direction; one of 0 gives 0."""
    padded = np.zeros(shape)
    rows, cols = psf.shape
    padded[:rows, :cols] = psf
    found = np.fft.rfft2(np.roll(padded, (-(rows // 2), -(cols // 2)), (0, 1)))
    size = np.abs(found)
    return np.conj(found) / np.maximum(size, least * size.max()) ** 2


def deconvolve(images: DataFrame, psf: np.ndarray, height: int, width: int, padded: bool = True, least: float = LEAST_TRANSFORM) -> DataFrame:
    """Images (image_id, y, pixels) with what a point spread function has scattered brought back, by an inverse filter.

    The function (of the image's size or less, its middle the core) is the same for all images, so it is the one
    thing that every task holds; its sum is brought to 1. An image is padded to twice its size with zeros, unless it is
    to wrap around, and cut back. Small transforms are bounded (see inverse_transform), so that a function whose
    transform has zeros gives numbers, though what it has wiped out stays lost. Rows that aren't there count as dark.
    One image meets in one task; images are spread over tasks.
    """
    return filter_images(images, [(psf / psf.sum(), padded)], height, width, least)


def filter_images(images: DataFrame, steps: list[tuple[np.ndarray, bool]], height: int, width: int, least: float = LEAST_TRANSFORM) -> DataFrame:
    """Images through inverse filters one after another, each (function, whether to pad), in one pass over each image."""
    inverses = []
    for psf, padded in steps:
        shape = (2 * height, 2 * width) if padded else (height, width)
        inverses.append((inverse_transform(psf, shape, least), shape))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for lines in frame["rows"]:
                image = np.zeros((height, width))
                for line in lines:
                    image[line["y"]] = line["pixels"]
                for inverse, shape in inverses:
                    image = np.fft.irfft2(np.fft.rfft2(image, shape) * inverse, shape)[:height, :width]
                out.append(image.tolist())
            yield pd.DataFrame({"image_id": frame["image_id"], "rows": out})

    whole = images.groupBy("image_id").agg(F.collect_list(F.struct("y", "pixels")).alias("rows"))  # of one image
    found = whole.mapInPandas(run, "image_id long, rows array<array<double>>")
    return found.select("image_id", F.posexplode("rows").alias("y", "pixels"))


def plane_of(rows: DataFrame, height: int, width: int) -> np.ndarray:
    """One plane (y, pixels) as an array on the driver: its size is that of one image. Rows that aren't there are 0."""
    plane = np.zeros((height, width))
    for row in rows.select("y", "pixels").collect():
        plane[row["y"]] = row["pixels"]
    return plane


def archive_deconvolution(
    images: DataFrame,
    planes: DataFrame,
    weights: DataFrame,
    plane_shape: tuple[int, int],
    scatter: DataFrame,
    scatter_shape: tuple[int, int],
    height: int = 750,
    width: int = 1000,
    tall: int = 1000,
    gain: float = 4.0,
    factor: float = CORE_FACTOR,
    least: float = LEAST_TRANSFORM,
) -> DataFrame:
    """Images (image_id, y, pixels) without diffraction and scatter.

    The diffraction planes (bin, y, pixels) are merged by the weights (bin, weight) of their wavelengths, rebinned to
    tall x width, cut above and below to the image's height, multiplied by the gain of rebinning, and undone with
    padding. The scatter function (y, pixels) is rebinned to the image's size, its core is set (see scatter_kernel), and
    it is undone around the edges. Both functions are made on Spark; only two planes of an image's size come to the
    driver. Small transforms are bounded (see inverse_transform).
    """
    if (tall - height) % 2 or tall < height:
        raise ValueError("the rebinned plane must be cut by as many rows above as below")
    merged = merge_planes(planes, weights)
    lines = merged.groupBy("y").agg(F.array_sort(F.collect_list(F.struct("x", "v"))).getField("v").alias("pixels"))  # of one plane
    alone = lambda rows: rows.select(F.lit(0).cast("long").alias("image_id"), F.col("y").cast("int").alias("y"), "pixels")
    cut = (tall - height) // 2
    diffraction = plane_of(rebin(alone(lines), *plane_shape, tall, width), tall, width)[cut : tall - cut] * gain
    spread = plane_of(rebin(alone(scatter), *scatter_shape, height, width), height, width)
    return filter_images(images, [(diffraction, True), (scatter_kernel(spread, factor), False)], height, width, least)


def compressed_streams(chunks: DataFrame) -> DataFrame:
    """Per image the stream of its chunks (image_id, sequence, checksum_status, arrival, payload): the best chunk of each
    sequence number, in order, with the bounds of the picture in it, and how many chunks are missing."""
    best = Window.partitionBy("image_id", "sequence").orderBy(checksum_rank(F.col("checksum_status")).desc(), F.desc("arrival"))
    chosen = chunks.withColumn("nth", F.row_number().over(best)).filter("nth = 1")
    parts = F.array_sort(F.collect_list(F.struct("sequence", F.hex("payload").alias("h"))))  # of one image
    held = chosen.groupBy("image_id").agg(parts.alias("parts"), F.count("*").alias("n"), F.max("sequence").alias("last"))
    stream = F.unhex(F.array_join(F.col("parts.h"), ""))
    joined = held.select("image_id", "n", (F.col("last") + 1 - F.col("n")).alias("missing"), stream.alias("stream"))
    start, stop = bits.marker_bounds(F.col("stream"))
    return joined.withColumns({"start": start, "stop": stop})
