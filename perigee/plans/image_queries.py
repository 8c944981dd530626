"""Queries over images made from embeddings: 64 vectors make an image, their 64 numbers the pixels of a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators import images as ops
from perigee.plans.base import query
from perigee.plans.fixtures import table

SIDE = 64

IMAGES_SQL = """
images AS (SELECT vec_id // 64 AS image_id, (vec_id % 64)::INT AS y, [floor(abs(v::DOUBLE) * 1000)::INT FOR v IN embedding] AS pixels FROM embeddings),
cells AS (SELECT image_id, y, (x - 1)::INT AS x, pixels[x] AS v FROM images, unnest(range(1, 65)) AS r(x))"""
IMAGES = "WITH " + IMAGES_SQL.strip()


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of images."""
    pixels = F.transform("embedding", lambda v: F.floor(F.abs(v.cast("double")) * 1000).cast("int"))
    return table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 64").alias("image_id"), (F.col("vec_id") % 64).cast("int").alias("y"), pixels.alias("pixels"))


def cells(df: DataFrame, *more: str) -> DataFrame:
    """One row for each pixel."""
    return df.select("image_id", "y", *more, F.posexplode("pixels").alias("x", "v"))


COPIES_SQL = """
copies AS (
    SELECT image_id, y AS row_index, CASE WHEN (y + c) % 7 = 3 THEN pixels[1:60] ELSE pixels END AS pixels, y * 3 + c AS arrival,
           ['valid', 'failed', 'missing'][(image_id + y * 5 + c * 2) % 3 + 1] AS checksum_status
    FROM images, unnest(range(3)) AS r(c) WHERE (y + c) % 4 <> 1),
ranked AS (SELECT *, CASE checksum_status WHEN 'valid' THEN 3 WHEN 'missing' THEN 2 ELSE 1 END AS rank FROM copies),
best AS (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY image_id, row_index ORDER BY rank DESC, arrival DESC) = 1),
metadata AS (SELECT DISTINCT image_id, 63 AS n_rows, 64 AS n_cols FROM images WHERE image_id % 5 <> 2 UNION ALL SELECT -1, 63, 64 FROM (SELECT count(*) FROM images))"""
COPIES = f"{IMAGES}, {COPIES_SQL.strip()}"


def copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three copies of each row, some short, with checksums of all kinds."""
    c = F.col("c")
    many = images(spark, sf_dir).withColumn("c", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).filter((F.col("y") + c) % 4 != 1)
    status = F.get(F.array(F.lit("valid"), F.lit("failed"), F.lit("missing")), ((F.col("image_id") + F.col("y") * 5 + c * 2) % 3).cast("int"))
    short = F.when((F.col("y") + c) % 7 == 3, F.slice("pixels", 1, 60)).otherwise(F.col("pixels"))
    return many.select("image_id", F.col("y").alias("row_index"), short.alias("pixels"), (F.col("y") * 3 + c).alias("arrival"), status.alias("checksum_status"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of most images, and of one that has no rows."""
    known = images(spark, sf_dir).filter("image_id % 5 <> 2").select("image_id").distinct()
    return known.union(spark.range(1).select(F.lit(-1).cast("long"))).select("image_id", F.lit(63).alias("n_rows"), F.lit(64).alias("n_cols"))


@query("w3_best_row_copy", COPIES + " SELECT image_id, row_index, rank, arrival, len(pixels)::INT AS n FROM best")
def w3_best_row_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.best_rows(copies(spark, sf_dir)).select("image_id", "row_index", "rank", "arrival", F.size("pixels").alias("n"))


ACCEPTED_SQL = """
accepted AS (SELECT *, rank >= coalesce(max(rank) OVER (PARTITION BY image_id, row_index ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS accepted FROM ranked)"""


@query("w4_accepted_rows", f"{COPIES}, {ACCEPTED_SQL} SELECT image_id, row_index, arrival, accepted FROM accepted")
def w4_accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.accepted_rows(copies(spark, sf_dir)).select("image_id", "row_index", "arrival", "accepted")


@query(
    "a9_row_lengths",
    f"""{COPIES}, {ACCEPTED_SQL},
counted AS (SELECT image_id, len(pixels) AS n, count(*) AS c, min(arrival) AS first FROM accepted WHERE accepted GROUP BY ALL)
SELECT image_id, min(n)::INT AS min_length, arg_max(n, c * 1000 - first)::INT AS mode_length, max(n)::INT AS max_length FROM counted GROUP BY image_id""",
)
def a9_row_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.row_lengths(copies(spark, sf_dir))


@query(
    "a8_image_inventory",
    f"""{COPIES},
seen AS (SELECT image_id, count(*) AS rows_seen, count(*) FILTER (rank = 3) AS valid_rows, count(*) FILTER (rank = 2) AS missing_status, count(*) FILTER (rank = 1) AS failed_rows FROM ranked GROUP BY image_id),
used AS (SELECT image_id, count(*) AS unique_rows, count(*) FILTER (row_index BETWEEN 1 AND n_rows) AS in_range,
                count(*) FILTER (row_index BETWEEN 1 AND n_rows AND len(pixels) <> n_cols) AS bad_length,
                count(*) FILTER (row_index BETWEEN 1 AND n_rows AND len(pixels) = n_cols AND rank > 1) AS used_rows
         FROM best LEFT JOIN metadata USING (image_id) GROUP BY image_id)
SELECT image_id, coalesce(rows_seen, 0) AS rows_seen, coalesce(rows_seen - unique_rows, 0) AS duplicate_rows, n_rows - coalesce(in_range, 0) AS missing_rows,
       coalesce(bad_length, 0) AS bad_length, coalesce(failed_rows, 0) AS failed_rows, coalesce(used_rows, 0) AS used_rows,
       coalesce(n_rows = used_rows, false) AS complete,
       concat_ws('; ', CASE WHEN n_rows IS NULL THEN 'no metadata' END, CASE WHEN n_rows > coalesce(in_range, 0) THEN 'rows missing' END,
                 CASE WHEN bad_length > 0 THEN 'rows of wrong length' END, CASE WHEN failed_rows > 0 THEN 'failed checksums' END) AS warnings
FROM metadata FULL JOIN (SELECT * FROM seen JOIN used USING (image_id)) USING (image_id)""",
)
def a8_image_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.inventory(copies(spark, sf_dir), metadata(spark, sf_dir))
    return found.select("image_id", "rows_seen", "duplicate_rows", "missing_rows", "bad_length", "failed_rows", "used_rows", "complete", "warnings")


@query(
    "u4_missing_rows",
    COPIES + """
SELECT image_id, array_to_string([r FOR r IN range(1, n_rows + 1) IF NOT list_contains(coalesce(rows, []), r)], ',') AS missing
FROM metadata LEFT JOIN (SELECT image_id, list(DISTINCT row_index) AS rows FROM copies GROUP BY image_id) USING (image_id)""",
)
def u4_missing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.missing_rows(copies(spark, sf_dir), metadata(spark, sf_dir))
    return found.select("image_id", F.array_join(F.col("missing").cast("array<string>"), ",").alias("missing"))


@query(
    "b10_assemble",
    COPIES + """
SELECT m.image_id, r.row_index::INT AS row_index, CASE WHEN len(pixels) = 64 AND rank > 1 THEN list_sum(pixels) ELSE 0 END::BIGINT AS total
FROM metadata m CROSS JOIN unnest(range(1, 64)) AS r(row_index) LEFT JOIN best b ON b.image_id = m.image_id AND b.row_index = r.row_index""",
)
def b10_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = ops.assemble(copies(spark, sf_dir), metadata(spark, sf_dir))
    return whole.select("image_id", "row_index", F.aggregate("pixels", F.lit(0).cast("long"), lambda a, v: a + v).alias("total"))


@query("a10_chunk_coverage", COPIES + " SELECT image_id, min(row_index) AS first, max(row_index) AS last, count(DISTINCT row_index) AS chunks, max(row_index) - min(row_index) + 1 - count(DISTINCT row_index) AS gaps, max(row_index) + 1 - count(DISTINCT row_index) AS missing FROM copies GROUP BY image_id")
def a10_chunk_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.chunk_coverage(copies(spark, sf_dir).withColumn("sequence", F.col("row_index")))


def frames(spark: SparkSession) -> DataFrame:
    """Calibration frames by rule: dark y, flat 1 or 2 by column, every 97th pixel bad."""
    numbers = F.sequence(F.lit(0), F.lit(SIDE - 1))
    y = F.col("id").cast("int")
    return spark.range(SIDE).select(
        y.alias("y"),
        F.transform(numbers, lambda x: y).alias("dark"),
        F.transform(numbers, lambda x: 1 + x % 2).alias("flat"),
        F.transform(numbers, lambda x: F.when((y * SIDE + x) % 97 == 5, 1).otherwise(0)).alias("bad"),
    )


@query("i1_calibrate", IMAGES + " SELECT image_id, y, x, CASE WHEN (y * 64 + x) % 97 <> 5 THEN (v - y) / (1 + x % 2) END AS v FROM cells")
def i1_calibrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(ops.calibrate(images(spark, sf_dir), frames(spark)))


OUTLIERS_SQL = """
near AS (
    SELECT a.image_id, a.y, a.x, a.v, quantile_disc(b.v, 0.5) AS middle
    FROM cells a JOIN (SELECT image_id, max(y) AS h FROM images GROUP BY image_id) USING (image_id)
    CROSS JOIN unnest([-1, 0, 1]) AS dy(dy) CROSS JOIN unnest([-1, 0, 1]) AS dx(dx)
    JOIN cells b ON b.image_id = a.image_id AND b.y = least(greatest(a.y + dy, 0), h) AND b.x = least(greatest(a.x + dx, 0), 63)
    GROUP BY a.image_id, a.y, a.x, a.v),
outliers AS (SELECT * FROM near WHERE abs((v - middle) / (middle + 1e-12)) > 3)"""


@query("i2_outliers", f"{IMAGES}, {OUTLIERS_SQL} SELECT image_id, y, x, v AS value, middle FROM outliers")
def i2_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.find_outliers(images(spark, sf_dir), 3.0)


@query(
    "i3_repair_ledger",
    f"""{IMAGES}, {OUTLIERS_SQL},
ranked AS (
    SELECT o.image_id, o.y, o.x, o.v, sqrt((c.y - o.y) * (c.y - o.y) + (c.x - o.x) * (c.x - o.x)) AS d, c.v AS nv,
           row_number() OVER (PARTITION BY o.image_id, o.y, o.x ORDER BY (c.y - o.y) * (c.y - o.y) + (c.x - o.x) * (c.x - o.x), c.y, c.x) AS rank
    FROM outliers o JOIN cells c ON c.image_id = o.image_id AND abs(c.y - o.y) <= 12 AND abs(c.x - o.x) <= 12
    WHERE NOT EXISTS (SELECT 1 FROM outliers b WHERE b.image_id = c.image_id AND b.y = c.y AND b.x = c.x))
SELECT image_id, y, x, v AS old_value, round(sum(nv / (d + 1e-12)) / sum(1 / (d + 1e-12)), 6) AS new_value FROM ranked WHERE rank <= 4 GROUP BY image_id, y, x, v""",
)
def i3_repair_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = images(spark, sf_dir)
    return ops.repair_outliers(source, ops.find_outliers(source, 3.0)).withColumn("new_value", F.round("new_value", 6))


@query("i4_rotate", IMAGES + " SELECT image_id, 63 - x AS y, y AS x, v FROM cells")
def i4_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rotate(cells(images(spark, sf_dir)), 1, SIDE, SIDE)


@query("i5_exposure", IMAGES + " SELECT image_id, y, x, v / CASE WHEN y < 20 THEN 0.5 ELSE 4.0 END::DOUBLE AS v FROM cells")
def i5_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.col("id").cast("int")
    mask = spark.range(SIDE).select(y.alias("y"), F.array_repeat(y < 20, SIDE).alias("inner"))
    return cells(ops.normalise_exposure(images(spark, sf_dir), 0.5, 4.0, mask))


@query(
    "i6_rebin",
    IMAGES + """,
grid AS (SELECT image_id, ny, nx, least(ny * 63 / 31, 63) AS fy, least(nx * 63 / 31, 63) AS fx FROM (SELECT image_id FROM images GROUP BY image_id HAVING count(*) = 64), unnest(range(32)) AS a(ny), unnest(range(32)) AS b(nx)),
corners AS (SELECT *, floor(fy + 1e-9)::INT AS y0, floor(fx + 1e-9)::INT AS x0 FROM grid)
SELECT g.image_id, ny::INT AS y, nx::INT AS x, round(sum(c.v * CASE WHEN dy = 0 THEN 1 - greatest(fy - y0, 0) ELSE greatest(fy - y0, 0) END * CASE WHEN dx = 0 THEN 1 - greatest(fx - x0, 0) ELSE greatest(fx - x0, 0) END), 6) AS v
FROM corners g, unnest([0, 1]) AS p(dy), unnest([0, 1]) AS q(dx), cells c
WHERE c.image_id = g.image_id AND c.y = least(y0 + dy, 63) AND c.x = least(x0 + dx, 63) GROUP BY g.image_id, ny, nx""",
)
def i6_rebin(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = images(spark, sf_dir)
    full = source.groupBy("image_id").count().filter(F.col("count") == SIDE)  # the last image of a table may lack rows
    whole = source.join(full, "image_id", "left_semi")
    return cells(ops.rebin(whole, SIDE, SIDE, 32, 32)).withColumn("v", F.round("v", 6))


@query("i8_preview", IMAGES + " SELECT image_id, 63 - x AS y, y AS x, round((v - min(v) OVER i) / (max(v) OVER i - min(v) OVER i), 9) AS v FROM cells WINDOW i AS (PARTITION BY image_id)")
def i8_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.preview(images(spark, sf_dir), SIDE, SIDE).withColumn("v", F.round("v", 9))


@query("a15_histogram", IMAGES + " SELECT image_id, (v // 32)::BIGINT AS bin, count(*) AS pixels FROM cells GROUP BY ALL")
def a15_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.histogram(images(spark, sf_dir))


@query("a16_psf_merge", IMAGES + " SELECT y, x, round(sum((image_id + 1) * v) / (SELECT sum(image_id + 1) + 500 FROM (SELECT DISTINCT image_id FROM images)), 6) AS v FROM cells GROUP BY y, x")
def a16_psf_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    planes = images(spark, sf_dir).withColumnRenamed("image_id", "bin")
    weights = planes.select("bin", (F.col("bin") + 1).alias("weight")).distinct().union(spark.range(1).select(F.lit(-9).cast("long"), F.lit(500).cast("long")))
    return ops.merge_planes(planes, weights).withColumn("v", F.round("v", 6))


@query("a21_section_mean", IMAGES + " SELECT image_id // 4 AS image_id, y, x, round(avg(v), 6) AS v FROM cells GROUP BY ALL")
def a21_section_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = images(spark, sf_dir).select(F.expr("image_id div 4").alias("image_id"), (F.col("image_id") % 4).alias("section"), "y", "pixels")
    return ops.section_mean(stack).withColumn("v", F.round("v", 6))


@query(
    "f23_processing_mode",
    "SELECT event_id, c & 3 = 3 AS compressed, CASE c & 3 WHEN 0 THEN 16 WHEN 1 THEN 8 WHEN 2 THEN 12 END AS bit_depth, (c >> 4) & 3 AS threshold, (c >> 6) & 3 AS position FROM (SELECT event_id, event_id % 256 AS c FROM events)",
)
def f23_processing_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", ops.processing_mode(F.col("event_id") % 256).alias("m")).select("event_id", "m.*")


@query(
    "f28_dimensions",
    """
SELECT event_id, 2000 // rb AS n_rows, 1504 // cb AS n_cols, 2000 % rb <> 0 OR 1504 % cb <> 0 AS uneven
FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_id % 256 + 1 WHEN 1 THEN event_id % 5 + 1 ELSE 1 END AS rb,
             CASE event_id % 3 WHEN 0 THEN event_id // 256 % 256 + 1 WHEN 1 THEN event_id % 7 + 1 ELSE 1 END AS cb FROM events)""",
)
def f28_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, n = F.col("event_id") % 3, F.col("event_id")
    size = ops.dimensions(F.lit(2000), F.lit(1504), F.when(at == 0, n % 65536), F.when(at == 1, n % 5), F.when(at == 1, n % 7))
    return table(spark, sf_dir, "events").select("event_id", size.alias("s")).select("event_id", "s.*")


CAPTURES_SQL = """
captures AS (
    SELECT event_id // 13 AS image_id, event_id AS arrival, CASE WHEN event_id // 13 % 3 > 0 THEN (event_id % 13 < 9)::INT END AS sensor,
           CASE WHEN event_id % 13 < 9 THEN 35 ELSE 15000 END AS ms, CASE WHEN event_id % 13 < 9 THEN 3 ELSE 2 END AS shift, user_id % 40 = 0 AS filtered, event_id * 5 AS start
    FROM events)"""


@query(
    "a6_capture_summary",
    f"""WITH {CAPTURES_SQL.strip()},
sums AS (SELECT image_id, count(*) AS captures, count(*) FILTER (ms = 35) AS n_in, count(*) FILTER (ms = 15000) AS n_out, coalesce(bool_or(filtered) FILTER (ms = 35), false) AS f_in,
                coalesce(bool_or(filtered) FILTER (ms = 15000), false) AS f_out, round(max(start) - min(start) + arg_max(ms, start) / 1000, 6) AS elapsed, bool_or(sensor IS NOT NULL) OR min(ms) < max(ms) AS known FROM captures GROUP BY image_id)
SELECT image_id, captures, CASE WHEN known THEN n_in ELSE 0 END AS stacked_inner, CASE WHEN known THEN n_out ELSE 0 END AS stacked_outer,
       round(CASE WHEN known AND n_in > 0 THEN (n_in - f_in::INT) * 0.035 / 8 END, 9) AS exposure_inner, round(CASE WHEN known AND n_out > 0 THEN (n_out - f_out::INT) * 15.0 / 4 END, 9) AS exposure_outer, elapsed
FROM sums""",
)
def a6_capture_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    short = n % 13 < 9
    image = F.expr("event_id div 13")
    captures = table(spark, sf_dir, "events").select(
        image.alias("image_id"),
        n.alias("arrival"),
        F.when(image % 3 > 0, short.cast("int")).alias("sensor"),
        F.when(short, 35).otherwise(15000).alias("integration_ms"),
        F.when(short, 3).otherwise(2).alias("right_shift"),
        (F.col("user_id") % 40 == 0).alias("filtered"),
        (n * 5).alias("start"),
    )
    found = ops.capture_summary(captures)
    exposures = [F.round(f"exposure_{s}", 9).alias(f"exposure_{s}") for s in ("inner", "outer")]
    return found.select("image_id", "captures", "stacked_inner", "stacked_outer", *exposures, F.round("elapsed", 6).alias("elapsed"))
