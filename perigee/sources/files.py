"""Files as tables: listings of captures, dictionaries in file order, decoded tables as CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perigee.operators.ordering import number_rows, running_sums
from perigee.sources.scratch import small

#: A record of a CSV file, and a cell with the comma before it; quoted parts may hold line breaks and commas.
RECORD = r'(?:[^"\r\n]++|"(?:[^"]|"")*+")++'
CELL = r',("(?:[^"]|"")*+"|[^,]*+)'

# How captures and decoded tables are named.
CAPTURE_TIME = r"ccsds_(\d{4})_(\d{3})_(\d{2})_(\d{2})_(\d{2})"
DECODED_NAME = r"decoded_apid_(\d+)_([^/]+)\.csv(?:/|$)"


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """path, length and modified of the files in a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def base_name(path: Column) -> Column:
    """The last part of a path."""
    return F.regexp_extract(path, r"([^/]+)/?$", 1)


def prefixed_captures(listing: DataFrame, prefix: str, own: list[str]) -> DataFrame:
    """The captures of a folder whose name begins with prefix, without the pipeline's own outputs."""
    name = base_name(F.col("path"))
    return listing.withColumn("name", name).filter(F.col("name").startswith(prefix) & ~F.col("name").isin(own))


def capture_order(listing: DataFrame) -> DataFrame:
    """listing with sort_key, in whose order captures stand: by the time in their name, those without one last by name."""
    name = base_name(F.col("path"))
    time = [F.regexp_extract(name, CAPTURE_TIME, i).try_cast("int") for i in range(1, 6)]
    return listing.withColumn("sort_key", F.struct(time[0].isNull().alias("untimed"), F.array(*time).alias("time"), name.alias("name")))


def input_modes(listing: DataFrame, folder_col: str, kind_col: str, requested: str = "auto") -> DataFrame:
    """Per folder the kind of captures to read, or why there is none: both kinds in auto mode, or nothing there."""
    kinds = F.array_sort(F.collect_set(kind_col))  # two kinds at most
    found = listing.groupBy(folder_col).agg(kinds.alias("kinds"))
    if requested == "auto":
        mode, error = F.when(F.size("kinds") == 1, F.get("kinds", F.lit(0))), F.when(F.size("kinds") == 0, "none").when(F.size("kinds") > 1, "ambiguous")
    else:
        there = F.array_contains("kinds", requested)
        mode, error = F.when(there, F.lit(requested)), F.when(~there, "none")
    return found.select(folder_col, mode.alias("mode"), error.alias("error"))


def products_current(files: DataFrame, by: str) -> DataFrame:
    """Per product whether its outputs are current: the oldest is not older than the newest input, and there are both."""
    oldest, newest = F.min(F.when(~F.col("is_input"), F.col("modified"))), F.max(F.when(F.col("is_input"), F.col("modified")))
    return files.groupBy(by).agg(F.coalesce(oldest >= newest, F.lit(False)).alias("current"))


def ordered_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns (texts) of CSV files with a header, with file and ordinal: the place of a record in its file.

    Files of any size are read in blocks, in parallel, and may have different columns in any number. Line breaks and
    commas inside quotes belong to a cell, two quotes there are one; only lines of records that go over several lines are
    brought together. A column that a file doesn't have is null, and so is an empty cell.
    """
    place = ["file", "block", "line"]
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), F.regexp_replace("value", "^\uFEFF", "").alias("value")
    )
    lines = running_sums(lines.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))), place, "quotes", "before")
    first = lines.groupBy("file").agg(F.min("before").alias("first"))  # one row a file
    lines = lines.join(small(first), "file").withColumn("begins", (F.col("before") - F.col("first")) % 2 == 0)
    alone = F.col("begins") & (F.col("quotes") % 2 == 0)
    parts = running_sums(lines.filter(~alone).withColumn("opens", F.col("begins").cast("int")), place, "opens", "earlier")
    parts = parts.groupBy("file", (F.col("earlier") + F.col("opens")).alias("record")).agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("p"))  # of one record
    whole = parts.select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["line"].alias("line"), F.array_join("p.value", "\n").alias("value"))
    whole = whole.unionByName(lines.filter(alone).select(*place, "value"))
    found = F.filter(F.regexp_extract_all("value", F.lit(RECORD), 0), lambda x: F.trim(x) != "")
    records = number_rows(whole.select(*place, F.posexplode(found).alias("part", "record")), [*place, "part"], "number")
    heads = records.join(small(records.groupBy("file").agg(F.min("number").alias("head"))), "file")
    names = heads.filter("number = head").select("file", cells_of(F.col("record")).alias("_names"))
    rows = heads.filter("number > head").select("file", (F.col("number") - F.col("head")).cast("int").alias("ordinal"), cells_of(F.col("record")).alias("_cells"))
    rows = rows.join(small(names), "file")
    at = lambda c: F.array_position("_names", c).cast("int")
    value = lambda c: F.when(at(c) > 0, F.get("_cells", at(c) - 1))
    return rows.select("file", "ordinal", *[F.when(value(c) != "", value(c)).alias(c) for c in columns])


def cells_of(record: Column) -> Column:
    """The cells of one CSV record as texts."""
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(CELL), 1)
    return F.transform(found, lambda x: F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))


def packet_names(rows: DataFrame) -> DataFrame:
    """apid and packet_name of dictionary rows (file, ordinal, APID, Name); the first definition of an APID wins.

    Rows whose APID is no whole number are left out.
    """
    known = rows.withColumn("apid", F.trim("APID").try_cast("int")).filter("apid is not null")
    return known.groupBy("apid").agg(F.min_by(F.trim("Name"), F.struct("file", "ordinal")).alias("packet_name"))


def decoded_tables(spark: SparkSession, folder: str) -> dict[int, tuple[str, DataFrame]]:
    """The decoded tables below a folder by APID, with their names and columns as the CSV files have them.

    Files are read wherever they lie; a path with another name is an error. The driver holds one path for each APID.
    """
    files = list_files(spark, folder, "*.csv", recursive=True).select("path")
    parts = files.select(F.regexp_extract("path", DECODED_NAME, 1).try_cast("int").alias("apid"), F.regexp_extract("path", DECODED_NAME, 2).alias("name"), "path")
    parts = parts.withColumn("table", F.regexp_extract("path", r"^(.*?decoded_apid_\d+_[^/]+\.csv)", 1)).drop("path").distinct()
    found = parts.collect()  # one row for each decoded table
    if any(r["apid"] is None for r in found):
        raise ValueError("a decoded table must be named decoded_apid_<number>_<name>.csv")
    out = {}
    for apid in sorted({r["apid"] for r in found}):
        own = sorted({r["table"] for r in found if r["apid"] == apid})
        name = next(r["name"] for r in found if r["apid"] == apid)
        out[apid] = (name, spark.read.option("header", True).option("inferSchema", True).option("recursiveFileLookup", True).csv(own))
    return out


def column_order(cells: DataFrame, preferred: list[str]) -> DataFrame:
    """apid, field and position (from 0) of the columns of each APID's table, of rows (apid, packet_index, ordinal, field).

    Preferred fields come first in their order, then the others as they are first seen.
    """
    first = cells.groupBy("apid", "field").agg(F.min(F.struct("packet_index", "ordinal")).alias("first"))
    rank = F.array_position(F.array(*map(F.lit, preferred)), F.col("field"))
    rank = F.when(rank > 0, rank).otherwise(len(preferred) + 1)
    place = F.row_number().over(Window.partitionBy("apid").orderBy(rank, "first", "field")) - 1
    return first.select("apid", "field", place.alias("position"))


def write_decoded(rows: DataFrame, folder: str) -> None:
    """Write rows (with packet_name and apid) as one decoded table for each APID, in place of all that was there."""
    name = F.concat(F.lit("decoded_apid_"), F.col("apid"), F.lit("_"), F.col("packet_name"), F.lit(".csv"))
    rows.withColumn("table", name).drop("apid", "packet_name").write.mode("overwrite").option("header", True).partitionBy("table").csv(folder)


def register_views(spark: SparkSession, tables: dict[int, tuple[str, DataFrame]]) -> list[str]:
    """A temporary view apid_<number> for each table, for SQL over them; returns their names."""
    for apid, (_, rows) in tables.items():
        rows.createOrReplaceTempView(f"apid_{apid}")
    return [f"apid_{apid}" for apid in tables]
