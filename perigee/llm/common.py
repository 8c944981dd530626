"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.sources.scratch import delete_table, shared_folder

#: A table of at most this many bytes may be broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

#: A bitmap of keys has 2 ** BITMAP_BITS bits, 16 MB.
BITMAP_BITS = 27

WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table of this name in a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a batch of large rows for Python; a batch is held several times on its way.
ARROW_BYTES = "4m"

#: Tables are written in row groups of this many bytes, which a writing task holds.
ROW_GROUP_BYTES = 16 << 20

_FORGET: dict[str, Callable[[], None]] = {}


def _write(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back; this cuts the lineage."""
    return _write(df, name)[1]


class Tables:
    """Tables that one call of an operator writes in the shared folder."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held = spark, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """As materialize."""
        path, table = _write(df, name)
        self.held.append((path, table))
        return table

    def delete(self, *gone: DataFrame) -> None:
        """Delete tables that nothing reads any more, and the shuffle files of steps that are over.

        Spark deletes these when the driver's garbage is collected, which a driver with little to do puts off.
        """
        for path, table in self.held:
            if any(table is x for x in gone):
                delete_table(self.spark, path)
        self.held = [x for x in self.held if not any(x[1] is y for y in gone)]
        self.spark._jvm.System.gc()

    def drop(self, *but: DataFrame) -> None:
        """Delete the tables, but for those that are read later on."""
        for path, table in self.held:
            if not any(table is x for x in but):
                delete_table(self.spark, path)
        self.held = [x for x in self.held if any(x[1] is y for y in but)]


def remembers(name: str, forget: Callable[[], None]) -> None:
    """Say how a worker forgets what the operator of this name remembers between tasks."""
    _FORGET[name] = forget


def begin_task(name: str) -> None:
    """In a worker: give back the memory that other operators' tasks have left in it."""
    for other, forget in _FORGET.items():
        if other != name:
            forget()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, jobs hand at most this many rows and about ARROW_BYTES at a time to Python, for rows that are large."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def small_or_shuffled(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """df with a broadcast hint if its counted rows fit the bound, else unchanged for a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def marked(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """df with `_maybe`: whether key may be in keys (key long). No row that is in keys is missed.

    A bitmap of 2 ** BITMAP_BITS places, whatever the number of keys, is broadcast in rows of 2 ** 15 places.
    """
    at = F.pmod(F.col("key"), F.lit(1 << BITMAP_BITS))
    rows = keys.select(F.shiftright(at, 15).alias("_row"), F.pmod(at, F.lit(1 << 15)).alias("at"))
    rows = rows.groupBy("_row").agg(F.bitmap_construct_agg("at").alias("_bits"))
    held = df.withColumn("_at", F.pmod(key, F.lit(1 << BITMAP_BITS))).withColumn("_row", F.shiftright("_at", 15))
    bit = F.expr("shiftright(cast(conv(hex(substring(_bits, cast(_at % 32768 div 8 + 1 as int), 1)), 16, 10) as int), cast(_at % 8 as int)) & 1")
    joined = held.join(F.broadcast(rows), "_row", "left")
    return joined.withColumn("_maybe", F.coalesce(bit == 1, F.lit(False))).drop("_row", "_at", "_bits")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the decimal doc_id modulo the number of folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def text_key(text_col: str) -> Column:
    """A hash of a row's text, which tells rows of one id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def without(df: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """df less the rows whose id and text_key are in gone (doc_id, text_key). Null ids are equal to each other.

    If gone is too large to broadcast, only rows whose text_key may be among its own are shuffled.
    """
    gone = materialize(gone.select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")).distinct(), "gone")
    n = gone.count()
    same = df[id_col].eqNullSafe(F.col("_gone_id")) & (text_key(text_col) == F.col("_gone_key"))
    if n * 32 <= BROADCAST_BYTES:
        return df.join(F.broadcast(gone), same, "left_anti")
    seen = marked(df, text_key(text_col), gone.select(F.col("_gone_key").alias("key")))
    rest = seen.filter("_maybe").drop("_maybe")
    same = rest[id_col].eqNullSafe(F.col("_gone_id")) & (text_key(text_col) == F.col("_gone_key"))
    return seen.filter("not _maybe").drop("_maybe").unionByName(rest.join(gone, same, "left_anti"))
