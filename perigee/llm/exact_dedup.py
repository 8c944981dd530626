"""Exact duplicates through an extendible-hash index on shared files."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm import common
from perigee.llm.common import Tables, arrow_rows, begin_task, marked, materialize, small_or_shuffled, text_key, without

#: Hash bits of one level of the directory. A level has at most 2 ** MAX_DEPTH cells under each cell of the one above.
MAX_DEPTH = 14

#: Owner tasks take ranges of keys by their first bits.
RANGE_BITS = 12

CLASSES = "bucket long, key long, sha binary, keep_id long, group_size long"


def grow_directory(cells: dict[int, int], capacity: int) -> list[tuple[int, int, int]]:
    """Split buckets of over `capacity` keys until there is none, or until the directory is full.

    cells: number of keys by the first MAX_DEPTH bits of their hash. It starts with one bucket. A bucket splits by
    its next hash bit; if it is as deep as the directory, the directory doubles. Returns (cell, bucket, local
    depth) for every cell of MAX_DEPTH bits; a bucket is named by its first cell.
    """
    sums = [0]
    for cell in range(1 << MAX_DEPTH):
        sums.append(sums[-1] + cells.get(cell, 0))
    directory = [(0, 0)]  # (prefix, local depth) of the bucket that each cell of the directory points to
    depth = 0
    while True:
        over = {
            (prefix, local)
            for prefix, local in directory
            if local < MAX_DEPTH
            and sums[(prefix + 1) << (MAX_DEPTH - local)] - sums[prefix << (MAX_DEPTH - local)] > capacity
        }
        if not over:
            break
        if any(local == depth for _, local in over):
            directory = [bucket for bucket in directory for _ in range(2)]
            depth += 1
        directory = [
            ((at >> (depth - local - 1)), local + 1) if (prefix, local) in over else (prefix, local)
            for at, (prefix, local) in enumerate(directory)
        ]
    spread = MAX_DEPTH - depth
    return [
        (cell, prefix << (MAX_DEPTH - local), local)
        for at, (prefix, local) in enumerate(directory)
        for cell in range(at << spread, (at + 1) << spread)
    ]


def buckets(keys: DataFrame, capacity: int, tables: Tables) -> DataFrame:
    """key, bucket (the first key of its range) and depth of every key, for buckets of at most `capacity` keys.

    Each level counts the keys of its cells, and one task for each cell of the level above grows a directory over at
    most 2 ** MAX_DEPTH counts. Cells of the last bits of a level that are still overfull go on to the next level, so
    the directory gets as deep as the keys ask for. It lies in the shared folder and is joined; nothing of it comes
    to the driver.
    """
    placed: list[DataFrame] = []
    left = keys.select("key", F.lit(0).cast("long").alias("parent"))
    for level in range(-(-64 // MAX_DEPTH)):
        spare = 64 - MAX_DEPTH * (level + 1)  # bits of a key behind this level's
        moved = F.shiftrightunsigned("key", spare) if spare >= 0 else F.call_function("shiftleft", F.col("key"), F.lit(-spare))
        left = left.withColumn("cell", moved.bitwiseAND(F.lit((1 << MAX_DEPTH) - 1)).cast("int"))

        def split(group: pa.Table) -> pa.Table:
            counts = dict(zip(group["cell"].to_pylist(), group["count"].to_pylist(), strict=True))
            parent = group["parent"][0].as_py()
            found = [x for x in grow_directory(counts, capacity) if x[0] in counts]
            over = [depth == MAX_DEPTH and counts[cell] > capacity for cell, _, depth in found]
            columns = [[parent] * len(found), *[[x[i] for x in found] for i in range(3)], over]
            return pa.table(dict(zip(("parent", "cell", "bucket", "depth", "over"), columns, strict=True)), DIRECTORY)

        counted = left.groupBy("parent", "cell").count()
        directory = counted.groupBy("parent").applyInArrow(split, "parent long, cell int, bucket int, depth int, over boolean")
        directory = tables.write(directory, "dedup-directory")
        at = left.join(small_or_shuffled(directory, directory.count(), 48), ["parent", "cell"])
        shifted = lambda name, n: F.call_function("shiftleft", F.col(name).cast("long"), F.lit(n))
        if spare >= 0:
            start = shifted("parent", MAX_DEPTH + spare).bitwiseOR(shifted("bucket", spare))
        else:
            start = shifted("parent", MAX_DEPTH + spare).bitwiseOR(F.shiftright("bucket", -spare).cast("long"))
        at = tables.write(at.select("key", "parent", "cell", "over", start.alias("bucket"), (F.col("depth") + level * MAX_DEPTH).alias("depth")), "dedup-placed")
        if not at.filter("over").limit(1).count() or spare <= 0:
            return union([*placed, at.select("key", "bucket", "depth")])
        placed.append(at.filter("not over").select("key", "bucket", "depth"))
        left = at.filter("over").select("key", shifted("parent", MAX_DEPTH).bitwiseOR(F.col("cell").cast("long")).alias("parent"))
    raise AssertionError("64 bits tell all keys apart")


def union(tables: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, tables)


DIRECTORY = pa.schema([("parent", pa.int64()), ("cell", pa.int32()), ("bucket", pa.int32()), ("depth", pa.int32()), ("over", pa.bool_())])


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold the equal texts of a batch into one row, before anything is shuffled."""
    begin_task("dedup")
    for batch in batches:
        groups = pa.Table.from_batches([batch]).group_by(["key", "text"])
        folded = groups.aggregate([("doc_id", "max"), ([], "count_all")])
        folded = folded.rename_columns({"doc_id_max": "doc_id", "count_all": "rows"})
        yield from folded.select(["key", "text", "doc_id", "rows"]).to_batches()


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An owner's task: rows in order of key; texts of one key are chained and compared byte by byte.

    Holds the distinct texts of one key only.
    """
    begin_task("dedup")
    bucket, key, links = None, None, []  # of the key: [text, largest id, rows]

    def classes() -> pa.RecordBatch:
        found = [x for x in links if x[2] > 1]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([bucket] * len(found), pa.int64()),
                pa.array([key] * len(found), pa.int64()),
                pa.array([hashlib.sha256(x[0]).digest() for x in found], pa.binary()),
                pa.array([x[1] for x in found], pa.int64()),
                pa.array([x[2] for x in found], pa.int64()),
            ],
            ["bucket", "key", "sha", "keep_id", "group_size"],
        )

    for batch in batches:
        for own, k, text, doc_id, rows in zip(*(batch[c].to_pylist() for c in ("bucket", "key", "text", "doc_id", "rows")), strict=True):
            if k != key:
                if links:
                    yield classes()
                bucket, key, links = own, k, []
            for link in links:
                if link[0] == text:
                    link[1] = max((x for x in (link[1], doc_id) if x is not None), default=None)
                    link[2] += rows
                    break
            else:
                links.append([text, doc_id, rows])
    if links:
        yield classes()


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 512) -> DataFrame:
    """Groups of rows with identical texts; of each, the row with the largest id stays.

    1. The texts are read once for narrow entries (id, 64-bit key, SHA-256) in the shared folder.
    2. Keys that occur more than once are dealt to buckets by a directory that doubles while a bucket holds over
       `capacity` keys (see buckets).
    3. The texts of those keys alone are read again (told by the keys, or by a bitmap of fixed size if these are many),
       folded with their equals inside each batch, so that a group of any size sends one row a batch, and sent to the
       owner of their range of keys, which chains the texts of a key and compares bytes. The classes are the index,
       written in the shared folder in order of bucket.
    4. The entries join the classes found.

    Null texts count as empty, and all empty texts are one group. Null ids are smaller than any other. If the row
    that stays occurs several times, one of the occurrences stays. An empty table gives an empty result. Other
    columns of df are not looked at.

    Returns doc_id, keep_id, group_size, kept, text_sha256, text_key (a hash of the text) for every row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = text_key(text_col)
    tables = Tables(df.sparkSession)
    entries = tables.write(
        df.select(
            F.col(id_col).cast("long").alias("doc_id"),
            key.alias("key"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "dedup-entries",
    )
    again = tables.write(entries.groupBy("key").count().filter("count > 1").select("key"), "dedup-keys")
    keys = again.count()
    owned = buckets(again, capacity, tables)
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"), text.cast("binary").alias("text"))
    if keys * 32 <= common.BROADCAST_BYTES:
        texts = texts.join(F.broadcast(again), "key", "left_semi")
    else:
        texts = marked(texts, F.col("key"), again).filter("_maybe")
    found = (
        texts.select("doc_id", "key", "text")
        .mapInArrow(combine, "key long, text binary, doc_id long, rows long")
        .join(small_or_shuffled(owned, keys, 40), "key")
        .withColumn("range", F.shiftrightunsigned("bucket", 64 - RANGE_BITS))
        .select("range", "bucket", "key", "text", "doc_id", "rows")
        .repartition("range")
        .sortWithinPartitions("range", "bucket", "key")
        .mapInArrow(chain, CLASSES)
    )
    with arrow_rows(df.sparkSession, 512):  # whole texts
        found = tables.write(found, "dedup-index")
    groups = found.count()
    first = (
        entries.join(small_or_shuffled(found, groups, 80), ["key", "sha"])
        .filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("key", "sha", "keep_id", "group_size")
        .agg(F.min("tie").alias("keep_tie"))
    )
    first = tables.write(first, "dedup-first")
    tables.drop(entries, first)
    return entries.join(small_or_shuffled(first, groups, 96), ["key", "sha"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("keep_tie").isNull() | (F.col("keep_tie") == F.col("tie"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.col("key").alias("text_key"),
    )


def distinct_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 512) -> DataFrame:
    """df with the row of each group of identical texts that stays (see exact_duplicates).

    If a row that stays occurs several times with the same id and text, one of the occurrences is chosen by id and
    text alone, so extra columns of it come from any of them.
    """
    found = materialize(exact_duplicates(df, id_col, text_col, capacity), "dedup-found")
    rows = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("rows"), F.max("kept").alias("kept")).filter("kept")
    again = rows.filter("rows > 1").select(F.col("doc_id").alias("_again_id"), F.col("text_key").alias("_again_key"))
    kept = without(df, found.groupBy("doc_id", "text_key").agg(F.max("kept").alias("kept")).filter("not kept"), id_col, text_col)
    n = again.count()
    if not n:
        return kept
    same = kept[id_col].eqNullSafe(F.col("_again_id")) & (text_key(text_col) == F.col("_again_key"))
    held = small_or_shuffled(again, n, 32)
    return kept.join(held, same, "left_anti").union(kept.join(held, same, "left_semi").dropDuplicates([id_col, text_col]))
