"""Exact nearest binary codes by incremental multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import Tables

#: Codes are cut into segments of 16 bits, of which the upper 8 name a cell and the lower 8 a place in it.
SEGMENT_BITS, CELL_BITS = 16, 8
IN_WORD = 64 // SEGMENT_BITS

FOUND = "query long, query_id long, row long, vec_id long, distance int"


def masks() -> list[np.ndarray]:
    """For each radius, the masks that flip as many of the 8 lower bits of a segment."""
    return [np.array([sum(1 << b for b in bits) for bits in combinations(range(CELL_BITS), radius)], np.int64) for radius in range(CELL_BITS + 1)]


def codes(df: DataFrame, id_col: str, vector_col: str, words: int) -> DataFrame:
    """id and code of every vector: a bit for each number, set where it is above 0, in words of 64 bits.

    Null numbers and those that are missing have no bit set. Rows with a null id or vector have no code.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def word(number: Column) -> Column:
        bits = F.transform(
            F.slice(vector_col, number * 64 + 1, F.lit(64)),
            lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", one, i)).otherwise(none),
        )
        return F.aggregate(bits, none, lambda a, b: a.bitwiseOR(b))

    code = F.when(F.col(vector_col).isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(words - 1)), word))
    return df.select(F.col(id_col).cast("long").alias("id"), code.alias("code")).dropna()


def by_segment(coded: DataFrame, segments: int) -> DataFrame:
    """The rows once for each segment, with its cell."""
    cell = F.expr(f"shiftrightunsigned(code[segment div {IN_WORD}], {SEGMENT_BITS} * (segment % {IN_WORD}) + {SEGMENT_BITS - CELL_BITS}) & 255")
    return coded.withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(segments - 1)))).withColumn("cell", cell.cast("int"))


def searched(least: int, most: int, words: int, k: int):
    """A function over rows in order of (segment, cell, part, asks) that finds codes by one segment.

    The rows of a cell's part come first and are held (a bounded number), the queries follow and stream by. A query
    meets the codes whose segment differs from its own in least to most bits, of which the cell tells the upper ones,
    and returns those that may be among its k nearest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips, at, parts = masks(), None, []
        index: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {c: batch[c].to_numpy(zero_copy_only=False) for c in ("segment", "cell", "part", "asks", "row", "id", "bound")}
            code = batch["code"].flatten().to_numpy().reshape(-1, words).view(np.uint64)
            place = np.stack([column[c] for c in ("segment", "cell", "part", "asks")])
            cuts = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for start, stop in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows], strict=True):
                here = tuple(place[:3, start])
                if here != at:
                    at, parts, index = here, [], None
                if not place[3, start]:
                    parts.append((code[start:stop], column["row"][start:stop], column["id"][start:stop]))
                    continue
                shift = np.uint64(SEGMENT_BITS * (at[0] % IN_WORD))
                word = at[0] // IN_WORD
                if index is None:
                    held, rows, ids = (np.concatenate([p[i] for p in parts]) for i in range(3)) if parts else (code[:0], column["row"][:0], column["id"][:0])
                    low = ((held[:, word] >> shift) & np.uint64(255)).astype(np.int64)
                    order = np.argsort(low, kind="stable")
                    index = held[order], rows[order], ids[order], np.searchsorted(low[order], np.arange(257))
                held, rows, ids, offsets = index
                for i in range(start, stop):
                    value = int((code[i, word] >> shift) & np.uint64(0xFFFF))
                    upper = ((value >> 8) ^ at[1]).bit_count()
                    found = [np.arange(offsets[v], offsets[v + 1]) for r in range(max(0, least - upper), min(CELL_BITS, most - upper) + 1) for v in (value & 255) ^ flips[r]]
                    if not found:
                        continue
                    found = np.concatenate(found)
                    distance = np.bitwise_count(held[found] ^ code[i]).sum(axis=1).astype(np.int32)
                    near = distance <= column["bound"][i]
                    found, distance = found[near], distance[near]
                    best = np.lexsort((rows[found], ids[found], distance))[:k]
                    n = len(best)
                    for held_out, values in zip(out, (np.full(n, column["row"][i]), np.full(n, column["id"][i]), rows[found][best], ids[found][best], distance[best]), strict=True):
                        held_out.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["query", "query_id", "row", "vec_id", "distance"])

    return run


def nearest_codes(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    query_every: int = 20,
    block_rows: int = 65_536,
    first_radius: int = 2,
) -> DataFrame:
    """For every row whose id is divisible by query_every, the k rows of least Hamming distance among all rows.

    A code has a bit for each number of its vector. Rows are held by each of their segments of 16 bits, in cells by the
    upper 8 bits, and cells of over block_rows rows in parts; of equal codes the k rows of the smallest ids are enough.
    A query is sent to the cells that a radius reaches, first with all radii up to first_radius, then with one more in
    each round. A code that none of the segments has shown within radius r is at least segments * (r + 1) away, so a
    query is done when its k-th verified distance is below that; only the others go on. The last radius covers all.

    Ties go to the smaller id; a query finds itself. Rows with a null id or vector are left out; rows that occur
    several times are found as often. Vectors may have any length, and shorter ones have zeros at their end. If there
    are fewer than k rows, all are returned. An empty table gives an empty result. Other columns of df are not looked at.

    Returns query_id, rank (from 1), vec_id, distance.
    """
    tables = Tables(df.sparkSession)
    words = max(1, -(-(df.agg(F.max(F.size(vector_col))).first()[0] or 0) // 64))
    segments = words * IN_WORD
    coded = tables.write(codes(df, id_col, vector_col, words).withColumn("row", F.monotonically_increasing_id()), "hamming-codes")
    of_code = Window.partitionBy("code").orderBy("id", "row")
    kept = tables.write(coded.withColumn("nth", F.row_number().over(of_code)).filter(F.col("nth") <= k).drop("nth"), "hamming-kept")
    enough = min(k, kept.count())
    index = tables.write(by_segment(kept, segments), "hamming-index")
    cells = index.groupBy("segment", "cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    cells = F.broadcast(tables.write(cells, "hamming-cells"))  # 256 rows for each segment at most
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    held = index.join(cells, ["segment", "cell"]).select("segment", "cell", part.alias("part"), F.lit(0).alias("asks"), "row", "id", "code", F.lit(0).alias("bound"))
    asked = coded.filter(F.col("id") % query_every == 0).groupBy("id", "code").agg(F.min("row").alias("row"))
    waiting = tables.write(asked.withColumn("bound", F.lit(64 * words)), "hamming-asked")
    found: DataFrame | None = None
    least, most = 0, min(first_radius, SEGMENT_BITS)
    while True:
        near = F.filter(F.sequence(F.lit(0), F.lit(255)), lambda c: F.bit_count(c.bitwiseXOR(F.col("cell"))) <= most)
        sent = by_segment(waiting, segments).withColumn("cell", F.explode(near)).join(cells, ["segment", "cell"])
        sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        sent = sent.select("segment", "cell", "part", F.lit(1).alias("asks"), "row", "id", "code", "bound")
        rows = held.unionByName(sent).repartition("segment", "cell", "part").sortWithinPartitions("segment", "cell", "part", "asks")
        new = rows.mapInArrow(searched(least, most, words, k), FOUND)
        every = new.distinct() if found is None else found.unionByName(new).distinct()
        best = Window.partitionBy("query").orderBy("distance", "vec_id", "row")
        found = tables.write(every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank"), "hamming-found")
        if most == SEGMENT_BITS:
            break
        last = found.groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("last"))
        done = (F.col("n") >= enough) & (F.col("last") < segments * (most + 1))
        bound = F.when(F.col("n") >= k, F.col("last")).otherwise(F.col("bound"))
        waiting = waiting.join(last, F.col("row") == F.col("query"), "left").filter(~F.coalesce(done, F.lit(False)))
        waiting = tables.write(waiting.select("id", "code", "row", bound.alias("bound")), "hamming-asked")
        if not waiting.limit(1).count():
            break
        least = most = most + 1
    tables.drop(found)
    order = Window.partitionBy("query").orderBy("distance", "vec_id", "row")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "distance")
