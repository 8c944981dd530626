"""Near-duplicate groups by a Jaccard self-join on word shingles with rare-first prefixes.

The join is exact. Shingles stand as 64-bit hashes. Only links between different texts are looked for, and only as
many as components need: texts with equal sets are one node, and a list of texts that share a rare shingle is
compared with one of its members at a time, as long as the list still spans several components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import BROADCAST_BYTES, Tables, arrow_rows, begin_task, marked, materialize, remembers, small_or_shuffled, text_key, without
from perigee.llm.components import connected

#: Shingle frequencies are counted in 2 ** CELL_BITS cells, which SLICES rows carry.
CELL_BITS, SLICES = 22, 64

#: Parts of the hash range in which the suffix filter compares two sets.
PROBES = 64

#: Lists are compared with one pivot in as many rounds before all pairs across components are.
PIVOT_ROUNDS = 4

#: Nodes of a component, and shingles of them on average, that one task compares with as many others.
BLOCK_NODES, BLOCK_SHINGLES = 256, 1 << 20

#: Lists that a sample of one posting in SAMPLE_EVERY shows to have over HOT_NODES nodes, and over one posting in
#: HOT_PARTS of all (so there are at most as many), are dealt to several tasks.
SAMPLE_EVERY, HOT_NODES, HOT_PARTS = 64, 2048, 50_000

#: Rows with texts or sets that a worker gets at a time.
ARROW_ROWS = 512

#: A worker forgets the words it has met when it holds as many.
CACHE_WORDS = 200_000

#: Multipliers of the shingle hash, one for each word.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class Words(dict):
    """Hashes of words; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


WORDS = Words()
remembers("jaccard", WORDS.clear)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Hashes of all shingles of `width` words, in their order in the text; of fewer words, one of them all.

    bytes.lower() and bytes.split() know the letters A-Z and the six white-space bytes only, as the words ask.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(WORDS.__getitem__, words), np.uint64, n)
    width = min(n, width)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out ^= hashes[i : n - width + 1 + i]
        out *= MULTIPLIERS[i % len(MULTIPLIERS)]
        out ^= out >> np.uint64(29)
    return out


def cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def frequency_levels(texts: DataFrame, width: int) -> np.ndarray:
    """How frequent the shingles of each cell are over all texts, in eighths of a power of two.

    Each task counts its texts' shingles in cells and sends SLICES rows; the counts are summed slice by slice as they
    stream in, and the driver gets one byte a cell. Cells are shared by many rare shingles, which only blurs their
    order among themselves; frequent ones stand out. Any order gives the same links.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task("jaccard")
        total = np.zeros(1 << CELL_BITS, np.uint32)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(total, cell(shingles(text.as_py(), width)), 1)
        for i, part in enumerate(total.reshape(SLICES, -1)):
            if part.any():
                small = part.astype(np.min_scalar_type(part.max()))
                arrays = [pa.array([i], pa.int32()), pa.array([small.itemsize], pa.int32()), pa.array([small.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["slice", "width", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, bytes_each, counts in zip(batch["slice"].to_pylist(), batch["width"].to_pylist(), batch["counts"], strict=True):
                counts = np.frombuffer(counts.as_buffer(), f"u{bytes_each}").astype(np.int64)
                sums[number] = sums[number] + counts if number in sums else counts
        levels = [np.minimum(255, np.round(8 * np.log2(1 + x))).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], ["slice", "levels"])

    counted = texts.select("text").mapInArrow(count, "slice int, width int, counts binary").repartition("slice")
    levels = np.zeros((SLICES, (1 << CELL_BITS) // SLICES), np.uint8)
    for row in counted.mapInArrow(add, "slice int, levels binary").collect():  # SLICES rows
        levels[row["slice"]] = np.frombuffer(bytes(row["levels"]), np.uint8)
    return levels.ravel()


def signature(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return xxhash.xxh3_128_digest(hashes.tobytes())


def needed(percent: int, a: Column, b: Column) -> Column:
    """The smallest intersection of sets of sizes a and b that links them: 100 i >= percent (a + b - i)."""
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent))


def prefixes(texts: DataFrame, levels: np.ndarray, width: int, percent: int) -> DataFrame:
    """Of each row: doc_id, n_shingles, signature, probes, and the prefix of its set, the rarest shingles first.

    Two linked sets share a shingle of both prefixes if these have n - ceil(percent n / 100) + 1 shingles. Rows whose
    set this task has just met have no prefix; so a group of copies gives one for each task.
    """
    held = texts.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task("jaccard")
        met: set[bytes] = set()
        for batch in batches:
            sizes, signatures, probes, keys = [], [], [], []
            for text in batch["text"]:
                hashes = np.unique(shingles(text.as_py(), width))
                n = len(hashes)
                sign = signature(hashes) if n else None
                sizes.append(n)
                signatures.append(sign)
                if n and sign not in met:
                    if len(met) >= 200_000:
                        met.clear()
                    met.add(sign)
                    rank = held.value[cell(hashes)].astype(np.uint64) << np.uint64(56)
                    order = np.argsort(rank | (hashes >> np.uint64(8)), kind="stable")
                    keys.append(hashes[order[: n - -(-percent * n // 100) + 1]].view(np.int64))
                    probes.append(np.bincount((hashes & np.uint64(PROBES - 1)).astype(np.int64), minlength=PROBES).astype(np.int32))
                else:
                    keys.append(None)
                    probes.append(None)
            arrays = [
                batch["doc_id"],
                batch["text_key"],
                pa.array(sizes, pa.int64()),
                pa.array(signatures, pa.binary()),
                pa.array(probes, pa.list_(pa.int32())),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "n_shingles", "sign", "probes", "keys"])

    return texts.mapInArrow(run, "doc_id long, text_key long, n_shingles long, sign binary, probes array<int>, keys array<long>")


def shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of key, those whose key another row has, with `two`: whether just one other has.

    Holds the rows of the last key back between batches, two at most.
    """

    def flagged(batch: pa.RecordBatch, sizes: np.ndarray) -> pa.RecordBatch:
        kept = batch.append_column("two", pa.array(sizes == 2)).filter(pa.array(sizes > 1))
        return kept.select(["node", "n", "pos", "key", "two"])

    held, many = None, None  # rows of the last key if it may have two at most, else that key
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        keys = batch["key"].to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        lengths = np.diff(np.r_[starts, len(keys)])
        sizes = lengths + 3 * (keys[starts] == many) if many is not None else lengths
        if sizes[-1] > 2:
            held, many = None, keys[-1]
        else:
            held, many = batch.slice(starts[-1]), None
            batch, sizes, lengths = batch.slice(0, starts[-1]), sizes[:-1], lengths[:-1]
        if (sizes > 1).any():
            yield flagged(batch, np.repeat(sizes, lengths))
    if held is not None and held.num_rows == 2:
        yield flagged(held, np.array([2, 2]))


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets of hashes are linked; sizes are compared first."""
    least, most = sorted((len(x), len(y)))
    if 100 * least < percent * most:
        return False
    both = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * both >= percent * (len(x) + len(y) - both)


def verify(percent: int):
    """A function that keeps the pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = zip(batch["set_a"], batch["set_b"], strict=True)
            kept = [similar(*[np.frombuffer(v.as_buffer(), np.uint64) for v in pair], percent) for pair in each]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def sets_of(texts: DataFrame, wanted: DataFrame, rows: int, width: int) -> DataFrame:
    """node and set (sorted hashes) of the wanted nodes (node, doc_id, text_key, sign), whose texts are read again.

    There are at most `rows` of them. If they are too many to broadcast, only texts whose text_key may be among theirs
    are shuffled. Repeated rows of a table may give a node's set more than once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task("jaccard")
        for batch in batches:
            nodes, sets = [], []
            for node, sign, text in zip(batch["node"].to_pylist(), batch["sign"].to_pylist(), batch["text"], strict=True):
                hashes = np.unique(shingles(text.as_py(), width))
                if signature(hashes) == sign:
                    nodes.append(node)
                    sets.append(hashes.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "set"])

    ids = wanted.select("node", "sign", F.col("doc_id").alias("wanted_id"), F.col("text_key").alias("wanted_key"))
    same = F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("text_key") == F.col("wanted_key"))
    if rows * 72 > BROADCAST_BYTES:
        texts = marked(texts, F.col("text_key"), ids.select(F.col("wanted_key").alias("key"))).filter("_maybe").drop("_maybe")
    found = texts.join(small_or_shuffled(ids, rows, 72), same)
    return found.select("node", "sign", "text").mapInArrow(run, "node long, set binary")


def dealt_lists(postings: DataFrame) -> DataFrame:
    """The postings whose key another node has, with `two` (see shared_keys) and `salt`: lists of very many nodes are
    dealt to several parts.

    A sample shows which lists are so long. They are kept unseen and dealt by node, so that no task gets a whole one;
    the sample decides on the dealing only, not on what is compared.
    """
    total = postings.count()
    sampled = postings.filter(F.pmod(F.xxhash64("node", "key"), F.lit(SAMPLE_EVERY)) == 0).groupBy("key").agg((F.count("*") * SAMPLE_EVERY).alias("size"))
    hot = materialize(sampled.filter(F.col("size") > max(HOT_NODES, total // HOT_PARTS)), "jaccard-hot")
    held = F.broadcast(hot)  # HOT_PARTS rows at most
    cold = postings.join(held, "key", "left_anti").select("node", "n", "pos", "key").repartition("key").sortWithinPartitions("key")
    cold = cold.mapInArrow(shared_keys, "node long, n long, pos int, key long, two boolean").withColumn("salt", F.lit(0))
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / HOT_NODES)).cast("int")
    return cold.unionByName(postings.join(held, "key").select("node", "n", "pos", "key", F.lit(False).alias("two"), salt.alias("salt")))


def with_listed_before(lists: DataFrame) -> DataFrame:
    """lists with `before`: how many of a node's shingles before this one have a list.

    A shingle that two nodes share before one of both prefixes is in both prefixes too, and so has a list. Those
    before it without a list are not shared, which bounds what the pair has in common more closely than positions.
    """
    order = Window.partitionBy("node").orderBy("pos")
    return lists.withColumn("before", F.row_number().over(order) - 1)


def pivots(percent: int):
    """A function over rows in order of (key, salt, rank) that pairs each list's first node, its pivot, with the others.

    Pairs of one component go, and pairs that can't be linked by their sizes and the place of the shared shingle: a
    pair shares at most the listed shingles before it (see with_listed_before) and all that is left behind it. Holds
    one pivot between batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch[c].to_numpy() for c in ("key", "salt", "node", "n", "pos", "before", "label")}
            if held is not None:
                rows = {c: np.concatenate([held[c], v]) for c, v in rows.items()}
            first = np.r_[True, (rows["key"][1:] != rows["key"][:-1]) | (rows["salt"][1:] != rows["salt"][:-1])]
            at = np.flatnonzero(first)[np.cumsum(first) - 1]
            pivot = {c: v[at] for c, v in rows.items()}
            held = {c: v[-1:] for c, v in pivot.items()}
            most = np.minimum(rows["before"], pivot["before"]) + np.minimum(rows["n"] - rows["pos"], pivot["n"] - pivot["pos"])
            good = (rows["label"] != pivot["label"]) & (most * (100 + percent) >= percent * (rows["n"] + pivot["n"]))
            a, b = np.minimum(rows["node"], pivot["node"])[good], np.maximum(rows["node"], pivot["node"])[good]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array((rows["n"] + pivot["n"])[good])], ["a", "b", "both"])

    return run


class Join:
    """The lists of nodes that share a rare shingle, and the components found so far.

    labels has only nodes of components of more than one. sets gives node and set of some nodes, and of how many at most;
    they are read for one comparison and deleted after it, as few of the listed nodes are ever compared in full.
    """

    def __init__(self, tables: Tables, lists: DataFrame, probes: DataFrame, sets: Callable[[DataFrame, int], DataFrame], percent: int):
        self.tables, self.lists, self.probes, self.sets, self.percent = tables, lists, probes, sets, percent
        self.labels: DataFrame | None = None
        self.checked: DataFrame | None = None
        self.merged = 0

    def labelled(self, lists: DataFrame) -> DataFrame:
        """The lists with each node's component, and whether it has other nodes."""
        if self.labels is None:
            return lists.withColumns({"label": F.col("node"), "grouped": F.lit(False)})
        joined = lists.join(small_or_shuffled(self.labels, self.merged, 32), "node", "left")
        return joined.withColumns({"grouped": F.col("label").isNotNull(), "label": F.coalesce("label", "node")})

    def pivot_round(self, number: int) -> int:
        """Compare the nodes of each list with its pivot, which a hash chooses anew; returns the number of pairs.

        A list of two is done with after that.
        """
        dealt = self.labelled(self.lists).select("key", "salt", "node", "n", "pos", "before", "label").repartition("key", "salt")
        ranked = dealt.withColumn("rank", F.xxhash64(F.lit(number), "node")).sortWithinPartitions("key", "salt", "rank", "node").drop("rank")
        found = self.compare(ranked.mapInArrow(pivots(self.percent), "a long, b long, both long").distinct())
        self.lists = self.lists.filter("not two")
        return found

    def last_rounds(self) -> None:
        """Compare all that lists still have in different components.

        Of two linked nodes that are in different components now, one is in a component of several nodes, and the
        components are compared as wholes; or both are alone, and they meet in every list of both, so that their
        first shared shingle bounds what they share. Two that met in a list of two have been compared.
        """
        lists = self.tables.write(self.labelled(self.lists), "jaccard-open")
        if self.labels is not None:
            self.compare_components(lists)
        alone = self.labelled(lists.filter("not grouped").drop("label", "grouped", "salt"))
        pairs = alone.alias("x").join(alone.alias("y"), F.expr("x.key = y.key and x.node < y.node and x.label <> y.label"))
        pairs = pairs.filter(F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * self.percent)
        most = F.least("x.before", "y.before") + F.least(F.expr("x.n - x.pos"), F.expr("y.n - y.pos"))
        pairs = pairs.filter(most >= needed(self.percent, F.col("x.n"), F.col("y.n")))
        pairs = pairs.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"))
        first = pairs.agg(F.min("x.pos").alias("pa"), F.min("y.pos").alias("pb"))
        near = first.filter(F.least(F.expr("na - pa"), F.expr("nb - pb")) >= needed(self.percent, F.col("na"), F.col("nb")))
        self.compare(near.select("a", "b", F.expr("na + nb").alias("both")))

    def compare(self, pairs: DataFrame) -> int:
        """Verify pairs (a, b, both sizes) that have not been before, once each, and merge what they link."""
        if self.checked is not None:
            pairs = pairs.join(self.checked, ["a", "b"], "left_anti")
        x, y = self.probes.toDF("a", "probes_a"), self.probes.toDF("b", "probes_b")
        # Suffix filter: a part of the hash range gives no more common shingles than the smaller set has there.
        most = F.aggregate(F.zip_with("probes_a", "probes_b", lambda v, w: F.least(v, w)), F.lit(0), lambda s, v: s + v)
        pairs = pairs.join(x, "a").join(y, "b").filter(most * (100 + self.percent) >= F.col("both") * self.percent)
        pairs = self.tables.write(pairs.select("a", "b"), "jaccard-pairs")
        n = pairs.count()
        if n:
            self.checked = pairs if self.checked is None else self.checked.union(pairs)
            wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            sets = self.tables.write(self.sets(wanted, 2 * n), "jaccard-sets")
            both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
            links = both.select("a", "b", "set_a", "set_b").mapInArrow(verify(self.percent), "a long, b long")
            links = self.tables.write(links, "jaccard-links")
            self.tables.delete(sets)
            self.merge(links)
            self.tables.delete(links)
        return n

    def compare_components(self, lists: DataFrame) -> None:
        """Compare pairs of components of which one at least has several nodes and which share a list.

        The nodes of the larger one are dealt to blocks, those of all others that are to be compared with it to
        slices, and a task compares a block with a slice: it returns one link for each node of the slice that has any.
        So neither pairs nor a whole component meet in one place.
        """
        sides = [x.groupBy("key", "label").agg(F.min("n").alias("lo"), F.max("n").alias("hi")) for x in (lists.filter("grouped"), lists)]
        close = F.expr(f"x.key = y.key and x.label <> y.label and x.hi * 100 >= y.lo * {self.percent} and y.hi * 100 >= x.lo * {self.percent}")
        pairs = sides[0].alias("x").join(sides[1].alias("y"), close).select(F.col("x.label").alias("big"), F.col("y.label").alias("other")).distinct()
        sizes = self.tables.write(self.labels.groupBy("label").agg(F.count("*").alias("size")), "jaccard-sizes")
        pairs = pairs.join(sizes.toDF("big", "size"), "big").join(sizes.toDF("other", "other_size"), "other", "left")
        larger = F.expr("coalesce(other_size, 1) < size or (other_size = size and other < big)")  # each pair of groups once
        pairs = self.tables.write(pairs.filter(larger).select("big", "other"), "jaccard-groups")
        if pairs.limit(1).count() == 0:
            return
        n_of = self.probes.select("node", F.aggregate("probes", F.lit(0), lambda s, v: s + v).cast("long").alias("n"))
        members = self.labels.join(pairs.select(F.col("big").alias("label")).distinct(), "label", "left_semi").join(n_of, "node")
        members = self.tables.write(members.select("node", F.col("label").alias("big"), "n"), "jaccard-members")
        of_other = self.labels.select("node", F.col("label").alias("other"))
        span = members.groupBy("big").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
        asked = pairs.join(of_other, "other", "left").select("big", F.coalesce("node", "other").alias("node")).join(n_of, "node").join(span, "big")
        asked = asked.filter(F.expr(f"hi * 100 >= n * {self.percent} and n * 100 >= lo * {self.percent}"))
        asked = self.tables.write(asked.select("node", "big", "n"), "jaccard-asked")
        wanted = members.select("node").union(asked.select("node")).distinct()
        sets = self.tables.write(self.sets(wanted, members.count() + asked.count()), "jaccard-sets")

        def parts(side: DataFrame, name: str) -> DataFrame:
            most = F.greatest(F.count("*") / BLOCK_NODES, F.sum("n") / BLOCK_SHINGLES)
            return side.groupBy("big").agg(F.ceil(most).cast("int").alias(name))

        grid = self.tables.write(parts(members, "blocks").join(parts(asked, "slices"), "big"), "jaccard-grid")

        def dealt(side: DataFrame, own: str, across: str) -> DataFrame:
            """Each node in its own part, once for every part of the other side."""
            at = F.pmod(F.xxhash64("node"), F.col(own)).cast("int")
            every = F.explode(F.sequence(F.lit(0), F.col(across) - 1))
            return side.join(grid, "big").select("node", "big", at.alias(own[:-1]), every.alias(across[:-1])).join(sets, "node")

        percent = self.percent

        def links(block: pa.Table, queries: pa.Table) -> pa.Table:
            if not block.num_rows or not queries.num_rows:
                return pa.table({c: pa.array([], pa.int64()) for c in "ab"})
            held = [np.frombuffer(s.as_buffer(), np.uint64) for s in block["set"]]
            sizes = np.array([len(x) for x in held])
            hashes, owners = np.concatenate(held), np.repeat(np.arange(len(held)), sizes)
            order = np.argsort(hashes, kind="stable")
            hashes, owners, nodes = hashes[order], owners[order], block["node"].to_numpy()
            found: list[tuple[int, int]] = []
            for node, data in zip(queries["asked"].to_pylist(), queries["own_set"], strict=True):
                own = np.frombuffer(data.as_buffer(), np.uint64)
                start, stop = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
                places = np.repeat(stop - np.cumsum(stop - start), stop - start) + np.arange((stop - start).sum())
                both = np.bincount(owners[places], minlength=len(held))  # shared with each member
                linked = 100 * both >= percent * (sizes + len(own) - both)
                if linked.any():
                    found.append((node, int(nodes[np.argmax(linked)])))
            return pa.table({c: pa.array([x[i] for x in found], pa.int64()) for i, c in enumerate("ab")})

        left = dealt(members, "blocks", "slices").groupBy("big", "block", "slice")
        right = dealt(asked, "slices", "blocks").select("big", "block", "slice", "node", "set").toDF("of", "in", "by", "asked", "own_set").groupBy("of", "in", "by")
        found = self.tables.write(left.cogroup(right).applyInArrow(links, "a long, b long"), "jaccard-links")
        self.tables.delete(members, asked, grid, sets)
        self.merge(found)
        self.tables.delete(found, sizes, pairs)

    def merge(self, links: DataFrame) -> bool:
        """Merge the components that links (a, b) join; returns whether there were any links."""
        if links.limit(1).count() == 0:
            return False
        if self.labels is not None:
            held = small_or_shuffled(self.labels, self.merged, 32)
            for end in "ab":
                links = links.join(held.toDF(end, "label"), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
        new = connected(links.filter("a <> b")).toDF("label", "new")
        if self.labels is None:
            self.labels = self.tables.write(new.toDF("node", "label"), "jaccard-labels")
        else:
            moved = self.labels.join(new, "label", "left").select("node", F.coalesce("new", "label").alias("label"))
            fresh = new.join(self.labels, new.label == self.labels.node, "left_anti").toDF("node", "label")
            self.labels = self.tables.write(moved.union(fresh).distinct(), "jaccard-labels")
        self.merged = self.labels.count()
        return True


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Components of texts whose sets of word shingles have a Jaccard similarity of percent / 100 or more.

    Words are what white space (space, tab to carriage return) leaves, with A-Z in lower case. A text of fewer words
    than width is one shingle; null texts and texts without words have empty sets and are linked with nothing. Texts
    are taken whole. Rows are nodes of their own, so repeated ids and null ids are fine; a component's id is its
    smallest doc_id that is not null. An empty table gives an empty result. Other columns of df are not looked at.

    Returns doc_id, n_shingles, component_id, text_key (a hash of the text) and label for every row. label tells components
    apart, which component_id doesn't if an id stands on unrelated texts.
    """
    with arrow_rows(df.sparkSession, ARROW_ROWS):
        return _near_duplicates(df, id_col, text_col, width, percent)


def _near_duplicates(df: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    tables = Tables(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"), text)
    levels = frequency_levels(texts, width)
    rows = prefixes(texts, levels, width, percent).withColumn("node", F.monotonically_increasing_id())
    rows = tables.write(rows, "jaccard-rows")
    tables.delete()

    groups = rows.filter("sign is not null").groupBy("sign").agg(F.min("node").alias("first"), F.count("*").alias("rows"))
    groups = tables.write(groups.filter("rows > 1").select("sign", "first"), "jaccard-copies")
    copies = small_or_shuffled(groups, groups.count(), 48)
    nodes = rows.select("doc_id", "text_key", "n_shingles", "sign", "node").join(copies, "sign", "left")
    nodes = tables.write(nodes.withColumn("first", F.coalesce("first", "node")), "jaccard-nodes")

    moved = tables.write(nodes.filter("first <> node").select("node"), "jaccard-moved")
    first = rows.filter("keys is not null").join(small_or_shuffled(moved, moved.count(), 16), "node", "left_anti")
    postings = first.select("node", F.col("n_shingles").alias("n"), F.posexplode("keys").alias("pos", "key"))
    shared = tables.write(dealt_lists(postings), "jaccard-shared")
    tables.delete()
    lists = tables.write(with_listed_before(shared), "jaccard-lists")
    tables.delete(shared)

    listed = tables.write(lists.select("node").distinct(), "jaccard-listed")
    n = listed.count()
    listed = small_or_shuffled(listed, n, 16)
    probes = tables.write(first.join(listed, "node", "left_semi").select("node", "probes"), "jaccard-probes")
    tables.delete(rows, moved)

    def sets(wanted: DataFrame, at_most: int) -> DataFrame:
        return sets_of(texts, nodes.join(small_or_shuffled(wanted, at_most, 16), "node", "left_semi"), at_most, width)

    join = Join(tables, lists, probes, sets, percent)
    for number in range(PIVOT_ROUNDS):
        if not join.pivot_round(number):
            break
    join.last_rounds()

    labelled = nodes.withColumn("label", F.col("first"))
    if join.labels is not None:
        labels = small_or_shuffled(join.labels.toDF("first", "merged"), join.merged, 32)
        labelled = nodes.join(labels, "first", "left").withColumn("label", F.coalesce("merged", "first"))
    labelled = tables.write(labelled.select("doc_id", "text_key", "n_shingles", "label"), "jaccard-labelled")
    named = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows")).filter("rows > 1").drop("rows")
    named = tables.write(named, "jaccard-named")
    tables.drop(labelled, named)
    result = labelled.join(small_or_shuffled(named, named.count(), 32), "label", "left")
    return result.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "text_key", "label")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """df with one row of each component: that of the smallest id, and of its texts that of the smallest text_key.

    Rows with empty sets are alone and stay; so do rows with null ids. Rows alike in id and text stay or go together.
    """
    found = materialize(near_duplicates(df, id_col, text_col, width, percent), "jaccard-found")
    linked = found.filter("doc_id is not null and n_shingles > 0")
    keepers = linked.groupBy("label").agg(F.min(F.struct("doc_id", "text_key")).alias("keep"), F.count("*").alias("rows"))
    keepers = materialize(keepers.filter("rows > 1").select("label", "keep"), "jaccard-keepers")
    return without(df, linked.join(keepers, "label").filter("doc_id <> keep.doc_id or text_key <> keep.text_key"), id_col, text_col)
