"""Phrases that recur, by multikey three-way quicksort of suffix pointers, and how firmly their words belong together."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import Tables, arrow_rows, small_or_shuffled

#: Words of the longest phrase.
MOST_WORDS = 5

#: A task keeps at most so many different words, and so many suffixes before it sends them.
MOST_KNOWN, SUFFIXES = 500_000, 1 << 20

#: Bits of the bitmaps that are sent to all tasks: frequent words, and word sequences with very many suffixes.
BITMAP_BITS = 24

#: Suffixes that a task sorts together, about. Beginnings with more are dealt by one word more.
SORTED_TOGETHER = 1 << 21

#: Words of the sample that tells such beginnings; it decides on dealing only. Of larger tables the share is SAMPLE_SHARE.
SAMPLE_WORDS, SAMPLE_SHARE = 1 << 20, 2.0**-14

BREAKS = bytes.maketrans(b".,;:!?\n\v\f\r\t", b"\n\n\n\n\n\n\n\n\n\n ")
MIX = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Numbers for the words of one language in one task; 0 is the end of a piece."""

    def __init__(self, lang: str):
        self.seed = xxhash.xxh64_intdigest(lang.encode())
        self.ids: dict[bytes, int] = {b"\n": 0}
        self.words: list[bytes] = [b"\n"]
        self.hashes = np.zeros(1, np.uint64)

    def number(self, texts: list[bytes]) -> np.ndarray:
        """The words of texts in order, with a 0 behind each piece."""
        found = b"\n".join(texts).lower().translate(BREAKS).replace(b"\n", b" \n ").split(b" ")
        ids, words = self.ids, self.words
        for word in set(found).difference(ids):
            if word:
                ids[word] = len(words)
                words.append(word)
        fresh = words[len(self.hashes) :]
        if fresh:
            digests = np.fromiter((xxhash.xxh64_intdigest(w, self.seed) for w in fresh), np.uint64, len(fresh))
            self.hashes = np.concatenate([self.hashes, digests])
        return np.fromiter((ids[w] for w in found if w), np.int64)


def numbered_batches(batches: Iterator[pa.RecordBatch], most_known: int = MOST_KNOWN) -> Iterator[tuple[str, Words, np.ndarray, bool]]:
    """Batches of (lang, text) as numbers: language, its words, the numbers, and whether these words end with this batch."""
    held: dict[str, Words] = {}
    for batch in batches:
        by_lang: dict[str, list[bytes]] = defaultdict(list)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_lang[lang].append(text)
        for lang, texts in by_lang.items():
            words = held.setdefault(lang, Words(lang))
            numbers = words.number(texts)
            full = len(words.words) > most_known
            yield lang, words, numbers, full
            if full:
                del held[lang]


def worded(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """lang and text in bytes of the rows that have text; a null language is und."""
    text = F.col(text_col)
    rows = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text.cast("binary").alias("text"))
    return rows.filter("octet_length(text) > 0")


def word_counts(rows: DataFrame) -> DataFrame:
    """lang, word and n of all words, added up in each task first; with word null, the number of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, tuple[Words, np.ndarray]] = {}

        def sums(lang: str) -> pa.RecordBatch:
            words, n = counts.pop(lang)
            at = np.flatnonzero(n[1:]) + 1
            names = [words.words[i].decode("utf-8", "replace") for i in at]
            return pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1), pa.string()), pa.array([*names, None], pa.string()), pa.array([*n[at].tolist(), int(n[1:].sum())], pa.int64())], names=["lang", "word", "n"])

        for lang, words, numbers, full in numbered_batches(batches):
            n = np.bincount(numbers, minlength=len(words.words))
            if lang in counts:
                before = counts[lang][1]
                n[: len(before)] += before
            counts[lang] = (words, n)
            if full:
                yield sums(lang)
        for lang in list(counts):
            yield sums(lang)

    return rows.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def bitmap(hashes: DataFrame) -> np.ndarray:
    """The bitmap of a table of hashes (key): 2 ** BITMAP_BITS bits, 2 MB, whatever the number of keys. A key's bit is
    its lowest bits; keys may share bits, so that more are let through."""
    at = F.col("key").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    rows = hashes.select(F.shiftright(at, 15).alias("row"), F.pmod(at, F.lit(1 << 15)).alias("at")).groupBy("row").agg(F.bitmap_construct_agg("at").alias("bits"))
    out = np.zeros(1 << BITMAP_BITS >> 3, np.uint8)
    for row in rows.collect():  # at most 512 rows of 4 KB
        out[row["row"] * 4096 : row["row"] * 4096 + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def within(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set."""
    at = keys & np.uint64((1 << BITMAP_BITS) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def word_keys(frequent: DataFrame) -> DataFrame:
    """The hashes of words (lang, word) as Words gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            keys = np.fromiter((xxhash.xxh64_intdigest(w.encode(), xxhash.xxh64_intdigest(g.encode())) for g, w in pairs), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])

    return frequent.select("lang", "word").mapInArrow(run, "key long")


def suffixes(numbers: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """The first MOST_WORDS words behind each place, up to the end of the piece or the first word that isn't usable, of
    the places where there are two or more: a column for each, 0 behind the end."""
    held = np.where(usable[numbers], numbers, 0)
    held = np.concatenate([held, np.zeros(MOST_WORDS, np.int64)])
    at = np.flatnonzero((held[:-1] > 0) & (held[1:] > 0))
    columns = [held[at], held[at + 1]]
    for i in range(2, MOST_WORDS):
        columns.append(np.where(columns[-1] > 0, held[at + i], 0))
    return np.array(columns, np.int32)


def beginnings(columns: np.ndarray, hashes: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the first 2, 3 and more words of suffixes."""
    key = hashes[columns[0]]
    for column in columns[1:]:
        key = key * MIX + hashes[column]
        key = key ^ (key >> np.uint64(29))
        yield key


def often_begun(rows: DataFrame, n_words: int, frequent: np.ndarray) -> DataFrame:
    """key: hashes of beginnings of 2 to 4 words that have more than SORTED_TOGETHER suffixes, by a sample of the rows.

    What it misses or adds changes how suffixes are dealt, and no count.
    """
    share = min(1.0, max(SAMPLE_WORDS / max(n_words, 1), SAMPLE_SHARE))
    bits = rows.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, numbers, _ in numbered_batches(batches):
            columns = suffixes(numbers, usable_words(words, bits.value))
            for key in list(beginnings(columns, words.hashes))[:-1]:
                keys, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    sampled = rows.sample(False, share, 7).mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return sampled.filter(F.col("n") > max(SORTED_TOGETHER * share, 16))


def usable_words(words: Words, frequent: np.ndarray) -> np.ndarray:
    """Whether each word may be frequent; the end of a piece isn't."""
    usable = within(frequent, words.hashes)
    usable[0] = False
    return usable


BLOCKS = "route int, lang string, words binary, depths binary, columns binary, weights binary"


def packed(names: bytes, columns: np.ndarray, depths: np.ndarray, weights: np.ndarray) -> dict[str, bytes]:
    """A block's parts in few bytes: small numbers where they do, nothing where all are usual, and compressed."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    small = np.uint16 if columns.max() < 1 << 16 else np.int32
    return {
        "words": squeeze(names),
        "columns": squeeze(small().dtype.char.encode() + columns.astype(small).tobytes()),
        "depths": b"" if (depths == 2).all() else squeeze(depths.tobytes()),
        "weights": b"" if (weights == 1).all() else squeeze(weights.astype(np.int64).tobytes()),
    }


def unpacked(words: bytes, depths: bytes, columns: bytes, weights: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words, columns, depths and weights of a block."""
    widen = zstandard.ZstdDecompressor().decompress
    held = widen(columns)
    numbers = np.frombuffer(held, held[:1].decode(), offset=1).reshape(MOST_WORDS, -1)
    n = numbers.shape[1]
    return (
        widen(words).split(b"\n"),
        numbers,
        np.frombuffer(widen(depths), np.int8) if depths else np.full(n, 2, np.int8),
        np.frombuffer(widen(weights), np.int64) if weights else np.ones(n, np.int64),
    )


def routed_suffixes(rows: DataFrame, routes: int, frequent: np.ndarray, often: np.ndarray) -> DataFrame:
    """All suffixes in blocks: those that begin with the same two words go the same route, or, where very many do, those
    that begin with the same three words, and so on. A block has its words, and of each suffix the number of words that
    it was dealt by, its words and how often it occurs; equal suffixes of a task are folded."""
    context = rows.sparkSession.sparkContext
    frequent_bits, often_bits = context.broadcast(frequent), context.broadcast(often)

    def send(lang: str, words: Words, parts: list[np.ndarray]) -> Iterator[dict]:
        columns = np.concatenate(parts, axis=1)
        if not columns.shape[1]:
            return
        keys = list(beginnings(columns, words.hashes))
        key, depth = keys[0], np.full(columns.shape[1], 2, np.int8)
        for i, longer in enumerate(keys[1:], 2):
            more = (depth == i) & within(often_bits.value, key)
            if not more.any():
                break
            depth[more] += 1
            key = np.where(more, longer, key)
        route = (key >> np.uint64(32)) % np.uint64(routes)
        pair = lambda a, b: columns[a].astype(np.int64) << 32 | columns[b]
        order = np.lexsort((columns[4], pair(2, 3), pair(0, 1), route))
        columns, route, depth = columns[:, order], route[order], depth[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (columns[:, 1:] != columns[:, :-1]).any(axis=0)
        first = np.flatnonzero(fresh)
        weights = np.diff(np.append(first, len(order)))
        columns, route, depth = columns[:, first], route[first], depth[first]
        edges = [0, *(np.flatnonzero(np.diff(route)) + 1), len(route)]
        for lo, hi in pairwise(edges):
            own = columns[:, lo:hi]
            used, local = np.unique(own, return_inverse=True)
            names = b"\n".join(words.words[i] for i in used if i)
            yield {"route": int(route[lo]), "lang": lang} | packed(names, local.reshape(own.shape) + (used[0] > 0), depth[lo:hi], weights[lo:hi])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, tuple[Words, list[np.ndarray]]] = {}
        for lang, words, numbers, full in numbered_batches(batches):
            held = parts.setdefault(lang, (words, []))[1]
            held.append(suffixes(numbers, usable_words(words, frequent_bits.value)))
            if full or sum(p.shape[1] for p in held) >= SUFFIXES:
                yield from batched(send(lang, *parts.pop(lang)))
        for lang in list(parts):
            yield from batched(send(lang, *parts.pop(lang)))

    schema = pa.schema([("route", pa.int32()), ("lang", pa.string()), *[(c, pa.binary()) for c in ("words", "depths", "columns", "weights")]])

    def batched(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in rows:
            held.append(row)
            if len(held) == 64:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    return rows.mapInArrow(emit, BLOCKS)


def quicksort_counts(columns: np.ndarray, weights: np.ndarray, least: int, known_from: int) -> Iterator[tuple[int, int, int]]:
    """(pointer, words, count) of the phrases of 2 words and more that the suffixes begin with.

    Multikey three-way quicksort of pointers: a range is split by one word into less, equal and greater; the weight of the
    equal part is the count of the phrase up to this word, and it is split on by the next word. Ranges below `least` are
    abandoned where all occurrences of their phrases are here, that is, from known_from words on (2 at least).
    """
    pointers = np.arange(len(weights))
    stack = [(0, len(pointers), 0)]
    while stack:
        lo, hi, depth = stack.pop()
        own = pointers[lo:hi]
        if max(depth + 1, 2) >= known_from and weights[own].sum() < least:
            continue
        words = columns[depth][own]
        pivot = words[len(words) // 2]
        below, above = words < pivot, words > pivot
        less, greater = own[below], own[above]
        equal = own[~(below | above)]
        a, b = lo + len(less), hi - len(greater)
        pointers[lo:hi] = np.concatenate([less, equal, greater])
        if len(less):
            stack.append((lo, a, depth))
        if len(greater):
            stack.append((b, hi, depth))
        if pivot == 0:  # the phrases that end here have been counted
            continue
        count = int(weights[equal].sum())
        if depth and (count >= least or depth + 1 < known_from):
            yield int(equal[0]), depth + 1, count
        if depth + 1 < MOST_WORDS and (count >= least or depth + 2 < known_from):
            stack.append((a, b, depth + 1))


def counted_phrases(blocks: DataFrame, least: int, routes: int) -> DataFrame:
    """lang, phrase, words and n of all phrases of 2 to MOST_WORDS words that occur at least so often. A task sorts one route's
    suffixes of one language at a time."""

    def mine(lang: str, held: list[tuple]) -> Iterator[tuple]:
        ids: dict[bytes, int] = {}
        columns, depths, weights = [], [], []
        for block in held:
            names, own, depth, weight = unpacked(*block)
            table = np.zeros(len(names) + 1, np.int32)
            table[1:] = [ids.setdefault(w, len(ids) + 1) for w in names]
            columns.append(table[own])
            depths.append(depth)
            weights.append(weight)
        columns, depths, weights = np.concatenate(columns, axis=1), np.concatenate(depths), np.concatenate(weights)
        names = [b"", *ids]
        for depth in np.unique(depths):
            own = depths == depth
            part = columns[:, own]
            for at, n_words, count in quicksort_counts(part, weights[own], least, int(depth)):
                yield lang, b" ".join(names[i] for i in part[:n_words, at]), n_words, count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True)

        def found() -> Iterator[tuple]:
            at, held = None, []
            for route, lang, *block in rows():
                if held and at != (route, lang):
                    yield from mine(at[1], held)
                    held = []
                at = (route, lang)
                held.append(block)
            if held:
                yield from mine(at[1], held)

        out = []
        for row in found():
            out.append(row)
            if len(out) == 10_000:
                yield as_batch(out)
                out = []
        if out:
            yield as_batch(out)

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        langs, phrases, words, counts = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(langs), pa.array([p.decode("utf-8", "replace") for p in phrases]), pa.array(words, pa.int32()), pa.array(counts, pa.int64())], names=["lang", "phrase", "words", "n"])

    dealt = blocks.repartition(routes, "route").sortWithinPartitions("route", "lang")
    partial = dealt.mapInArrow(run, "lang string, phrase string, words int, n long")
    return partial.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def score_phrases(phrases: DataFrame, words: DataFrame, totals: DataFrame, n_totals: int) -> DataFrame:
    """phrases (lang, phrase, words, n) with a, l, r, n and score of their lowest-scoring cut; of equal scores the first.

    Scores are made of whole numbers of any size, in Python.
    """
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")).unionByName(words.select("lang", F.col("word").alias("part"), F.col("n").alias("f")))
    split = phrases.withColumn("_words", F.split("phrase", " ", -1)).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    first = F.array_join(F.slice("_words", F.lit(1), F.col("k")), " ").alias("_first")
    rest = F.array_join(F.slice("_words", F.col("k") + 1, F.col("words")), " ").alias("_rest")
    cuts = split.select("lang", "phrase", "words", F.col("n").alias("a"), "k", first, rest)
    left = parts.select("lang", F.col("part").alias("_first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("_rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "_first"]).join(right, ["lang", "_rest"]).join(small_or_shuffled(totals, n_totals, 64), "lang")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, l, r, n = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in "alrn")
            yield batch.append_column("score", pa.array([1000 * x * w // (y * z) for x, y, z, w in zip(a, l, r, n, strict=True)], pa.int64()))

    kept = cuts.select("lang", "phrase", "words", "k", "a", "l", "r", "n")
    scored = kept.mapInArrow(score, "lang string, phrase string, words int, k int, a long, l long, r long, n long, score long")
    lowest = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("cut"))
    return lowest.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def free_phrases(scored: DataFrame) -> DataFrame:
    """Phrases that no longer phrase holds as often as they occur.

    A phrase inside a longer one occurs no less than what lies between them, so looking at one word more is enough.
    """
    words = F.split("phrase", " ", -1)
    longer = scored.filter("words > 2").withColumn("_words", words)
    shorter = F.array(F.slice("_words", F.lit(1), F.col("words") - 1), F.slice("_words", F.lit(2), F.col("words") - 1))
    held = longer.select("lang", F.col("a").alias("_a"), F.explode(F.transform(shorter, lambda w: F.array_join(w, " "))).alias("phrase"))
    most = held.groupBy("lang", "phrase").agg(F.max("_a").alias("_most"))
    return scored.join(most, ["lang", "phrase"], "left").filter("_most is null or _most < a").drop("_most")


def mine_phrases(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, most: int = 2_000) -> DataFrame:
    """The firmest phrases of 2 to 5 words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are cut into pieces at .,;:!? and line breaks, and pieces into words at spaces and tabs; A-Z are lower-cased.
    A phrase needs `least` occurrences. Null and empty texts have no words; a null language is und. Equal rows count
    each; an empty table gives no rows. Other columns aren't looked at, so they may have any name.

    Words are counted first. Suffixes then end at words below `least`, told by a bitmap that may let others through.
    """
    tables = Tables(df.sparkSession)
    rows = worded(df, text_col, lang_col)
    with arrow_rows(df.sparkSession, 2_000):
        counted = tables.write(word_counts(rows).filter(F.col("word").isNull() | (F.col("n") >= least)), "phrase-words")
        totals = counted.filter("word is null").select("lang", "n")
        words = counted.filter("word is not null")
        n_words, n_langs = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        frequent = bitmap(word_keys(words))
        often = bitmap(often_begun(rows, n_words, frequent))
        routes = max(1, n_words // SORTED_TOGETHER)
        phrases = counted_phrases(routed_suffixes(rows, routes, frequent, often), least, max(routes, 2))
        phrases = tables.write(phrases, "phrase-counts")
    scored = tables.write(free_phrases(score_phrases(phrases, words, totals, n_langs)), "phrase-scores")
    tables.drop(scored)
    ranked = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(256)))
    for keys in (["lang", "_part"], ["lang"]):  # the best of a part first, so that few meet
        best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
