"""Byte-pair encoding with word ends: token counts by heap merging, encoding at forced boundaries, decoding.

The vocabulary file is read on each worker from the path given; it follows the tokenizers library's JSON with a
BPE model that has an end-of-word suffix.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import operator
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import begin_task, remembers

#: A worker holds at most so many of the chunks (or pre-tokens and fragments) it has met, and never longer ones.
CACHE_ITEMS, CACHE_PIECES, CACHE_CHARS = 300_000, 100_000, 64

#: A byte that no UTF-8 text has.
WORD_END = b"\xff"

#: Rows that a worker handles at a time.
SLICE_ROWS = 256

SEPARATORS = regex.compile(r"[\x1c-\x1f]")

RARE = regex.compile(r"[\u0530-\U0010ffff]")

SHOWN = operator.itemgetter(0)  # true of chunks that have ids

_LOADED: dict[str, Vocabulary] = {}


@functools.cache
def unassigned() -> regex.Pattern:
    """Matches letters that this Python's Unicode doesn't have; the library's may be of another age."""
    runs: list[list[int]] = []
    for c in range(0x110000):
        if unicodedata.category(chr(c)) == "Cn":
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return regex.compile("[" + "".join(f"\\U{x:08x}-\\U{y:08x}" for x, y in runs) + "]")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others for the letters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """A vocabulary file: normalisation, pre-tokens, special strings, ids and merge ranks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.numerals = {i: str(i) for i in self.tokens}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.piece = regex.compile(split["pattern"]["Regex"])
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        letters = byte_letters()
        self.letters = dict(enumerate(letters))
        self.numbers = {letter: b for b, letter in enumerate(letters)}
        self.path, self.library = path, None
        # Byte pairs that stand side by side inside some token. At any other pair no token can reach across.
        self.inside = set()
        for token in self.ids:
            plain = [self.numbers[c] for c in token.removesuffix(self.end) if c in self.numbers]
            self.inside.update(zip(plain, plain[1:]))
        # Ids of single bytes, inside a word and at its end, and merges as pairs of ids.
        self.first_ids = [self.ids.get(c) for c in letters]
        self.last_ids = [self.ids.get(c + self.end) for c in letters]
        self.id_ranks = {self.ids[a] << 32 | self.ids[b]: rank for (a, b), rank in self.ranks.items()}
        self.merged_ids = [self.ids[a + b] for a, b in pairs]

    def parts(self, text: str) -> Iterator[tuple[str, list[str]]]:
        """A text as runs of ("special", strings), ("chunks", what lies between white space) or ("pieces", pre-tokens)."""
        for part in self.cut_special.split(text) if "<|" in text else [text]:
            if part in self.special:
                yield "special", [part]
            elif part.isascii() or not RARE.search(part) or not unassigned().search(part):
                yield "chunks", self.chunks(part)
            else:
                yield "pieces", self.library_pieces(part)

    @staticmethod
    def chunks(text: str) -> list[str]:
        """A normalised text cut at white space, which no token crosses.

        Normal means canonical composition, and lower case letter by letter: a sigma has one form, also at the end
        of a word. Four separators that split() cuts at are no white space here.
        """
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return [text] if SEPARATORS.search(text) else text.split()

    def library_pieces(self, text: str) -> list[str]:
        """Pre-tokens as the library cuts them, for texts with letters that this Python doesn't know yet."""
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.numbers.__getitem__, piece)).decode() for piece, _ in cut]

    def symbols(self, piece: str) -> list[str]:
        """The letters of a pre-token's bytes; the last bears the word's end."""
        out = [self.letters[b] for b in piece.encode()]
        out[-1] += self.end
        return out


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once by each worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> tuple[list[str | None], int]:
    """Merge adjacent symbols, lowest rank first and leftmost among equals, with a heap over a linked list.

    symbols is changed in place; a symbol merged into its left neighbour becomes None. Returns it and the number
    of merges.
    """
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of the two has been merged since
        symbols[i], symbols[j] = left + right, None
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get((symbols[i], symbols[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
        k = before[i]
        if k >= 0:
            rank = ranks.get((symbols[k], symbols[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, k, symbols[k], symbols[i]))
    return symbols, merges


def merge_ids(ids: list[int], ranks: dict[int, int], merged_ids: list[int]) -> list[int]:
    """What merge leaves of a few symbols, given and returned as ids: the lowest rank is looked for after each merge."""
    rank, none = ranks.get, len(merged_ids)
    pairs = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
    while pairs:
        lowest = min(pairs)
        if lowest == none:
            break
        i = pairs.index(lowest)
        merged = ids[i] = merged_ids[lowest]
        del ids[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = rank(merged << 32 | ids[i + 1], none)
        if i:
            pairs[i - 1] = rank(ids[i - 1] << 32 | merged, none)
    return ids


class Remembered(dict):
    """What a function gives for short pieces. When half of the items are new, those met before them are forgotten."""

    def __init__(self, function: Callable, items: int):
        super().__init__()
        self.function, self.items, self.older = function, items, {}

    def __missing__(self, piece: str):
        value = self.older.get(piece)
        if value is None:
            value = self.function(piece)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= self.items // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = value
        return value


class Counter:
    """Counts tokens: the symbols of each pre-token less the merges made. No ids are looked up."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        self.pieces = Remembered(self.count_piece, CACHE_PIECES)
        self.counts = Remembered(self.count_chunk, CACHE_ITEMS)

    def count_chunk(self, chunk: str) -> int:
        return sum(map(self.pieces.__getitem__, self.vocabulary.piece.findall(chunk)))

    def count_piece(self, piece: str) -> int:
        symbols = self.vocabulary.symbols(piece)
        n = len(symbols)
        return n - merge(symbols, self.vocabulary.ranks)[1]

    def count(self, text: str) -> int:
        """The number of tokens of a text."""
        return sum(
            1 if kind == "special" else sum(map((self.counts if kind == "chunks" else self.pieces).__getitem__, items))
            for kind, items in self.vocabulary.parts(text)
        )


class Encoder:
    """Encodes pre-tokens fragment by fragment, cut where no token can reach across."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        self.fragments = Remembered(self.encode_fragment, CACHE_PIECES)
        self.pieces = Remembered(self.encode_piece, CACHE_PIECES)
        self.shown = Remembered(self.show_chunk, CACHE_ITEMS)

    def cut(self, data: bytes) -> list[bytes]:
        """The fragments of a pre-token's bytes; the last has WORD_END behind it."""
        inside = self.vocabulary.inside
        places = [at for at, pair in enumerate(zip(data, data[1:]), 1) if pair not in inside]
        data += WORD_END
        return [data[i:j] for i, j in zip([0, *places], [*places, None])]

    def encode_fragment(self, fragment: bytes) -> list[int]:
        """The ids of a fragment; one of many symbols is merged by heap, which takes less than square time."""
        v, ends = self.vocabulary, fragment.endswith(WORD_END)
        data = fragment.removesuffix(WORD_END)
        if len(data) > CACHE_CHARS:
            symbols = [v.letters[b] for b in data]
            symbols[-1] += v.end * ends
            return [v.ids[s] for s in merge(symbols, v.ranks)[0] if s is not None]
        ids = [v.first_ids[b] for b in data]
        if ends:
            ids[-1] = v.last_ids[data[-1]]
        return merge_ids(ids, v.id_ranks, v.merged_ids)

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of a pre-token. A fragment is remembered only where there are several."""
        fragments = self.cut(piece.encode())
        if len(fragments) == 1:
            return self.encode_fragment(fragments[0])
        return list(itertools.chain.from_iterable(map(self.fragments.__getitem__, fragments)))

    def encode_chunk(self, chunk: str) -> Sequence[int]:
        """The ids of a chunk. One that is a single pre-token is remembered as a chunk only."""
        pieces = self.vocabulary.piece.findall(chunk)
        if len(pieces) == 1:
            return self.encode_piece(pieces[0])
        return list(itertools.chain.from_iterable(map(self.pieces.__getitem__, pieces)))

    def show_chunk(self, chunk: str) -> tuple[str, str]:
        """Of a chunk: the ids as text, and their decoded form."""
        ids = self.encode_chunk(chunk)
        return " ".join(map(self.vocabulary.numerals.__getitem__, ids)), self.decode(ids)

    def encode(self, text: str) -> list[int]:
        """The ids of a text."""
        out: list[int] = []
        for kind, items in self.vocabulary.parts(text):
            if kind == "special":
                out.append(self.vocabulary.special[items[0]])
            else:
                out += [i for x in items for i in (self.encode_chunk(x) if kind == "chunks" else self.pieces[x])]
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids. The vocabulary has no decoder of its own, so tokens are joined by single spaces."""
        return " ".join(map(self.vocabulary.tokens.__getitem__, ids))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Of a text: the number of ids, the ids as text and their decoded form."""
        shown: list[tuple[str, str]] = []
        for kind, items in self.vocabulary.parts(text):
            if kind == "chunks":
                shown += filter(SHOWN, map(self.shown.__getitem__, items))
            elif kind == "special":
                shown.append((str(self.vocabulary.special[items[0]]), items[0]))
            else:
                shown += [(" ".join(map(str, ids)), self.decode(ids)) for ids in map(self.pieces.__getitem__, items)]
        ids = " ".join([x[0] for x in shown])
        return ids.count(" ") + bool(ids), ids, " ".join([x[1] for x in shown])


_WORKERS: dict[tuple[type, str], Counter | Encoder] = {}


def worker(kind: type, path: str) -> Counter | Encoder:
    """A worker's own counter or encoder; it is kept between tasks, as is what it remembers."""
    begin_task("bpe")
    if (kind, path) not in _WORKERS:
        _WORKERS[kind, path] = kind(path)
    return _WORKERS[kind, path]


def _forget() -> None:
    _WORKERS.clear()
    _LOADED.clear()


remembers("bpe", _forget)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut into smaller ones, so that what a worker makes of one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _id_type(df: DataFrame, id_col: str) -> str:
    return df.schema[id_col].dataType.simpleString()


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """Tokens of every text, by heap-and-linked-list merging; nothing is shuffled.

    Null and empty texts have 0 bytes and 0 tokens. Special strings inside a text count 1 token each. Texts are
    taken whole; repeated rows are counted each; an empty table gives an empty result; other columns of df are not
    looked at. Returns doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker(Counter, path)
        for batch in sliced(batches):
            counts = [counter.count(text) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_bytes"], pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    texts = _texts(df, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = texts.mapInArrow(run, f"doc_id {_id_type(df, id_col)}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and decoded text of every text; nothing is shuffled.

    Null and empty texts have no ids and decode to the empty text. Texts are taken whole; repeated rows are encoded
    each; an empty table gives an empty result; other columns of df are not looked at. Returns doc_id, ids, decoded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker(Encoder, path)
        for batch in sliced(batches):
            ids = [encoder.encode(text) for text in batch["text"].to_pylist()]
            arrays = [batch["doc_id"], pa.array(ids, pa.list_(pa.int32())), pa.array(map(encoder.decode, ids), pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    return _texts(df, id_col, text_col).mapInArrow(run, f"doc_id {_id_type(df, id_col)}, ids array<int>, decoded string")


def encode_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """As encode_texts, but with digests in place of ids and decoded text, so that results stay narrow.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, and with_ids the ids too. The digest of a text without ids
    is that of the empty text.
    """
    kinds = f"doc_id {_id_type(df, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker(Encoder, path)
        for batch in sliced(batches):
            counts, shas, backs, lists = [], [], [], []
            for text in batch["text"].to_pylist():
                n, shown, back = encoder.digest(text)
                counts.append(n)
                shas.append(hashlib.sha256(shown.encode()).hexdigest())
                backs.append(hashlib.sha256(back.encode()).hexdigest())
                if with_ids:
                    lists.append(np.array(shown.split(), np.int32))
            arrays = [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(backs, pa.string())]
            if with_ids:
                arrays.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "ids"][: len(arrays)])

    return _texts(df, id_col, text_col).mapInArrow(run, kinds + ", ids array<int>" * with_ids)
