"""Language identification by compression with one dictionary per language."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



#: A text is compressed in blocks of this many bytes, so that the dictionary counts for all of it.
BLOCK = 4096

LETTER = regex.compile(r"\p{L}")

NO_WORD = re.compile(r"[\W\d_]+")


def plain(text: str) -> bytes:
    """The whole text in lower case, with one space for each run of anything but letters."""
    return NO_WORD.sub(" ", text.lower()).encode()


def sample_texts(df: DataFrame, lang: Column, may_learn: Column, id_col: str, text_col: str, docs: int) -> DataFrame:
    """At most `docs` texts of each language, chosen by a hash of the id.

    Counts per language give each its own share of the hash range, twice as wide as needed; rows within it are
    then ranked. So the sample is bounded however many rows there are, and reruns agree.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), lang.alias("lang"), may_learn.alias("ok"))
    rows = rows.filter("ok and lang is not null and text is not null and text <> ''").drop("ok")
    rows = rows.withColumn("place", F.xxhash64(F.lit(7), "doc_id").cast("double") / float(1 << 63))  # -1 to 1
    counts = rows.groupBy("lang").count()
    near = F.col("place") < 4.0 * docs / F.col("count") - 1.0
    order = Window.partitionBy("lang").orderBy("place", "doc_id", F.xxhash64("text"))
    return (
        rows.join(F.broadcast(counts), "lang")  # one row for each language
        .filter(near)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= docs)
        .select("lang", "text", "rank")
    )


def learn(sample: DataFrame, dictionary_bytes: int) -> dict[str, bytes]:
    """For each language the whole sampled texts one after another, as raw dictionary content."""
    share = F.lit(max(1, dictionary_bytes))
    kept = Window.partitionBy("lang").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.octet_length("text")).over(kept), F.lit(0))
    rows = sample.withColumn("used", used).filter(F.col("used") < share).select("lang", "rank", "text").collect()
    texts: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        texts.setdefault(row["lang"], []).append(plain(row["text"]))
    return {lang: b" ".join(parts)[:dictionary_bytes] for lang, parts in texts.items()}


class Classifier:
    """Compresses texts with each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int):
        self.langs = sorted(dictionaries)
        self.compressors = []
        for lang in self.langs:
            raw = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False))

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin of a text; `und`, 0 and 0 without a letter or without anything learned."""
        if not text or not self.langs or not LETTER.search(text):
            return "und", 0.0, 0.0
        data = plain(text)
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]
        least = min(sizes)
        best = sizes.index(least)
        others = sorted(sizes[:best] + sizes[best + 1 :])
        margin = (others[0] - least) / others[0] if others else 1.0
        score = 1 / sum(math.exp(-0.5 * min(1000, size - least)) for size in sizes)
        return self.langs[best], score, margin





def identify_language(
    df: DataFrame,
    may_learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = 256,
    dictionary_bytes: int = 110_000,
    level: int = 6,
    min_margin: float = 0.01,
) -> DataFrame:
    """The language whose dictionary compresses a text best.

    Learns from rows where may_learn holds and the language is not null, at most sample_docs whole texts and
    dictionary_bytes bytes of each language (both bounds fix what the driver gathers and every task holds). Every
    whole text is then compressed in blocks with each language's dictionary; nothing is shuffled. rejected marks
    texts whose best size is not smaller than the second best by the share min_margin.

    `und` with score 0 is given to null texts, texts without a letter, and all texts if nothing can be learned; they
    are rejected. Ties go to the language that comes first by code point. Repeated rows are judged each; an empty
    table gives an empty result; other columns of df are not looked at.

    Returns doc_id, lang_pred, score (0 to 1), margin, rejected.
    """
    sample = sample_texts(df, F.col(lang_col), may_learn, id_col, text_col, sample_docs)
    dictionaries = learn(sample, dictionary_bytes)
    held = df.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(held.value, level)
        for batch in batches:
            found = [classifier.classify(text) for text in batch["text"].to_pylist()]
            langs, scores, margins = ([x[i] for x in found] for i in range(3))
            arrays = [batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score", "margin"])

    kind = df.schema[id_col].dataType.simpleString()
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = texts.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, margin double")
    return found.withColumn("rejected", (F.col("lang_pred") == "und") | (F.col("margin") < min_margin))
