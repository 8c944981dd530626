"""License phrases and license notices in texts. DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import Tables, small_or_shuffled, text_key

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a license, and its label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices that stand for a license where they aren't worded quite so.
TEMPLATES = {
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

#: Different words of all templates together; they are written into the plan.
MOST_TOKENS = 5_000


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none of null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(WORD), 0)


def phrase_places(words: Column, phrases: dict[str, str]) -> dict[str, Column]:
    """n_base, first_word, last_word and base_labels of an array of words.

    The words are joined by spaces, so a phrase's words stand together where the phrase stands between spaces; how many
    words come before or after is the number of spaces there. The joined text is a column that callers name `_joined`.
    """
    joined = F.col("_joined")
    spaces = lambda text: F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))
    found, first, last, labels = [], [], [], []
    for phrase, label in phrases.items():
        there, between = F.contains(joined, F.lit(f" {phrase} ")), f" {phrase} "
        found.append(F.when(there, F.regexp_count(joined, F.lit(f"(?<= ){phrase}(?= )"))).otherwise(0))
        first.append(F.when(there, spaces(F.substring_index(joined, between, 1))))
        last.append(F.when(there, F.size(words) - len(phrase.split(" ")) - spaces(F.substring_index(joined, between, -1))))
        labels.append(F.when(there, F.lit(label)))
    return {
        "n_base": reduce(lambda a, b: a + b, found).cast("long"),
        "first_word": F.array_min(F.array(*first)).cast("long"),
        "last_word": F.array_max(F.array(*last)).cast("long"),
        "_base": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }


def rare_first(rows: DataFrame, templates: dict[str, str]) -> list[str]:
    """The templates' words, those first that the fewest rows (with words) have; ties in order of the word.

    Only sums of these words reach the driver, MOST_TOKENS at most.
    """
    vocabulary = sorted({w for t in templates for w in t.split(" ")})
    if len(vocabulary) > MOST_TOKENS:
        raise ValueError(f"templates have {len(vocabulary)} words, more than {MOST_TOKENS}")
    held = rows.select(F.explode(F.array_intersect(literal(vocabulary), "words")).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def literal(words: list[str]) -> Column:
    """An array of fixed words as one literal."""
    return F.split(F.lit(" ".join(words)), " ") if words else F.array().cast("array<string>")


def prefixes(spark, templates: dict[str, str], order: list[str], percent: int) -> DataFrame:
    """One row for each word of a template's prefix: word, place in the template (from 0), tokens (rare first), need, label.

    A block that holds `need` of the template's words has one of its first len - need + 1 words.
    """
    rows = []
    for text, label in templates.items():
        tokens = sorted(set(text.split(" ")), key=order.index)
        need = -(-percent * len(tokens) // 100)
        rows += [(word, i, tokens, need, label) for i, word in enumerate(tokens[: len(tokens) - need + 1])]
    return spark.createDataFrame(rows, "word string, place int, tokens array<string>, need int, label string")


def notice_matches(rows: DataFrame, templates: dict[str, str], percent: int, block_words: int) -> DataFrame:
    """doc_id, text_key, label and containment of each block of a text (with words) that holds a template's share of words.

    Blocks are block_words words long and begin every half of that. Of a block only the templates' words are looked at,
    rare ones first; it is joined by each with the templates that have the word in their prefix. What is left of both
    behind the word bounds the words in common (positional filter), and the block's words bound them too (length
    filter). The first word in common alone makes the pair, so that each is verified once.
    """
    order = rare_first(rows, templates)
    spark = rows.sparkSession
    table = prefixes(spark, templates, order, percent)
    firsts = {r["word"] for r in table.select("word").collect()}  # of the fixed templates
    least = min(r["need"] for r in table.select("need").collect())
    step = block_words // 2
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - step - 1, F.lit(0)), F.lit(step))
    some = rows.filter(F.arrays_overlap("words", literal(sorted(firsts))))
    blocks = some.select("doc_id", "text_key", F.explode(F.transform(starts, lambda i: F.array_intersect(literal(order), F.slice("words", i + 1, block_words)))).alias("block"))
    keyed = blocks.filter(F.size("block") >= least).select("*", F.posexplode("block").alias("at", "word"))
    joined = keyed.join(F.broadcast(table), "word")  # of the fixed templates, MOST_TOKENS words
    left = F.least(F.size("tokens") - F.col("place"), F.size("block") - F.col("at"))
    is_first = ~F.arrays_overlap(F.slice("tokens", F.lit(1), F.col("place")), F.col("block"))
    shared = F.size(F.array_intersect("tokens", "block"))
    pairs = joined.filter((left >= F.col("need")) & is_first).withColumn("shared", shared).filter("shared >= need")
    return pairs.select("doc_id", "text_key", "label", (F.col("shared") / F.size("tokens")).alias("containment"))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, percent: int = 80, block_words: int = 64) -> DataFrame:
    """For each row: n_words, the places of license phrases, their labels, and the labels of license notices too.

    n_base counts the places where a phrase's words stand together; first_word and last_word are the smallest and largest
    of these (words from 0), null without any. labels has base_labels and those of templates whose words a block of
    text holds to `percent` or more; score is 1 with a phrase, else the highest share that was found, else 0. Word order
    inside a block doesn't count.

    Null and empty texts have no words and no labels. Ids may be null or repeated: rows are told apart by id and text.
    An empty table gives no rows. Other columns aren't looked at.
    """
    templates = TEMPLATES if templates is None else templates
    rows = df.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("text_key"), words_of(F.col(text_col)).alias("words"))
    tables = Tables(df.sparkSession)
    found = notice_matches(rows, templates, percent, block_words).groupBy("doc_id", "text_key").agg(F.collect_set("label").alias("_labels"), F.max("containment").alias("_share"))
    found = tables.write(found.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}), "license-notices")
    joined_words = rows.withColumn("_joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    based = joined_words.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), *[c.alias(n) for n, c in phrase_places(F.col("words"), PHRASES).items()])
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    both = based.join(small_or_shuffled(found, found.count(), 128), same, "left")
    labels = F.array_sort(F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_share", F.lit(0.0)))
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("_base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score")
    )
