"""Phrase mining against plain counting."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.llm import phrases as ops

SCHEMA = "doc_id long, text string, lang string, n long, phrase int, score int, word int"


def plain_phrases(rows, least, most):
    """Everything by dictionaries of tuples of words."""
    counts, totals = collections.Counter(), collections.Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    found = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    inside = set()
    for (lang, words), n in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, words[i : i + k])
                if n >= counts[part]:
                    inside.add(part)
    out = collections.defaultdict(list)
    for (lang, words), a in found.items():
        if (lang, words) in inside:
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]], totals[lang]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n, -s) for lang, rows in out.items() for i, (s, a, p, l, r, n) in enumerate(sorted(rows)[:most]))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    words = ["Aa", "b", "c", "É", "d-e", "f", "\x0e", "日本"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", "", ".", "\t", "\n", " ,"]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    made = [(t, rng.choice(["en", "de", None, ""])) for t in texts]
    hot = [("one two three four five six " * 40, "en")] * 12  # one beginning has many suffixes
    return made + hot + [(None, "en"), ("", "en"), (" \t.\n", "en"), ("x" * 200_000, "en"), ("alone", "fr"), made[0], made[0]]


@pytest.mark.parametrize("together", [1 << 21, 64])
def test_phrases_are_those_of_plain_counting(spark, rows, monkeypatch, together):
    monkeypatch.setattr(ops, "SORTED_TOGETHER", together)  # 64: several routes, and hot beginnings dealt by more words
    docs = spark.createDataFrame([(i, t, g, 1, 2, 3, 4) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(4)
    found = ops.mine_phrases(docs, least=10, most=30).collect()
    assert sorted(map(tuple, found)) == plain_phrases(rows, 10, 30)
    assert max(r["rank"] for r in found) == 30


def test_hot_beginnings_are_found(spark, rows, monkeypatch):
    monkeypatch.setattr(ops, "SORTED_TOGETHER", 64)
    docs = ops.worded(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    everything = np.full(1 << ops.BITMAP_BITS >> 3, 255, np.uint8)
    assert ops.often_begun(docs, 10_000, everything).count() >= 6 * 3


def test_quicksort_counts_equal_parts():
    rng = np.random.default_rng(1)
    columns = rng.integers(0, 4, (5, 3_000)).astype(np.int32)
    columns[:2] += 1
    for i in range(3, 5):
        columns[i][columns[i - 1] == 0] = 0
    weights = rng.integers(1, 4, 3_000)
    expected = collections.Counter()
    for row, w in zip(columns.T.tolist(), weights.tolist()):
        for k in range(2, 6):
            if 0 not in row[:k]:
                expected[tuple(row[:k])] += w
    for known_from in (2, 4):
        found = {tuple(columns[:k, at].tolist()): n for at, k, n in ops.quicksort_counts(columns, weights, 40, known_from)}
        assert found == {p: n for p, n in expected.items() if n >= 40 or len(p) < known_from}


def test_scores_pass_64_bits(spark):
    big = 3 * 10**15
    phrases = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, words int, n long")
    words = spark.createDataFrame([("en", "a", big + 7), ("en", "b", big + 11)], "lang string, word string, n long")
    totals = spark.createDataFrame([("en", 9 * 10**17)], "lang string, n long")
    assert ops.score_phrases(phrases, words, totals, 1).first()["score"] == 1000 * big * 9 * 10**17 // ((big + 7) * (big + 11))


def test_no_documents(spark):
    assert ops.mine_phrases(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ops.mine_phrases(spark.createDataFrame([], SCHEMA).withColumn("text", F.lit(None).cast("string"))).count() == 0
