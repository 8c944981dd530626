"""License scan against a plain loop over all blocks and templates."""

import random
import re

import pytest
from pyspark.sql import functions as F

from perigee.llm import licenses as ops

SCHEMA = "doc_id long, text string, word int, tokens string, label string, block int, at int, place int, words int"


def plain_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    places, base = [], set()
    for phrase, label in ops.PHRASES.items():
        p = phrase.split(" ")
        own = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += own
        base |= {label} if own else set()
    labels, share = set(base), 0.0
    for start in range(0, max(len(words) - 32, 1), 32):
        block = set(words[start : start + 64])
        for template, label in ops.TEMPLATES.items():
            t = set(template.split(" "))
            if 100 * len(t & block) >= 80 * len(t):
                labels.add(label)
                share = max(share, len(t & block) / len(t))
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if places else share


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    prose = lambda n: " ".join(rng.choice(["lorem", "ipsum", "the", "of", "software", "license", "under", "Été"]) for _ in range(n))
    made = [None, "", " .,;", "MIT License", "mit\tlicense mit-license CC BY cc by cc by", "Gnu General  Public\nLicense: Apache License", "apachelicense", "x " * 30_000 + "CC-BY", "É" * 50_000]
    for template in ops.TEMPLATES:
        words = template.split(" ")
        fewer = [w for w in words if rng.random() > 0.15]
        most = words[: len(words) * 7 // 10]
        for body in (words, fewer, most, rng.sample(words, len(words))):
            made.append(prose(rng.randint(0, 200)) + ". " + " ".join(body).upper() + ", " + prose(rng.randint(0, 100)))
    return made + made[3:8]


def test_scan_is_that_of_all_blocks(spark, texts):
    ids = [None if i % 11 == 0 else i // 2 for i in range(len(texts))]  # null and repeated ids
    rows = [(i, t, 1, "t", "l", 2, 3, 4, 5) for i, t in zip(ids, texts)]
    found = ops.scan_licenses(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((i, *plain_scan(t))) for i, t in zip(ids, texts))
    assert any(r["labels"] != r["base_labels"] for r in found)


def test_other_templates_and_thresholds(spark):
    rows = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "alpha beta"), (3, "delta gamma x beta alpha")], "doc_id long, text string")
    found = ops.scan_licenses(rows, templates={"alpha beta gamma delta": "own"}, percent=100).collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in found} == {1: ("own", 1.0), 2: ("", 0.0), 3: ("own", 1.0)}
    with pytest.raises(ValueError):
        ops.scan_licenses(rows, templates={" ".join(f"w{i}" for i in range(ops.MOST_TOKENS + 1)): "x"})


def test_no_documents(spark):
    assert ops.scan_licenses(spark.createDataFrame([], SCHEMA).withColumn("rank", F.lit(1))).count() == 0


def test_no_python_workers(spark, small):
    from perigee.llm.registry import op12_license_scan

    plan = op12_license_scan(spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
