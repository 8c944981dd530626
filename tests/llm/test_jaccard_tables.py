"""Tables and shuffle files that the Jaccard join has done with."""

from __future__ import annotations

import itertools
import random

import pyarrow as pa
import pytest

from perigee.llm import common, jaccard
from perigee.sources.scratch import list_folders, shared_folder


def test_rows_and_postings_are_gone_before_nodes_are_compared(spark, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join([*words, "more"]), " ".join(words[::-1]), "few words", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.range(1).write.mode("overwrite").parquet(f"{shared_folder(spark)}/jaccard-before")
    before, seen, last = set(list_folders(spark, shared_folder(spark))), [], jaccard.Join.last_rounds
    monkeypatch.setattr(jaccard.Join, "last_rounds", lambda self: (seen.extend(list_folders(spark, shared_folder(spark))), last(self))[1])
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(df).collect()}
    assert found == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}
    own = {name.rsplit("-", 1)[0] for name in set(seen) - before}
    assert "jaccard-lists" in {name[:13] for name in set(seen) - before}
    assert not {x for x in own if x.startswith(("jaccard-rows", "jaccard-shared"))}


def small_words_and_copies(rng: random.Random) -> list[str]:
    """Texts of three words that share most rare shingles but are not alike, and chains of near copies."""
    texts = [" ".join(rng.choices("abc", k=30)) for _ in range(40)]
    for letter in "xyz":
        base = [f"{letter}{i}" for i in range(80)]
        texts += [" ".join(base[i : i + 60]) for i in range(0, 20, 2)]
    return texts


def smallest_linked(texts: list[str]) -> dict[int, int]:
    """The smallest number that links reach, by comparing all pairs."""
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    least = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(a):
                if least[a] != least[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    return dict(enumerate(least))


def test_sets_are_read_only_of_nodes_that_are_compared(spark, monkeypatch):
    """Before, the sets of all nodes with a list were written, and all of them shuffled once more."""
    rng, asked, sets_of = random.Random(4), set(), jaccard.sets_of
    near = [f"n{i}" for i in range(40)]
    texts = [" ".join(near), " ".join([*near, "more"]), *(" ".join(rng.choices("abc", k=30)) for _ in range(40))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(jaccard, "sets_of", lambda t, wanted, *a: (asked.update(r["doc_id"] for r in wanted.collect()), sets_of(t, wanted, *a))[1])
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(df).collect()}
    assert found == smallest_linked(texts)
    assert {0, 1} <= asked and len(asked) < 10


@pytest.mark.parametrize("limit", [common.BROADCAST_BYTES, 0])
def test_links_with_and_without_broadcasts(spark, monkeypatch, limit):
    texts = small_words_and_copies(random.Random(5))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for module in (common, jaccard):
        monkeypatch.setattr(module, "BROADCAST_BYTES", limit, raising=False)
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 2)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(df).collect()}
    assert found == smallest_linked(texts)


def test_shared_keys_tell_lists_of_two_wherever_batches_end():
    rng = random.Random(6)
    for _ in range(200):
        sizes = [rng.choice([1, 1, 2, 2, 3, 4, 7]) for _ in range(rng.randint(1, 12))]
        keys = [key for key, size in enumerate(sizes) for _ in range(size)]
        table = pa.table({"node": range(len(keys)), "n": [9] * len(keys), "pos": pa.array([0] * len(keys), pa.int32()), "key": keys})
        cuts = sorted(rng.choices(range(len(keys) + 1), k=rng.randint(0, 6)))
        batches = [b for x, y in itertools.pairwise([0, *cuts, len(keys)]) for b in table.slice(x, y - x).to_batches()]
        found = [(r["node"], r["key"], r["two"]) for b in jaccard.shared_keys(iter(batches)) for r in b.to_pylist()]
        assert found == [(node, key, sizes[key] == 2) for node, key in enumerate(keys) if sizes[key] > 1]
