"""The pipeline against a plain version of each stage on that stage's own input."""

import collections

import corpus_pipeline
from perigee.llm import mixing, registry
from perigee.llm.common import materialize, read_table
from test_operators import components
from tokenizers import Tokenizer


def test_stages(spark, small):
    docs = read_table(spark, small, "documents")
    columns = docs.columns
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, small, "labels").collect()}
    outputs = [docs]
    for _, stage in corpus_pipeline.STAGES:
        outputs.append(materialize(stage(spark, outputs[-1], small), "test-stage"))
    assert all(out.columns == columns for out in outputs[:-1])
    start, good, single, apart, mixed, encoded = [out.collect() for out in outputs]

    kept = {r["doc_id"] for r in good}
    assert [i for i in labels if labels[i] == 1 and i not in kept] == []

    by_text = collections.defaultdict(list)
    for r in good:
        by_text[r["text"]].append(r["doc_id"])
    assert sorted(r["doc_id"] for r in single) == sorted(max(ids) for ids in by_text.values())

    rows = sorted(single, key=lambda r: r["doc_id"])
    _, roots = components([r["text"] for r in rows])
    first = {}
    for r, root in zip(rows, roots, strict=True):
        first.setdefault(root, r["doc_id"])
    assert sorted(r["doc_id"] for r in apart) == sorted(first.values())

    words = collections.Counter()
    for r in mixed:
        words[r["doc_id"]] += len(r["text"].encode().split())
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(outputs[3]).collect() if r["taken"]}
    assert dict(words) == taken

    library = Tokenizer.from_file(registry.vocabulary_path())
    expected = collections.Counter(tuple(library.encode(r["text"], add_special_tokens=False).ids) for r in mixed)
    assert collections.Counter(tuple(r["ids"]) for r in encoded) == expected
    assert len(start) >= len(good) >= len(single) >= len(apart)


def test_awkward_rows_and_empty_tables(spark, tmp_path):
    """Nulls, empty and repeated rows, and no rows at all, go through every stage."""
    texts = [None, "", " ", "a", "one two three four five six seven", "one two three four five six seven", "x " * 5000]
    rows = [(i, t, None, ["s", None][i % 2], None) for i, t in enumerate(texts)] + [(None, "no id here at all", "en", "s", 1)] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(3, 1, 0), (4, None, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, held in (("some", rows), ("none", [])):
        docs = spark.createDataFrame(held, schema)
        for step, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, str(tmp_path)), f"test-{name}")
            if step != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert bool(docs.count()) == bool(held)
