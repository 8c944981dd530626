"""Each operator against brute force on a small table of awkward rows."""

import collections
import hashlib
import random
import tempfile
import time
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perigee.llm import bpe, common, exact_dedup, hamming, jaccard, language, line_dedup, mixing, quality, registry, sharding
from perigee.llm.common import fold, read_table

CLASHES = {"key": 1, "size": 2, "label": "x", "part": 3, "node": 4, "sign": b"y", "bucket": 5, "rank": 6, "start": 7, "total": 8, "text_key": 9}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))) for _ in range(200)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    near = []
    for text in base[:25]:
        parts = text.split(" ")
        parts[rng.randrange(len(parts))] = "zz"
        near.append(" ".join(parts))
    lines = ["\n".join(rng.sample(base, 2)) for _ in range(10)]
    odd = [None, None, "", "", "  \n\t", "a", "one two", "ONE  two", "It's <|endoftext|> ÉÀ Σίσυφος ΟΔΟΣ", "x" * 3000, "wörd " * 2000, "the line that comes again\nthe line that comes agaim\nthe line that comes again"]
    return base + near + lines + odd + base[:10] + base[:4] * 3


@pytest.fixture(scope="module")
def rows():
    texts = awkward_texts()
    sources = ["b", "a", None, "", "c", "b", "b"]
    made = [(i * 3, t, "en", sources[i % 7], 0) for i, t in enumerate(texts)]
    return [*made, made[5], made[5], (None, "a row without an id", None, None, None), (None, texts[0], "en", "a", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return frame.withColumns({name: F.lit(value) for name, value in CLASHES.items()})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sharding(docs, rows, nothing):
    found = sharding.shard_by_bytes(docs, n_shards=5).collect()
    size = lambda text: len((text or "").encode()) + 1
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in found) == sorted(
        (i if i is not None else -1, size(t), zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    held, total, largest = collections.defaultdict(list), sum(r["size"] for r in found), max(r["size"] for r in found)
    for r in found:
        held[r["shard"]].append(r)
    assert all(sorted(r["slot"] for r in held[s]) == list(range(len(held[s]))) for s in held)
    assert all(abs(sum(r["size"] for r in held[s]) - total / 5) <= largest for s in held)
    order = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in order]
    assert ids == sorted(ids)
    assert sharding.shard_by_bytes(nothing).count() == 0


def test_exact_dedup(docs, rows, nothing):
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    found = exact_dedup.exact_duplicates(docs, capacity=2).collect()
    assert len(found) == len(rows)
    keep = {hashlib.sha256(t.encode()).hexdigest(): (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}
    kept = collections.Counter()
    for r in found:
        assert (r["keep_id"], r["group_size"]) == keep[r["text_sha256"]]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1}
    left = exact_dedup.distinct_texts(docs)
    assert left.columns == docs.columns
    assert sorted((r["text"] or "") for r in left.collect()) == sorted(groups)
    assert exact_dedup.exact_duplicates(nothing).count() == 0


def test_directory_splits_until_buckets_fit():
    cells = {i * 3 % 16384: 5 for i in range(3000)}
    directory = exact_dedup.grow_directory(cells, 40)
    assert [cell for cell, _, _ in directory] == list(range(16384))
    held = collections.Counter()
    for cell, bucket, depth in directory:
        held[bucket, depth] += cells.get(cell, 0)
    assert all(n <= 40 or depth == exact_dedup.MAX_DEPTH for (_, depth), n in held.items())
    assert exact_dedup.grow_directory({}, 1)[-1] == (16383, 0, 0)
    assert max(d for _, _, d in exact_dedup.grow_directory({7: 99}, 1)) == exact_dedup.MAX_DEPTH


def test_encoding_and_counts(docs, rows, nothing):
    path = registry.vocabulary_path()
    library = Tokenizer.from_file(path)
    texts = {t or "" for _, t, *_ in rows}
    expected = {t: library.encode(t, add_special_tokens=False).ids for t in texts}
    by_sha = {hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(): ids for ids in expected.values()}
    for r in bpe.encode_digests(docs, path, with_ids=True).collect():
        ids = by_sha[r["ids_sha256"]]
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    whole = {r["doc_id"]: r for r in bpe.encode_texts(docs, path).collect()}
    counts = {r["doc_id"]: r for r in bpe.count_tokens(docs, path, limit=100).collect()}
    for i, t, *_ in rows[:-1]:
        if i is not None:
            assert whole[i]["ids"] == expected[t or ""]
            assert counts[i]["n_tokens"] == len(expected[t or ""]) and counts[i]["n_bytes"] == len((t or "").encode())
            assert counts[i]["over_limit"] == (len(expected[t or ""]) > 100)
    assert bpe.count_tokens(nothing, path).count() == bpe.encode_digests(nothing, path).count() == 0


def test_no_token_reaches_across_a_cut():
    encoder = bpe.Encoder(registry.vocabulary_path())
    merged = lambda piece: [s for s in bpe.merge(encoder.vocabulary.symbols(piece), encoder.vocabulary.ranks)[0] if s]
    rng = random.Random(1)
    for _ in range(500):
        piece = "".join(rng.choice("abctheqzx'éß😀!#") for _ in range(rng.randint(1, 20)))
        assert list(encoder.encode_piece(piece)) == [encoder.vocabulary.ids[s] for s in merged(piece)]


def test_quality(spark, docs, nothing):
    small = "/root/testdata/sf0.01"
    scored = registry.op4_quality(spark, small).join(read_table(spark, small, "labels"), "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in scored) / len(scored) > 0.95
    clean = [r["predicted"] for r in scored if r["quality"] == 1]
    assert sum(clean) / len(clean) > 0.97
    at = fold(F.col("doc_id"), 5)
    unlabelled = spark.createDataFrame([], "doc_id long, quality int")
    found = quality.score_quality(docs, unlabelled, at != 0, at == 1).collect()
    assert {r["score"] for r in found} == {0.5} and len(found) == docs.count()
    labels = docs.select("doc_id", F.length("text").alias("quality")).withColumn("quality", (F.col("quality") > 50).cast("int"))
    found = quality.score_quality(docs, labels, at != 0, at == 1).collect()
    assert all(0 <= r["score"] <= 1 for r in found) and len(found) == docs.count()
    assert quality.score_quality(nothing, labels, at != 0, at == 1).count() == 0


def test_isotonic():
    import numpy as np

    good, n = np.array([1.0, 0.0, 3.0, 2.0, 5.0]), np.array([2.0, 2.0, 4.0, 4.0, 5.0])
    fitted = quality.pool_adjacent(good, n)
    assert (np.diff(fitted) >= 0).all() and abs((fitted * n).sum() - good.sum()) < 1e-9
    assert fitted.tolist() == [0.25, 0.25, 0.625, 0.625, 1.0]


def test_topk(spark):
    rng = random.Random(5)
    vectors = [(i, [rng.choice((-1.0, 1.0)) for _ in range(64)]) for i in range(300)]
    vectors += [(i, vectors[7][1]) for i in range(300, 340)] + [(340, None), (None, [1.0] * 64), (341, [None, float("nan")] + [1.0] * 3), (20, vectors[20][1])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("code", F.lit(1)).withColumn("block", F.lit(1))
    code = lambda v: sum(1 << i for i, x in enumerate(v) if x is not None and x == x and x > 0)
    known = [(i, code(v)) for i, v in vectors if i is not None and v is not None]
    expected = {}
    for q, c in known:
        if q % 20 == 0:
            expected[q] = sorted(((c ^ d).bit_count(), i) for i, d in known)[:10]
    found = collections.defaultdict(list)
    for r in hamming.nearest_codes(frame, block_rows=100).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["distance"], r["vec_id"]))
    assert dict(found) == expected
    assert hamming.nearest_codes(frame.limit(0)).count() == 0


def components(texts, width=5, percent=80):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
    parent = list(range(len(texts)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    return sets, [root(a) for a in range(len(texts))]


def test_jaccard(docs, rows, nothing):
    sets, roots = components([t for _, t, *_ in rows])
    smallest = {}
    for (i, *_), r in zip(rows, roots, strict=True):
        if i is not None:
            smallest[r] = min(i, smallest.get(r, i))
    expected = sorted((-1 if i is None else i, len(s), smallest.get(r, -1)) for (i, *_), s, r in zip(rows, sets, roots, strict=True))
    found = jaccard.near_duplicates(docs).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], -1 if r["component_id"] is None else r["component_id"]) for r in found) == expected
    assert jaccard.near_duplicates(nothing).count() == 0


def test_jaccard_in_a_large_group(spark, monkeypatch):
    """Many near copies, of which most are linked only through others; blocks and rounds are made small."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(120):
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(60)] = f"x{rng.random()}"
        texts.append(" ".join(text))
    texts += [" ".join(f"y{rng.random()}" for _ in range(30)) for _ in range(30)]
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 16)
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 1)
    _, roots = components(texts)
    smallest = {r: roots.index(r) for r in roots}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(frame).collect()}
    assert found == {i: smallest[r] for i, r in enumerate(roots)}
    left = jaccard.one_of_each(frame)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(smallest.values())


def test_language(spark, docs, nothing):
    small = "/root/testdata/sf0.01"
    found = registry.op7_language(spark, small).join(read_table(spark, small, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) / len(found) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)
    judged = language.identify_language(docs, F.lit(True)).collect()
    assert len(judged) == docs.count()
    empty = {r["doc_id"] for r in docs.collect() if not any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in judged if r["lang_pred"] == "und"} == empty
    assert {r["lang_pred"] for r in language.identify_language(docs, F.lit(False)).collect()} == {"und"}
    assert language.identify_language(nothing, F.lit(True)).count() == 0


def test_mixing(docs, rows, nothing):
    found = mixing.mix_sources(docs, block_words=4).collect()
    size = lambda text: len([w for w in (text or "").encode().split()])
    assert sorted(r["size"] for r in found) == sorted(size(t) for _, t, *_ in rows)
    sizes = collections.Counter()
    for _, t, _, source, _ in rows:
        sizes[source] += size(t)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and level * weight[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    target = {s: 3.0 * sizes[s] if s in capped else level * weight[s] for s in names}
    taken = collections.Counter()
    by_size = {(sizes[s], round(target[s], 6)): s for s in names}
    for r in found:
        taken[by_size[r["source_size"], round(r["target"], 6)]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 16 + 0.02 * target[s] for s in names)
    assert sorted(map(repr, mixing.mix_sources(docs, block_words=4).collect())) == sorted(map(repr, found))
    assert mixing.mix_sources(nothing).count() == 0
    unique = docs.dropDuplicates(["doc_id", "text"])
    mixed = mixing.mixed_texts(unique, block_words=4)
    assert mixed.columns == docs.columns
    words = collections.Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += size(r["text"])
    expected = collections.Counter()
    for r in mixing.mix_sources(unique, block_words=4).collect():
        expected[r["doc_id"]] += r["taken"]
    assert +words == +expected


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def test_lines(docs, rows, nothing):
    every = [(-1 if i is None else i, n, line) for i, t, *_ in rows if t is not None for n, line in enumerate(t.split("\n"))]
    first = {}
    for i, n, line in every:
        if line:
            first[line] = min((i, n), first.get(line, (i, n)))
    keep = {}
    for line, at in first.items():
        close = [b for other, b in first.items() if within_one(line, other)]
        keep[line] = min([at, *close])
    expected = sorted((i, n, len(line), *(keep[line] if line else (i, n))) for i, n, line in every)
    null = lambda x: -1 if x is None else x
    found = line_dedup.duplicate_lines(docs).collect()
    assert sorted((null(r["doc_id"]), r["line_no"], r["n_chars"], null(r["keep_doc_id"]), r["keep_line_no"]) for r in found) == expected
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == (r["keep_doc_id"], r["keep_line_no"])) for r in found)
    assert line_dedup.duplicate_lines(nothing).count() == 0
    unique = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    assert line_dedup.without_duplicate_lines(unique).columns == docs.columns


def test_short_lines(spark):
    """Lines of every length are compared within one edit by the registered query; many share a variant."""
    rng = random.Random(4)
    lines = ["".join(rng.choice("abcdé") for _ in range(rng.randint(0, 9))) for _ in range(250)]
    lines += [chr(200 + i) for i in range(150)] + ["Anth.", "Onth.", "The anhely eran.", "The, anhely eran.", "s" * 19, "s" * 20]
    rng.shuffle(lines)
    texts = ["\n".join(lines[i : i + 7]) for i in range(0, len(lines), 7)]
    every = [(i, n, line) for i, t in enumerate(texts) for n, line in enumerate(t.split("\n"))]
    first = {}
    for i, n, line in every:
        first.setdefault(line, (i, n))
    expected = []
    for i, n, line in every:
        near = [at for other, at in first.items() if other and within_one(line, other)]
        expected.append((i, n, *(min(near) if line else (i, n))))
    folder = tempfile.mkdtemp(prefix="spark-lines-")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    found = registry.op10_line_dedup(spark, folder).collect()
    assert sorted((r["doc_id"], r["line_no"], r["keep_doc_id"], r["keep_line_no"]) for r in found) == expected


def test_long_lines(spark):
    """Lines around the length from which running sums are used, and of a million letters, are compared as others are."""
    rng = random.Random(6)
    letters = "abcdé😀"
    lines = []
    for n in (line_dedup.LONG - 1, line_dedup.LONG, line_dedup.LONG + 1, line_dedup.LONG + 2, 3_000):
        base = "".join(rng.choice(letters) for _ in range(n))
        at = rng.randrange(n)
        lines += [base, base[:at] + base[at + 1 :], base[:at] + "x" + base[at + 1 :], base[:at] + "yz" + base[at:], base[:at] + "z" + base[at:]]
    rng.shuffle(lines)
    first = {line: (i, 0) for i, line in reversed(list(enumerate(lines)))}
    expected = {i: min([at for other, at in first.items() if within_one(line, other)])[0] for i, line in enumerate(lines)}
    frame = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert {r["doc_id"]: r["keep_doc_id"] for r in line_dedup.duplicate_lines(frame).collect()} == expected
    big = "".join(rng.choices(letters, k=1_000_000))
    frame = spark.createDataFrame([(1, big), (2, big[:400_000] + "x" + big[400_001:]), (3, big[:-1]), (4, big[::-1])], "doc_id long, text string")
    began = time.perf_counter()
    assert {r["doc_id"]: r["keep_doc_id"] for r in line_dedup.duplicate_lines(frame).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    assert time.perf_counter() - began < 120


def test_verification_drops_what_is_further_apart(spark):
    texts = spark.createDataFrame([(1, 1, (0, 0), "some line"), (2, 2, (1, 0), "some lime"), (3, 3, (2, 0), "other")], "h1 long, h2 long, first struct<d:long,n:int>, line string")
    asked = spark.createDataFrame([(2, 2, (0, 0)), (3, 3, (0, 0))], "h1 long, h2 long, earlier struct<d:long,n:int>")
    assert [r["h1"] for r in line_dedup.verified(asked, texts).collect()] == [2]


def test_mixing_of_small_sources(spark):
    """Beside a large source, sources of 10 to 300 words come to their targets in blocks of the production size."""
    sizes = {"a": 40000} | {f"s{n:03}": n for n in (10, 20, 31, 33, 65, 100, 127, 130, 200, 299, 300)}
    rng = random.Random(6)
    made = []
    for source, left in sizes.items():
        while left:
            n = min(left, rng.randint(1, 200))
            made.append((len(made), " ".join(f"{source}w{i}" for i in range(n)), "en", source, 0))
            left -= n
    frame = spark.createDataFrame(made, SCHEMA).repartition(3)
    source_of = {i: source for i, _, _, source, _ in made}
    found = mixing.mix_sources(frame, block_words=64).collect()
    target = {source_of[r["doc_id"]]: r["target"] for r in found}
    expected = {r["doc_id"]: r["taken"] for r in found if r["taken"]}
    taken = collections.Counter()
    for i, n in expected.items():
        taken[source_of[i]] += n
    assert all(abs(taken[s] - target[s]) <= (192 if s == "a" else max(1, 0.03 * target[s])) for s in sizes)
    words = collections.Counter()
    for r in mixing.mixed_texts(frame, block_words=64).collect():
        words[r["doc_id"]] += len(r["text"].split())
    assert dict(words) == expected


def test_one_of_each_with_repeated_ids(spark):
    """Unrelated texts under one id all stay; of near copies the one of the smallest id does."""
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    made = [(1, texts[0]), (1, texts[1]), (2, texts[1] + " more"), (3, texts[2]), (4, texts[2])]
    frame = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    left = sorted((r["doc_id"], r["text"]) for r in jaccard.one_of_each(frame).collect())
    assert left == [(1, texts[0]), (1, texts[1]), (3, texts[2])]


def test_shards_of_the_mix_have_quotas_of_their_own(docs):
    """The number of shards changes which blocks are drawn, while each source's words stay near its target."""
    takes = [{(r["doc_id"], r["size"]): r["taken"] for r in mixing.mix_sources(docs, block_words=4, n_shards=n).collect()} for n in (1, 7)]
    assert takes[0] != takes[1]
    assert abs(sum(takes[0].values()) - sum(takes[1].values())) <= 0.05 * sum(takes[0].values())


def test_each_shard_by_its_middle_byte(docs, rows):
    size = lambda text: len((text or "").encode()) + 1
    order = sorted(((-1 if i is None else i, size(t), zlib.crc32((t or "").encode())) for i, t, *_ in rows))
    total, before, expected = sum(n for _, n, _ in order), 0, []
    for i, n, crc in order:
        expected.append((i, n, crc, (2 * before + n) * 5 // (2 * total)))
        before += n
    found = sharding.shard_by_bytes(docs, n_shards=5).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in found) == sorted(expected)


def test_written_shards(spark, rows, tmp_path):
    unique = {i: t for i, t, *_ in rows if i is not None}
    frame = spark.createDataFrame(list(unique.items()), "doc_id long, text string")
    sharding.write_shards(frame, f"file://{tmp_path}/shards", n_shards=3)
    again = spark.read.parquet(f"file://{tmp_path}/shards")
    assert {r["doc_id"]: r["text"] for r in again.collect()} == unique
    assert {r["shard"] for r in again.collect()} == {0, 1, 2}


def test_directory_of_several_levels(spark, monkeypatch):
    """Keys that share their first bits go on to deeper levels, and buckets hold no more than their capacity."""
    keys = [*range(40), *(5 << 60 | n for n in range(30)), *(-n for n in range(1, 30)), *(n << 50 for n in range(1, 50))]
    frame = spark.createDataFrame([(k,) for k in keys], "key long")
    found = exact_dedup.buckets(frame, 4, exact_dedup.Tables(spark)).collect()
    assert sorted(r["key"] for r in found) == sorted(keys)
    held = collections.Counter((r["bucket"], r["depth"]) for r in found)
    assert max(held.values()) <= 4 and max(r["depth"] for r in found) > exact_dedup.MAX_DEPTH
    assert all((r["key"] ^ r["bucket"]) % (1 << 64) >> (64 - r["depth"]) == 0 for r in found if r["depth"])


def test_dedup_without_broadcasts(docs, rows, monkeypatch):
    """Beyond the bound of broadcasts, a bitmap picks the texts that are shuffled; results are the same."""
    plain = sorted(map(repr, exact_dedup.exact_duplicates(docs).collect()))
    left = sorted(r["text"] or "" for r in exact_dedup.distinct_texts(docs).collect())
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert len(exact_dedup.exact_duplicates(docs).collect()) == len(plain)
    assert sorted(r["text"] or "" for r in exact_dedup.distinct_texts(docs).collect()) == left
    groups = collections.Counter(t or "" for _, t, *_ in rows)
    for r in exact_dedup.exact_duplicates(docs).collect():
        assert r["group_size"] == groups[next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])]


def test_long_vectors(spark):
    """Vectors of 150 numbers make codes of three words; some are shorter."""
    rng = random.Random(8)
    vectors = [(i, [rng.choice((-1.0, 1.0)) for _ in range(150)]) for i in range(120)] + [(120, [1.0] * 70)]
    code = lambda v: sum(1 << i for i, x in enumerate(v) if x > 0)
    expected = {q: sorted(((code(v) ^ code(w)).bit_count(), j) for j, w in vectors)[:3] for q, v in vectors if q % 20 == 0}
    found = collections.defaultdict(list)
    for r in hamming.nearest_codes(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"), k=3).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["distance"], r["vec_id"]))
    assert dict(found) == expected


def test_very_long_texts(spark):
    """A word of a megabyte and a text of ten megabytes go through as others do."""
    texts = ["x" * 1_000_000, "some words and 12 numbers é " * 370_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = registry.vocabulary_path()
    library = Tokenizer.from_file(path)
    expected = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["n_tokens"] for r in bpe.count_tokens(frame, path).collect()} == expected
    assert {r["doc_id"]: r["n_tokens"] for r in bpe.encode_digests(frame, path).collect()} == expected
    assert {r["doc_id"]: r["n_shingles"] for r in jaccard.near_duplicates(frame).collect()} == {0: 1, 1: 6}
