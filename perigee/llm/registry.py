"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm import bpe, conversations, exact_dedup, hamming, jaccard, language, licenses, line_dedup, mixing, phrases, quality, sharding
from perigee.llm.common import fold, read_table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of nearly equal bytes."""
    return sharding.shard_by_bytes(read_table(spark, sf_dir, "documents"), n_shards=16)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical documents."""
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents")).drop("text_key")


def vocabulary_path() -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of all documents, as digests."""
    return bpe.encode_digests(read_table(spark, sf_dir, "documents"), vocabulary_path())


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labelled ones of four folds; the fold 0 is held out."""
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    at = fold(F.col("doc_id"), 5)
    scored = quality.score_quality(documents, labels, may_learn=at != 0, calibrates=at == 1)
    return scored.select("doc_id", (at == 0).alias("held_out"), "score", "predicted")


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every 20th embedding, the 10 nearest of all by the Hamming distance of sign bits."""
    return hamming.nearest_codes(read_table(spark, sf_dir, "embeddings"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by shingle similarity."""
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_key", "label")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three folds; the fold 2 is held out."""
    at = fold(F.col("doc_id"), 4)
    found = language.identify_language(read_table(spark, sf_dir, "documents"), may_learn=at != 2)
    return found.select("doc_id", (at == 2).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes from each."""
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return bpe.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary_path())


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each line of all documents, however short, the earliest line within one edit."""
    return line_dedup.duplicate_lines(read_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of all conversations after a set damage."""
    given = read_table(spark, sf_dir, "conversations")
    summary, repaired = conversations.repair_conversations(conversations.damage_turns(given))
    digests = conversations.conversation_digests(repaired).withColumnRenamed("conv_id", "_id")
    every = given.select(F.col("conv_id").alias("_every")).distinct()
    joined = every.join(summary, F.col("_every").eqNullSafe(F.col("conv_id")), "left").join(digests, F.col("_every").eqNullSafe(F.col("_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return joined.select(F.col("_every").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents."""
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The firmest phrases of each language of all documents."""
    return phrases.mine_phrases(read_table(spark, sf_dir, "documents"))


OP1_SQL = """
WITH RECURSIVE steps AS (  -- the table of CRC-32, by its polynomial
    SELECT b, b::BIGINT AS c, 0 AS n FROM unnest(range(0, 256)) AS each(b)
    UNION ALL
    SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n + 1 FROM steps WHERE n < 8),
crc AS (
    SELECT list(c ORDER BY b) AS t FROM steps WHERE n = 8),
sized AS (
    SELECT doc_id, (strlen(coalesce(text, '')) + 1)::BIGINT AS size,
           xor(list_reduce(
               [4294967295::BIGINT] || [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')],
               lambda c, x: xor(t[xor(c, x) % 256 + 1], c // 256)), 4294967295) AS text_crc32
    FROM documents, crc),
placed AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS before,
           sum(size) OVER () AS total
    FROM sized),
dealt AS (
    SELECT *, (((2 * before + size) * 16) // (2 * total))::INT AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY before) - 1 AS slot, NULL::INT AS grown_shard
FROM dealt
"""

OP6_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
        list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 3, 2))]) END AS s
    FROM worded),
long AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM long a JOIN long b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
    SELECT a AS node, a AS label FROM links
    UNION
    SELECT l.b, r.label FROM reached r JOIN links l ON l.a = r.node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(c.component_id, doc_id) AS component_id
FROM sets LEFT JOIN (SELECT node, min(label) AS component_id FROM reached GROUP BY node) c ON c.node = doc_id
"""

OP2_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP10_SQL = r"""
WITH split AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
    FROM documents),
different AS (
    SELECT line, length(line) AS n, min((doc_id, line_no)) AS first FROM split WHERE line <> '' GROUP BY line),
near AS (  -- an edit of one letter is one of four bytes at most
    SELECT a.line, b.first AS earlier, a.n AS n, string_split(a.line, '') AS x, string_split(b.line, '') AS y
    FROM different a JOIN different b ON b.n BETWEEN a.n - 1 AND a.n + 1 AND b.first < a.first AND levenshtein(a.line, b.line) <= 4),
earliest AS (
    SELECT line, min(earlier) AS earlier FROM near
    WHERE CASE len(x) - len(y)
        WHEN 0 THEN list_sum([(p[1] <> p[2])::INT FOR p IN list_zip(x, y)]) <= 1
        WHEN 1 THEN list_contains([x[:i - 1] || x[i + 1:] FOR i IN range(1, len(x) + 1)], y)
        ELSE list_contains([y[:i - 1] || y[i + 1:] FOR i IN range(1, len(y) + 1)], x) END
    GROUP BY line),
decided AS (
    SELECT s.doc_id, s.line_no, length(s.line) AS n_chars, coalesce(e.earlier, d.first, (s.doc_id, s.line_no)) AS keep
    FROM split s LEFT JOIN different d USING (line) LEFT JOIN earliest e USING (line))
SELECT doc_id, line_no::INT AS line_no, n_chars::INT AS n_chars, keep = (doc_id, line_no) AS kept,
       struct_extract(keep, 1) AS keep_doc_id, struct_extract(keep, 2)::INT AS keep_line_no
FROM decided
"""

OP5_SQL = """
WITH coded AS (
    SELECT vec_id, [coalesce(x > 0 AND NOT isnan(x), false) FOR x IN embedding] AS bits
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
measured AS (
    SELECT q.vec_id AS query_id, r.vec_id, list_sum([(a[1] <> a[2])::INT FOR a IN list_zip(q.bits, r.bits)])::INT AS distance
    FROM coded q, coded r WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank, vec_id, distance
FROM measured QUALIFY rank <= 10
"""

OP8_SQL = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, coalesce('s' || source, 't') AS key,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, '') || '/5') AS place
    FROM documents),
sources AS (
    SELECT key, sum(size)::BIGINT AS source_size FROM sized GROUP BY key),
weighed AS (
    SELECT *, (row_number() OVER (ORDER BY key) - 1) % 3 + 1 AS weight, 3 * source_size AS cap,
           sum(source_size) OVER ()::BIGINT AS total
    FROM sources),
capped AS (
    SELECT *, sum(weight) OVER ()::BIGINT AS weights,
           coalesce(sum(cap) OVER before, 0)::BIGINT AS caps, coalesce(sum(weight) OVER before, 0)::BIGINT AS used
    FROM weighed
    WINDOW before AS (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
    SELECT key, source_size, total,
           least(cap::DOUBLE, max((total - caps) / (weights - used)) OVER () * weight) AS target
    FROM capped),
cut AS (
    SELECT *, source_size < 64 * 64 AS small,
           (CASE WHEN source_size >= 64 * 64 THEN 64 ELSE greatest(source_size // 64, 1) END)::BIGINT AS width
    FROM targets),
blocks AS (
    SELECT *, ceil(source_size / width)::BIGINT AS n_blocks,
           total - sum(CASE WHEN small THEN target ELSE 0 END) OVER () AS shared
    FROM cut),
quotients AS (
    SELECT key, target / (2 * k + 1) AS quotient, k, shared
    FROM blocks, unnest(range(0, 3 * n_blocks + 20)) AS each(k)
    WHERE NOT small AND target > 0),
ranked AS (
    SELECT key, row_number() OVER (ORDER BY quotient DESC, key, k) AS rank, round(shared / 64)::BIGINT AS n FROM quotients),
shards AS (
    SELECT s FROM unnest(range(0, 17)) AS each(s)),
upto AS (  -- the first s shards have the s / 16 of all blocks that have the highest quotients
    SELECT key, s, sum((rank <= n * s // 16)::BIGINT)::BIGINT AS quota FROM ranked, shards GROUP BY key, s
    UNION ALL
    SELECT key, s, round(target / greatest(source_size, 1) * ((n_blocks * s + 15) // 16))::BIGINT FROM blocks, shards WHERE small),
dealt AS (
    SELECT key, s - 1 AS shard, quota - lag(quota) OVER (PARTITION BY key ORDER BY s) AS asked FROM upto),
wanted AS (
    SELECT d.key, d.shard, d.asked, (n_blocks * shard + 15) // 16 AS first_rank,
           (n_blocks * (shard + 1) + 15) // 16 - (n_blocks * shard + 15) // 16 AS held
    FROM dealt d JOIN blocks USING (key) WHERE d.shard >= 0),
given AS (  -- what a shard can't take goes to the next ones
    SELECT key, shard, first_rank, held, least(asked, 3 * held)::BIGINT AS quota, (asked - least(asked, 3 * held))::BIGINT AS over_it
    FROM wanted WHERE shard = 0
    UNION ALL
    SELECT w.key, w.shard, w.first_rank, w.held, least(w.asked + g.over_it, 3 * w.held)::BIGINT,
           (w.asked + g.over_it - least(w.asked + g.over_it, 3 * w.held))::BIGINT
    FROM given g JOIN wanted w ON w.key = g.key AND w.shard = g.shard + 1),
filled AS (  -- and what the last can't take to the ones before
    SELECT key, shard, first_rank, held, (quota + greatest(least(3 * held - quota,
               max(CASE WHEN shard = 15 THEN over_it END) OVER (PARTITION BY key) - coalesce(sum(3 * held - quota) OVER later, 0)), 0))::BIGINT AS quota
    FROM given WINDOW later AS (PARTITION BY key ORDER BY shard DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
quotas AS (
    SELECT key, list(quota ORDER BY shard) AS quotas, list(first_rank ORDER BY shard) AS firsts, list(held ORDER BY shard) AS helds
    FROM filled GROUP BY key),
strides AS (
    SELECT b.*, q.quotas, q.firsts, q.helds, ('0x' || substr(md5(b.key || '/5'), 1, 6))::BIGINT AS shift,
           CASE WHEN n_blocks % 1000099 <> 0 THEN 1000099 WHEN n_blocks % 1000003 <> 0 THEN 1000003 ELSE 1000033 END AS stride
    FROM blocks b LEFT JOIN quotas q USING (key)),
placed AS (
    SELECT doc_id, key, size, (sum(size) OVER (PARTITION BY key ORDER BY place, doc_id, size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
    FROM sized)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 OR n_blocks = 0 THEN 0 ELSE
           list_sum([(least(start + size, (b + 1) * width) - greatest(start, b * width)) * list_sum([
                   list_sum([quotas[s] // helds[s] + (r - firsts[s] < quotas[s] % helds[s])::BIGINT FOR s IN [r * 16 // n_blocks + 1]])
                   FOR r IN [(b * stride + shift) % n_blocks]])
               FOR b IN range(start // width, (start + size - 1) // width + 1)])
           END::BIGINT AS taken
FROM placed JOIN strides USING (key)
"""

OP11_SQL = r"""
WITH RECURSIVE steps AS (  -- the table of CRC-32, by its polynomial
    SELECT b, b::BIGINT AS c, 0 AS n FROM unnest(range(0, 256)) AS each(b)
    UNION ALL
    SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n + 1 FROM steps WHERE n < 8),
crc AS (
    SELECT list(c ORDER BY b) AS t FROM steps WHERE n = 8),
hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
               [4294967295::BIGINT] || [('0x' || h)::BIGINT FOR h IN regexp_extract_all(
                   hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..')],
               lambda c, x: xor(t[xor(c, x) % 256 + 1], c // 256)), 4294967295) % 20 AS damage
    FROM conversations, crc),
damaged AS (
    SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
           CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE damage WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed WHERE damage <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) - 1 AS i,
           rtrim(text, E' \t\n\x0B\f\r') AS body FROM damaged),
judged AS (
    SELECT *, CASE WHEN body = '' THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
           substr(role, 1, 1) AS letter, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed),
kept (letter, q, after) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
due (q, role, after) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
single AS (  -- edits of a turn in a state; a role is given, or is the turn's own
    SELECT letter, q, after, 'K' AS edit, 0 AS cost, NULL AS role FROM kept
    UNION ALL SELECT NULL, q, after, 'R', 1, role FROM due
    UNION ALL SELECT NULL, q, q, 'D', 2, NULL FROM due),
moves AS (  -- with up to two turns inserted before it
    SELECT letter, q, after, edit, cost, role, []::VARCHAR[] AS put FROM single
    UNION ALL SELECT s.letter, d.q, s.after, 'I' || s.edit, s.cost + 5, s.role, [d.role || ':'] FROM due d JOIN single s ON s.q = d.after
    UNION ALL SELECT s.letter, d.q, s.after, 'II' || s.edit, s.cost + 10, s.role, [d.role || ':', e.role || ':']
              FROM due d JOIN due e ON e.q = d.after JOIN single s ON s.q = e.after),
ways AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS body FROM (SELECT DISTINCT conv_id FROM judged)
    UNION ALL
    SELECT conv_id, i, q, cost, audit, body FROM (
    SELECT w.conv_id, w.i + 1 AS i, m.after AS q, w.cost + m.cost + CASE WHEN j.fault = 'truncated' AND m.edit NOT LIKE '%D' THEN 5 ELSE 0 END AS cost,
           w.audit || m.edit AS audit,
           w.body || m.put || CASE WHEN m.edit LIKE '%D' THEN []::VARCHAR[] ELSE [coalesce(m.role, j.role) || ':' || j.text] END AS body
    FROM ways w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i
    JOIN moves m ON m.q = w.q AND (m.letter IS NULL OR m.letter = j.letter)
                AND (m.edit LIKE '%D' OR j.fault IS NULL OR j.fault = 'truncated')) AS reached
    QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before || letter NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id),
ended AS (
    SELECT * FROM (
    SELECT w.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, cost + CASE q WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END AS cost,
           audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
           body || CASE q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE []::VARCHAR[] END AS body
    FROM ways w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i) AS complete
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1)
SELECT v.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(body, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) v LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM v.conv_id
"""

OP12_SQL = (
    r"""
WITH worded AS (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
phrases (phrase, label) AS (VALUES """
    + ", ".join(f"('{phrase}', '{label}')" for phrase, label in licenses.PHRASES.items())
    + """),
places AS (
    SELECT row_no, label, pos FROM (SELECT row_no, w, unnest(range(1, len(w) + 1)) AS pos FROM worded) JOIN (
        SELECT string_split(phrase, ' ') AS p, label FROM phrases) ON w[pos] = p[1] AND w[pos : pos + len(p) - 1] = p),
based AS (
    SELECT row_no, count(*) AS n_base, min(pos) - 1 AS first_word, max(pos) - 1 AS last_word, list(label) AS labels FROM places GROUP BY row_no),
templates (template, label) AS (VALUES """
    + ", ".join(f"('{template}', '{label}')" for template, label in licenses.TEMPLATES.items())
    + """),
sets AS (
    SELECT label, list_distinct(string_split(template, ' ')) AS t FROM templates),
blocks AS (
    SELECT row_no, w[i + 1 : i + 64] AS b FROM (SELECT row_no, w, unnest(range(0, greatest(len(w) - 32, 1), 32)) AS i FROM worded)),
shares AS (
    SELECT row_no, label, len(list_intersect(t, b)) AS shared, len(t) AS n FROM blocks, sets),
noticed AS (
    SELECT row_no, list(label) AS labels, max(shared / n) AS share FROM shares WHERE 100 * shared >= 80 * n GROUP BY row_no)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(list_distinct(based.labels)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(coalesce(based.labels, []) || coalesce(noticed.labels, []))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM worded LEFT JOIN based USING (row_no) LEFT JOIN noticed USING (row_no)
"""
)

OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
counted AS (
    SELECT lang, w[i : i + k - 1] AS words, k, count(*) AS f FROM placed, unnest(range(1, 6)) AS each(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (
    SELECT * FROM counted WHERE k > 1 AND f >= 100),
cuts AS (
    SELECT c.lang, c.words, c.k, c.f AS a, cut, x.f AS l, y.f AS r, n, ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c JOIN totals USING (lang)
    JOIN counted x ON x.lang = c.lang AND x.words = c.words[1 : cut] JOIN counted y ON y.lang = c.lang AND y.words = c.words[cut + 1 : c.k]),
lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1),
inside AS (
    SELECT DISTINCT s.lang, s.words FROM candidates s JOIN (
        SELECT lang, words, f, k, unnest(range(1, k + 1)) AS i FROM candidates) g
    ON g.lang = s.lang AND g.k > s.k AND g.i + s.k - 1 <= g.k AND g.words[g.i : g.i + s.k - 1] = s.words AND 100 * g.f >= 100 * s.f)
SELECT lang, row_number() OVER best AS rank, array_to_string(words, ' ') AS phrase, a, l, r, n, score
FROM lowest ANTI JOIN inside USING (lang, words)
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ') COLLATE C)
QUALIFY rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of this subpackage by name, and the pipeline."""
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_sharding": op1_sharding,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_bpe": op3_bpe,
        "op4_quality": op4_quality,
        "op5_topk_search": op5_topk_search,
        "op6_ngram_jaccard": op6_ngram_jaccard,
        "op7_language": op7_language,
        "op8_mixing": op8_mixing,
        "op9_token_counts": op9_token_counts,
        "op10_line_dedup": op10_line_dedup,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_license_scan": op12_license_scan,
        "op13_phrases": op13_phrases,
    }


def oracles() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {
        "op1_sharding": OP1_SQL,
        "op2_exact_dedup": OP2_SQL,
        "op5_topk_search": OP5_SQL,
        "op6_ngram_jaccard": OP6_SQL,
        "op8_mixing": OP8_SQL,
        "op10_line_dedup": OP10_SQL,
        "op11_conversation_repair": OP11_SQL,
        "op12_license_scan": OP12_SQL,
        "op13_phrases": OP13_SQL,
    }
