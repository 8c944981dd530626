"""Conversation repair against all edits tried out, and against its SQL on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from perigee.llm import conversations as ops
from perigee.llm import registry

LEGAL = re.compile(r"^(s?(ua)+)?$")


def all_repairs(codes):
    """The cheapest and then least of all edits of a few turns, tried one by one; up to two inserted turns in each place."""
    best = None
    for edits in itertools.product("KRD", repeat=len(codes)):
        if any(e != "D" and c == "-" for e, c in zip(edits, codes)):
            continue
        for inserted in itertools.product(range(3), repeat=len(codes) + 1):
            if sum(inserted) > 2:
                continue
            letters = "".join("I" * n + e for n, e in zip(inserted, [*edits, ""]))
            cost = 5 * sum(inserted) + sum({"K": 0, "R": 1, "D": 2}[e] + (5 if e != "D" and c.isupper() else 0) for e, c in zip(edits, codes))
            free = [c.lower() for e, c in zip(edits, codes)]
            options = [[]]
            own = iter(zip(edits, free))
            for letter in letters:
                e = next(own) if letter != "I" else None
                if letter == "D":
                    continue
                options = [o + [x] for o in options for x in ([e[1]] if letter == "K" else ["u", "a"])]
            if any(LEGAL.match("".join(o)) for o in options) and (best is None or (cost, letters) < best):
                best = (cost, letters)
    return best


def test_search_finds_the_least_of_all_edits():
    rng = random.Random(11)
    cases = ["", "u", "s", "x", "ua", "sua", "ssua", "uu", "au", "uUa", "s-u", "A", "uxua", "aaa"] + ["".join(rng.choice("suaxUA-") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    for codes in cases:
        expected = all_repairs(codes)
        assert ops.solve_whole(codes) == expected, codes
        nothing_known = [[0] * 4 for _ in range(len(codes) + 1)]
        assert ops.search(codes, 0, ops.TAIL, nothing_known) == expected, codes  # any lower bound gives the same


def test_parts_join_to_the_whole():
    rng = random.Random(12)
    for _ in range(60):
        codes = "".join(rng.choice("suaxUA--") for _ in range(rng.randint(2, 30)))
        cuts = [0, *sorted(rng.sample(range(1, len(codes)), min(3, len(codes) - 1))), len(codes)]
        parts = [ops.solve_part(codes[a:b]) for a, b in zip(cuts, cuts[1:])]
        cost, way = ops.join_parts([p[0] for p in parts], [p[1] for p in parts])
        letters = "".join(p[2][4 * q + e] for p, (q, e) in zip(parts, way)) + "I" * (ops.TAIL[way[-1][1]] // 5)
        assert (cost, letters) == ops.solve_whole(codes), codes


SCHEMA = "conv_id long, turn long, role string, text string, part string, code int"


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(5)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((conv, turn * rng.choice([1, 1, 2]), role, rng.choice(["Hello.", "Yes!", "no end", " ", "", None, "A?\n", "tail.  ", "f"]), "x", 1))
    rows += [(None, None, "user", "Without an id.", None, None), (7, None, "system", "First.", None, None), (7, None, "user", "x" * 100_000 + ".", None, None)]
    rows += [rows[0]] * 3  # repeated rows
    drops = [(1000, t, "user", "gone.", None, None) for t in range(200) if zlib.crc32(f"1000:{t}".encode()) % 20 == 0][:2]
    return rows + drops


def test_query_rules_on_awkward_rows(spark, awkward, tmp_path, monkeypatch):
    spark.createDataFrame(awkward, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    expected = con.sql(registry.OP11_SQL)
    names = expected.columns
    found = registry.op11_conversation_repair(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected.fetchall()))


def test_long_conversation_in_blocks(spark):
    rng = random.Random(9)
    turns = [(5, i, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), rng.choice(["%d.", "%d?", "%d"]) % (i if rng.random() < 0.9 else 3)) for i in range(5_000)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(7)
    frame = frame.unionByName(spark.createDataFrame([(1, 0, "user", "Hi."), (9, 0, "user", "Hi."), (9, 1, "assistant", "Hi.")], frame.schema))
    summary, repaired = ops.repair_conversations(frame)
    seen, codes, roles = set(), "", []
    for _, _, role, text in turns:
        again = (role, text) in seen
        seen.add((role, text))
        letter = role[0] if role[0] in "sua" else "x"
        codes += "-" if again else letter if text[-1] in ".!?" else letter.upper()
        roles.append(letter)
    bounds = ops.suffix_bounds(codes, ops.TAIL)
    rows = {r["conv_id"]: r for r in summary.collect()}
    assert rows[5]["cost"] == bounds[0][0]
    assert rows[5]["illegal"] == sum(a + b not in ops.LEGAL for a, b in itertools.pairwise(roles))
    assert (rows[5]["gaps"], rows[5]["duplicate"]) == (0, codes.count("-"))
    assert (rows[1]["audit"], rows[9]["audit"]) == ("D", "KK")
    kept = repaired.filter("conv_id = 5").orderBy("part", "number", "place").collect()
    assert LEGAL.match("".join(r["role"][0] for r in kept))
    digest = {r["conv_id"]: r["repaired_sha256"] for r in ops.conversation_digests(repaired).collect()}
    assert digest[5] == hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in kept).encode()).hexdigest()
    assert 1 not in digest  # nothing is left of it


def test_no_conversations(spark):
    summary, repaired = ops.repair_conversations(spark.createDataFrame([], SCHEMA).withColumn("place", F.lit(1)))
    assert (summary.count(), repaired.count(), ops.conversation_digests(repaired).count()) == (0, 0, 0)
