"""Repair of conversation structure: the cheapest edits after which roles alternate, by branch-and-bound.

A conversation's turns become one code each. Conversations are cut into blocks of at most BLOCK turns, so that none is
held whole: a block that may be a part is solved from each state of the alternation to each, and the parts of one
conversation are joined by their costs alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby, islice, pairwise, repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from perigee.llm.common import Tables

#: Turns that are solved together at most; a long conversation leaves one row of costs for each block.
BLOCK = 1024

NEVER = 1 << 60

# States: 0 nothing yet, 1 after the system's turn, 2 after a user's, 3 after an assistant's. A conversation may end in 0 and 3.
STATES = range(4)
AFTER_DUE = (2, 2, 3, 2)
DUE = ("user", "user", "assistant", "user")
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

#: What it costs to end a conversation in a state: turns inserted up to the next assistant's.
INSERTED = 5
TAIL = (0, 2 * INSERTED, INSERTED, 0)

WHITE = " \t\n\v\f\r"


def edits_of(state: int, code: str) -> list[tuple[str, int, int, int]]:
    """Edits in order of letter: (letter, cost, state after it, turns used).

    A code is a role's initial (x for others), a capital if the turn is truncated, or - if it must go.
    """
    found = [("D", 2, state, 1), ("I", INSERTED, AFTER_DUE[state], 0)]
    if code != "-":
        cut = 5 if code.isupper() else 0
        if (code.lower(), state) in KEEPS:
            found.append(("K", cut, KEEPS[code.lower(), state], 1))
        found.append(("R", 1 + cut, AFTER_DUE[state], 1))
    return found


EDITS = {(q, c): edits_of(q, c) for q in STATES for c in "suaxSUAX-"}


def suffix_bounds(codes: str, ends: tuple[int, ...]) -> list[list[int]]:
    """The least cost from each place and state to an end, whatever the edits' letters. ends: cost of ending in each state."""
    bounds = [list(ends)]
    for code in reversed(codes):
        later, here = bounds[-1], []
        for q in STATES:
            here.append(min(cost + later[after] for _, cost, after, used in EDITS[q, code] if used))
        for _ in STATES:  # inserted turns lead from state to state
            here = [min(here[q], INSERTED + here[AFTER_DUE[q]]) for q in STATES]
        bounds.append(here)
    return bounds[::-1]


def search(codes: str, start: int, ends: tuple[int, ...], bounds: list[list[int]]) -> tuple[int, str] | None:
    """Cost and letters of the cheapest edits from a state to an end; of equal cost the least letters. None if there are none.

    Depth-first branch-and-bound on an explicit stack: a node is a place and a state; it is left when its cost and bound
    (any lower bound will do) can't beat the incumbent (cost, letters), or when its table entry, the best prefix that has
    reached it, is as good. When the stack is empty, the incumbent is proved.
    """
    best: tuple[int, str] = (NEVER, "")
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, letters = stack.pop()
        hope = cost + bounds[at][state]
        if hope > best[0] or hope >= NEVER or (hope == best[0] and letters > best[1]):
            continue
        if (at, state) in reached and reached[at, state] <= (cost, letters):
            continue
        reached[at, state] = (cost, letters)
        if at == len(codes):
            best = min(best, (cost + ends[state], letters + "I" * (ends[state] // INSERTED)))
            continue
        children = [(bounds[at + used][after] + extra, letter, after, used, extra) for letter, extra, after, used in EDITS[state, codes[at]]]
        for _, letter, after, used, extra in sorted(children, reverse=True):  # the most hopeful is popped first
            stack.append((at + used, after, cost + extra, letters + letter))
    return None if best[0] >= NEVER else best


def solve_whole(codes: str) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a whole conversation."""
    cost, letters = search(codes, 0, TAIL, suffix_bounds(codes, TAIL))
    return cost, letters


def solve_part(codes: str) -> tuple[list[int], list[int], list[str]]:
    """For each start and end state: cost (-1 if there is no way), place of the letters among those of this start, letters."""
    costs, ranks, letters = [-1] * 16, [0] * 16, [""] * 16
    for end in STATES:
        ends = tuple(0 if q == end else NEVER for q in STATES)
        bounds = suffix_bounds(codes, ends)
        for start in STATES:
            found = search(codes, start, ends, bounds)
            if found:
                costs[4 * start + end], letters[4 * start + end] = found
    for start in STATES:
        for rank, end in enumerate(sorted(STATES, key=lambda e: letters[4 * start + e])):
            ranks[4 * start + end] = rank
    return costs, ranks, letters


def join_parts(costs: list[list[int]], ranks: list[list[int]]) -> tuple[int, list[tuple[int, int]]]:
    """The cheapest way through the parts of a conversation: cost, and start and end state of each part.

    The bounds behind each part are exact here, so the first descent, by bound and then by letters, is proved.
    """
    bounds = [list(TAIL)]
    for part in reversed(costs):
        bounds.append([min((part[4 * q + e] + bounds[-1][e] for e in STATES if part[4 * q + e] >= 0), default=NEVER) for q in STATES])
    bounds.reverse()
    state, way = 0, []
    for part, rank, later in zip(costs, ranks, bounds[1:], strict=True):
        held = [(part[4 * state + e] + later[e], rank[4 * state + e], e) for e in STATES if part[4 * state + e] >= 0]
        end = min(held)[2]
        way.append((state, end))
        state = end
    return bounds[0][0], way


def codes_of_turns(turns: DataFrame) -> DataFrame:
    """One row for each different turn (conv_id, turn, role, text_key) with copies, code, fault and letter.

    The first fault counts: blank, duplicate (role and text came earlier), truncated. Equal turns are folded before
    they are shuffled; of these, the copies after the first are duplicates. Texts themselves aren't shuffled here.
    """
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(body == "", "blank").when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated")
    slim = turns.select("conv_id", "turn", "role", F.sha2("text", 256).alias("text_key"), fault.alias("fault"))
    folded = slim.groupBy("conv_id", "turn", "role", "text_key", "fault").agg(F.count("*").alias("copies"))
    spoken = F.col("fault").isNull() | (F.col("fault") != "blank")
    order = F.struct(F.col("turn").isNotNull().alias("timed"), F.col("turn").alias("turn"))
    again = folded.filter(spoken).groupBy("conv_id", "role", "text_key").agg(F.min(order).alias("_first"), F.count("*").alias("_turns"))
    again = again.filter("_turns > 1").select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "text_key")], "_first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("text_key") == F.col("_text_key"))
    joined = folded.join(again, same, "left")
    later = spoken & F.coalesce(order > F.col("_first"), F.lit(False))
    marked = joined.withColumn("fault", F.when(later, "duplicate").otherwise(F.col("fault"))).select(*folded.columns)
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    must_go = F.col("fault").isin("blank", "duplicate")
    code = F.when(must_go, "-").when(F.col("fault") == "truncated", F.upper("letter")).otherwise(F.col("letter"))
    return marked.withColumn("letter", letter).withColumn("code", code)


LEGAL = {"su", "ua", "au"}
FAULTS = ("blank", "duplicate", "truncated")


class Block:
    """The turns of one conversation that are solved together, and what is counted over them."""

    def __init__(self, conv: object):
        self.conv, self.codes, self.held, self.counts = conv, [], [], dict.fromkeys(FAULTS, 0)
        self.illegal, self.first, self.last, self.first_turn, self.last_turn, self.turns = 0, None, None, None, None, 0

    def add(self, turn: int | None, role: str, key: str, code: str, fault: str | None, letter: str) -> None:
        if code != "-":
            self.held.append({"at": len(self.codes), "turn": turn, "role": role, "text_key": key})
        self.codes.append(code)
        if fault:
            self.counts[fault] += 1
        self.illegal += self.last is not None and self.last + letter not in LEGAL
        self.first, self.last = self.first or letter, letter
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self, part: int, number: int, whole: bool) -> dict:
        """The block as a row; a whole conversation has the one cost and letters of its repair."""
        codes = "".join(self.codes)
        if whole:
            cost, found = solve_whole(codes)
            costs, ranks, letters = [cost], [0], [found]
        else:
            costs, ranks, letters = solve_part(codes)
        solved = {"conv_id": self.conv, "part": part, "number": number, "whole": whole, "held": self.held, "costs": costs, "ranks": ranks, "letters": letters}
        ends = {"first_letter": self.first, "last_letter": self.last, "first_turn": self.first_turn, "last_turn": self.last_turn, "turns": self.turns}
        return solved | self.counts | {"illegal": self.illegal} | ends


def blocks_of(rows: Iterator[tuple]) -> Iterator[tuple[Block, int, int, bool]]:
    """Blocks of rows (conv_id, turn, role, text_key, code, fault, letter, copies, part) in order, with part, number in
    the conversation, and whether the conversation surely is whole: not cut, and neither first nor last of its partition."""
    before, first = None, True
    for conv, own in groupby(rows, key=lambda r: r[0]):
        if before:
            yield *before[:3], before[3] == "whole"
        block, number = Block(conv), 0
        for _, turn, role, key, code, fault, letter, copies, part in own:
            for each, why in chain([(code, fault)], repeat(("-", "blank" if fault == "blank" else "duplicate"), copies - 1)):
                if len(block.codes) == BLOCK:
                    yield block, part, number, False
                    block, number = Block(conv), number + 1
                block.add(turn, role, key, each, why, letter)
        before, first = (block, part, number, "part" if first or number else "whole"), False
    if before:
        yield *before[:3], False


PARTS = (
    "conv_id {conv}, part int, number int, whole boolean, held array<struct<at int, turn {turn}, role string, text_key string>>, "
    "costs array<int>, ranks array<int>, letters array<string>, first_letter string, last_letter string, first_turn {turn}, last_turn {turn}, "
    "turns long, blank long, duplicate long, truncated long, illegal long"
)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of rows that Python returns."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def in_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 500) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches."""
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def solved_parts(turns: DataFrame) -> DataFrame:
    """The blocks of all conversations, solved: range partitions in order of conversation and turn are read once."""
    order = ["conv_id", "turn", "role", "text_key"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    ddl = PARTS.format(conv=dict(turns.dtypes)["conv_id"], turn=dict(turns.dtypes)["turn"])
    schema, columns = arrow_schema(ddl), [*order, "code", "fault", "letter", "copies", "part"]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*[b.column(c).to_pylist() for c in columns], strict=True) for b in batches)
        yield from in_batches((block.row(*at) for block, *at in blocks_of(rows)), schema)

    return dealt.select(*columns).mapInArrow(solve, ddl)


def wrapped(value: int) -> int:
    """A whole number in 64 bits, as sums wrap there."""
    return (value + (1 << 63)) % (1 << 64) - (1 << 63)


WAYS = "conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, part int, number int, start int, chosen int, tail int"


def chosen_parts(parts: DataFrame) -> DataFrame:
    """One row for each part: its start state, which of its letters are chosen, turns inserted behind it, and the
    conversation's counts and cost. Conversations in one block are summed up where they are; of the others only costs
    and counts of their blocks meet, without turns and letters."""
    ddl = WAYS.format(conv=dict(parts.dtypes)["conv_id"])
    schema = arrow_schema(ddl)

    def combine(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["number"]))
        cost, way = join_parts([r["costs"] for r in rows], [r["ranks"] for r in rows])
        pairs = list(pairwise(rows))
        illegal = sum(r["illegal"] for r in rows) + sum(a["last_letter"] + b["first_letter"] not in LEGAL for a, b in pairs)
        timed = [r for r in rows if r["turns"]]
        turns = sum(r["turns"] for r in timed) - sum(a["last_turn"] == b["first_turn"] for a, b in pairwise(timed))
        gaps = wrapped(timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - turns) if timed else 0
        whole = {"conv_id": rows[0]["conv_id"], "gaps": gaps, "illegal": illegal, "cost": cost} | {k: sum(r[k] for r in rows) for k in FAULTS}
        out = []
        for r, (start, end) in zip(rows, way, strict=True):
            tail = TAIL[end] // INSERTED if r is rows[-1] else 0
            out.append(whole | {"part": r["part"], "number": r["number"], "start": start, "chosen": 4 * start + end, "tail": tail})
        return pa.Table.from_pylist(out, schema=schema)

    open_ones = parts.filter("not whole").drop("held", "letters", "whole")
    several = open_ones.groupBy("conv_id").applyInArrow(combine, ddl)
    gaps = F.when(F.col("turns") > 0, F.expr("last_turn - first_turn + 1 - turns")).otherwise(0).cast("long").alias("gaps")
    fixed = [F.lit(0).alias(c) for c in ("start", "chosen", "tail")]
    one = parts.filter("whole").select("conv_id", gaps, *FAULTS, "illegal", F.get("costs", F.lit(0)).cast("long").alias("cost"), "part", "number", *fixed)
    return one.unionByName(several)


def edited_turns(taken: DataFrame) -> DataFrame:
    """The turns that stay or come in: conv_id, part, number, place, role, and the turn, own_role and text_key they had."""
    kinds = dict(taken.select("conv_id", F.col("held")[0]["turn"].alias("turn")).dtypes)
    ddl = f"conv_id {kinds['conv_id']}, part int, number int, place int, role string, turn {kinds['turn']}, own_role string, text_key string"
    schema, columns = arrow_schema(ddl), ["conv_id", "part", "number", "held", "start", "letters"]

    def edits(conv: object, part: int, number: int, held: list[dict], state: int, letters: str) -> Iterator[dict]:
        own, at = {x["at"]: x for x in held}, 0
        for place, letter in enumerate(letters):
            turn = own.get(at, {}) if letter in "KR" else {}
            if letter != "D":
                role = turn["role"] if letter == "K" else DUE[state]
                state = KEEPS[role[:1], state]
                had = {"turn": turn.get("turn"), "own_role": turn.get("role"), "text_key": turn.get("text_key")}
                yield {"conv_id": conv, "part": part, "number": number, "place": place, "role": role} | had
            at += letter != "I"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*[b.column(c).to_pylist() for c in columns], strict=True) for b in batches)
        yield from in_batches(chain.from_iterable(edits(*r) for r in rows), schema, 5_000)

    return taken.select(*columns).mapInArrow(apply, ddl)


def repair_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of each conversation: a summary of each, and the turns that it leaves.

    Turns stand in order of turn (nulls first), then of role and digest of the text. Keeping a turn costs 0, giving it
    the user's or assistant's role 1, deleting it 2 (blank and duplicate turns must go), inserting an empty one 5, and a
    truncated turn that stays 5; roles must then read system at most once, then user and assistant in turn. Null roles
    and texts count as one space; rows without an id are one conversation. Equal rows are told apart by nothing: the
    second and later are duplicates. An empty table gives no rows. Other columns aren't looked at.

    Returns (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) and (conv_id, part, number, place, role,
    text); part, number and place order a conversation's turns. gaps wraps beyond 64 bits.
    """
    tables = Tables(df.sparkSession)
    space = F.lit(" ")
    turns = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, space).alias("role"), F.coalesce(text_col, space).alias("text"))
    parts = tables.write(solved_parts(codes_of_turns(turns)), "conversation-parts")
    ways = chosen_parts(parts).withColumnsRenamed({"conv_id": "_conv", "part": "_part", "number": "_number"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("number") == F.col("_number"))
    letters = F.concat(F.get("letters", F.col("chosen")), F.repeat(F.lit("I"), F.col("tail")))
    counts = ["gaps", *FAULTS, "illegal", "cost"]
    taken = parts.select("conv_id", "part", "number", "held", "letters").join(ways, same)
    taken = tables.write(taken.select("conv_id", "part", "number", "held", *counts, "start", letters.alias("letters")), "conversation-edits")
    tables.drop(taken)
    in_order = F.array_sort(F.collect_list(F.struct("part", "number", "letters")))  # the audit is one text
    audit = F.array_join(F.transform(in_order, lambda x: x["letters"]), "")
    summary = taken.groupBy("conv_id").agg(*[F.first(c).alias(c) for c in counts], audit.alias("audit"))
    edited = edited_turns(taken)
    spoken = turns.withColumn("text_key", F.sha2("text", 256)).groupBy("conv_id", "turn", "role", "text_key").agg(F.first("text").alias("text"))
    spoken = spoken.withColumnsRenamed({"conv_id": "_conv", "turn": "_turn", "role": "_role", "text_key": "_key"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")) & (F.col("own_role") == F.col("_role")) & (F.col("text_key") == F.col("_key"))
    kept = edited.join(spoken, same, "left")
    return summary, kept.select("conv_id", "part", "number", "place", "role", F.coalesce("text", F.lit("")).alias("text"))


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """conv_id and sha256 of `role:text` of its repaired turns, joined by newlines. Turns stream by in order; only the
    digest of one conversation is held."""
    order = ["part", "number", "place"]
    ddl = f"conv_id {dict(repaired.dtypes)['conv_id']}, repaired_sha256 string"
    schema = arrow_schema(ddl)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*[b.column(c).to_pylist() for c in ("conv_id", "role", "text")], strict=True) for b in batches)

        def each() -> Iterator[dict]:
            for conv, own in groupby(rows, key=lambda r: r[0]):
                held = hashlib.sha256()
                for i, (_, role, text) in enumerate(own):
                    held.update(("\n" * (i > 0) + f"{role}:{text}").encode())
                yield {"conv_id": conv, "repaired_sha256": held.hexdigest()}

        yield from in_batches(each(), schema)

    sorted_turns = repaired.repartition("conv_id").sortWithinPartitions("conv_id", *order)
    return sorted_turns.select("conv_id", "role", "text").mapInArrow(digest, ddl)


def damage_turns(df: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) spoilt by crc32 of `conv_id:turn` modulo 20: 0 drops one, 1 empties its text, 2
    takes out its [.!?], 3 repeats it, 4 makes its role user. Nulls in role, text and in what is hashed are one space."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = df.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(place.cast("binary")) % 20).alias("_by"))
    text = F.when(F.col("_by") == 1, "").when(F.col("_by") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_by") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_by") == 3, 2).otherwise(1)))
    return rows.filter("_by <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")
