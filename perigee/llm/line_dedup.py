"""Near-equal lines through deletion neighbourhoods. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import materialize, small_or_shuffled

#: Lines of fewer letters have few variants and halves that many share, so they emit variants without a look at halves.
SHORT = 8

#: Lines of at least so many letters get their variants' hashes from running sums over letters, in work that grows with
#: the line; below, from the variants' texts. Lines of this length and one more get both, so that all neighbours meet.
LONG = 512


def split_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, line_no (from 0) and line of every text; null texts have no lines."""
    return df.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))


def line_hash() -> list[Column]:
    """Two independent 64-bit hashes, which stand for a line."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]


def half_keys() -> Column:
    """Hashes of the first and the last k letters, for the k of the line's own length and of one letter less.

    Of two lines within one edit the shorter, of n letters, shares its first or its last n div 2 letters with the
    other. So a line whose half keys no other line has is alone.
    """
    halves = F.array_distinct(F.array(F.expr("n_chars div 2"), F.expr("(n_chars - 1) div 2")))
    return F.flatten(
        F.transform(
            halves,
            lambda k: F.array(
                F.xxhash64(F.lit("p"), k, F.substring("line", F.lit(1), k.cast("int"))),
                F.xxhash64(F.lit("s"), k, F.substring("line", F.col("n_chars") - k.cast("int") + 1, k.cast("int"))),
            ),
        )
    )


def variants() -> Column:
    """The line itself (place 0) and the line less the letter at each place, as pairs of hashes v1, v2.

    Lines alike without the letter at the same place are one edit apart, and so are a line and every line that is
    alike to it without one letter. There is no other way to be within one edit.
    """

    def key(text: Column, place: Column) -> Column:
        return F.struct(F.xxhash64(text).alias("v1"), F.xxhash64(F.lit(1), text).alias("v2"), place.cast("int").alias("place"))

    less = F.transform(
        F.sequence(F.lit(1), F.col("n_chars")),
        lambda i: key(F.concat(F.substring("line", F.lit(1), i - 1), F.substring("line", i + 1, F.col("n_chars"))), i),
    )
    return F.concat(F.array(key(F.col("line"), F.lit(0))), less)


#: Letters of a long line that are held in one row.
PART = 64


def long_variants(lines: DataFrame) -> DataFrame:
    """The same keys for long lines (h1, h2, first, line): v1, v2 are sums over letters of hashes of letter and place.

    Less the letter at a place, those before it count at their places and those behind it one place earlier: the sum of
    the first up to there, and what the second has from there on. Lines are cut into parts of PART letters, whose sums
    run along the line; inside a part they are added up. Sums of 2 ** 31 letters fit 64 bits.
    """
    parts = lines.select("h1", "h2", "first", F.posexplode(F.regexp_extract_all("line", F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))).alias("part", "text"))
    letters = F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0))
    hashed = lambda seed, back: F.transform(letters, lambda x, i: F.pmod(F.xxhash64(F.lit(seed), x, F.col("part") * PART + i - back), F.lit(1 << 31)))
    added = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda total, v: total + v)
    zero = F.lit(0).cast("long")
    summed = parts.withColumns({f"{kind}{seed}": added(hashed(seed, back)) for seed in (1, 2) for back, kind in ((0, "a"), (1, "b"))})
    line = Window.partitionBy("h1", "h2")
    before, behind = line.orderBy("part").rowsBetween(Window.unboundedPreceding, -1), line.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    around = {f"s{i}": F.coalesce(F.sum(f"a{i}").over(before), zero) + F.coalesce(F.sum(f"b{i}").over(behind), zero) for i in (1, 2)}
    held = summed.withColumns(around).drop("a1", "b1", "a2", "b2").withColumns({f"{kind}{seed}": hashed(seed, back) for seed in (1, 2) for back, kind in ((0, "a"), (1, "b"))})
    less = lambda i, seed: F.col(f"s{seed}") + added(F.slice(f"a{seed}", F.lit(1), i)) + added(F.slice(f"b{seed}", i + 2, F.lit(PART)))
    each = F.transform(F.sequence(F.lit(0), F.size("a1") - 1), lambda i: F.struct(less(i, 1).alias("v1"), less(i, 2).alias("v2"), (F.col("part") * PART + i + 1).cast("int").alias("place")))
    whole = summed.groupBy("h1", "h2", "first").agg(F.sum("a1").alias("v1"), F.sum("a2").alias("v2")).withColumn("place", F.lit(0))
    return held.select("h1", "h2", "first", F.inline(each)).unionByName(whole)


def one_edit_apart(a: Column, b: Column) -> Column:
    """Whether two different texts are one edit apart: they are alike behind the first letter in which they differ.

    How much of their beginnings is alike is found by halving, so the work is that of some 30 comparisons.
    """
    halving = F.array(*[F.lit(1 << i) for i in range(30, -1, -1)])
    alike = F.aggregate(halving, F.lit(0), lambda at, step: at + F.when(F.substring(a, F.lit(1), at + step) == F.substring(b, F.lit(1), at + step), step).otherwise(0))
    behind = lambda text, more: F.substring(text, alike + 1 + more, F.length(text))
    more = F.length(a) - F.length(b)
    return F.when(more == 0, behind(a, 1) == behind(b, 1)).when(more == 1, behind(a, 1) == behind(b, 0)).when(more == -1, behind(a, 0) == behind(b, 1)).otherwise(False)


def verified(earliest: DataFrame, texts: DataFrame) -> DataFrame:
    """earliest (h1, h2, earlier) without the rows whose lines (of texts: h1, h2, first, line) aren't within one edit.

    Only lines that have an earlier one are looked at, each against one other.
    """
    own = texts.select("h1", "h2", F.col("line").alias("_own"))
    kept = texts.select(F.col("first").alias("earlier"), F.col("line").alias("_kept"))
    pairs = earliest.join(own, ["h1", "h2"]).join(kept, "earlier").filter(one_edit_apart(F.col("_own"), F.col("_kept")))
    return pairs.select("h1", "h2", "earlier").distinct()


def duplicate_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every line of every text, the earliest line within one edit; the line stays if that is itself.

    Lines stand in order of doc_id, then line number. Equal lines are one edit class of any size: they are folded
    before they are shuffled, and come back by their hashes. Of the different lines, those that share a half key with
    another, and all below SHORT letters, emit all variants with up to one letter deleted, as hashed keys, in work that
    grows with the line's length (see long_variants). Lines that share a variant at one place are all within one edit of
    each other, and those of any place are within one edit of the line that is the variant; so equal variants meet in an
    aggregate that finds the earliest of each, and no pairs are made, however many lines share a variant. The edit
    distance of each line to its earliest one is then verified on the texts.

    Empty lines always stay, and null texts have no lines. Rows that are alike in id and text are told apart by
    nothing, so their lines stay or go together; null ids come first. An empty table gives an empty result. Other
    columns of df are not looked at.

    Returns doc_id, line_no, n_chars, kept, keep_doc_id, keep_line_no.
    """
    lines = split_lines(df, id_col, text_col)
    measured = lines.withColumn("n_chars", F.length("line"))
    hashed = measured.select("doc_id", "line_no", "n_chars", *line_hash(), half_keys_or_none(SHORT))
    hashed = materialize(hashed, "line-hashes")
    different = materialize(
        hashed.filter("n_chars > 0")
        .groupBy("h1", "h2")
        .agg(
            F.min(F.struct("doc_id", "line_no")).alias("first"),
            F.count("*").alias("rows"),
            F.first("n_chars").alias("n_chars"),
            F.first("halves").alias("halves"),
        ),
        "line-different",
    )
    halves = different.filter("halves is not null").select("h1", "h2", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("lines")).filter("lines > 1").select("half")
    near = materialize(halves.join(shared, "half", "left_semi").select("h1", "h2").distinct(), "line-near")
    short = F.col("n_chars") < SHORT
    near = different.filter(~short).join(near, ["h1", "h2"], "left_semi").unionByName(different.filter(short))
    near = materialize(near.select("h1", "h2", "first"), "line-first")
    found = (
        measured.select("*", *line_hash())
        .join(small_or_shuffled(near, near.count(), 64), ["h1", "h2"])
        .filter(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no")))
        .dropDuplicates(["h1", "h2"])
    )
    found = materialize(found.select("h1", "h2", "first", "line", "n_chars"), "line-texts")
    keyed = found.filter(F.col("n_chars") <= LONG + 1).select("h1", "h2", "first", F.inline(variants()))
    keyed = keyed.unionByName(long_variants(found.filter(F.col("n_chars") >= LONG)))
    alike, same_place = Window.partitionBy("v1", "v2"), Window.partitionBy("v1", "v2", "place")
    itself = F.col("place") == 0
    met = (
        keyed.withColumn("substituted", F.min("first").over(same_place))
        .withColumn("shorter", F.min(F.when(itself, F.col("first"))).over(alike))
        .withColumn("longer", F.min(F.when(~itself, F.col("first"))).over(alike))
        .withColumn("earlier", F.when(itself, F.col("longer")).otherwise(F.least("substituted", "shorter")))
    )
    earliest = met.filter(F.col("earlier") < F.col("first")).groupBy("h1", "h2").agg(F.min("earlier").alias("earlier"))
    earliest = verified(earliest, found)
    decided = different.join(earliest, ["h1", "h2"], "left").filter("rows > 1 or earlier is not null")
    decided = materialize(decided.select("h1", "h2", F.coalesce("earlier", "first").alias("keep")), "line-decisions")
    own = F.struct("doc_id", "line_no")
    keep = F.coalesce("keep", own)
    return hashed.join(small_or_shuffled(decided, decided.count(), 64), ["h1", "h2"], "left").select(
        "doc_id",
        "line_no",
        "n_chars",
        keep.eqNullSafe(own).alias("kept"),
        keep["doc_id"].alias("keep_doc_id"),
        keep["line_no"].alias("keep_line_no"),
    )


def half_keys_or_none(letters: int) -> Column:
    """The half keys of lines of so many letters or more, else null."""
    return F.when(F.col("n_chars") >= letters, half_keys()).alias("halves")


def without_duplicate_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with the lines that don't stay taken out of its texts. Ids must be unique; null texts stay null."""
    gone = duplicate_lines(df, id_col, text_col).filter("not kept")
    gone = gone.groupBy(F.col("doc_id").alias("_gone_id")).agg(F.collect_set("line_no").alias("_gone"))  # of one text
    lines = F.filter(F.split(text_col, "\n"), lambda _, i: ~F.array_contains("_gone", i))
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(F.array_join(lines, "\n"))
    joined = df.join(gone, df[id_col] == F.col("_gone_id"), "left")
    return joined.select(*[text.alias(c) if c == text_col else df[c] for c in df.columns])
