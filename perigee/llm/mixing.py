"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks, then seeded block selection.

DataFrame operations only. Tables of one row for each source are ranked in one window each, and broadcast if they are
small; tables of documents, buckets and blocks are not gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import materialize, small_or_shuffled, text_key, word_count

#: No document is taken more often than this.
MOST = 3

#: Weights by a source's place in the order of names.
CYCLE = 3

#: A source has as many blocks at least, of fewer words if it is small.
LEAST_BLOCKS = 64

#: Bytes of a source's row with the quotas of 16 shards, for the choice of a join.
SOURCE_BYTES = 400

#: Primes, of which the first from the seed's on that does not divide the number of a source's blocks strides through them.
STRIDES = (1000003, 1000033, 1000037, 1000039, 1000081, 1000099)


def source_key(source: Column) -> Column:
    """A key that is never null, in the order of source names with null last."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("t"))


def word_sizes(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """doc_id, source key, size in words, and a seeded order (hexadecimal) of every row. The one pass over the texts."""
    order = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"/{seed}")).cast("binary"))
    return materialize(
        df.select(
            F.col(id_col).alias("doc_id"),
            source_key(F.col(source_col)).alias("key"),
            word_count(F.col(text_col)).alias("size"),
            order.alias("place"),
            text_key(text_col).alias("text_key"),
        ),
        "mix-sizes",
    )


def source_targets(sized: DataFrame) -> DataFrame:
    """One row for each source: key, rows, source_size, weight, target.

    Weights share all words. A source whose share would exceed MOST times its size gets just that, and the excess is
    shared among the others by weight, until none is above: sources are capped in order of cap / weight, which
    raises the level of the rest as long as the next cap is below it and then lowers it, so the highest level holds.
    """
    sources = sized.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    by_name, all_rows = Window.orderBy("key"), Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "key").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.col("caps")) / (F.col("weights") - F.col("used"))
    return (
        sources.withColumn("weight", ((F.row_number().over(by_name) - 1) % CYCLE + 1).cast("long"))
        .withColumn("cap", MOST * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(all_rows))
        .withColumn("weights", F.sum("weight").over(all_rows))
        .withColumn("caps", F.coalesce(F.sum("cap").over(by_cap), F.lit(0)))
        .withColumn("used", F.coalesce(F.sum("weight").over(by_cap), F.lit(0)))
        .withColumn("level", F.max(level).over(all_rows))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
        .select("key", "rows", "source_size", "weight", F.coalesce("target", F.lit(0.0)).alias("target"), "total")
    )


def block_quotas(targets: DataFrame, block_words: int, n_shards: int) -> DataFrame:
    """Blocks that each source gives to each shard of the mix: key, width, n_blocks, quotas (array by shard).

    width is the words of a source's blocks: block_words, or less in a source that would have fewer than LEAST_BLOCKS
    such blocks (one word at least). The blocks of such a small source are given by its own share of them: the first s
    shards have its target, as a part of its size, of the blocks that are dealt to them, rounded.

    The other sources share what words are left. They have as many blocks as fit into these, and the first s shards
    have the share s / n_shards of them.
    Sainte-Laguë gives the blocks of the first s shards to the highest of the quotients target / (2 k + 1). The
    quotas only grow with s, so a shard's own quota is the difference of two. A source's quota differs from its
    exact share by at most half the number of sources times its share, plus one; so only quotients in that range are
    ranked, and these are about two for each source.

    A source's blocks are dealt to the shards too (see shard_blocks). What a shard can't take of a quota, because it
    exceeds MOST times the source's blocks there, goes to the next shards, and what these can't take to the ones before.
    """
    least = LEAST_BLOCKS * block_words
    width = F.when(F.col("source_size") >= least, F.lit(block_words)).otherwise(F.greatest(F.expr(f"source_size div {LEAST_BLOCKS}"), F.lit(1)))
    cut = (
        targets.withColumn("small", F.col("source_size") < least)
        .withColumn("width", width.cast("long"))
        .withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("width")).cast("long"))
        .withColumn("total", F.col("total") - F.sum(F.when(F.col("small"), F.col("target")).otherwise(0.0)).over(Window.partitionBy()))
        .withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(n_shards))))
    )
    part = F.col("target") / F.greatest("source_size", F.lit(1)) * F.expr(first_rank("shard", n_shards))
    own = cut.filter("small").withColumn("quota", F.round(part).cast("long"))
    shares = (
        cut.filter("not small")
        .withColumn("sources", F.count("*").over(Window.partitionBy("shard")))
        .withColumn("seats", F.expr(f"round(total / {block_words}) * shard").cast("long"))
        .withColumn("seats", F.expr(f"seats div {n_shards}"))
        .withColumn("share", F.col("seats") * F.col("target") / F.greatest("total", F.lit(1)))
        .withColumn("around", F.ceil(F.col("sources") * F.col("target") / F.greatest("total", F.lit(1)) / 2) + 2)
        .withColumn("sure", F.greatest(F.floor("share") - F.col("around"), F.lit(0)).cast("long"))
        .withColumn("left", F.col("seats") - F.sum("sure").over(Window.partitionBy("shard")))
    )
    quotients = shares.withColumn("k", F.explode(F.expr("sequence(sure, sure + 2 * cast(around as bigint) + 1)"))).withColumn(
        "quotient", F.col("target") / (2 * F.col("k") + 1)
    )
    rank = F.row_number().over(Window.partitionBy("shard").orderBy(F.desc("quotient"), "key", "k"))
    won = quotients.withColumn("won", (rank <= F.col("left")) & (F.col("target") > 0))
    upto = (
        won.groupBy("key", "width", "n_blocks", "shard", "sure")
        .agg((F.col("sure") + F.sum(F.col("won").cast("long"))).alias("quota"))
        .drop("sure")
        .unionByName(own.select("key", "width", "n_blocks", "shard", "quota"))
        .groupBy("key", "width", "n_blocks")
        .agg(F.array_sort(F.collect_list(F.struct("shard", "quota"))).alias("by_shard"))  # n_shards of each source
        .select("key", "width", "n_blocks", F.col("by_shard.quota").alias("upto"))
    )
    asked, most = "held.left + upto[s] - if(s = 0, 0L, upto[s - 1])", f"{MOST} * ({shard_blocks('s', n_shards)})"
    onward = F.expr(f"""
        aggregate(sequence(0, {n_shards} - 1), named_struct('left', 0L, 'quotas', cast(array() as array<bigint>)), (held, s) ->
            named_struct('left', greatest({asked} - {most}, 0L), 'quotas', concat(held.quotas, array(least({asked}, {most})))))""")
    more = f"least(held.left, {most} - onward.quotas[s])"
    back = F.expr(f"""
        aggregate(sequence({n_shards} - 1, 0), named_struct('left', onward.left, 'quotas', cast(array() as array<bigint>)), (held, s) ->
            named_struct('left', held.left - {more}, 'quotas', concat(array(onward.quotas[s] + {more}), held.quotas))).quotas""")
    return upto.withColumn("onward", onward).select("key", "width", "n_blocks", back.alias("quotas"))


def first_rank(shard: str, n_shards: int) -> str:
    """SQL: the rank of a source's first block in a shard. Blocks in seeded order are dealt to shards in runs."""
    return f"(n_blocks * {shard} + {n_shards - 1}) div {n_shards}"


def shard_blocks(shard: str, n_shards: int) -> str:
    """SQL: how many of a source's blocks a shard has."""
    return f"{first_rank(f'({shard} + 1)', n_shards)} - {first_rank(shard, n_shards)}"


def word_offsets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """sized with `start`: the words of the same source that come before, in the seeded order.

    A source's hash range is cut into as many buckets as the square root of its rows, so that neither a bucket nor
    the list of a source's buckets gets long; each bucket's total gives the next ones their base.
    """
    of_source = small_or_shuffled(targets.select("key", "rows", "source_size", "target"), targets.count(), SOURCE_BYTES)
    spread = sized.join(of_source, "key").withColumn(
        "bucket", F.expr("cast(conv(substr(place, 1, 8), 16, 10) as bigint) * cast(ceil(sqrt(rows)) as bigint) div 4294967296")
    )
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        spread.groupBy("key", "bucket")
        .agg(F.sum("size").alias("words"))
        .select("key", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("key", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum("size").over(inside) - F.col("size")
    return spread.withColumn("run", run).join(bases, ["key", "bucket"]).withColumn("start", F.col("base") + F.col("run"))


def with_draws(placed: DataFrame, targets: DataFrame, block_words: int, n_shards: int, seed: int) -> DataFrame:
    """Add each source's quotas, and the stride and shift of its seeded order of blocks."""
    turned = STRIDES[seed % len(STRIDES) :] + STRIDES[: seed % len(STRIDES)]
    stride = F.lit(turned[-1])
    for prime in reversed(turned[:-1]):
        stride = F.when(F.col("n_blocks") % prime != 0, F.lit(prime)).otherwise(stride)
    drawn = block_quotas(targets, block_words, n_shards).withColumn("stride", stride.cast("long"))
    drawn = drawn.withColumn("shift", F.conv(F.substring(F.md5(F.concat("key", F.lit(f"/{seed}")).cast("binary")), 1, 6), 16, 10).cast("long"))
    drawn = materialize(drawn, "mix-quotas")
    return placed.join(small_or_shuffled(drawn, targets.count(), SOURCE_BYTES), "key")


def draws(block: str, n_shards: int) -> str:
    """SQL: how often a block is drawn.

    Block b comes (stride b + shift) mod n_blocks-th in the seeded order, which tells its shard. A shard goes through
    its blocks in that order again and again until its quota is reached.
    """
    ranked = f"transform(array(({block} * stride + shift) % n_blocks), r -> struct(r, cast(r * {n_shards} div n_blocks as int) as s))[0]"
    count = f"quotas[x.s] div ({shard_blocks('x.s', n_shards)}) + if(x.r - ({first_rank('x.s', n_shards)}) < quotas[x.s] % ({shard_blocks('x.s', n_shards)}), 1, 0)"
    return f"transform(array({ranked}), x -> {count})[0]"


def taken_words(n_shards: int) -> Column:
    """Words taken from a document: over the blocks that it reaches into, its words there times the block's draws."""
    return F.expr(f"""
        case when size = 0 or n_blocks = 0 then 0L else
            aggregate(
                sequence(start div width, (start + size - 1) div width),
                0L,
                (sum, b) -> sum + {draws("b", n_shards)} * (least(start + size, (b + 1) * width) - greatest(start, b * width))
            ) end""")


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = 64,
    n_shards: int = 16,
    seed: int = 5,
) -> DataFrame:
    """How many words a mix takes from each row, so that sources come to their target weights.

    Sources in order of code point, null last, weigh 1, 2, 3 and so on in turn, and share as many words as there are
    (see source_targets). Each source's documents stand one after another in a seeded order and are cut into blocks
    of block_words words, or fewer in a small source. The mix has n_shards shards: block_quotas gives each its quota of
    every source, and each draws that many of the source's blocks in it (see draws). A seed stands for an order of the
    documents and of the blocks.

    Null and empty texts have size 0, and nothing is taken from them. Rows that are alike in id and size may swap
    their shares; repeated rows are taken each. An empty table gives an empty result. Other columns of df are not
    looked at. The last block of a source is short, so the words taken differ from the target by some blocks,
    of which a source has LEAST_BLOCKS or more (or blocks of one word).

    Returns doc_id, size, source_size, target, taken.
    """
    sized = word_sizes(df, id_col, text_col, source_col, seed)
    targets = materialize(source_targets(sized), "mix-targets")
    drawn = with_draws(word_offsets(sized, targets), targets, block_words, n_shards, seed)
    return drawn.select("doc_id", "size", "source_size", "target", taken_words(n_shards).alias("taken"))


def mixed_texts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = 64,
    n_shards: int = 16,
    seed: int = 5,
) -> DataFrame:
    """The mix itself: the columns of df, with the words drawn of each text, as one row for each round of draws.

    A row of which every block is drawn keeps its text as it is; else the words of drawn blocks stay, each with the
    white space behind it. Rounds of which nothing is drawn give no row, so texts without words go. Other columns are
    kept as they are. Rows alike in id and text all get the draws of the one that stands first in its source.
    """
    sized = word_sizes(df, id_col, text_col, source_col, seed)
    targets = materialize(source_targets(sized), "mix-targets")
    drawn = with_draws(word_offsets(sized, targets), targets, block_words, n_shards, seed)
    reached = f"transform(sequence(start div width, (start + size - 1) div width), b -> struct(b, {draws('b', n_shards)} as times))"
    rounds = F.expr(f"""
        filter(transform(sequence(0L, {MOST - 1}L), round ->
            transform(filter({reached}, x -> x.times > round), x -> x.b)), x -> size(x) > 0)""")
    whole = F.expr("size(blocks) = (start + size - 1) div width - start div width + 1")
    shares = (
        drawn.filter("size > 0 and n_blocks > 0")
        .groupBy("doc_id", "text_key")
        .agg(F.min(F.struct("start", "key", "size", "width", "n_blocks", "stride", "shift", "quotas")).alias("own"))
        .select("doc_id", "text_key", "own.*")
        .select("doc_id", "text_key", "size", "start", "width", F.explode(rounds).alias("blocks"))
        .withColumn("whole", whole)
        .select(F.col("doc_id").alias("_mix_id"), F.col("text_key").alias("_mix_key"), F.struct("size", "start", "width", "blocks", "whole").alias("_mix"))
    )
    cut = F.expr("""
        array_join(flatten(transform(_mix.blocks, b -> slice(_pieces,
            cast(greatest(b * _mix.width, _mix.start) - _mix.start + 1 as int),
            cast(least((b + 1) * _mix.width, _mix.start + _mix.size) - greatest(b * _mix.width, _mix.start) as int)))), '')""")
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), 1)
    joined = df.join(shares, df[id_col].eqNullSafe(F.col("_mix_id")) & (text_key(text_col) == F.col("_mix_key"))).withColumn("_pieces", F.when(~F.col("_mix.whole"), pieces))
    text = F.when(F.col("_mix.whole"), F.col(text_col)).otherwise(cut)
    return joined.select(*[text.alias(c) if c == text_col else df[c] for c in df.columns])
