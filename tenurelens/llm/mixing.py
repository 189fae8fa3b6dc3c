"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sizes are words. A source is cut into about sqrt(words) blocks by a keyed hash of its
documents, so that neither the blocks of a source nor the documents of a block grow faster than
the square root of the source; a source with a third of all rows is as many blocks as it needs.
The mix takes whole epochs of a source, then blocks in keyed order until its target is met, the
last document cut at the word.

The copies of blocks are dealt to output shards by a binary tree: at each node the block quotas
of the sources are split between the left and the right half of the shards by a draw from the
multivariate hypergeometric distribution, so the counts are exact and distributed as if single
blocks had been dealt at random. The tree needs one number per source on the driver, as the
weights do. A shard then owns a range of each source's permuted blocks, disjoint from all other
shards', and is ordered by a keyed hash.

Only sizes and ids are shuffled to plan the mix; texts move once, to their shard.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenurelens.llm.scratch import cut

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3

#: sources that are broadcast at most (one short row each); beyond, joins shuffle
BROADCAST_SOURCES = 100_000


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def keyed(key: str, *parts: Column) -> Column:
    """60 bits of an MD5 over the key and the parts, as a long."""
    text = F.concat_ws(":", F.lit(key), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, words -> with nth (by code point, null last), weight, target.

    The water level is closed form: with sources ordered by most * words / weight, those below
    the level are full, and the level is what is left over the weight that is left.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("nth"), F.lit(n)).cast("int") + 1)
    named = sizes.withColumn("nth", (F.row_number().over(by_name) - 1).cast("long")).withColumn("weight", weight)
    order = Window.orderBy(F.col("words") * most / F.col("weight"), "nth")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("words").over(everything)
    full = F.coalesce(F.sum(F.col("words") * most).over(before), F.lit(0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = named.withColumn("level", (total - full).cast("double") / rest)
    open_ = F.col("level") * F.col("weight") <= F.col("words") * most
    level = F.min(F.when(open_, F.struct(F.col("words") * most / F.col("weight"), "nth", "level"))).over(everything)
    return levelled.withColumn("at", level["level"]).select(
        "source", "nth", "words", "weight",
        F.least(F.col("words").cast("double") * most, F.coalesce("at", F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def _blocks(words: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.sqrt(words.cast("double")))).cast("long")


def _plan(lean: DataFrame, key: str, weights: Sequence[int], most: int) -> tuple[DataFrame, DataFrame]:
    """Sources and blocks of rows (doc_id, source, size), with what the mix takes of them."""
    totals = lean.groupBy("source").agg(F.sum("size").alias("words"))
    goal = F.round("target").cast("long")
    sources = (
        targets(totals, weights, most)
        .withColumn("n_blocks", _blocks(F.col("words")))
        .withColumn("epochs", F.when(F.col("words") > 0, F.floor(goal / F.col("words"))).otherwise(0).cast("long"))
        .withColumn("over", goal - F.col("epochs") * F.col("words"))
    )
    rows = sources.limit(BROADCAST_SOURCES + 1).collect()
    if len(rows) <= BROADCAST_SOURCES:
        sources = F.broadcast(lean.sparkSession.createDataFrame(rows, sources.schema))
    summed = _place(lean, sources, key).groupBy("nth", "block").agg(F.sum("size").alias("block_words"))
    in_turn = Window.partitionBy("nth").orderBy(keyed(key, F.col("nth"), F.col("block")), "block")
    blocks = summed.withColumn("rank", (F.row_number().over(in_turn) - 1).cast("long")).withColumn(
        "passed", F.coalesce(F.sum("block_words").over(in_turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    return sources, blocks


def _place(rows: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """Rows with their source's line, their own hash and their block."""
    named = sources.withColumnRenamed("source", "named")
    return (
        rows.join(named, F.col("source").eqNullSafe(F.col("named")))
        .withColumn("h", keyed(key, F.col("doc_id")))
        .withColumn("block", F.pmod("h", F.col("n_blocks")))
    )


def _taken(placed: DataFrame, blocks: DataFrame) -> DataFrame:
    """Documents with `part` (words of the broken epoch) and `taken`."""
    met = placed.join(blocks.drop("block_words"), ["nth", "block"])
    in_turn = Window.partitionBy("nth", "block").orderBy("h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.col("over") - F.col("passed") - F.coalesce(F.sum("size").over(in_turn), F.lit(0))
    return met.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long")).withColumn(
        "taken", F.col("epochs") * F.col("size") + F.col("part")
    )


def quotas(
    docs: DataFrame, key: str = "mix", weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs (doc_id, text, source).

    A null text has size 0; a null source is a source of its own, the last; a null doc_id is
    placed like any other id. Repeated rows each count. With no words at all every target is
    0. An empty table gives an empty result. Other columns are ignored. The taken words of a
    source add up to its target, rounded, and no document is taken more than `most` times.
    """
    lean = cut(docs.select("doc_id", "source", size(F.col("text")).alias("size")))
    sources, blocks = _plan(lean, key, weights, most)
    return _taken(_place(lean, sources, key), blocks).select(
        "doc_id", "size", F.col("words").alias("source_size"), "target", "taken"
    )


def hypergeometric(draw: random.Random, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn from good + bad, by inversion from the mode outwards."""
    low, high = max(0, n - bad), min(n, good)
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    from math import exp, lgamma

    def chance(k: int) -> float:
        choose = lambda a, b: lgamma(a + 1) - lgamma(b + 1) - lgamma(a - b + 1)
        return exp(choose(good, k) + choose(bad, n - k) - choose(good + bad, n))

    u = draw.random()
    up, down, p = mode, mode - 1, chance(mode)
    p_up = p_down = p
    while True:
        u -= p_up
        if u <= 0:
            return up
        if down >= low:
            p_down *= (down + 1) * (bad - n + down + 1) / ((good - down) * (n - down))
            u -= p_down
            if u <= 0:
                return down
            down -= 1
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
        elif down < low:
            return mode
        else:
            p_up = 0.0


def split_quotas(counts: Sequence[int], shards: int, seed: int) -> list[list[int]]:
    """counts per source -> one list of counts per shard, by the splitting tree."""
    out: list[list[int]] = []

    def node(mine: list[int], first: int, last: int) -> None:
        if last - first == 1:
            out.append(mine)
            return
        middle = (first + last) // 2
        draw = random.Random(f"{seed}:{first}:{last}")
        left_size = sum(mine) * (middle - first) // (last - first)
        rest, open_, left = sum(mine), left_size, []
        for c in mine:
            k = hypergeometric(draw, c, rest - c, open_) if open_ and c else 0
            left.append(k)
            rest, open_ = rest - c, open_ - k
        node(left, first, middle)
        node([c - k for c, k in zip(mine, left, strict=True)], middle, last)

    node(list(counts), 0, shards)
    return out


def first_words(text: Column, n: Column) -> Column:
    """The text up to its n-th word and the white space after it."""
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    parts = F.split(text, F.lit(SPACE), (n + lead + 1).cast("int"))
    tail = F.when(F.size(parts) > n + lead, F.length(F.element_at(parts, -1))).otherwise(0)
    return F.substring(text, F.lit(1), (F.length(text) - tail).cast("int"))


def _deal(sources: DataFrame, blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """nth, shard, copy, rank: every taken copy of a block with the shard the tree deals it to."""
    # blocks in use: all of them in whole epochs, the first ones in the broken one
    used = blocks.join(sources.select("nth", "over"), "nth").groupBy("nth").agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col("passed") < F.col("over")).alias("some")
    )
    counts = {r["nth"]: r for r in used.join(sources.select("nth", "epochs"), "nth").collect()}
    order = sorted(counts)
    drawn = split_quotas([counts[s]["epochs"] * counts[s]["all"] + counts[s]["some"] for s in order], shards, seed)
    ranges, at = [], dict.fromkeys(order, 0)
    for shard, mine in enumerate(drawn):
        for s, k in zip(order, mine, strict=True):
            if k:
                ranges.append((s, shard, at[s], at[s] + k - 1))
                at[s] += k
    spark = blocks.sparkSession
    return (
        spark.createDataFrame(ranges, "nth long, shard int, first long, last long")
        .withColumn("turn", F.explode(F.sequence("first", "last")))
        .join(
            spark.createDataFrame([(s, counts[s]["all"]) for s in order], "nth long, per_epoch long"), "nth"
        )
        .select("nth", "shard", F.floor(F.col("turn") / F.col("per_epoch")).alias("copy"),
                F.pmod("turn", "per_epoch").alias("rank"))
    )


#: words in an output shard, and the least number of shards
SHARD_WORDS, LEAST_SHARDS = 16_000_000, 64


def shard_count(sources: DataFrame, shard_words: int = SHARD_WORDS) -> int:
    """Shards of about `shard_words` words for what the mix takes."""
    words = sources.agg(F.sum(F.round("target"))).first()[0] or 0
    return max(LEAST_SHARDS, -(-int(words) // shard_words))


def dealt_quotas(
    docs: DataFrame,
    shards: int | None = None,
    key: str = "mix",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = 20,
) -> DataFrame:
    """The rows of `quotas`, with `taken` summed over the copies that `mix` deals to its shards.

    A block knows its dealt copies (at most `most` + 1), so rows stay as they are and no text
    moves. Rows of blocks that no shard holds have 0. Nulls, ties and empty tables as in `quotas`.
    """
    lean = cut(docs.select("doc_id", "source", size(F.col("text")).alias("size")))
    sources, blocks = _plan(lean, key, weights, most)
    shards = shards or shard_count(sources)
    copies = _deal(sources, blocks, shards, seed).groupBy("nth", "rank").agg(F.collect_list("copy").alias("copies"))
    placed = _taken(_place(lean, sources, key), blocks.join(copies, ["nth", "rank"], "left"))
    words = F.aggregate(
        F.coalesce("copies", F.array().cast("array<bigint>")),
        F.lit(0).cast("long"),
        lambda done, copy: done + F.when(copy < F.col("epochs"), F.col("size")).otherwise(F.col("part")),
    )
    return placed.select("doc_id", "size", F.col("words").alias("source_size"), "target", words.alias("taken"))


def mix(
    docs: DataFrame,
    shards: int | None = None,
    key: str = "mix",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = 20,
) -> DataFrame:
    """The mixed rows: the columns of docs, then copy, words and shard, shuffled in each shard.

    A document appears once per epoch it is taken in; a copy that is cut holds the first
    `words` words. The number of shards follows from the words taken (SHARD_WORDS each) unless it
    is given, and each shard is one partition. Documents without words are never taken. Own columns named like the ones
    added are replaced. Nulls, ties and empty tables as in `quotas`.
    """
    own = [c for c in docs.columns if c not in ("copy", "words", "shard")]
    lean = cut(docs.select("doc_id", "source", size(F.col("text")).alias("size")))
    sources, blocks = _plan(lean, key, weights, most)
    shards = shards or shard_count(sources)
    whole = docs.select(
        "doc_id", "source", size(F.col("text")).alias("size"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("own")
    )
    taken = _taken(_place(whole, sources, key), blocks).where("taken > 0")
    copies = taken.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("epochs")))).withColumn(
        "words", F.when(F.col("copy") < F.col("epochs"), F.col("size")).otherwise(F.col("part"))
    ).where("words > 0")
    dealt = _deal(sources, blocks, shards, seed)
    out = copies.join(dealt, ["nth", "copy", "rank"])
    text = F.col("own.text")
    cut_text = F.when(F.col("words") < F.col("size"), first_words(text, F.col("words"))).otherwise(text)
    columns = [cut_text.alias(c) if c == "text" else F.col(f"own.`{c}`") for c in own]
    tick = keyed(key, F.col("shard"), F.col("copy"), F.col("doc_id"))
    return (
        out.select(*columns, F.col("copy").cast("int").alias("copy"), "words", "shard")
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", tick)
    )
