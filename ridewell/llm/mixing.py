"""Mixing sources to target weights: exact block quotas split over output shards by a hypergeometric tree."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, spill, table

#: Plans of so many rows at most (a row for each block of a source, some 200 bytes) are broadcast.
SMALL_PLAN = 50_000
#: Words of a shard.
SHARD_WORDS = 20_000_000


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], num: int, den: int, cap: int) -> DataFrame:
    """source, source_size, place and target of each row (source, source_size).

    Sources by code point, null last, weigh as `weights` says, repeating, and share num / den of all
    sizes; a target stops at cap times its source's size, and the excess is shared again by weight.
    A source is capped when its cap is below its share of what the sources with a lower ratio of
    cap to weight leave, so one pass in the order of that ratio settles all of them.
    """
    ordered = sources.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("place", F.lit(len(weights))) + 1).cast("double")
    rows = ordered.withColumns({"weight": weight, "most": F.col("source_size") * F.lit(float(cap))})
    up = Window.orderBy(F.col("most") / F.col("weight"), "place")
    rows = rows.withColumns({
        "pool": F.sum("source_size").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * F.lit(num / den),
        "below": F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "heavy": F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    share = (F.col("pool") - F.col("below")) / F.col("heavy")
    rows = rows.withColumn("level", F.when(F.col("most") > F.col("weight") * share, share))
    # The level of the first source that is not capped is the level of all that are not.
    first = F.first("level", ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.withColumn("settled", first).select("source", "source_size", "place", F.when(F.col("level").isNull(), F.col("most")).otherwise(F.col("weight") * F.col("settled")).alias("target"))


def _halve(seed: int, level: int):
    def split(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        node, counts = int(group["node"].iloc[0]), group["draws"].to_numpy(np.int64)
        rng = np.random.default_rng([seed, level, node])
        left = rng.multivariate_hypergeometric(counts, int(counts.sum()) // 2, method="marginals")
        sides = [pd.DataFrame({"node": 2 * node + i, "place": group["place"], "draws": n}) for i, n in ((0, left), (1, counts - left))]
        return pd.concat(sides, ignore_index=True)

    return split


def shard_quotas(draws: DataFrame, levels: int, seed: int) -> DataFrame:
    """node, place, draws: how many block draws of each source each of the 2**levels shards gets, from (place, draws).

    Every node of the tree halves the draws it holds at random, exact in total and by source. A
    node's group has a row for each source.
    """
    tree = draws.select(F.lit(0).cast("long").alias("node"), F.col("place").cast("long").alias("place"), F.col("draws").cast("long").alias("draws"))
    for level in range(levels):
        tree = tree.groupBy("node").applyInPandas(_halve(seed, level), "node long, place long, draws long")
    return tree


def _fill(group: pd.DataFrame) -> pd.DataFrame:
    """Of a source's untaken units, counted by weight, how many fill what is left: the heaviest that fit come first."""
    group, left, out = group.sort_values("weight", ascending=False), float(group["left_words"].iloc[0]), []
    for weight, n in zip(group["weight"], group["units"], strict=True):
        out.append(min(int(n), int(left // weight)))
        left -= out[-1] * weight
    return group.assign(quota=out)[["source", "weight", "quota"]]


def least(wanted: DataFrame) -> DataFrame:
    """Of each source's units of one weight the `quota` first by key and size.

    First within each block, whose units are bounded by the words of a block: what a block does not
    let through could not be among the first of all. So no task sorts all units of a common weight.
    """
    for group in (("source", "weight", "block"), ("source", "weight")):
        wanted = wanted.withColumn("at", F.row_number().over(Window.partitionBy(*group).orderBy("key", "size"))).filter("at <= quota")
    return wanted


def _plan(units: DataFrame, weights: tuple[int, ...], num: int, den: int, cap: int, shard_words: int, seed: int) -> DataFrame:
    """What becomes of each block of each source: (s, b, source_size, target, shards, last, upto, fills).

    units: one for each source, key and size, with its block and the words of all its rows. `shards`
    has a struct (epoch, shard) for each time that the whole block is drawn. `last`, if not null, is
    the shard of the draw that comes short: of the block its units up to key `upto` are in it, and
    those whose (key, size) is in `fills`.
    """
    groups = spill(units.groupBy("source", "block").agg(F.sum("weight").alias("words")))
    goals = targets(groups.groupBy("source").agg(F.sum("words").alias("source_size")), weights, num, den, cap)
    goals = goals.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goals = goals.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    order = Window.partitionBy("place").orderBy(F.xxhash64(F.lit(seed + 1), "block"), "block")
    plan = groups.withColumnRenamed("source", "s").join(goals, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    plan = plan.withColumns({"turn": (F.row_number().over(order) - 1).cast("long"), "after": F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    before = F.col("after") - F.col("words")
    some = F.col("source_size") > 0
    plan = plan.withColumns({"extra": (some & (F.col("after") <= F.col("rest"))).cast("long"), "short": some & (F.col("after") > F.col("rest")) & (before <= F.col("rest")), "left_words": F.col("rest") - before})
    plan = spill(plan)

    # Of the block that does not fit whole, units in the order of their keys while they fit; then what fits best of all that is left.
    short = plan.filter("short").select(F.col("source").alias("s"), F.col("block").alias("b"), "turn", "left_words")
    later = plan.filter("extra = 0").select(F.col("source").alias("s"), F.col("block").alias("b"))
    near = Window.partitionBy("source", "block").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = units.join(short, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).withColumn("sum", F.sum("weight").over(near))
    cut = cut.groupBy("source", "block", "left_words").agg(F.max(F.when(F.col("sum") <= F.col("left_words"), F.struct("key", "sum"))).alias("last"))
    cut = spill(cut.select(F.col("source").alias("cut_s"), F.col("block").alias("cut_b"), F.col("last.key").alias("upto"), (F.col("left_words") - F.coalesce("last.sum", F.lit(0))).alias("left_words")))
    free = units.join(later, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")
    free = free.join(cut, F.col("source").eqNullSafe(F.col("cut_s"))).filter("weight > 0 AND weight <= left_words AND NOT (block = cut_b AND coalesce(key <= upto, false))")
    free = free.select("source", "block", "key", "size", "weight", "left_words")
    quota = free.groupBy("source", "weight", "left_words").agg(F.count("*").alias("units")).groupBy("source").applyInPandas(_fill, "source string, weight long, quota long").filter("quota > 0")
    quota = quota.select(F.col("source").alias("q_s"), F.col("weight").alias("q_w"), "quota")
    chosen = least(free.join(quota, F.col("source").eqNullSafe(F.col("q_s")) & (F.col("weight") == F.col("q_w"))))
    fills = chosen.groupBy("source", "block").agg(F.collect_list(F.struct("key", "size")).alias("fills"))
    fills = spill(fills.select(F.col("source").alias("f_s"), F.col("block").alias("f_b"), "fills"))

    counts = plan.groupBy("place").agg(F.max("passes").alias("passes"), F.sum("extra").alias("extra"), F.max(F.when(F.col("short"), F.col("turn"))).alias("short_turn"), F.count("*").alias("n_blocks"))
    draws = counts.withColumn("draws", F.col("passes") * F.col("n_blocks") + F.col("extra") + F.col("short_turn").isNotNull().cast("long"))
    words = plan.agg(F.sum(F.col("words") * F.lit(num / den))).first()[0] or 0
    quotas = shard_quotas(draws, shard_levels(words, shard_words), seed)
    ends = quotas.withColumn("end", F.sum("draws").over(Window.partitionBy("place").orderBy("node"))).groupBy("place").agg(F.sort_array(F.collect_list(F.struct("end", "node"))).alias("ends"))
    sources = spill(draws.join(ends, "place").select(F.col("place").alias("p"), "n_blocks", "short_turn", "ends"))
    plan = plan.join(sources, F.col("place") == F.col("p"))

    def shard(draw):
        """Draw number epoch * n_blocks + turn belongs to the first shard whose range ends beyond it."""
        return F.get(F.filter("ends", lambda x: x["end"] > draw), 0)["node"]

    epochs = F.when(F.col("passes") + F.col("extra") > 0, F.sequence(F.lit(0).cast("long"), F.col("passes") + F.col("extra") - 1)).otherwise(F.array().cast("array<long>"))
    shards = F.transform(epochs, lambda e: F.struct(e.alias("epoch"), shard(e * F.col("n_blocks") + F.col("turn")).alias("shard")))
    last = shard(F.col("passes") * F.col("n_blocks") + F.col("short_turn"))
    plan = plan.join(cut, F.col("source").eqNullSafe(F.col("cut_s")) & (F.col("block") == F.col("cut_b")), "left").join(fills, F.col("source").eqNullSafe(F.col("f_s")) & (F.col("block") == F.col("f_b")), "left")
    return spill(plan.select(F.col("source").alias("s"), F.col("block").alias("b"), "source_size", "target", "passes", shards.alias("shards"), last.alias("last"), "upto", F.coalesce("fills", F.array().cast("array<struct<key:bigint,size:bigint>>")).alias("fills")))


def shard_levels(words: float, shard_words: int = SHARD_WORDS) -> int:
    """Levels of the tree: 2**levels shards of at most shard_words words on average."""
    return max(2, math.ceil(math.log2(max(1.0, words / shard_words))))


def placements(docs: DataFrame, size: Column, weights: tuple[int, ...] = (3, 1, 2), num: int = 3, den: int = 2, cap: int = 2, blocks: int | None = None, shard_words: int = SHARD_WORDS, seed: int = 11) -> DataFrame:
    """mix and row of each row of docs: row has its columns, mix is struct<size, source_size, target, places>, places an array of (epoch, shard, place).

    docs needs doc_id and source; whatever other columns are called, they stay inside `row`. A source's
    documents fall into `blocks` blocks by a hash of doc_id (of 4 for each shard, 256 at least, if
    not given). The mix draws every block of a source as often as the target holds whole passes,
    then blocks in a permuted order while they fit, of the next block documents in a permuted order
    while they fit, and at last whichever documents fit best into what is left, so that a source
    falls short of its target by less than its smallest document that is not drawn once more. Each
    shard of the splitting tree takes the next of its source's permuted draws, as many as its quota
    says, so that shards are disjoint; `place` orders a shard locally.

    A null source is a source. Sources of no size get nothing, nor do documents without words beyond
    whole passes and blocks. Rows with equal doc_id (null included), source and size are drawn
    together, so reruns agree. An empty table gives an empty result. One task each sees a row for
    every source, and for every block of a source, but never documents.
    """
    names = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]
    rows = docs.select(F.struct(size.cast("long").alias("size"), F.xxhash64(F.lit(seed), "doc_id").alias("key"), F.col("source").alias("source")).alias("mix"), F.struct(*names).alias("row"))
    known = spill(rows.groupBy("mix").count())
    if blocks is None:
        words = known.agg(F.sum(F.col("mix.size") * F.col("count"))).first()[0] or 0
        blocks = max(256, 4 << shard_levels(words * num / den, shard_words))
    block = lambda key: F.pmod(F.xxhash64(key), F.lit(blocks))
    units = known.select("mix.source", "mix.key", "mix.size", block("mix.key").alias("block"), (F.col("mix.size") * F.col("count")).alias("weight"))
    plan = _plan(units, weights, num, den, cap, shard_words, seed)
    plan = F.broadcast(plan) if plan.count() <= SMALL_PLAN else plan
    rows = rows.join(plan, F.col("mix.source").eqNullSafe(F.col("s")) & (block("mix.key") == F.col("b")))
    own = F.struct(F.col("mix.key").alias("key"), F.col("mix.size").alias("size"))
    partly = F.col("last").isNotNull() & (F.size("shards") == F.col("passes")) & (F.coalesce(F.col("mix.key") <= F.col("upto"), F.lit(False)) | F.array_contains("fills", own))
    kept = F.when(partly, F.concat("shards", F.array(F.struct(F.col("passes").alias("epoch"), F.col("last").alias("shard"))))).otherwise(F.col("shards"))
    places = F.transform(kept, lambda x: F.struct(x["epoch"].alias("epoch"), x["shard"].alias("shard"), F.xxhash64(F.lit(seed + 2), x["shard"], x["epoch"], F.col("mix.key")).alias("place")))
    return rows.select(F.struct(F.col("mix.size").alias("size"), "source_size", "target", places.alias("places")).alias("mix"), "row")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of the mix with the columns of docs: a document appears as often as it is drawn, shuffled within its shard."""
    placed = placements(docs, words_of(F.col("text")), **how).select(F.explode("mix.places").alias("at"), "row")
    return placed.repartition("at.shard").sortWithinPartitions("at.shard", "at.place").select("row.*")


def op7(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = spill(docs.select("doc_id", "source", words_of(F.col("text")).alias("size")))
    placed = placements(sized, F.col("size")).select("row.doc_id", "mix.*")
    # What a document's shards receive of it.
    return placed.select("doc_id", "size", "source_size", "target", F.aggregate("places", F.lit(0).cast("long"), lambda n, _: n + F.col("size")).alias("taken"), F.transform("places", lambda x: x["shard"]).alias("shards"))
