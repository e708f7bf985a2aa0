"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame functions only.

Documents are hashed into blocks per source. A source's blocks are permuted for
each pass over it and drawn until its target is met to the word. The numbers of
drawn blocks per source are exact quotas; a binary tree over the output shards
splits them, at each node by a multivariate hypergeometric draw, so every shard
gets its exact number of blocks in a random composition. Shards take disjoint runs
of the permuted blocks and are shuffled locally.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketry.llm.common import WORD, n_words, numbered, renamed, stored


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, passes: int = 2) -> DataFrame:
    """(source, no, source_size, target) from (source, source_size).

    Sources in code point order, null last, take the weights in turn and share
    `share` of all words by weight; a target stops at `passes` times its source's size
    and the excess is shared again by weight. In one step: the level at which the
    capped shares add up, found on the sources sorted by cap per weight. The windows
    see one row per source.
    """
    names = sizes.withColumn("no", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    each = F.array(*[F.lit(w) for w in weights])
    rows = names.withColumn("weight", F.element_at(each, (F.col("no") - 1) % len(weights) + 1))
    rows = rows.withColumn("cap", F.lit(passes) * F.col("source_size")).withColumn("turn", F.col("cap") / F.col("weight"))
    by_turn = W.orderBy("turn", "no").rowsBetween(W.unboundedPreceding, W.currentRow)
    every = W.orderBy("turn", "no").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = rows.withColumns(
        {
            "caps": F.sum("cap").over(by_turn),
            "before": F.sum("weight").over(by_turn),
            "all_weights": F.sum("weight").over(every),
            "wanted": F.sum("source_size").over(every) * F.lit(share),
        }
    )
    reached = F.col("caps") + F.col("turn") * (F.col("all_weights") - F.col("before")) >= F.col("wanted")
    level = (F.col("wanted") - (F.col("caps") - F.col("cap"))) / (F.col("all_weights") - F.col("before") + F.col("weight"))
    rows = rows.withColumn("level", F.min(F.when(reached, F.struct("turn", "no", level.alias("at")))).over(every)["at"])
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return rows.select("source", "no", "source_size", target.alias("target"))


def hypergeometric(population: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Number of marked among `drawn` of `population`, by inversion at the uniform u, exact up to rounding of doubles."""
    low = F.greatest(F.lit(0).cast("long"), drawn - (population - marked))
    high = F.least(marked, drawn)

    def following(weight: Column, x: Column) -> Column:
        up = F.log(((marked - x) * (drawn - x)).cast("double"))
        down = F.log(((x + 1) * (population - marked - drawn + x + 1)).cast("double"))
        return F.when(x < high, weight + up - down).otherwise(weight)

    def add(acc: Column, x: Column) -> Column:
        top = F.greatest(acc["top"], acc["weight"])
        mass = acc["mass"] * F.exp(acc["top"] - top) + F.exp(acc["weight"] - top)
        return F.struct(following(acc["weight"], x).alias("weight"), top.alias("top"), mass.alias("mass"))

    zero = F.lit(0.0)
    whole = F.aggregate(F.sequence(low, high), F.struct(zero.alias("weight"), zero.alias("top"), zero.alias("mass")), add)

    def pick(total: Column) -> Column:
        def find(acc: Column, x: Column) -> Column:
            sofar = acc["sofar"] + F.exp(acc["weight"] - total["top"]) / total["mass"]
            found = F.when(acc["found"] >= 0, acc["found"]).when(sofar >= u, x).otherwise(F.lit(-1).cast("long"))
            return F.struct(following(acc["weight"], x).alias("weight"), sofar.alias("sofar"), found.alias("found"))

        start = F.struct(zero.alias("weight"), zero.alias("sofar"), F.lit(-1).cast("long").alias("found"))
        return F.aggregate(F.sequence(low, high), start, find)["found"]

    found = F.transform(F.array(whole), pick)[0]
    return F.when(low >= high, low).when(found >= 0, found).otherwise(high)


def splitting_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, no, n) from (no, n): blocks of each source for each shard; shard sizes differ by at most the rounding."""
    root = quotas.agg(F.sort_array(F.collect_list(F.struct("no", F.col("n").cast("long").alias("n")))).alias("parts"))
    nodes = root.select(F.lit(0).alias("first"), F.lit(shards).alias("width"), "parts")
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        if level and level % 8 == 0:
            nodes = nodes.repartition("first")
        half = F.floor(F.col("width") / 2).cast("int")
        total = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["n"])

        def draw(acc: Column, part: Column) -> Column:
            u = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("first"), part["no"]), F.lit(1 << 53)) / float(1 << 53)
            k = hypergeometric(acc["population"], part["n"], acc["drawn"], u)
            after = F.transform(
                F.array(k),
                lambda k: F.struct(
                    (acc["population"] - part["n"]).alias("population"),
                    (acc["drawn"] - k).alias("drawn"),
                    F.concat(acc["out"], F.array(F.struct(part["no"].alias("no"), k.alias("n")))).alias("out"),
                ),
            )
            return after[0]

        start = F.struct(
            F.col("total").alias("population"),
            F.floor(F.col("total") * F.col("half") / F.col("width")).cast("long").alias("drawn"),
            F.expr("cast(array() as array<struct<no:int,n:bigint>>)").alias("out"),
        )
        nodes = nodes.withColumn("half", half).withColumn("total", total)
        nodes = nodes.withColumn("left", F.aggregate("parts", start, draw)["out"])
        rest = F.zip_with("parts", "left", lambda p, q: F.struct(p["no"].alias("no"), (p["n"] - q["n"]).alias("n")))
        two = F.array(
            F.struct(F.col("first").alias("first"), F.col("half").alias("width"), F.col("left").alias("parts")),
            F.struct((F.col("first") + F.col("half")).alias("first"), (F.col("width") - F.col("half")).alias("width"), rest.alias("parts")),
        )
        one = F.array(F.struct(F.col("first").alias("first"), F.col("width").alias("width"), F.col("parts").alias("parts")))
        nodes = nodes.select(F.inline(F.when(F.col("width") > 1, two).otherwise(one)))
    return nodes.select(F.col("first").alias("shard"), F.inline("parts"))


def plan(blocks: DataFrame, wanted: DataFrame, shards: int, passes: int, seed: int) -> DataFrame:
    """One row per block: source, block, source_size, target, draws array<struct<pass, shard, words>>, and whether a draw is partial.

    `blocks` is (source, block, words), `wanted` the result of targets().
    """
    goal = F.round("target").cast("long")
    rows = blocks.withColumnRenamed("source", "of").join(wanted, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    every = rows.withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(passes))))
    every = every.withColumn("order", F.xxhash64(F.lit(seed), F.col("no"), F.col("block"), F.col("pass")))
    run = W.partitionBy("no").orderBy("pass", "order", "block")
    every = every.withColumn("before", F.sum("words").over(run) - F.col("words"))
    # each pass goes over all blocks, so the running sum over passes is the place in the whole draw
    words = F.greatest(F.lit(0).cast("long"), F.least(F.col("words"), goal - F.col("before")))
    drawn = every.withColumn("take", words).where("take > 0").withColumn("place", F.row_number().over(run))
    drawn = drawn.select("no", "block", "pass", "take", "place")
    drawn = stored(drawn, "mix-drawn")
    shares = splitting_tree(drawn.groupBy("no").agg(F.count("*").alias("n")), shards, seed).where("n > 0")
    along = W.partitionBy("no").orderBy("shard")
    shares = shares.withColumn("last", F.sum("n").over(along)).withColumn("start", F.col("last") - F.col("n") + 1)
    places = shares.select("no", "shard", F.explode(F.sequence("start", "last")).alias("place"))
    placed = drawn.join(places, ["no", "place"])
    draws = F.sort_array(F.collect_list(F.struct("pass", "shard", F.col("take").alias("words"))))
    draws = placed.groupBy("no", "block").agg(draws.alias("draws"))  # at most one row per pass
    partial = F.coalesce(F.exists("draws", lambda d: d["words"] < F.col("words")), F.lit(False))
    return rows.join(draws, ["no", "block"], "left").select("source", "block", "source_size", "target", "draws", partial.alias("partial"))


def _mixed(docs: DataFrame, weights, share, passes, shards, blocks, shard_words, text, key, source, seed) -> tuple[DataFrame, str]:
    """Numbered rows of docs with size, source_size, target, draws, taken; the name of the text column."""
    rows, (of_key, of_source, of_text) = numbered(docs, key, source, text)
    rows = rows.withColumn("order", F.xxhash64(F.lit(seed), F.col(of_key), F.col(of_text))).withColumn("part", F.pmod("order", F.lit(blocks)))
    by_block = rows.groupBy(F.col(of_source).alias("source"), F.col("part").alias("block"))
    table = stored(by_block.agg(F.sum(n_words(of_text)).alias("words")), "mix-blocks")
    sizes = stored(table.groupBy("source").agg(F.sum("words").alias("source_size")), "mix-sources")
    if shards is None:
        total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
        shards = max(8, math.ceil(share * total / shard_words))
    wanted = stored(targets(sizes, weights, share, passes), "mix-targets")
    plans = stored(plan(table, wanted, shards, passes, seed), "mix-plan")
    rows = rows.join(plans, F.col(of_source).eqNullSafe(F.col("source")) & (F.col("part") == F.col("block")))
    # only blocks that are cut, at most one per source and pass, need their rows in order
    inside = W.partitionBy("source", "block").orderBy("order", of_key).rowsBetween(W.unboundedPreceding, -1)
    whole = rows.where(~F.col("partial")).withColumn("size", n_words(of_text)).withColumn("before", F.lit(0).cast("long"))
    cut_here = rows.where("partial").withColumn("size", n_words(of_text))
    rows = whole.unionByName(cut_here.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))))

    def cut(d: Column) -> Column:
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), d["words"] - F.col("before")))
        order = F.xxhash64(F.lit(seed), d["pass"], F.col("order"))
        return F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), words.alias("words"), order.alias("order_key"))

    empty = F.expr("cast(array() as array<struct<pass:int,shard:int,words:bigint,order_key:bigint>>)")
    draws = F.filter(F.coalesce(F.transform("draws", cut), empty), lambda d: d["words"] > 0)
    rows = rows.withColumn("draws", draws).withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]))
    return rows, of_text


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    passes: int = 2,
    shards: int | None = None,
    blocks: int = 1024,
    shard_words: int = 4_000_000,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    seed: int = 17,
) -> DataFrame:
    """Every row of docs with size, source_size, target, draws, taken.

    draws holds what the mix takes of the row: (pass, shard, words, order_key); words
    below size mean that the text is cut there, which happens to one document per
    source and pass at most. taken is the sum of words. Without `shards`, shards hold
    about `shard_words` words.

    Null text has size 0 and is never drawn; null sources are one source, the last;
    repeated rows are drawn as separate rows; ids may be null; input columns named as
    the added ones are replaced, others pass; an empty table gives an empty result.
    """
    rows, _ = _mixed(docs, weights, share, passes, shards, blocks, shard_words, text, key, source, seed)
    return renamed(rows, docs, "size", "source_size", "target", "draws", "taken")


def mixed_corpus(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    passes: int = 2,
    shards: int | None = None,
    blocks: int = 1024,
    shard_words: int = 4_000_000,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    seed: int = 17,
) -> DataFrame:
    """The mixed corpus: a row per draw with docs' columns, pass, shard and words, dealt and shuffled by shard.

    Cases as in mix(); input columns named pass, shard or words are replaced.
    """
    rows, of_text = _mixed(docs, weights, share, passes, shards, blocks, shard_words, text, key, source, seed)
    rows = rows.select(*[f"c{i}" for i in range(len(docs.columns))], "size", F.inline("draws"))
    start = F.array_join(F.slice(F.regexp_extract_all(F.col(of_text), F.lit(WORD), 0), 1, F.col("words").cast("int")), " ")
    rows = rows.withColumn(of_text, F.when(F.col("words") == F.col("size"), F.col(of_text)).otherwise(start))
    return renamed(rows.repartition("shard").sortWithinPartitions("shard", "order_key"), docs, "pass", "shard", "words")
