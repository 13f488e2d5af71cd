"""Mixing sources to target weights with exact block quotas for every shard.

The documents of a source lie in a random but fixed order, cut into blocks.
A source's target decides how often its blocks are used: so many whole passes,
then a part of one more, to the document. The blocks used are dealt to output
shards by a splitting tree: at each node a multivariate hypergeometric draw
says how many blocks of each source go left, so the leaves hold exact quotas
that add up. Permuted blocks then fill the quotas, each block in one place,
and a shard is shuffled locally. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flarebook.llm.tables import WORD, scratch

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCKS = 256
SEED = "mix"


def random_text(*parts: Column) -> Column:
    """A fixed pseudo-random text of its parts."""
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))


def uniform(text: Column) -> Column:
    """A number from 0 to 1 out of the first 52 bits of a hash."""
    return F.conv(F.substring(text, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def hypergeometric(total: Column, marked: Column, drawn: Column, chance: Column) -> Column:
    """How many marked ones are among those drawn, by inverting the distribution.

    Weights are kept as logarithms and taken relative to the largest one, so
    with any numbers none overflows, and those that count do not vanish.
    """
    least = F.greatest(F.lit(0), drawn - (total - marked))
    most = F.least(drawn, marked)
    whole_number = F.array().cast("array<int>")

    def counts() -> Column:
        return F.when(most > least, F.sequence(least, most - 1)).otherwise(whole_number)

    def following(log: Column, count: Column) -> Column:
        more = (marked - count) * (drawn - count) / ((count + 1) * (total - marked - drawn + count + 1))
        return log + F.log(more)

    def highest(state: Column, count: Column) -> Column:
        log = following(state["log"], count)
        return F.struct(log.alias("log"), F.greatest(state["top"], log).alias("top"))

    zero = F.lit(0.0)
    top = F.aggregate(counts(), F.struct(zero.alias("log"), zero.alias("top")), highest, lambda s: s["top"])
    start = F.struct(zero.alias("log"), top.alias("top"), F.exp(-top).alias("sum"))

    def add(state: Column, count: Column) -> Column:
        log = following(state["log"], count)
        weight = F.exp(log - state["top"])
        return F.struct(log.alias("log"), state["top"].alias("top"), (state["sum"] + weight).alias("sum"))

    added = F.aggregate(counts(), start, add)
    first = F.struct(
        zero.alias("log"),
        added["top"].alias("top"),
        F.exp(-added["top"]).alias("sum"),
        least.alias("found"),
        (chance * added["sum"]).alias("limit"),
    )

    def step(state: Column, count: Column) -> Column:
        log = following(state["log"], count)
        passed = state["sum"] <= state["limit"]
        return F.struct(
            log.alias("log"),
            state["top"].alias("top"),
            (state["sum"] + F.exp(log - state["top"])).alias("sum"),
            (state["found"] + passed.cast("int")).alias("found"),
            state["limit"].alias("limit"),
        )

    return F.aggregate(counts(), first, step, lambda s: s["found"])


def split(quotas: Column, node: Column, seed: str) -> Column:
    """Counts of the left child: half of all blocks of a node, drawn without looking at their source."""
    total = F.aggregate(quotas, F.lit(0), lambda n, q: n + q["quota"])
    start = F.struct(
        total.alias("total"),
        F.floor(total / 2).cast("int").alias("drawn"),
        F.array().cast("array<int>").alias("left"),
    )

    def draw(state: Column, q: Column) -> Column:
        chance = uniform(random_text(F.lit(seed), node, q["place"]))
        count = hypergeometric(state["total"], q["quota"], state["drawn"], chance)
        return F.transform(
            F.array(count),
            lambda c: F.struct(
                (state["total"] - q["quota"]).alias("total"),
                (state["drawn"] - c).alias("drawn"),
                F.concat(state["left"], F.array(c)).alias("left"),
            ),
        )[0]

    return F.aggregate(quotas, start, draw, lambda s: s["left"])


def splitting_tree(sources: DataFrame, levels: int, seed: str) -> DataFrame:
    """``place``, ``shard``, ``quota`` of each source (``place``, ``quota``) in 2^levels shards.

    A node is one row with a count for each source.
    """
    nodes = sources.agg(F.sort_array(F.collect_list(F.struct("place", "quota"))).alias("quotas")).withColumn(
        "node", F.lit(1)
    )

    def taken(quotas: Column, counts: Column) -> Column:
        return F.zip_with(quotas, counts, lambda q, c: F.struct(q["place"].alias("place"), c.alias("quota")))

    for _ in range(levels):
        halves = F.transform(
            F.array(split(F.col("quotas"), F.col("node"), seed)),
            lambda left: F.array(
                F.struct((F.col("node") * 2).alias("node"), taken(F.col("quotas"), left).alias("quotas")),
                F.struct(
                    (F.col("node") * 2 + 1).alias("node"),
                    taken(
                        F.col("quotas"), F.zip_with(F.col("quotas"), left, lambda q, c: q["quota"] - c)
                    ).alias("quotas"),
                ),
            ),
        )[0]
        nodes = nodes.select(F.explode(halves).alias("half")).select("half.node", "half.quotas")
    return nodes.select((F.col("node") - 2**levels).alias("shard"), F.explode("quotas").alias("q")).select(
        "q.place", "shard", "q.quota"
    )


def targets(sizes: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source``, ``place``, ``source_size``, ``target`` from ``source`` and ``source_size``.

    All targets add up to ``share`` of all sizes, in proportion to the weights;
    a target stops at ``most`` times its source, and what is above goes to the
    others by weight. One row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn(
        "place", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weighed = ranked.withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") % len(weights))
    ).withColumn("limit", (F.col("source_size") * most).cast("double"))
    # Sources reach their limit in this order; the level of the water is the
    # highest that any number of full sources would give the rest.
    filling = everything.orderBy(F.col("limit") / F.col("weight"), "place")
    full = F.coalesce(F.sum("limit").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    all_words = F.sum("source_size").over(everything)
    leveled = weighed.withColumn("level", (all_words * share - full) / rest)
    level = F.max("level").over(everything)
    return leveled.select(
        "source", "place", "source_size", F.least("limit", F.col("weight") * level).alias("target")
    )


def mix(
    docs: DataFrame,
    share: float = SHARE,
    most: int = MOST,
    weights: tuple[int, ...] = WEIGHTS,
    blocks: int = BLOCKS,
    levels: int = 6,
    seed: str = SEED,
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``shards``, ``source``, ``text_key`` of each row.

    Reads ``doc_id``, ``text`` and ``source``. A size is the number of words; a
    null text has none; a null source is a source, the last one. ``shards``
    names the shard of each copy that the mix takes, ``taken`` is their number
    times the size. Rows with equal ``doc_id`` are placed by size; equal rows
    share a place in any order. ``most * blocks`` should stay below a thousand.

    Text is read once for its size and never shuffled. The wide steps run over
    rows of a few numbers, by source and block, so a source with a third of all
    rows is spread over ``blocks`` groups.
    """
    key = random_text(F.lit(seed), F.col("doc_id"))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("text_key"),
    ).withColumn("key", key)
    sized = sized.withColumn("block", (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % blocks).cast("int"))
    block_sizes = sized.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    sources = targets(block_sizes.groupBy("source").agg(F.sum("block_size").alias("source_size")), share, most, weights)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    sources = sources.withColumn("passes", passes).withColumn(
        "rest", F.col("target") - F.col("passes") * F.col("source_size")
    )
    own = Window.partitionBy("place").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    used = (
        block_sizes.withColumnRenamed("source", "block_source")
        .join(sources, F.col("block_source").eqNullSafe(F.col("source")))
        .withColumn("block_before", F.coalesce(F.sum("block_size").over(own), F.lit(0)))
        .withColumn("copies", F.col("passes") + (F.col("block_before") < F.col("rest")).cast("int"))
    )
    # Blocks in permuted order fill the places that the tree left for their source.
    tickets = (
        used.filter("copies > 0")
        .select("place", "block", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
        .withColumn(
            "turn",
            F.row_number().over(
                Window.partitionBy("place").orderBy(
                    random_text(F.lit(seed), F.col("place"), F.col("block"), F.col("copy")), "block", "copy"
                )
            ),
        )
    )
    quotas = splitting_tree(used.groupBy("place").agg(F.sum("copies").cast("int").alias("quota")), levels, seed)
    slots = (
        quotas.filter("quota > 0")
        .select("place", "shard", F.explode(F.sequence(F.lit(1), "quota")).alias("slot"))
        .select(
            "place",
            "shard",
            F.row_number().over(Window.partitionBy("place").orderBy("shard", "slot")).alias("turn"),
        )
    )
    dealt = (
        tickets.join(slots, ["place", "turn"])
        .groupBy("place", "block")
        .agg(F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("dealt"))
    )
    plan = used.join(dealt, ["place", "block"], "left").select(
        F.col("block_source"),
        F.col("block").alias("of_block"),
        "source_size",
        "target",
        "passes",
        "rest",
        "block_before",
        F.coalesce(F.transform("dealt", lambda d: d["shard"]), F.array().cast("array<int>")).alias("block_shards"),
    )
    in_block = (
        Window.partitionBy("source", "block")
        .orderBy("key", "doc_id", "size", "text_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        sized.withColumn("within", F.coalesce(F.sum("size").over(in_block), F.lit(0)))
        .join(plan, F.col("source").eqNullSafe(F.col("block_source")) & (F.col("block") == F.col("of_block")))
        .withColumn("more", F.col("block_before") + F.col("within") + F.col("size") / 2 <= F.col("rest"))
    )
    copies = F.col("passes") + (F.col("more") & (F.col("rest") > 0)).cast("int")
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.slice("block_shards", F.lit(1), copies).alias("shards"),
        "source",
        "text_key",
    ).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("shards")).alias("taken"),
        "shards",
        "source",
        "text_key",
    )


def deal(docs: DataFrame, mixed: DataFrame, seed: str = SEED) -> DataFrame:
    """All columns of ``docs``, a row for each copy that the mix takes; shards lie one after another, each shuffled.

    A shard's rows are sorted by a hash in as many tasks as they need. Rows are
    told apart by id, source and text; of rows that are equal in these, each
    gets the copies of one.
    """
    taken = {c.lower() for c in docs.columns}
    prefix = "own_"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    own = [f"{prefix}{c}" for c in ("doc_id", "source", "text_key")]
    shards, rows, nth, shard, turn = (f"{prefix}{c}" for c in ("shards", "rows", "nth", "shard", "turn"))
    # Read several times below, so decided once.
    folder = scratch(docs.sparkSession, "mix")
    mixed.select("doc_id", "source", "text_key", "shards").toDF(*own, shards).write.parquet(folder)
    decided = docs.sparkSession.read.parquet(folder)
    groups = decided.groupBy(*own).agg(F.count(F.lit(1)).alias(rows), F.first(shards).alias(shards))
    keys = [F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64("text")]
    same = [key.eqNullSafe(F.col(name)) for key, name in zip(keys, own)]
    alone = docs.join(groups.filter((F.col(rows) == 1) & (F.size(shards) > 0)).drop(rows), same)

    # Equal rows: the first of the table's has the copies of the first that was decided, and so on.
    several = groups.filter(F.col(rows) > 1).select(*own)
    of = Window.partitionBy(*own)
    matched = docs.join(several, same).withColumn(nth, F.row_number().over(of.orderBy(*own)))
    same_group = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in own]
    numbered = decided.join(several.toDF(*[f"{c}_" for c in own]), same_group, "left_semi")
    numbered = numbered.withColumn(nth, F.row_number().over(of.orderBy(F.size(shards), shards)))
    numbered = numbered.toDF(*[f"{c}_" for c in own], shards, f"{nth}_")
    also = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in (*own, nth)]
    repeated = matched.join(numbered.filter(F.size(shards) > 0), also)

    columns = [F.col(c) for c in docs.columns]
    both = alone.select(*columns, *own, shards).unionByName(repeated.select(*columns, *own, shards))
    copies = both.select(*columns, *own, F.posexplode(shards).alias(nth, shard))
    order = random_text(F.lit(seed), F.col(shard), *[F.col(c) for c in own], F.col(nth))
    dealt = copies.withColumn(turn, order).drop(*own, nth)
    return dealt.repartitionByRange(shard, turn).sortWithinPartitions(shard, turn).select(*columns)
