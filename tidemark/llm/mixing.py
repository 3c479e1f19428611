"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every step is a DataFrame operation. Each source is cut into a fixed number of blocks by a hash of its rows, so the
blocks of a source that holds a third of all rows are as many as those of any other, and no task gets a whole source.
The mix takes whole passes over a source plus a prefix of its permuted blocks; the block on the edge is cut at the
row whose running total comes nearest, found by radix refinement of the hash (two levels of 10 bits, then rows).
The taken blocks of a source are its quota. The tree halves the multiset of all quotas again and again: a node is a run of a random
order of the sources' anonymous tickets and its first half goes left, so the number of each
source's tickets on the left is a draw from the multivariate hypergeometric distribution and every quota is kept
exactly. The order is that of a seeded hash; a ticket's place in it is the number of tickets in the buckets before its own (the
hash's first bits) and its place in its bucket, so no task ranks more than one bucket. Each source's permuted blocks are then dealt to the shards by its quotas; the mix is dealt over tasks and, within each,
ordered by shard and a seeded hash: that is the local shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import columns, stored, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
#: Bits of a row's hash: the top ones name its block, the low ones its place in the block, refined so many at a time.
BLOCK_BITS = 8
LOW_BITS = 64 - BLOCK_BITS
REFINE_BITS = 10
BUCKET_BITS = 12
WORD = r"[^\x20\x09-\x0D]++"


def _seeded(seed: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def sized(docs: DataFrame, seed: int = 7) -> DataFrame:
    """Rows of ``docs`` as doc_id, source, size (words; null text: 0), block (top bits of a hash of id and text), low (the other bits)."""
    spot = _seeded(seed, F.col("doc_id"), F.col("text"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"), spot.alias("spot"))
    return rows.select("doc_id", "source", "size", F.shiftrightunsigned("spot", LOW_BITS).cast("int").alias("block"), F.col("spot").bitwiseAND(F.lit((1 << LOW_BITS) - 1)).alias("low"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target.

    Sources in code point order, null last, take ``weights`` in turn. Filling up to the caps is solved in closed form: with
    sources ordered by cap over weight, the capped ones are a prefix, and all others get the same amount per weight.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.expr(f"cast((n - 1) % {len(weights)} + 1 as int)")).cast("double")
    w = sums.withColumn("n", F.row_number().over(order)).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    whole = Window.partitionBy(F.lit(0))
    filled = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "n")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("left", F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    w = w.withColumn("level", F.col("left") / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # The first source that its share does not fill sets the level for itself and all after it.
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("cap_rank", "level"))).over(whole)
    w = w.withColumn("cap_rank", F.row_number().over(filled)).withColumn("set", level)
    target = F.when((F.col("cap_rank") >= F.col("set.cap_rank")), F.least("cap", F.col("set.level") * F.col("weight"))).otherwise(F.col("cap"))
    return w.select("source", "source_size", target.alias("target"))


def _edge(rows: DataFrame, need: DataFrame, key: Column) -> DataFrame:
    """Per source, the value of ``key`` at which the running size passes what is needed, and what is needed before it.

    ``need``: source, rest. Returns source, at, rest: the part of the rest that falls in the rows whose key is ``at``.
    """
    sums = rows.withColumn("at", key).groupBy("source", "at").agg(F.sum("size").alias("here"))
    run = Window.partitionBy("source").orderBy("at")
    sums = sums.alias("s").join(need.alias("n"), F.col("s.source").eqNullSafe(F.col("n.source"))).select("s.source", "s.at", "here", "rest")
    sums = sums.withColumn("till", F.sum("here").over(run))
    return sums.where((F.col("till") - F.col("here") < F.col("rest")) & (F.col("till") >= F.col("rest"))).select("source", "at", (F.col("rest") - (F.col("till") - F.col("here"))).alias("rest"))


def placed(tickets: DataFrame) -> DataFrame:
    """``tickets`` with place (from 0, in the order of spot) and all (how many there are)."""
    bucket = F.shiftrightunsigned("spot", 64 - BUCKET_BITS).alias("bucket")
    counts = tickets.groupBy(bucket).agg(F.count("*").alias("here"))  # at most 2 ** BUCKET_BITS rows
    run = Window.partitionBy(F.lit(0)).orderBy("bucket")
    counts = counts.withColumn("before", F.sum("here").over(run) - F.col("here")).withColumn("all", F.sum("here").over(Window.partitionBy(F.lit(0))))
    inside = Window.partitionBy("bucket").orderBy("spot", "source", "ticket")
    return tickets.withColumn("bucket", bucket).join(counts, "bucket").withColumn("place", F.col("before") + F.row_number().over(inside) - 1)


def plan(rows: DataFrame, shard_bits: int = 4, seed: int = 7, **how) -> tuple[DataFrame, DataFrame]:
    """The targets, and the plan of each block: source, block, shards (one for each whole taking), edge_shard, edge_low.

    Rows of a block are taken once for each of ``shards``, and once more into ``edge_shard`` if low <= edge_low.
    """
    goal = targets(rows, **how)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    goal = stored(goal.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix-goal")
    blocks = stored(rows.groupBy("source", "block").agg(F.sum("size").alias("here")), "mix-blocks")
    run = Window.partitionBy("source").orderBy("permuted", "block")
    b = blocks.alias("b").join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source"))).select("b.source", "block", "here", "passes", "rest")
    b = b.withColumn("permuted", _seeded(seed + 1, F.col("source"), F.col("block"))).withColumn("till", F.sum("here").over(run))
    b = b.withColumn("kind", F.when((F.col("rest") > 0) & (F.col("till") <= F.col("rest")), "in").when(F.col("till") - F.col("here") < F.col("rest"), "edge").otherwise("out"))
    b = stored(b.withColumn("edge_rest", F.when(F.col("kind") == "edge", F.col("rest") - (F.col("till") - F.col("here")))), "mix-taken")

    # The cut inside the block on the edge: radix levels of the low bits, then the rows that share the last level's digits.
    edge = b.where(F.col("kind") == "edge").select("source", "block", F.col("edge_rest").alias("rest"))
    same = F.col("r.source").eqNullSafe(F.col("e.source"))
    inside = stored(rows.alias("r").join(edge.alias("e"), same & (F.col("r.block") == F.col("e.block"))).select("r.source", "low", "size"), "mix-inside")
    found, shift = edge.select("source", "rest"), LOW_BITS
    for _ in range(2):
        shift -= REFINE_BITS
        digits = F.shiftright("low", shift)
        found = stored(_edge(inside, found, digits), "mix-digits")
        inside = inside.alias("r").join(found.alias("e"), same & (digits == F.col("at"))).select("r.source", "low", "size")
    last = Window.partitionBy("source").orderBy("low")
    spots = inside.groupBy("source", "low").agg(F.sum("size").alias("here")).alias("r").join(found.alias("e"), same).select("r.source", "low", "here", "rest")
    # The last row is taken if half of it or more is needed.
    cut = spots.withColumn("till", F.sum("here").over(last)).where(F.col("till") - F.col("here") / 2 <= F.col("rest")).groupBy("source").agg(F.max("low").alias("top"))
    cut = found.alias("r").join(cut.alias("e"), same, "left").select("r.source", F.coalesce("top", F.shiftleft("at", shift) - 1).alias("edge_low"))

    # Quotas: one ticket for each taking of a block. The tree halves the tickets, whichever source they are of.
    slots = b.select("source", "block", "permuted", F.expr("case kind when 'out' then passes else passes + 1 end").alias("times"), "kind", "passes").where("times > 0")
    slots = slots.select("source", "block", "permuted", "kind", "passes", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("pass"))
    deal = Window.partitionBy("source").orderBy("pass", "permuted", "block")
    slots = stored(slots.withColumn("ticket", F.row_number().over(deal)), "mix-slots")
    nodes = placed(slots.select("source", "ticket", _seeded(seed + 2, F.col("source"), F.col("ticket")).alias("spot")))
    nodes = nodes.withColumn("node", F.lit(0))
    for _ in range(shard_bits):
        left = F.floor((F.col("all") + 1) / 2)
        right = F.col("place") >= left
        nodes = nodes.select("source", "ticket", (F.col("node") * 2 + right.cast("int")).alias("node"), F.when(right, F.col("place") - left).otherwise(F.col("place")).alias("place"), F.when(right, F.col("all") - left).otherwise(left).alias("all"))
    quotas = Window.partitionBy("source").orderBy("node", "ticket")
    dealt = nodes.select("source", F.col("node").alias("shard"), F.row_number().over(quotas).alias("ticket"))
    dealt = slots.alias("s").join(dealt.alias("d"), F.col("s.source").eqNullSafe(F.col("d.source")) & (F.col("s.ticket") == F.col("d.ticket"))).select("s.source", "block", "pass", "passes", "kind", "shard")
    on_edge = (F.col("kind") == "edge") & (F.col("pass") > F.col("passes"))
    per_block = dealt.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.when(~on_edge, F.col("shard")))).alias("shards"), F.max(F.when(on_edge, F.col("shard"))).alias("edge_shard"))
    per_block = per_block.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left").select("p.source", "block", "shards", "edge_shard", "edge_low")
    return goal, stored(per_block, "mix-plan")


def dealt_rows(docs: DataFrame, shard_bits: int = 4, seed: int = 7, **how) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, size, source_size, target, shards (one for each taking).

    Null text: size 0. Null source: a source of its own, last. A source without words is not taken. Rows equal in
    doc_id and text (any of them null) share one hash, so they are taken together. Empty table: no rows. Columns other
    than doc_id, text and source play no part. The same rows and seed give the same mix, however they are partitioned.
    """
    rows = stored(sized(docs, seed), "mix-sizes")
    goal, blocks = plan(rows, shard_bits, seed, **how)
    none = F.array().cast("array<int>")
    taken = F.concat("p.shards", F.when(F.col("edge_shard").isNotNull() & (F.col("low") <= F.col("edge_low")), F.array("edge_shard")).otherwise(none))
    out = rows.alias("r").join(blocks.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.block") == F.col("p.block")), "left")
    out = out.select("r.doc_id", "r.source", "size", F.coalesce(taken, none).alias("shards"))
    return out.alias("o").join(goal.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source"))).select("doc_id", "o.source", "size", "source_size", "target", "shards")


def mix(docs: DataFrame, shard_bits: int = 4, seed: int = 7, **how) -> DataFrame:
    """The mix itself: the columns of ``docs`` and mix_shard, mix_take, mix_key, a row for each taking.

    Each partition holds a random part of every shard, in the order of mix_shard and mix_key, a seeded hash; so do the files of a
    table written from it. Columns of ``docs`` that have these names, in whatever case, are replaced. Other edge cases: see dealt_rows.
    """
    rows = stored(sized(docs, seed), "mix-sizes")
    _, blocks = plan(rows, shard_bits, seed, **how)
    spot = _seeded(seed, F.col("doc_id"), F.col("text"))
    none = F.array().cast("array<int>")
    own = [c for c in docs.columns if c.lower() not in ("mix_shard", "mix_take", "mix_key")]
    d = docs.select(F.struct(*columns(own)).alias("d"), F.col("source").alias("s"), F.shiftrightunsigned(spot, LOW_BITS).cast("int").alias("b"), spot.bitwiseAND(F.lit((1 << LOW_BITS) - 1)).alias("low"))
    taken = F.concat("p.shards", F.when(F.col("edge_shard").isNotNull() & (F.col("low") <= F.col("edge_low")), F.array("edge_shard")).otherwise(none))
    out = d.join(blocks.alias("p"), F.col("s").eqNullSafe(F.col("p.source")) & (F.col("b") == F.col("p.block"))).select("d", "b", "low", F.posexplode(taken).alias("mix_take", "mix_shard"))
    out = out.select("d.*", "mix_shard", "mix_take", _seeded(seed + 3, F.col("b"), F.col("low"), F.col("mix_take")).alias("mix_key"))
    return out.repartition("mix_shard", "mix_key").sortWithinPartitions("mix_shard", "mix_key")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dealt_rows(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")
