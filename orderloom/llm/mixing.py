"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree over source blocks.

DataFrame functions only. A document belongs to one of ``BLOCKS`` hash blocks of its source, so that a source with
a third of all rows is spread over as many keys. Three small tables follow: words per block (pre-aggregated),
targets per source, and the units each source contributes. A unit is one pass over one block; the last unit of a source may be a part
of a block: of its documents, in the order of a hash, whole ones are taken up to the quota. The document in which the quota ends is taken or left as a
whole, whichever is nearer, so a source is off by half a document at most. Rows that repeat that document are taken or left together.

The tree halves the units node by node: in each node they are ranked by a hash of the node and the unit, and the first half goes left.
So the numbers of each source that go left are one multivariate-hypergeometric draw, and the leaves hold exact quotas per source.
Every source then permutes its own units and deals them to the shards in runs of those quotas: the draws of two shards are disjoint.
Documents are joined with the draws of their block, and a hash orders them within the shard.

Edge cases: a null text has size 0; a null source is a source of its own, last in order; documents of size 0 are never
taken; an empty table gives no rows; repeated rows are rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import keep

BLOCKS = 256
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def block_of(key: Sequence[Column], blocks: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(blocks)).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeat: float = 3.0) -> DataFrame:
    """Target words per source; ``sizes`` has one row (source, source_size) per source.

    All words are shared out by weight; no source gets more than ``max_repeat`` times its words, and what it would get beyond
    goes to the others by weight. In the order of cap per weight the capped sources come first, so one
    running sum finds the common level of the rest.
    """
    everything = Window.partitionBy()
    listed = sizes.withColumn("rn", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("rn") - 1, F.lit(len(weights))) + 1)
    listed = (
        listed.withColumn("w", w)
        .withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("all_w", F.sum("w").over(everything))
    )
    before = Window.orderBy(F.col("cap") / F.col("w"), "rn").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    listed = listed.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("w") * F.col("level"))
    common = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", F.col("w") * common))
    return listed.select("source", "source_size", target.alias("target"))


def _units(blocks: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """One row per pass over a block: (source, block, copy, share, quota); share is 1 but for a source's last unit, which takes ``quota`` words."""
    named = targets.select(F.col("source").alias("s_source"), "source_size", "target")
    permuted = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), "source", "block"), "block")
    repeat = F.floor(F.col("target") / F.col("source_size")).cast("long")
    rest = F.col("target") - repeat * F.col("source_size")
    before = F.coalesce(F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    extra = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("rest") - F.col("before")) / F.col("words")))
    shares = F.concat(
        F.array_repeat(F.lit(1.0), F.col("repeat").cast("int")),
        F.when(F.col("extra") > 0, F.array(F.col("extra"))).otherwise(F.array().cast("array<double>")),
    )
    return (
        blocks.filter("words > 0")
        .join(named, F.col("source").eqNullSafe(F.col("s_source")))
        .withColumns({"repeat": repeat, "rest": rest, "before": before})
        .withColumn("extra", extra)
        .select("source", "block", (F.col("rest") - F.col("before")).alias("quota"), F.posexplode(shares).alias("copy", "share"))
    )


def _cuts(sized: DataFrame, units: DataFrame) -> DataFrame:
    """Where a source's last unit ends: (source, block, cut, cut_words).

    The documents of the block are ordered by salt. Those before ``cut`` are taken, the one at it gives ``cut_words``: all or none. Words are first
    added up for 256 ranges of the salt, so that only documents of the range with the cut are sorted: one in 65,536 of a source.
    """
    last = units.filter("share < 1").select(F.col("source").alias("c_source"), F.col("block").alias("c_block"), "quota")
    inner = (
        sized.filter("size > 0")
        .join(last, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("block") == F.col("c_block")))
        .select("c_source", "c_block", "quota", F.shiftright("salt", 56).alias("range"), "salt", "size")
    )

    def crossing(rows: DataFrame, order: str) -> DataFrame:
        so_far = Window.partitionBy("c_source", "c_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
        return rows.filter((F.col("before") <= F.col("quota")) & (F.col("quota") < F.col("before") + F.col("words")))

    ranges = crossing(inner.groupBy("c_source", "c_block", "quota", "range").agg(F.sum("size").alias("words")), "range").select(
        F.col("c_source").alias("r_source"), F.col("c_block").alias("r_block"), F.col("range").alias("r_range"), F.col("before").alias("skipped")
    )
    within = inner.join(
        ranges,
        F.col("c_source").eqNullSafe(F.col("r_source")) & (F.col("c_block") == F.col("r_block")) & (F.col("range") == F.col("r_range")),
    )
    within = (
        within.withColumn("quota", F.col("quota") - F.col("skipped"))
        .groupBy("c_source", "c_block", "quota", "salt")
        .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("times"))
    )
    left = F.col("quota") - F.col("before")
    size = F.col("words") / F.col("times")
    words = F.when(left * 2 >= F.col("words"), size).otherwise(F.lit(0.0))
    return crossing(within, "salt").select(
        "c_source", "c_block", F.col("salt").alias("cut"), F.floor(words + 1e-9).cast("long").alias("cut_words")
    )


def split_quotas(units: DataFrame, levels: int, seed: int) -> DataFrame:
    """(source, turn, shard): how many units of each source every leaf of the tree gets, as a list of turns."""
    tree = units.select("source", F.col("block"), F.col("copy"), F.lit(1).cast("long").alias("node"))
    for level in range(levels):
        mixed = Window.partitionBy("node").orderBy(
            F.xxhash64(F.lit(seed + 2 + level), "node", "source", "block", "copy"), "source", "block", "copy"
        )
        left = F.row_number().over(mixed) * 2 <= F.count(F.lit(1)).over(Window.partitionBy("node")) + F.pmod("node", F.lit(2))
        tree = tree.withColumn("node", F.col("node") * 2 + F.when(left, 0).otherwise(1))
    leaf = (F.col("node") - (1 << levels)).cast("int")
    return tree.select(
        "source", leaf.alias("shard"), F.row_number().over(Window.partitionBy("source").orderBy("node")).alias("turn")
    )


def mix_plan(
    docs: DataFrame,
    key: Sequence[str] = ("doc_id",),
    weights: Sequence[float] = (1, 2, 3),
    max_repeat: float = 3.0,
    levels: int = 4,
    blocks: int = BLOCKS,
    seed: int = 17,
) -> DataFrame:
    """The draws of every row of ``docs`` (columns ``key``, source, text).

    Returns the key columns, source, size, source_size, target, and ``draws``: an array of (shard, copy, words, place), one entry
    per pass of the mix over the document. ``place`` orders the rows of a shard.
    """
    sized = keep(
        docs.select(
            *[F.col(k).alias(f"k{i}") for i, k in enumerate(key)],
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
            F.xxhash64(F.lit(seed), *[F.col(k) for k in key], F.col("text")).alias("salt"),
        ),
        "mix-sized",
    ).withColumn("block", F.pmod("salt", F.lit(blocks)).cast("int"))
    per_block = keep(sized.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    targets = keep(
        source_targets(per_block.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_repeat), "mix-targets"
    )
    units = keep(_units(per_block, targets, seed), "mix-units")
    own = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 99), "source", "block", "copy"), "block", "copy")
    turns = split_quotas(units, levels, seed).select(F.col("source").alias("q_source"), "turn", "shard")
    dealt = (
        units.withColumn("turn", F.row_number().over(own))
        .join(turns.withColumnRenamed("turn", "q_turn"), F.col("source").eqNullSafe(F.col("q_source")) & (F.col("turn") == F.col("q_turn")))
        .groupBy("source", "block")
        .agg(F.sort_array(F.collect_list(F.struct("copy", "shard", "share"))).alias("passes"))  # max_repeat + 1 entries at most
    )
    cuts = keep(_cuts(sized, units), "mix-cuts")
    per = (
        per_block.alias("b")
        .join(dealt.alias("d"), F.col("b.source").eqNullSafe(F.col("d.source")) & (F.col("b.block") == F.col("d.block")), "left")
        .join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .join(cuts.alias("c"), F.col("b.source").eqNullSafe(F.col("c.c_source")) & (F.col("b.block") == F.col("c.c_block")), "left")
        .select(
            F.col("b.source").alias("p_source"), F.col("b.block").alias("p_block"), "t.source_size", "t.target", "d.passes", "cut", "cut_words"
        )
    )
    part = F.when(F.col("salt") < F.col("cut"), F.col("size")).when(F.col("salt") == F.col("cut"), F.least("size", "cut_words")).otherwise(0)
    draws = F.filter(
        F.transform(
            F.coalesce("passes", F.array().cast("array<struct<copy:int,shard:int,share:double>>")),
            lambda p: F.struct(
                p["shard"].alias("shard"),
                p["copy"].alias("copy"),
                F.when(p["share"] < 1, part).otherwise(F.col("size")).cast("long").alias("words"),
                F.xxhash64(F.lit(seed + 7), F.col("salt"), p["copy"]).alias("place"),
            ),
        ),
        lambda d: d["words"] > 0,
    )
    joined = sized.join(per, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("block") == F.col("p_block")))
    return joined.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(key)], "source", "size", "source_size", "target", draws.alias("draws")
    )


def taken_words(plan: DataFrame) -> DataFrame:
    """Words the mix takes of each row, repeats counted."""
    return plan.withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"])).drop("draws")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: one per draw, all of them whole.

    Draws follow from doc_id and text, so repeated rows are drawn alike. The rows of a shard are dealt to 64 tasks and stand in the order of their
    places there.
    """
    # The caller's columns may have any names: they travel as one.
    named = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("mix_key"), "source", "text")
    plan = mix_plan(named, ("mix_key",), **options).dropDuplicates(["mix_key"])
    draws = plan.select(F.col("mix_key").alias("mix_of"), F.explode("draws").alias("draw"))
    return (
        named.select("row", "mix_key")
        .join(draws, F.col("mix_key") == F.col("mix_of"))
        .repartition("draw.shard", F.pmod(F.col("draw.place"), F.lit(64)))
        .sortWithinPartitions("draw.shard", "draw.place")
        .select("row.*")
    )


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """Contract query: one row per document with its size, its source's size and target, and the words taken."""
    from orderloom.llm.common import documents

    plan = taken_words(mix_plan(documents(spark, sf_dir)))
    return plan.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken")
