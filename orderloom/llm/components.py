"""Connected components of a large edge table, by alternating large-star and small-star steps.

Every step is a group-by with a map-side minimum and one join on a node, so no node's neighbours are gathered in one task; the
adaptive skew join splits hot nodes. Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node of ``edges`` (columns a, b) that is not its component's smallest; root is that smallest node.

    Loops and repeated edges are allowed. An empty table gives no rows.
    """
    now = keep(
        edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    while True:
        mark = now.agg(F.count("a"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
        before = mark
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b"), F.col("a")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(root, F.col("a") == F.col("n")).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = keep(small.union(root.select("n", "m")).distinct(), "edges")
