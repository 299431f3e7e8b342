"""Split of an order's paid amount over its lines.

Every line but the last gets ``round(paid / original * amount)``; the last line, the one with the highest
id, takes what is left, so the shares of an order add up to the amount paid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.money import cents, from_cents, prorate


_CENTS = {"_paid": "final_total_amount", "_original": "original_total_amount", "_amount": "line_amount"}


def _with_cents(lines: DataFrame) -> DataFrame:
    """Add the three amounts in cents. As columns of their own they are worked out once per row; inlined
    into the share they would blow up the generated code."""
    return lines.withColumns({name: cents(F.col(source)) for name, source in _CENTS.items()})


def with_share(lines: DataFrame, scale: int = 2) -> DataFrame:
    """Add, in cents, the three amounts and ``_share``, the rounded share before the last line takes the rest."""
    share = prorate(F.col("_paid"), F.col("_original"), F.col("_amount"), scale)
    return _with_cents(lines).withColumn("_share", share)


def order_sums(lines: DataFrame, scale: int = 2, carried: Sequence[str] = ()) -> DataFrame:
    """Per order, in cents: its last line, the sums over all lines, and what the last line has to add.

    ``lines`` needs order_id, order_detail_id, line_amount and the two order totals. The sums are plain
    aggregates, so an order of any size is combined map-side instead of being gathered for a window.
    ``carried`` names further columns that are the same on all lines of an order.
    """
    return with_share(lines, scale).groupBy("order_id", *carried).agg(
        F.max("order_detail_id").alias("last_detail_id"),
        F.sum("_amount").alias("origin_cents"),
        F.max("_paid").alias("paid_cents"),
        (F.max("_paid") - F.sum("_share")).alias("remainder_cents"),
    )


ORDER_SUMS = ("last_detail_id", "origin_cents", "paid_cents", "remainder_cents")


def apply_sums(lines: DataFrame, scale: int = 2) -> DataFrame:
    """Add ``final_detail_amount`` and the sums over the other lines of the order. ``lines`` carries the
    columns of :func:`order_sums`, which are dropped."""
    correction = F.when(F.col("order_detail_id") == F.col("last_detail_id"), F.col("remainder_cents")).otherwise(0)
    return (
        with_share(lines, scale)
        .withColumn("_cents", F.col("_share") + correction)
        .withColumns(
            {
                "final_detail_amount": from_cents(F.col("_cents")),
                "other_split_amount": from_cents(F.col("paid_cents") - F.col("_cents")),
                "other_origin_amount": from_cents(F.col("origin_cents") - F.col("_amount")),
            }
        )
        .drop("_cents", "_share", *_CENTS, *ORDER_SUMS)
    )


def split_arrivals(lines: DataFrame, running: DataFrame, scale: int = 2) -> tuple[DataFrame, DataFrame]:
    """Split the lines of one batch, given the running sums of orders seen in part before.

    Returns the lines with ``final_detail_amount`` and the running sums to store. An order is complete when
    its line amounts add up to its original amount; the batch that completes it gives the rest to its line
    with the highest id. Every line is split once and never revised. Orders complete within one batch leave
    no running sums.
    """
    earlier = running.select(
        "order_id", F.col("origin_cents").alias("_origin"), F.col("split_cents").alias("_split")
    )
    shared = with_share(lines, scale)
    batch = shared.groupBy("order_id").agg(
        F.max("dt").alias("dt"),
        F.max("order_detail_id").alias("_last"),
        F.sum("_amount").alias("_batch_origin"),
        F.sum("_share").alias("_batch_split"),
        F.max("_paid").alias("_paid"),
        F.max("_original").alias("_target"),
    )
    sums = (
        batch.join(earlier, "order_id", "left")
        .withColumn("_seen", F.col("_origin").isNotNull())
        .withColumn("origin_cents", F.coalesce("_origin", F.lit(0)) + F.col("_batch_origin"))
        .withColumn("split_cents", F.coalesce("_split", F.lit(0)) + F.col("_batch_split"))
        .withColumn("_complete", F.col("origin_cents") == F.col("_target"))
        .withColumn("_rest", F.when(F.col("_complete"), F.col("_paid") - F.col("split_cents")).otherwise(0))
        .withColumn("split_cents", F.col("split_cents") + F.col("_rest"))
    )
    correction = F.when(F.col("order_detail_id") == F.col("_last"), F.col("_rest")).otherwise(0)
    split = shared.join(sums.select("order_id", "_last", "_rest"), "order_id").withColumn(
        "final_detail_amount", from_cents(F.col("_share") + correction)
    )
    stored = sums.where(~F.col("_complete") | F.col("_seen"))
    return (
        split.select(*[c for c in lines.columns if c != "final_detail_amount"], "final_detail_amount"),
        stored.select("dt", "order_id", "origin_cents", "split_cents"),
    )
