"""The wide order line: orders joined with their lines, one row per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators import split
from orderloom.operators.keyed import earliest
from orderloom.schemas import MONEY, ORDER_DETAIL_WIDE

_LINE_AMOUNT = "line_amount"


def wide_columns(order: str, detail: str) -> list[Column]:
    """Wide-row columns from the two aliased sides, all but the split amount."""
    o = lambda name: F.col(f"{order}.{name}")
    d = lambda name: F.col(f"{detail}.{name}")
    return [
        d("id").alias("order_detail_id"),
        o("id").alias("order_id"),
        o("order_status"),
        o("create_time"),
        o("user_id"),
        d("sku_id"),
        d("order_price").alias("sku_price"),
        d("sku_num"),
        d("sku_name"),
        o("benefit_reduce_amount"),
        o("original_total_amount"),
        o("feight_fee"),
        o("final_total_amount"),
        o("if_first_order"),
        o("province_name"),
        o("province_area_code"),
        o("user_age_group"),
        o("user_gender"),
        o("create_date").alias("dt"),
        d("spu_id"),
        d("tm_id"),
        d("category3_id"),
        d("spu_name"),
        d("tm_name"),
        d("category3_nam").alias("category3_name"),
    ]


def with_line_amount(details: DataFrame) -> DataFrame:
    """The stated line amount, or price times quantity."""
    computed = (F.col("order_price") * F.col("sku_num")).cast(MONEY)
    if _LINE_AMOUNT in details.columns:
        computed = F.coalesce(_LINE_AMOUNT, computed)
    return details.withColumn(_LINE_AMOUNT, computed)


def join_orders(orders: DataFrame, details: DataFrame, extra: list[Column] | None = None) -> DataFrame:
    """Inner join on the order id. ``details`` and ``orders`` hold one row per id."""
    lines = with_line_amount(details)
    return (
        orders.alias("o")
        .join(lines.alias("d"), F.col("o.id") == F.col("d.order_id"))
        .select(*wide_columns("o", "d"), F.col(f"d.{_LINE_AMOUNT}"), *(extra or []))
    )


def dedup_sources(orders: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per order and per line. Done ahead of the join, where n copies of an order and m copies
    of a line would otherwise meet in n*m rows. Lines are told apart by order and id. Among copies of the same time the
    remaining columns decide, so a rerun keeps the same one."""
    rest = lambda df, keys: ["create_time", *[c for c in df.columns if c not in (*keys, "create_time")]]
    return (
        earliest(orders, ["id"], rest(orders, ["id"])),
        earliest(details, ["order_id", "id"], rest(details, ["order_id", "id"])),
    )


def dedup_wide(wide: DataFrame, key: str = "order_detail_id", seen: DataFrame | None = None) -> DataFrame:
    """One wide row per ``key`` whose key is not in ``seen`` already."""
    fresh = wide if seen is None else wide.join(seen.select(key).distinct(), key, "left_anti")
    return earliest(fresh, [key], ["create_time", "order_detail_id"]).select(*wide.columns)


def final_columns(wide: DataFrame) -> DataFrame:
    return wide.select(*ORDER_DETAIL_WIDE.fieldNames())


def attach_sums(orders: DataFrame, details: DataFrame, scale: int = 2) -> DataFrame:
    """Orders that have lines, with the per-order sums the split needs.

    Takes orders and lines before enrichment. Three narrow columns of the lines meet the orders once; the
    sums are grouped by all columns of the order, so they need no second join to come back to it, and the
    join's partitioning on the order id serves the grouping too.
    """
    lines = with_line_amount(details).select("order_id", F.col("id").alias("order_detail_id"), _LINE_AMOUNT)
    met = orders.withColumnRenamed("id", "order_id").join(lines, "order_id")
    carried = [c for c in orders.columns if c != "id"]
    return split.order_sums(met, scale, carried).withColumnRenamed("order_id", "id")


def order_wide(orders: DataFrame, details: DataFrame, scale: int = 2) -> DataFrame:
    """Wide rows with the paid amount split over the lines; ``orders`` carries its sums.

    The wide lines are shuffled once, for this join, and no later step asks for their partitioning, so AQE
    is free to cut a hot order into several tasks.
    """
    joined = join_orders(orders, details, [F.col(f"o.{c}") for c in split.ORDER_SUMS])
    return split.apply_sums(joined, scale)
