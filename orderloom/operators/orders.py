"""Order facts: time fields, first-order flag, dimension enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import clock
from orderloom.schemas import ORDER_DETAIL, ORDER_INFO


def with_time_fields(orders: DataFrame) -> DataFrame:
    moment = F.col("create_time")
    return orders.withColumns({"create_date": clock.day(moment), "create_hour": clock.hour(moment)})


def first_order_ids(orders: DataFrame, user_state: DataFrame | None = None) -> DataFrame:
    """Id of the earliest order of each user who is not in ``user_state``; equal times go to the lower id.

    A map-side combined aggregate: a user with a large share of all orders never gathers in one task.
    """
    earliest = F.min(F.struct("create_time", "id"))["id"]
    firsts = orders.groupBy("user_id").agg(earliest.alias("id"))
    if user_state is not None:
        # One row per user on the left, so the known-user test is free of hot keys.
        known = user_state.where(F.col("if_consumed") == "1").select(F.col("user_id").cast("long"))
        firsts = firsts.join(known, "user_id", "left_anti")
    return firsts.select("id")


def flag_first_orders(orders: DataFrame, first_ids: DataFrame) -> DataFrame:
    """Set ``if_first_order`` to "1" on the orders in ``first_ids``, else "0". Matched on the order id,
    which has no hot values. Two rows of the same order get the same flag."""
    firsts = first_ids.select("id", F.lit("1").alias("if_first_order"))
    return (
        orders.drop("if_first_order")
        .join(firsts, "id", "left")
        .withColumn("if_first_order", F.coalesce("if_first_order", F.lit("0")))
    )


def first_order_flag(orders: DataFrame, user_state: DataFrame | None = None) -> DataFrame:
    return flag_first_orders(orders, first_order_ids(orders, user_state))


def new_buyers(flagged: DataFrame) -> DataFrame:
    """State rows of the users who bought for the first time."""
    return flagged.where(F.col("if_first_order") == "1").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("if_first_order").alias("if_consumed")
    )


def enrich_orders(orders: DataFrame, province: DataFrame, users: DataFrame) -> DataFrame:
    """Left join province and user labels. Neither side carries a broadcast hint: Spark broadcasts a
    dimension below its size threshold and shuffles a larger one, splitting hot keys."""
    provinces = province.select(
        F.col("id").alias("province_id"),
        F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_code").alias("province_iso_code"),
    )
    buyers = users.select(
        F.col("id").alias("user_id"), "user_age_group", F.col("gender_name").alias("user_gender")
    )
    joined = orders.join(provinces, "province_id", "left").join(buyers, "user_id", "left")
    known = [c for c in ORDER_INFO.fieldNames() if c in joined.columns]
    return joined.select(*known, *[c for c in orders.columns if c not in known])


def enrich_details(details: DataFrame, product: DataFrame) -> DataFrame:
    """Left join the flattened product table: ids default to 0, names stay null on a miss.
    A line without its own ``sku_name`` takes the product's."""
    names = product.withColumnRenamed("sku_name", "_sku_name")
    joined = details.join(names, "sku_id", "left").withColumns(
        {
            "sku_name": F.coalesce("sku_name", "_sku_name"),
            **{c: F.coalesce(c, F.lit(0)) for c in ("spu_id", "tm_id", "category3_id")},
        }
    )
    return joined.select(
        *ORDER_DETAIL.fieldNames(), *[c for c in details.columns if c not in ORDER_DETAIL.fieldNames()]
    )


def without_labels(orders: DataFrame) -> DataFrame:
    """Orders with empty labels, for results that use amounts and brands only: the joins for the labels
    then never enter the plan."""
    labels = [c for c in ORDER_INFO.fieldNames() if c not in orders.columns]
    return orders.withColumns({c: F.lit(None).cast(ORDER_INFO[c].dataType) for c in labels})


def without_product(details: DataFrame) -> DataFrame:
    """Order lines with empty product columns, for results that use amounts only."""
    blank = [c for c in ORDER_DETAIL.fieldNames() if c not in details.columns]
    return details.withColumns({c: F.lit(None).cast(ORDER_DETAIL[c].dataType) for c in blank})
