"""Dimension tables: derive, keep the latest row per key, flatten the product snowflake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import people
from orderloom.operators.keyed import latest
from orderloom.schemas import USER_INFO


def upsert(
    current: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    apply_deletes: bool = False,
) -> DataFrame:
    """Latest row per key of ``current`` and ``changes``, by ``order``.

    A delete event counts as a plain row unless ``apply_deletes`` is set, which drops keys whose latest
    event is one.
    """
    rows = changes if current is None else current.unionByName(changes, allowMissingColumns=True)
    result = latest(rows, keys, order)
    if apply_deletes:
        result = result.where(F.coalesce(F.col("type"), F.lit("")) != "delete")
    return result


def user_info(users: DataFrame, as_of_year: int) -> DataFrame:
    """Add age band and gender label to source users."""
    extra = [c for c in users.columns if c not in USER_INFO.fieldNames()]
    years = people.age(F.col("birthday"), as_of_year)
    return users.withColumns(
        {
            "user_age_group": people.age_band(years),
            "gender_name": people.gender_name(F.col("gender")),
        }
    ).select(*USER_INFO.fieldNames(), *extra)


def product(sku: DataFrame, spu: DataFrame, trademark: DataFrame, category3: DataFrame) -> DataFrame:
    """The product snowflake as one row per sku.

    The second-hop joins run here, over the small product tables, so the order lines need one join.
    """
    return (
        sku.select(F.col("id").alias("sku_id"), "sku_name", "spu_id", "tm_id", "category3_id")
        .join(spu.select(F.col("id").alias("spu_id"), "spu_name"), "spu_id", "left")
        .join(trademark.select("tm_id", "tm_name"), "tm_id", "left")
        .join(
            category3.select(F.col("id").alias("category3_id"), F.col("name").alias("category3_nam")),
            "category3_id",
            "left",
        )
        .select("sku_id", "sku_name", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_nam")
    )
