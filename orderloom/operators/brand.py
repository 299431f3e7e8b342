"""Brand amounts per batch, totals over a time range, top-N ranking."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import MONEY


def batch_sums(wide: DataFrame, stat_time: Column) -> DataFrame:
    """Split amounts summed per brand and stat time. The brand stays two columns, so no name can be cut."""
    return (
        wide.groupBy(stat_time.alias("stat_time"), "tm_id", "tm_name")
        .agg(F.sum("final_detail_amount").cast(MONEY).alias("amount"))
    )


def totals(amounts: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Totals per brand of the batches strictly between ``start`` and ``end``."""
    if start is not None:
        amounts = amounts.where(F.col("stat_time") > F.lit(start))
    if end is not None:
        amounts = amounts.where(F.col("stat_time") < F.lit(end))
    return amounts.groupBy("tm_id", "tm_name").agg(F.sum("amount").cast(MONEY).alias("sum_amount"))


def top_n(brand_totals: DataFrame, n: int) -> DataFrame:
    return brand_totals.orderBy(F.desc("sum_amount"), "tm_id").limit(n)
