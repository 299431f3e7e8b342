"""Orders and lines that share their buckets: no shuffle in the wide join, hot orders spread, the same rows as the plain join."""

import pytest
from pyspark.sql import functions as F

from orderloom.operators import orders, wide
from orderloom.session import work_dir
from orderloom.sources.colocated import PART, Colocated
from tests.test_scale import skewed_shop


@pytest.fixture
def tables(spark):
    root = work_dir(spark, "colocated")
    made = Colocated(root, f"test_{root.rpartition('-')[2]}", buckets=4, hot_lines=5000)
    yield made
    made.drop(spark)


def rows_of(df):
    return sorted((r.order_id, r.order_detail_id, r.final_detail_amount, r.other_split_amount, r.sku_num) for r in df.collect())


def test_hot_order_is_spread_and_nothing_is_shuffled(spark, tables):
    order_rows, details = skewed_shop(spark)
    details = orders.without_product(details)
    summed = orders.without_labels(wide.attach_sums(order_rows, details))
    tables.write(summed, details)
    stored = tables.order_wide(spark)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert rows_of(stored) == rows_of(wide.order_wide(summed, details))
    parts = spark.table(tables._lines).where("order_id = 0").groupBy(PART).count().collect()
    assert len(parts) > 3 and max(r["count"] for r in parts) < 10_000
    tasks = stored.where("order_id = 0").select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1


def test_lines_without_an_order_orders_without_lines_and_empty_tables(spark, tables):
    order_rows, details = skewed_shop(spark, 300)
    details = orders.without_product(details)
    strays = details.limit(2).withColumn("order_id", F.lit(None).cast("long")).unionByName(details.limit(2).withColumn("order_id", F.lit(-5).cast("long")))
    summed = orders.without_labels(wide.attach_sums(order_rows, details))
    for given in (details.unionByName(strays), details.limit(0)):
        tables.write(summed, given)
        assert rows_of(tables.order_wide(spark)) == rows_of(wide.order_wide(summed, given))
