"""Plans and hot keys: what must hold when one key has a third of all rows."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from orderloom.operators import orders, wide
from orderloom.plans.queries import registered
from orderloom.schemas import MONEY
from orderloom.session import work_dir

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", [n for n in registered() if not n.startswith("stream_") and n != "progress_ledger"])
def test_no_cross_joins_and_no_python_in_batch_plans(spark, name):
    plan = plan_of(registered()[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", ["brand_topn", "order_wide", "split_amount", "first_order_flag", "dau_first_launch"])
def test_no_windows_over_keys(spark, name):
    assert "Window" not in plan_of(registered()[name](spark, SF_DIR))


def test_scan_reads_needed_columns_only(spark):
    plan = plan_of(registered()["brand_topn"](spark, SF_DIR))
    for unread in ("l_comment", "l_discount", "l_tax", "l_returnflag", "o_orderpriority", "c_acctbal", "c_name"):
        assert unread not in plan


def skewed_shop(spark, n=60_000):
    """Orders 0..999 of which order 0 and user 0 hold a third of the lines and of the orders."""
    order_rows = spark.range(1000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user_id"),
        F.lit(100).cast(MONEY).alias("final_total_amount"),
        F.lit(0).cast(MONEY).alias("benefit_reduce_amount"),
        F.lit(0).cast(MONEY).alias("feight_fee"),
        F.lit("1").alias("order_status"),
        F.timestamp_seconds(F.col("id") + 1_600_000_000).alias("create_time"),
    )
    details = spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("order_id"),
        F.lit(1).cast("long").alias("sku_id"),
        F.lit(1).cast("long").alias("sku_num"),
        (F.col("id") % 97 + 1).cast(MONEY).alias("order_price"),
        F.lit("x" * 200).alias("sku_name"),
    )
    originals = details.groupBy(F.col("order_id").alias("id")).agg(F.sum("order_price").cast(MONEY).alias("original_total_amount"))
    return orders.with_time_fields(order_rows.join(originals, "id")), details


def test_hot_order_splits_exactly_and_is_cut_by_aqe(spark, tmp_path):
    order_rows, details = skewed_shop(spark)
    root = work_dir(spark, "skew")
    order_rows.write.parquet(f"{root}/orders")
    details.repartition(8).write.parquet(f"{root}/details")
    order_rows, details = spark.read.parquet(f"{root}/orders"), spark.read.parquet(f"{root}/details")
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        summed = orders.without_labels(wide.attach_sums(order_rows, details))
        result = wide.order_wide(summed, orders.without_product(details))
        totals = result.groupBy("order_id").agg(F.sum("final_detail_amount").alias("paid"), F.count("*").alias("n"))
        found = {r.order_id: (r.paid, r.n) for r in totals.collect()}
        result.write.format("noop").mode("overwrite").save()
        rows = result.collect()
        final_plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(rows) == 60_000 and all(paid == 100 for paid, _ in found.values())
    assert found[0][1] >= 20_000
    assert "skew=true" in final_plan


def test_hot_user_gets_one_first_order(spark):
    order_rows, _ = skewed_shop(spark)
    flagged = orders.first_order_flag(order_rows)
    firsts = flagged.where("if_first_order = '1'").groupBy("user_id").count().collect()
    assert all(r["count"] == 1 for r in firsts)
    assert flagged.count() == order_rows.count()
    assert flagged.where("user_id = 0 and if_first_order = '1'").first().id == 0
