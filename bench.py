"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from orderloom.plans.queries import registered  # noqa: E402
from orderloom.plans.stream_queries import Pipeline  # noqa: E402
from orderloom.plans.warehouse import Warehouse  # noqa: E402
from orderloom.session import local_session  # noqa: E402
from orderloom.sources.mapping import Shop  # noqa: E402

HEADLINE = (
    "brand_topn",
    "order_wide",
    "split_amount",
    "order_wide_dedup",
    "first_order_flag",
    "order_enriched",
    "dim_latest",
    "cdc_object",
    "cdc_array",
    "log_route",
    "dau_first_launch",
    "dau_compare",
    "kpi_totals",
    "detail_page",
    "age_share",
    "province_sales",
    "doc_search",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("OFF")
    available = registered()

    def run(name: str) -> float:
        started = time.perf_counter()
        available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    def batches(days: int = 20, spans: int = 3) -> dict[str, float]:
        """Seconds of a micro-batch of the order jobs, change events to brand sums. A batch holds ``days`` days of orders and lines, which at
        sf0.1 are some 1,250 orders and 5,000 lines; the first span warms the jobs."""
        shop = Shop(spark, sf_dir)
        pipeline = Pipeline(shop, Warehouse(shop))
        pipeline.load_dimensions()
        jobs = ((pipeline.publish_orders, pipeline.publish_details), pipeline.publish_wide, pipeline.sum_brands)
        moment = F.col("create_time")
        starts = [F.expr(f"timestamp '1995-01-01' + interval {days * k} days") for k in range(spans + 2)]
        parts = [(moment >= low) & (moment < high) for low, high in zip(starts, starts[1:])]
        pipeline.feed_orders(*jobs, parts=parts[:1])
        pipeline.batch_seconds.clear()
        pipeline.feed_orders(*jobs, parts=parts[1:])
        ordered = sorted(pipeline.batch_seconds)
        return {"batches": len(ordered), "median": ordered[len(ordered) // 2], "longest": ordered[-1]}

    run("brand_topn")  # warm the JVM
    times = {name: run(name) for name in (sys.argv[1:] or HEADLINE)}
    stream = {} if sys.argv[1:] else batches()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "micro_batches": stream,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
