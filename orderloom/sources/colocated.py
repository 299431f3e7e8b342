"""Orders and lines stored side by side: both tables bucketed on the order, so the wide join reads them without a shuffle.

A bucketed join reads one bucket per task and cannot be cut at run time. Orders of many lines are therefore spread over several parts
when they are written: a line of such an order takes one part, the order is repeated for each of them, and the tables are bucketed on
order and part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators import split, wide

PART = "order_part"


@dataclass(frozen=True)
class Colocated:
    """The two tables, below ``path`` and under ``name`` in the catalog. An order of more than ``hot_lines`` lines is spread over one part
    per ``hot_lines`` lines begun. ``buckets`` belongs to the size of the data: a bucket should fit a task."""

    path: str
    name: str
    buckets: int = 64
    hot_lines: int = 100_000

    @property
    def _orders(self) -> str:
        return f"{self.name}_orders"

    @property
    def _lines(self) -> str:
        return f"{self.name}_lines"

    def _store(self, rows: DataFrame, key: str, table: str) -> None:
        (
            rows.repartition(self.buckets, key, PART)
            .write.mode("overwrite")
            .bucketBy(self.buckets, key, PART)
            .sortBy(key, PART)
            .option("path", f"{self.path}/{table}")
            .saveAsTable(table)
        )

    def write(self, orders: DataFrame, details: DataFrame, bare: DataFrame | None = None) -> None:
        """``orders`` carries the sums of the split (``wide.attach_sums``); one row per id on both sides. Lines without an
        order id meet nothing and are left out. ``bare`` are the lines before enrichment, if at hand: they are counted without its joins.

        Of the hot orders there is at most one per ``hot_lines`` lines, a few bytes each, so they are broadcast: orders and lines
        are shuffled once, into their buckets."""
        details = details.where(F.col("order_id").isNotNull())
        counted = (details if bare is None else bare.where(F.col("order_id").isNotNull())).groupBy("order_id").agg(F.count("*").alias("_n"))
        parts: Column = F.ceil(F.col("_n") / self.hot_lines).cast("int")
        hot = counted.where(F.col("_n") > self.hot_lines).select("order_id", parts.alias("_parts"))
        of_line = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("_parts"))).cast("int")
        spread = details.join(F.broadcast(hot), "order_id", "left").withColumn(PART, of_line).drop("_parts")
        repeated = (
            orders.join(F.broadcast(hot.withColumnRenamed("order_id", "id")), "id", "left")
            .withColumn(PART, F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
            .drop("_parts")
        )
        self._store(repeated, "id", self._orders)
        self._store(spread, "order_id", self._lines)

    def order_wide(self, spark: SparkSession, scale: int = 2) -> DataFrame:
        """The wide lines of the stored tables. Neither side is shuffled."""
        order_rows, lines = spark.table(self._orders).alias("o"), wide.with_line_amount(spark.table(self._lines)).alias("d")
        same = (F.col("o.id") == F.col("d.order_id")) & (F.col(f"o.{PART}") == F.col(f"d.{PART}"))
        sums = [F.col(f"o.{c}") for c in split.ORDER_SUMS]
        # A merge join of buckets: the hint keeps a small order table from being broadcast past its buckets.
        joined = order_rows.hint("merge").join(lines, same)
        return split.apply_sums(joined.select(*wide.wide_columns("o", "d"), F.col("d.line_amount"), *sums), scale)

    def drop(self, spark: SparkSession) -> None:
        for table in (self._orders, self._lines):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
