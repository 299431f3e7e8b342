"""The sample tables seen as shop entities.

Surrogate ids are taken from the data without a global or per-order numbering, which would need one task:
a product name or type is identified by its smallest sku id plus one, an order line by a 60-bit digest of
the columns that make it unique.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import clock
from orderloom.schemas import MONEY, ORDER_SOURCE

AS_OF_YEAR = 2021
LAUNCH_EVENTS = ("signup", "click")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _price_cents() -> Column:
    return F.round(F.col("l_extendedprice") * 100).cast("long")


# Primes just below 2^30 and a multiplier for each: every step of the digest stays inside a long.
DIGEST = ((1073741789, 1000003), (1073741783, 998244353))


def _detail_id() -> Column:
    """60-bit digest: two 30-bit polynomial digests side by side."""
    parts = [
        *[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        _price_cents(),
        F.unix_date(F.col("l_shipdate").cast("date")),
    ]
    halves = []
    for prime, factor in DIGEST:
        digest = F.lit(7).cast("long")
        for part in parts:
            digest = (digest * factor + part) % prime
        halves.append(digest)
    return halves[0] * 2**30 + halves[1]


def _unit_price() -> Column:
    """Line amount over quantity, half up to cents, in whole numbers."""
    quantity = F.col("l_quantity").cast("long")
    return (F.call_function("div", 2 * _price_cents() + quantity, 2 * quantity) / 100).cast(MONEY)


class Shop:
    """Entity frames over one directory of sample tables."""

    # The time column of the tables that have one.
    TIMES = {"orders": "o_orderdate", "events": "ts"}

    def __init__(self, spark: SparkSession, sf_dir: str, days: dict[str, tuple[str, str]] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.days = days or {}

    def on(self, table: str, first: str, last: str) -> Shop:
        """The same shop with ``table`` restricted to the days ``first`` to ``last``."""
        return Shop(self.spark, self.sf_dir, self.days | {table: (first, last)})

    def table(self, name: str) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in self.days:
            return rows
        # Compared in the column's own type, so the bounds reach the scan.
        moment = F.col(self.TIMES[name])
        kind = rows.schema[self.TIMES[name]].dataType
        first, last = (date.fromisoformat(day) for day in self.days[name])
        bound = lambda day: F.lit(day.isoformat()).cast(kind)
        return rows.where((moment >= bound(first)) & (moment < bound(last + timedelta(days=1))))

    @cached_property
    def order_base(self) -> DataFrame:
        """Orders without their province, which takes a join with the customers."""
        lines = self.table("lineitem")
        if "orders" in self.days:
            asked = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"))
            lines = lines.join(asked, "l_orderkey", "left_semi")
        original = (
            lines.groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("original"))
        )
        return (
            self.table("orders")
            .join(original, "o_orderkey", "left")
            .select(
                F.col("o_orderkey").alias("id"),
                F.col("o_orderstatus").alias("order_status"),
                F.col("o_custkey").alias("user_id"),
                F.col("o_totalprice").cast(MONEY).alias("final_total_amount"),
                F.lit(0).cast(MONEY).alias("benefit_reduce_amount"),
                F.coalesce("original", F.lit(0)).cast(MONEY).alias("original_total_amount"),
                F.lit(0).cast(MONEY).alias("feight_fee"),
                F.lit(None).cast("timestamp").alias("expire_time"),
                F.col("o_orderdate").cast("timestamp").alias("create_time"),
                F.lit(None).cast("timestamp").alias("operate_time"),
            )
        )

    @cached_property
    def order_source(self) -> DataFrame:
        """Orders as their source system writes them."""
        home = self.table("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("long").alias("province_id")
        )
        return self.order_base.join(home, "user_id", "left").select(*ORDER_SOURCE.fieldNames())

    @cached_property
    def detail_source(self) -> DataFrame:
        """Order lines. ``line_amount`` is the stated amount; the unit price is for display."""
        amount = F.col("l_extendedprice").cast(MONEY)
        return self.table("lineitem").select(
            _detail_id().alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            _unit_price().alias("order_price"),
            F.col("l_quantity").cast("long").alias("sku_num"),
            F.lit(None).cast("string").alias("sku_name"),
            F.lit(None).cast("timestamp").alias("create_time"),
            amount.alias("line_amount"),
        )

    @cached_property
    def detail_events(self) -> DataFrame:
        """Order lines with the creation time of their order, for streams joined on time."""
        times = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("create_time")
        )
        return self.detail_source.drop("create_time").join(times, "order_id")

    def _named(self, column: str) -> DataFrame:
        """Distinct values of a part column with their surrogate id."""
        return self.table("part").groupBy(column).agg((F.min("p_partkey") + 1).alias("id"))

    @cached_property
    def sku(self) -> DataFrame:
        spu = self._named("p_name").withColumnRenamed("id", "spu_id")
        category3 = self._named("p_type").withColumnRenamed("id", "category3_id")
        return (
            self.table("part")
            .join(spu, "p_name")
            .join(category3, "p_type")
            .select(
                F.col("p_partkey").alias("id"),
                "spu_id",
                F.col("p_retailprice").cast(MONEY).alias("price"),
                F.col("p_name").alias("sku_name"),
                F.lit(None).cast("string").alias("sku_desc"),
                F.col("p_size").cast("double").alias("weight"),
                F.substring_index("p_brand", "#", -1).cast("long").alias("tm_id"),
                "category3_id",
                F.lit(None).cast("string").alias("sku_default_img"),
                F.lit(None).cast("timestamp").alias("create_time"),
            )
        )

    @cached_property
    def spu(self) -> DataFrame:
        return self._named("p_name").select(
            "id",
            F.col("p_name").alias("spu_name"),
            F.lit(None).cast("string").alias("description"),
            F.lit(None).cast("long").alias("category3_id"),
            F.lit(None).cast("long").alias("tm_id"),
        )

    @cached_property
    def trademark(self) -> DataFrame:
        brands = self.table("part").select(F.col("p_brand").alias("tm_name")).distinct()
        return brands.select(F.substring_index("tm_name", "#", -1).cast("long").alias("tm_id"), "tm_name")

    @cached_property
    def category3(self) -> DataFrame:
        return self._named("p_type").select(
            "id", F.col("p_type").alias("name"), F.lit(None).cast("long").alias("category2_id")
        )

    @cached_property
    def province(self) -> DataFrame:
        key = F.col("n_nationkey").cast("string")
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(
                F.col("n_nationkey").cast("long").alias("id"),
                F.col("n_name").alias("name"),
                F.col("r_regionkey").cast("long").alias("region_id"),
                F.concat(F.lit("1"), F.lpad(key, 5, "0")).alias("area_code"),
                F.concat(F.lit("CN-"), key).alias("iso_code"),
            )
        )

    @cached_property
    def user_source(self) -> DataFrame:
        key = F.col("c_custkey")
        year = (F.lit(1940) + key % 70).cast("string")
        return self.table("customer").select(
            key.alias("id"),
            F.col("c_mktsegment").alias("user_level"),
            F.concat(year, F.lit("-01-01")).alias("birthday"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        )

    def _log_fields(self) -> DataFrame:
        mid = _text("user_id")
        return self.table("events").select(
            F.when(F.col("event_type").isin(*LAUNCH_EVENTS), F.struct(F.col("event_type").alias("entry"))).alias(
                "start"
            ),
            F.struct(
                mid.alias("mid"),
                mid.alias("uid"),
                F.concat(F.lit("1"), F.lpad((F.col("user_id") % 25).cast("string"), 5, "0")).alias("ar"),
                F.col("event_type").alias("ch"),
                F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("vc"),
            ).alias("common"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
            "event_id",
        )

    @cached_property
    def app_log(self) -> DataFrame:
        """Raw logs as messages; four partitions, offsets in event order."""
        return self._log_fields().select(
            F.lit(None).cast("string").alias("key"),
            F.to_json(F.struct("start", "common", "ts")).alias("value"),
            F.lit("APP_LOG").alias("topic"),
            (F.col("event_id") % 4).cast("int").alias("partition"),
            F.floor(F.col("event_id") / 4).cast("long").alias("offset"),
            F.timestamp_millis("ts").alias("timestamp"),
        )

    @cached_property
    def launches(self) -> DataFrame:
        """Launch records straight from the events, for queries that start after routing."""
        log = self._log_fields().where(F.col("start").isNotNull())
        moment = clock.from_millis(F.col("ts"))
        return log.select(
            "common.*",
            clock.day(moment).alias("dt"),
            clock.hour(moment).alias("hr"),
            F.lit("00").alias("mi"),
            "ts",
            F.col("event_id").alias("offset"),
        )

    @cached_property
    def search_documents(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").alias("id"),
            F.col("text").alias("name"),
            F.array(F.struct(F.col("lang").alias("name")), F.struct(F.col("source").alias("name"))).alias("members"),
            F.col("n_chars").alias("score"),
        )
