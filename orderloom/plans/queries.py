"""Every registered query. Each reads its whole tables; a limit appears only where it is the feature."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions import clock
from orderloom.functions.text import TIME_FORMAT, record_json
from orderloom.operators import brand, cdc, dashboard, dau, dims, logs, orders, search, wide
from orderloom.plans.warehouse import Warehouse
from orderloom.session import tune, work_dir
from orderloom.sources.colocated import Colocated
from orderloom.sources.mapping import Shop

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; the SQL counterparts use the same values.
STATE_CUTOFF = "1998-01-01"
RANKING_START, RANKING_END, RANKING_SIZE = datetime(1996, 1, 1), datetime(1999, 1, 1), 10
DAU_DAY = "2024-01-15"
PAGE_DAY, PAGE_KEYWORD, PAGE_START, PAGE_LENGTH = "1997-05-28", "l", 2, 20
WITHHELD = 7
SEEK_LENGTH = 5
SEARCH_WORD, SEARCH_MEMBER = "with", "en"

_REGISTRY: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Plain column types for comparison with SQL engines: money as double, times as text."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, TIME_FORMAT)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(build: Callable[[Shop, Warehouse], DataFrame]) -> Callable:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shop = Shop(tune(spark), sf_dir)
        return present(build(shop, Warehouse(shop)))

    _REGISTRY[build.__name__] = run
    return build


def registered() -> dict[str, Query]:
    from orderloom.plans import stream_queries  # noqa: F401  registers the streaming queries

    return dict(_REGISTRY)


# --- orders and the wide line -------------------------------------------------------------------


def brand_amounts(w: Warehouse) -> DataFrame:
    """Split amounts per brand, one batch per order month."""
    return brand.batch_sums(w.plain_wide(w.details), F.date_trunc("month", "create_time"))


@query
def brand_topn(shop: Shop, w: Warehouse) -> DataFrame:
    return brand.top_n(brand.totals(brand_amounts(w), RANKING_START, RANKING_END), RANKING_SIZE)


@query
def brand_batch_sum(shop: Shop, w: Warehouse) -> DataFrame:
    return brand_amounts(w)


@query
def split_amount(shop: Shop, w: Warehouse) -> DataFrame:
    return w.plain_wide(w.bare_details).select(
        "order_id",
        "order_detail_id",
        "line_amount",
        "final_total_amount",
        "original_total_amount",
        "final_detail_amount",
        "other_split_amount",
        "other_origin_amount",
    )


@query
def split_amount_whole_units(shop: Shop, w: Warehouse) -> DataFrame:
    """The split rounded to whole units instead of cents."""
    return w.plain_wide(w.bare_details, scale=0).select("order_id", "order_detail_id", "final_detail_amount")


@query
def order_wide(shop: Shop, w: Warehouse) -> DataFrame:
    return wide.final_columns(w.wide)


@query
def order_wide_dedup(shop: Shop, w: Warehouse) -> DataFrame:
    """The wide line when every order and every line arrives twice."""
    once_orders, once_details = wide.dedup_sources(
        w.timed_orders.unionByName(w.timed_orders),
        shop.detail_source.unionByName(shop.detail_source),
    )
    summed = w.labelled(wide.attach_sums(once_orders, once_details))
    return wide.final_columns(wide.order_wide(summed, orders.enrich_details(once_details, w.product)))


@query
def order_wide_colocated(shop: Shop, w: Warehouse) -> DataFrame:
    """The wide line from stored orders and lines that share their buckets."""
    root = work_dir(shop.spark, "colocated")
    tables = Colocated(root, f"wide_{root.rpartition('-')[2]}", buckets=8, hot_lines=1000)
    tables.write(w.labelled(wide.attach_sums(w.timed_orders, shop.detail_source)), w.details, shop.detail_source)
    return wide.final_columns(tables.order_wide(shop.spark))


@query
def wide_seen_filter(shop: Shop, w: Warehouse) -> DataFrame:
    """Doubled wide lines, less those of orders already delivered before the cutoff."""
    lines = wide.join_orders(orders.without_labels(w.base_orders), w.bare_details)
    seen = lines.where(F.col("dt") < STATE_CUTOFF).select("order_detail_id")
    fresh = wide.dedup_wide(lines.unionByName(lines), seen=seen)
    return fresh.select("order_detail_id", "order_id", "dt", "line_amount")


@query
def order_enriched(shop: Shop, w: Warehouse) -> DataFrame:
    return w.orders


@query
def detail_enriched(shop: Shop, w: Warehouse) -> DataFrame:
    return w.details.drop("line_amount")


def _state_and_batch(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Buyers before the cutoff as known users, the later orders as the batch."""
    timed = w.base_orders
    state = (
        timed.where(F.col("create_date") < STATE_CUTOFF)
        .select(F.col("user_id").cast("string"), F.lit("1").alias("if_consumed"))
        .distinct()
    )
    return state, timed.where(F.col("create_date") >= STATE_CUTOFF)


@query
def first_order_flag(shop: Shop, w: Warehouse) -> DataFrame:
    state, batch = _state_and_batch(w)
    return orders.first_order_flag(batch, state).select("id", "user_id", "create_time", "if_first_order")


@query
def new_buyers(shop: Shop, w: Warehouse) -> DataFrame:
    state, batch = _state_and_batch(w)
    return orders.new_buyers(orders.first_order_flag(batch, state))


@query
def order_time_fields(shop: Shop, w: Warehouse) -> DataFrame:
    return w.base_orders.select("id", "create_time", "create_date", "create_hour")


# --- dimensions and change events ---------------------------------------------------------------


@query
def user_demographics(shop: Shop, w: Warehouse) -> DataFrame:
    return w.users


def _user_changes(shop: Shop) -> tuple[DataFrame, DataFrame]:
    """Users as first seen, and a later change of level for every third one."""
    base = shop.user_source.withColumns({"type": F.lit("insert"), "offset": F.col("id")})
    changed = base.where(F.col("id") % 3 == 0).withColumns(
        {
            "user_level": F.concat("user_level", F.lit("+")),
            "type": F.when(F.col("id") % 2 == 0, "delete").otherwise("update"),
            "offset": F.col("id") + 1_000_000_000_000,
        }
    )
    return base, changed


@query
def dim_latest(shop: Shop, w: Warehouse) -> DataFrame:
    base, changed = _user_changes(shop)
    return dims.upsert(base, changed, ["id"], ["offset"]).drop("type", "offset")


@query
def dim_latest_deletes(shop: Shop, w: Warehouse) -> DataFrame:
    base, changed = _user_changes(shop)
    return dims.upsert(base, changed, ["id"], ["offset"], apply_deletes=True).drop("type", "offset")


@query
def product_dim(shop: Shop, w: Warehouse) -> DataFrame:
    return w.product


def _order_payload(shop: Shop) -> DataFrame:
    """Order rows as JSON payloads."""
    source = shop.table("orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("final_total_amount"),
        F.date_format("o_orderdate", TIME_FORMAT).alias("create_time"),
    )
    return source.select("id", record_json(source).alias("payload"))


def object_events(shop: Shop) -> DataFrame:
    """One object envelope per order, with snapshot markers where the id is a multiple of 50."""
    kind = (
        F.when(F.col("id") % 100 == 0, "bootstrap-start")
        .when(F.col("id") % 100 == 50, "bootstrap-complete")
        .otherwise("insert")
    )
    value = F.concat(
        F.lit('{"table":"order_info","type":"'), kind, F.lit('","data":'), F.col("payload"), F.lit("}")
    )
    return _order_payload(shop).select(value.alias("value"), F.col("id").alias("offset"))


def array_events(shop: Shop) -> DataFrame:
    """Array envelopes holding an order once, or twice with the second id moved, or nothing."""
    twice = F.concat(F.lit("["), F.col("payload"), F.lit(","), F.col("payload"), F.lit("]"))
    once = F.concat(F.lit("["), F.col("payload"), F.lit("]"))
    data = F.when(F.col("id") % 3 == 0, twice).when(F.col("id") % 3 == 1, once).otherwise("[]")
    value = F.concat(F.lit('{"table":"order_info","type":"INSERT","data":'), data, F.lit("}"))
    return _order_payload(shop).select(value.alias("value"), F.col("id").alias("offset"))


def _order_columns(df: DataFrame) -> DataFrame:
    return df.select("id", "user_id", "order_status", "final_total_amount", "create_time", "type")


@query
def cdc_object(shop: Shop, w: Warehouse) -> DataFrame:
    return _order_columns(cdc.table_rows(cdc.unwrap_object(object_events(shop)), "order_info"))


@query
def cdc_array(shop: Shop, w: Warehouse) -> DataFrame:
    return _order_columns(cdc.table_rows(cdc.unwrap_array(array_events(shop)), "order_info"))


def table_events(shop: Shop) -> DataFrame:
    """Envelopes of four tables in one stream of changes."""
    parts = []
    for table, key in (("nation", "n_nationkey"), ("customer", "c_custkey"), ("part", "p_partkey"), ("orders", "o_orderkey")):
        frame = shop.table(table)
        envelope = F.to_json(
            F.struct(F.lit(table).alias("table"), F.lit("insert").alias("type"), F.struct(*frame.columns).alias("data"))
        )
        parts.append(frame.select(envelope.alias("value"), F.col(key).cast("long").alias("offset")))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def payload_label(value: Column) -> Column:
    """A naming field of the payload, whichever of the four tables it is of."""
    fields = ("n_name", "c_mktsegment", "p_name", "o_orderstatus")
    return F.coalesce(*[F.get_json_object(value, f"$.{name}") for name in fields])


@query
def cdc_route(shop: Shop, w: Warehouse) -> DataFrame:
    routed = cdc.route(cdc.unwrap_object(table_events(shop)))
    return routed.select("topic", "offset", payload_label(F.col("value")).alias("label"))


@query
def cdc_rejects(shop: Shop, w: Warehouse) -> DataFrame:
    """Envelopes cut off half-way are set aside, the rest of the batch goes on."""
    broken = F.when(F.col("offset") % 7 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
    return cdc.rejects(object_events(shop).withColumn("value", broken)).select("offset", "value")


@query
def cdc_array_rejects(shop: Shop, w: Warehouse) -> DataFrame:
    """Array envelopes whose payload is text, and ones cut off, are set aside as they came."""
    text = F.concat(F.lit('{"table":"order_info","type":"INSERT","data":"'), F.col("offset"), F.lit('"}'))
    broken = (
        F.when(F.col("offset") % 7 == 0, text)
        .when(F.col("offset") % 11 == 0, F.substring("value", 1, 38))
        .otherwise(F.col("value"))
    )
    return cdc.rejects(array_events(shop).withColumn("value", broken), "array").select("offset", "value")


# --- logs and active devices --------------------------------------------------------------------


@query
def log_route(shop: Shop, w: Warehouse) -> DataFrame:
    return logs.route(shop.app_log).select("key", "topic", "partition", "offset")


@query
def log_archive(shop: Shop, w: Warehouse) -> DataFrame:
    return logs.archive(shop.app_log)


@query
def dau_first_launch(shop: Shop, w: Warehouse) -> DataFrame:
    """From raw logs: route, keep launches, parse, first launch per day and device."""
    started = logs.route(shop.app_log).where(F.col("topic") == logs.LAUNCH_TOPIC)
    return dau.first_launches(logs.launches(started), tie=("offset", "partition"))


@query
def dau_devices_per_day(shop: Shop, w: Warehouse) -> DataFrame:
    return dau.devices_per_day(shop.launches)


@query
def dau_total(shop: Shop, w: Warehouse) -> DataFrame:
    return dau.total(dau.first_launches(shop.on("events", DAU_DAY, DAU_DAY).launches), DAU_DAY)


@query
def dau_hourly(shop: Shop, w: Warehouse) -> DataFrame:
    return dau.hourly(dau.first_launches(shop.on("events", DAU_DAY, DAU_DAY).launches), DAU_DAY)


def _two_days(shop: Shop) -> DataFrame:
    """First launches of the day and the day before."""
    return dau.first_launches(shop.on("events", clock.previous_day(DAU_DAY), DAU_DAY).launches)


@query
def dau_compare(shop: Shop, w: Warehouse) -> DataFrame:
    return dau.dense_hours(dau.compare(_two_days(shop), DAU_DAY))


@query
def dau_compare_json(shop: Shop, w: Warehouse) -> DataFrame:
    return dau.compare_json(dau.compare(_two_days(shop), DAU_DAY))


@query
def new_devices(shop: Shop, w: Warehouse) -> DataFrame:
    return dau.new_devices(shop.launches, DAU_DAY)


@query
def kpi_totals(shop: Shop, w: Warehouse) -> DataFrame:
    return dau.kpis(shop.launches, DAU_DAY)


# --- dashboard and search -----------------------------------------------------------------------


@query
def detail_page(shop: Shop, w: Warehouse) -> DataFrame:
    """The day is picked in the scan of the orders, as a wide table partitioned by day would have it."""
    day = Warehouse(shop.on("orders", PAGE_DAY, PAGE_DAY))
    lines = w.wide_for(day.timed_orders, w.details)
    return dashboard.detail_page(lines, PAGE_DAY, PAGE_KEYWORD, PAGE_START, PAGE_LENGTH)


@query
def detail_count(shop: Shop, w: Warehouse) -> DataFrame:
    day = Warehouse(shop.on("orders", PAGE_DAY, PAGE_DAY))
    lines = wide.join_orders(orders.without_labels(day.base_orders), w.details)
    return dashboard.detail_count(lines, PAGE_DAY, PAGE_KEYWORD)


@query
def gender_share(shop: Shop, w: Warehouse) -> DataFrame:
    return dashboard.gender_share(wide.join_orders(w.orders, w.bare_details))


@query
def age_share(shop: Shop, w: Warehouse) -> DataFrame:
    lines = wide.join_orders(orders.without_labels(w.base_orders), w.bare_details)
    return dashboard.age_share(lines, shop.user_source, w.as_of_year)


@query
def province_sales(shop: Shop, w: Warehouse) -> DataFrame:
    return dashboard.province_sales(w.wide_for(w.timed_orders, w.bare_details), step=25_000_000)


@query
def doc_search(shop: Shop, w: Warehouse) -> DataFrame:
    found = search.search(shop.search_documents, SEARCH_WORD, SEARCH_MEMBER)
    return found.withColumn("members", F.array_join("members.name", ","))
