"""Registered streaming queries: the tables are cut into message files in time order, the jobs drain each
cut from the same checkpoints, and the result table is returned."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators import brand, cdc, dashboard, dau, dims, logs
from orderloom.plans.queries import (
    DAU_DAY,
    PAGE_DAY,
    PAGE_KEYWORD,
    PAGE_LENGTH,
    PAGE_START,
    SEEK_LENGTH,
    WITHHELD,
    payload_label,
    query,
    table_events,
)
from orderloom.plans.warehouse import Warehouse
from orderloom.schemas import (
    BRAND_AMOUNT,
    CATEGORY3,
    COUNTED_LINE,
    DAU_INFO,
    DAY_SKETCH,
    DIMENSION_KEYS,
    FIRST_DAY,
    ORDER_DETAIL_WIDE,
    ORDER_SPLIT_STATE,
    PROVINCE,
    SKU_INFO,
    SPU_INFO,
    TRADEMARK,
    USER_INFO,
    USER_STATE,
)
from orderloom.session import PACKED_STATE, checkpoint_settings, settings, work_dir
from orderloom.sources import topics
from orderloom.sources.mapping import Shop
from orderloom.sources.tables import BatchTable, Commits, KeyedTable, query_tables
from orderloom.streaming import jobs, progress, stateful

ORDER_CUTS = ("1997-03-01", "1999-06-01")
EVENT_CUTS = ("2024-01-11", "2024-01-21")


def cuts(moment: Column, bounds: Sequence[str]) -> list[Column]:
    """Conditions that cut a time column at ``bounds``."""
    if not bounds:
        return [F.lit(True)]
    edges = [F.lit(b).cast("timestamp") for b in bounds]
    middle = [(moment >= low) & (moment < high) for low, high in zip(edges, edges[1:])]
    return [moment < edges[0], *middle, moment >= edges[-1]]


def feed(messages: DataFrame, path: str) -> None:
    messages.write.mode("append").options(**topics.PACKED).json(path)


def change_messages(rows: DataFrame, table: str, position: str = "id") -> DataFrame:
    """Rows as object envelopes of one table, in source order."""
    written = rows.withColumns(
        {f.name: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") for f in rows.schema if f.dataType.typeName() == "timestamp"}
    )
    envelope = F.struct(F.lit(table).alias("table"), F.lit("insert").alias("type"), F.struct(*rows.columns).alias("data"))
    return written.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(envelope).alias("value"),
        F.lit("CHANGES").alias("topic"),
        F.lit(0).alias("partition"),
        F.col(position).alias("offset"),
    )


def drain(*stages: Callable | tuple[Callable, ...], seconds: list[float] | None = None) -> None:
    """Run jobs until each has read everything there is: one stage after the other, the jobs of a tuple
    side by side. The time of every batch is added to ``seconds``."""
    for stage in stages:
        for running in [begin() for begin in (stage if isinstance(stage, tuple) else (stage,))]:
            running.awaitTermination()
            if seconds is not None:
                batches = [p for p in running.recentProgress if p.numInputRows]
                seconds += [p.durationMs.get("triggerExecution", 0) / 1000 for p in batches]


class Pipeline:
    """Folders, tables and jobs of one streaming run.

    ``max_files`` bounds what a batch of a job with one source takes in, so that a backlog is worked off in batches of the usual size. The joined
    stream takes all there is: the files of one upstream batch share a span of time, and the watermark must not move on between them.
    """

    def __init__(self, shop: Shop, warehouse: Warehouse, max_files: int | None = None):
        self.shop, self.warehouse, self.spark, self.max_files = shop, warehouse, shop.spark, max_files
        self.root = work_dir(shop.spark, "stream")
        self.batch_seconds: list[float] = []
        table = lambda name, schema, key: KeyedTable(f"{self.root}/dim/{name}", schema, [key])
        self.dimensions = jobs.Dimensions(
            province=table("base_province", PROVINCE, "id"),
            users=table("user_info", USER_INFO, "id"),
            sku=table("sku_info", SKU_INFO, "id"),
            spu=table("spu_info", SPU_INFO, "id"),
            trademark=table("base_trademark", TRADEMARK, "tm_id"),
            category3=table("base_category3", CATEGORY3, "id"),
        )
        self.state = KeyedTable(f"{self.root}/user_state", USER_STATE, ["user_id"])
        self.running = KeyedTable(f"{self.root}/order_split", ORDER_SPLIT_STATE, ["order_id"], partition_by=["dt"])
        self.wide = BatchTable(f"{self.root}/order_wide", ORDER_DETAIL_WIDE, partition_by=["dt"], sort_by=["order_detail_id"])
        # The sums, the lines counted in them and the job's positions show a batch together.
        self.brand_commits = Commits(f"{self.root}/brand_commits")
        self.brands = BatchTable(f"{self.root}/brand", BRAND_AMOUNT, commits=self.brand_commits)
        self.counted = KeyedTable(
            f"{self.root}/brand_lines", COUNTED_LINE, jobs.LINE_KEY, partition_by=["dt"], commits=self.brand_commits
        )
        self.listener: progress.Positions | None = None
        self.dau = KeyedTable(
            f"{self.root}/dau", DAU_INFO, ["dt", "mid"], order=["ts"], partition_by=["dt"], keep_first=True
        )
        self.sketches = KeyedTable(f"{self.root}/day_sketches", DAY_SKETCH, ["dt"])
        self.first_days = KeyedTable(f"{self.root}/first_days", FIRST_DAY, ["dt", "mid"], partition_by=["dt"])

    def path(self, name: str) -> str:
        return f"{self.root}/topic/{name}"

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoint/{name}"

    def ledger(self, job: str) -> jobs.Ledger:
        """Positions of one job. Jobs write side by side, so each has a table of its own below ``progress``."""
        commits = self.brand_commits if job == "brands" else None
        return jobs.Ledger(progress.ledger(f"{self.root}/progress/{job}", commits), job)

    def listen(self) -> "Pipeline":
        """Take the positions of the joined stream from its progress."""
        self.listener = progress.Positions(self.spark)
        self.spark.streams.addListener(self.listener)
        return self

    def stop_listening(self) -> "Pipeline":
        self.spark.streams.removeListener(self.listener)
        self.listener = None
        return self

    def positions(self, *names: str) -> DataFrame:
        """The recorded positions of the jobs."""
        return reduce(DataFrame.unionByName, [self.ledger(name).table.current(self.spark) for name in names])

    def messages(self, name: str, since: int | None = None, bounded: bool = True) -> DataFrame:
        return topics.read_files(self.spark, self.path(name), self.max_files if bounded else None, since)

    def _since(self, job: str, topic: str, resume: bool) -> int | None:
        """Where a job without its checkpoint goes on."""
        return topics.next_position(self.ledger(job).table.current(self.spark), job, topic) if resume else None

    def _changes(self, name: str) -> DataFrame:
        return cdc.unwrap_object(self.messages(name))

    def rejected(self, name: str) -> str:
        return f"{self.root}/reject/{name}"

    def load_dimensions(self) -> None:
        """Fill the dimension tables through their jobs."""
        shop, year = self.shop, self.warehouse.as_of_year
        sources = (
            ("base_province", shop.province, self.dimensions.province, None),
            ("user_info", shop.user_source, self.dimensions.users, lambda users: dims.user_info(users, year)),
            ("sku_info", shop.sku, self.dimensions.sku, None),
            ("spu_info", shop.spu, self.dimensions.spu, None),
            ("base_trademark", shop.trademark, self.dimensions.trademark, None),
            ("base_category3", shop.category3, self.dimensions.category3, None),
        )
        position = lambda name: "tm_id" if name == "base_trademark" else "id"
        jobs.together(self.spark, *[partial(feed, change_messages(rows, name, position(name)), self.path(name)) for name, rows, _, _ in sources])
        drain(tuple(partial(self.keep_dimension, name, table, derive) for name, _, table, derive in sources))

    def keep_dimension(self, name: str, table: KeyedTable, derive: Callable | None = None):
        return jobs.keep_dimension(
            self.messages(name),
            name,
            table,
            self.rejected(name),
            self._checkpoint(name),
            derive,
            envelope="object",
            ledger=self.ledger(name),
            trigger=jobs.DRAIN,
        )

    def publish_orders(self, send: topics.Writer | None = None):
        return jobs.publish_orders(
            self.messages("order_info"),
            self.dimensions,
            self.state,
            send or topics.to_files(self.path("DWD_ORDER_INFO")),
            self.rejected("order_info"),
            self._checkpoint("orders"),
            envelope="object",
            ledger=self.ledger("order_info"),
            trigger=jobs.DRAIN,
        )

    def publish_details(self, send: topics.Writer | None = None):
        return jobs.publish_details(
            self.messages("order_detail"),
            self.dimensions,
            send or topics.to_files(self.path("DWD_ORDER_DETAIL")),
            self.rejected("order_detail"),
            self._checkpoint("details"),
            envelope="object",
            ledger=self.ledger("order_detail"),
            trigger=jobs.DRAIN,
        )

    def joined(self, resume: bool = False, unmatched: bool = False) -> DataFrame:
        return jobs.joined_lines(
            *(
                progress.watched(self.messages(topic, self._since("wide", topic, resume), bounded=False), topic)
                for topic in ("DWD_ORDER_INFO", "DWD_ORDER_DETAIL")
            ),
            unmatched=unmatched,
        )

    def late_lines(self) -> DataFrame:
        """Lines the wide job has set aside because their order never came."""
        rows = self.spark.read.option("recursiveFileLookup", "true").schema("order_id long, order_detail_id long")
        return rows.json(f"{self.root}/late")

    def publish_wide(self, send: topics.Writer | None = None, resume: bool = False, unmatched: bool = False):
        """The wide job. ``resume`` starts it without its checkpoint, from the positions in the ledger; messages that waited in the join's
        state are then gone."""
        name = f"wide {self.root}"
        first_batch = self.wide.next_batch(self.spark) if resume else 0
        if self.listener:
            self.listener.follow(name, self.ledger("wide").table, "wide", first_batch)
        running = jobs.publish_wide(
            self.joined(resume, unmatched),
            self.wide,
            self.running,
            send or topics.to_files(self.path("ADS_ORDER_WIDE")),
            self._checkpoint(f"wide-{first_batch}" if resume else "wide"),
            name=name,
            first_batch=first_batch,
            late=f"{self.root}/late" if unmatched else None,
            trigger=jobs.DRAIN,
        )
        if self.listener:
            running.awaitTermination()
            self.listener.settle(running)
        return running

    def sum_brands(self, resume: bool = False):
        """The brand job, or with ``resume`` the same without its checkpoint, from the positions in the ledger."""
        first_batch = self.brand_commits.last(self.spark) + 1 if resume else 0
        return jobs.sum_brands(
            self.messages("ADS_ORDER_WIDE", self._since("brands", "ADS_ORDER_WIDE", resume)),
            self.brands,
            self.counted,
            self.rejected("brands"),
            self._checkpoint(f"brands-{first_batch}" if resume else "brands"),
            ledger=self.ledger("brands"),
            commits=self.brand_commits,
            first_batch=first_batch,
            trigger=jobs.DRAIN,
        )

    def feed_orders(
        self, *stages: Callable | tuple[Callable, ...], lines: bool = True, parts: Sequence[Column] | None = None
    ) -> "Pipeline":
        """Cut orders, and lines if wanted, by time; after each cut run the given stages. ``parts`` are other cuts than the usual ones."""
        orders, details = self.shop.order_source, self.shop.detail_events
        for part in parts or cuts(F.col("create_time"), ORDER_CUTS):
            if lines:
                self.feed_pair(orders.where(part), details.where(part))
            else:
                feed(change_messages(orders.where(part), "order_info"), self.path("order_info"))
            drain(*stages, seconds=self.batch_seconds)
        return self

    def feed_pair(self, orders: DataFrame, details: DataFrame) -> None:
        jobs.together(
            self.spark,
            lambda: feed(change_messages(orders, "order_info"), self.path("order_info")),
            lambda: feed(change_messages(details, "order_detail"), self.path("order_detail")),
        )

    def close_orders(self) -> None:
        """One order and line far in the future: the watermark of the join passes everything before."""
        end = {"id": F.lit(-1).cast("long"), "create_time": F.lit("2100-01-01").cast("timestamp")}
        self.feed_pair(
            self.shop.order_source.limit(1).withColumns(end),
            self.shop.detail_events.limit(1).withColumns(end | {"order_id": end["id"]}),
        )

    def feed_logs(self, *stages: Callable, bounds: Sequence[str] = EVENT_CUTS) -> "Pipeline":
        messages = self.shop.app_log
        for part in cuts(F.col("timestamp"), bounds):
            feed(messages.where(part), self.path("APP_LOG"))
            drain(*stages, seconds=self.batch_seconds)
        return self

    def route_logs(self, send: topics.Writer | None = None):
        return jobs.route_logs(
            self.messages("APP_LOG"),
            send or topics.to_files(self.path("logs"), split_by_topic=True),
            f"{self.root}/archive",
            self._checkpoint("logs"),
            ledger=self.ledger("LOGS"),
            trigger=jobs.DRAIN,
        )

    def launch_messages(self) -> DataFrame:
        """Launch logs. Their positions are those of the raw log, which routing carries along."""
        launches = topics.read_files(self.spark, topics.topic_path(self.path("logs"), logs.LAUNCH_TOPIC), self.max_files)
        return launches.withColumn("topic", F.lit("APP_LOG"))

    def count_devices(self, sketches: KeyedTable | None = None):
        return jobs.count_devices(
            self.launch_messages(),
            self.dau,
            self.rejected("launches"),
            self._checkpoint("dau"),
            ledger=self.ledger("DAU"),
            first_days=self.first_days,
            sketches=sketches,
            trigger=jobs.DRAIN,
        )

    def day_figures(self, day: str) -> DataFrame:
        """Active and new devices of a day, from that day's partitions of the kept tables."""
        on_day = F.col("dt") == day
        fresh = self.first_days.current(self.spark, where=on_day).where(~F.col("moved"))
        return dau.kept_kpis(self.dau.current(self.spark, where=on_day), fresh)

    def to_table(self, name: str, rows: DataFrame):
        """Append a stateful stream to a result folder."""
        writer = (
            rows.writeStream.format("parquet")
            .option("path", f"{self.root}/{name}")
            .option("checkpointLocation", self._checkpoint(name))
            .trigger(**jobs.DRAIN)
        )
        with stateful.disk_state(self.spark), settings(self.spark, checkpoint_settings(self.spark, self.root) | PACKED_STATE):
            return writer.start()

    def result(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")


@query
def stream_dau(shop: Shop, w: Warehouse) -> DataFrame:
    run = Pipeline(shop, w)
    return run.feed_logs(run.route_logs, run.count_devices).dau.current(shop.spark)


@query
def stream_dau_total(shop: Shop, w: Warehouse) -> DataFrame:
    """Active devices of a day from the kept table: the day names its partition."""
    run = Pipeline(shop, w)
    run.feed_logs(run.route_logs, run.count_devices)
    return dau.total(run.dau.current(shop.spark, where=F.col("dt") == DAU_DAY), DAU_DAY)


@query
def stream_kpi(shop: Shop, w: Warehouse) -> DataFrame:
    """Headline figures of a day, kept up to date by the device job instead of counted over all history."""
    run = Pipeline(shop, w)
    return run.feed_logs(run.route_logs, run.count_devices).day_figures(DAU_DAY)


@query
def stream_dau_state(shop: Shop, w: Warehouse) -> DataFrame:
    """Days and devices kept by streaming dedup; which launch of the day is kept depends on arrival."""
    run = Pipeline(shop, w)
    seen = lambda: run.to_table("seen", stateful.first_seen_devices(logs.launches(run.launch_messages())))
    return run.feed_logs(run.route_logs, seen).result("seen").select("dt", "mid")


@query
def stream_device_sketches(shop: Shop, w: Warehouse) -> DataFrame:
    """Devices of a month merged from the kept sketches of its days, held against the exact count: within three standard errors."""
    run = Pipeline(shop, w)
    run.feed_logs(run.route_logs, partial(run.count_devices, run.sketches))
    month = F.substring("dt", 1, 7).alias("month")
    sketches = run.sketches.current(shop.spark).select(month, "dt", "sketch")
    merged = dau.sketched_devices(dau.merge_sketches(sketches, "month"))
    days = sketches.groupBy("month").agg(F.count("*").alias("days"))
    exact = run.dau.current(shop.spark).select(month, "mid").distinct().groupBy("month").agg(F.count("*").alias("exact"))
    error = F.abs(F.col("devices") - F.col("exact")) / F.col("exact")
    bound = 3 * 1.04 / 2 ** (dau.SKETCH_BITS / 2)
    return merged.join(days, "month").join(exact, "month").select("month", "days", (error <= bound).alias("within_bound"))


@query
def stream_unmatched(shop: Shop, w: Warehouse) -> DataFrame:
    """Lines of orders that are never sent. The wide job gives them out once the watermark, moved on by a last pair, has passed them."""
    run = Pipeline(shop, w)
    sent = F.col("id") % WITHHELD != 0
    stages = ((run.publish_orders, run.publish_details), partial(run.publish_wide, unmatched=True))
    orders, details = shop.order_source, shop.detail_events
    for part in cuts(F.col("create_time"), ORDER_CUTS):
        run.feed_pair(orders.where(part & sent), details.where(part))
        drain(*stages)
    run.close_orders()
    drain(*stages)
    return run.late_lines().select("order_detail_id", "order_id")


@query
def progress_ledger(shop: Shop, w: Warehouse) -> DataFrame:
    run = Pipeline(shop, w)
    run.feed_logs(run.route_logs, run.count_devices)
    run.load_dimensions()
    run.listen().feed_orders((run.publish_orders, run.publish_details), run.publish_wide, run.sum_brands).stop_listening()
    return run.positions("LOGS", "DAU", *DIMENSION_KEYS, "order_info", "order_detail", "wide", "brands")


@query
def stream_cdc_route(shop: Shop, w: Warehouse) -> DataFrame:
    """Change events of four tables through the routing job."""
    run = Pipeline(shop, w)
    feed(table_events(shop), run.path("CHANGES"))
    drain(
        lambda: jobs.route_changes(
            topics.read_files(shop.spark, run.path("CHANGES")),
            topics.to_files(run.path("ods"), split_by_topic=True),
            run.rejected("changes"),
            f"{run.root}/checkpoint/ods",
            trigger=jobs.DRAIN,
        )
    )
    routed = shop.spark.read.json(run.path("ods"), schema="value string, offset long, batch_id long, topic string")
    return routed.select("topic", "offset", payload_label(F.col("value")).alias("label"))


@query
def stream_dim(shop: Shop, w: Warehouse) -> DataFrame:
    """Users, then changed users, through the dimension job."""
    run = Pipeline(shop, w)
    first = shop.user_source
    changed = first.where(F.col("id") % 3 == 0).withColumn("user_level", F.concat("user_level", F.lit("+")))
    derive = lambda users: dims.user_info(users, w.as_of_year)
    for rows in (first, changed):
        feed(change_messages(rows, "user_info"), run.path("user_info"))
        drain(lambda: run.keep_dimension("user_info", run.dimensions.users, derive))
    return run.dimensions.users.current(shop.spark)


@query
def stream_dim_sql(shop: Shop, w: Warehouse) -> DataFrame:
    """SQL over the kept dimension tables, after their jobs have filled them."""
    run = Pipeline(shop, w)
    run.load_dimensions()
    d = run.dimensions
    return query_tables(
        shop.spark,
        """
        SELECT t.tm_id, t.tm_name, c.name AS category3_name, count(*) AS skus
        FROM {sku} s JOIN {trademark} t ON s.tm_id = t.tm_id JOIN {category3} c ON s.category3_id = c.id
        GROUP BY t.tm_id, t.tm_name, c.name
        """,
        sku=d.sku,
        trademark=d.trademark,
        category3=d.category3,
    )


@query
def stream_first_order(shop: Shop, w: Warehouse) -> DataFrame:
    """Orders through the order job with its state table; the flag as published to the topic."""
    run = Pipeline(shop, w)
    run.feed_orders(run.publish_orders, lines=False)
    published = shop.spark.read.option("recursiveFileLookup", "true").json(
        run.path("DWD_ORDER_INFO"), schema="value string"
    )
    fields = F.from_json("value", "id long, user_id long, if_first_order string", {"mode": "PERMISSIVE"})
    return published.select(F.inline(F.array(fields)))


@query
def stream_first_order_state(shop: Shop, w: Warehouse) -> DataFrame:
    run = Pipeline(shop, w)
    flagged = lambda: run.to_table(
        "flags", stateful.first_orders(cdc.table_rows(run._changes("order_info"), "order_info"))
    )
    return run.feed_orders(flagged, lines=False).result("flags").select("id", "user_id", "if_first_order")


@query
def stream_wide(shop: Shop, w: Warehouse) -> DataFrame:
    """Change events to wide lines: dimensions, facts, join and split, each through its job."""
    run = Pipeline(shop, w)
    run.load_dimensions()
    run.feed_orders((run.publish_orders, run.publish_details), run.publish_wide)
    return run.wide.rows(shop.spark).select(*ORDER_DETAIL_WIDE.fieldNames())


@query
def stream_detail_page(shop: Shop, w: Warehouse) -> DataFrame:
    """A detail page served from the kept wide table, which is partitioned by day."""
    run = Pipeline(shop, w)
    run.load_dimensions()
    run.feed_orders((run.publish_orders, run.publish_details), run.publish_wide)
    return dashboard.detail_page(run.wide.rows(shop.spark), PAGE_DAY, PAGE_KEYWORD, PAGE_START, PAGE_LENGTH)


@query
def stream_detail_seek(shop: Shop, w: Warehouse) -> DataFrame:
    """The second page of a day, found from the last line of the first."""
    run = Pipeline(shop, w)
    run.load_dimensions()
    run.feed_orders((run.publish_orders, run.publish_details), run.publish_wide)
    pages = partial(dashboard.page_after, run.wide.rows(shop.spark), PAGE_DAY, PAGE_KEYWORD, length=SEEK_LENGTH)
    last = pages().agg(F.max("order_detail_id")).first()[0]
    return pages(after=last)


@query
def stream_brand(shop: Shop, w: Warehouse) -> DataFrame:
    """The same, on to brand sums per batch and their totals."""
    run = Pipeline(shop, w)
    run.load_dimensions()
    run.feed_orders((run.publish_orders, run.publish_details), run.publish_wide, run.sum_brands)
    return brand.totals(run.brands.rows(shop.spark))


@query
def stream_split_state(shop: Shop, w: Warehouse) -> DataFrame:
    """The split with running sums in the state store, line by line."""
    run = Pipeline(shop, w)
    parts = lambda: run.to_table("parts", stateful.split_lines(run.joined()))
    run.feed_orders((run.publish_orders, run.publish_details), parts)
    return run.result("parts").select("order_id", "order_detail_id", "final_detail_amount")
