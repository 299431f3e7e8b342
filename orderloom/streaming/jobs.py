"""The streaming jobs of the warehouse.

Each job reads one message stream (two for the wide line), runs the batch operators inside ``foreachBatch``
and writes results under the batch id, so a replayed batch replaces its own output. Dimensions and state are
read anew in every batch, restricted to the keys of the batch before winners are chosen. A batch only looks at state written by
earlier batches. Tables are compacted by the job that writes them, every ``compact_every`` batches.

Messages leave through a ``topics.Writer`` (files or Kafka). Rows that cannot be used go to a reject folder with their text. A job that is
given a ledger records how far each batch has read the source topic. A job that has lost its checkpoint goes on from there with ``first_batch``, as its
batches count from 0 again and the numbers name what it writes.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions.text import typed_rows
from orderloom.operators import brand, cdc, dau, dims, logs, orders, split, wide
from orderloom.operators.keyed import earliest, latest
from orderloom.schemas import DIMENSION_KEYS, LINE_AMOUNT, ORDER_DETAIL, ORDER_DETAIL_WIDE, ORDER_INFO
from orderloom.session import PACKED_STATE, checkpoint_settings, settings
from orderloom.sources import topics
from orderloom.sources.tables import BatchTable, Commits, KeyedTable
from orderloom.streaming import progress

REFERENCE_TRIGGER = {"processingTime": "5 seconds"}
DRAIN = {"availableNow": True}
COMPACT_EVERY = 100

Handler = Callable[[DataFrame, int], None]


def start(
    stream: DataFrame, handler: Handler, checkpoint: str, trigger: dict | None = None, name: str | None = None, first_batch: int = 0
) -> StreamingQuery:
    """Run ``handler`` on every batch. The batch is kept while the handler reads it more than once.

    Spark turns adaptive execution off in the session of a stream that keeps state. What a handler runs on the batch holds none and is adaptive again:
    without, a rebalance hint counts for nothing, and every task of a batch writes a file of every day it meets.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                with settings(batch.sparkSession, {"spark.sql.adaptive.enabled": "true"}):
                    handler(batch, batch_id + first_batch)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    with settings(stream.sparkSession, checkpoint_settings(stream.sparkSession, checkpoint) | PACKED_STATE):
        return writer.trigger(**(trigger or REFERENCE_TRIGGER)).start()


def together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run writes of a batch that do not build on each other side by side, so that a small batch does not wait for their fixed costs one after
    the other. All have ended when this returns or raises the first error."""
    inherited = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(writes)) as pool:
        running = [pool.submit(inherited(write)) for write in writes]
    for one in running:
        one.result()


@dataclass(frozen=True)
class Ledger:
    """Where a job records its positions, and the consumer group it records them under."""

    table: KeyedTable
    group: str
    compact_every: int = COMPACT_EVERY

    def record(self, batch: DataFrame, batch_id: int) -> None:
        self.table.write(progress.positions(batch, self.group), batch_id)
        self.table.compact_every(batch.sparkSession, batch_id, self.compact_every)


# --- change events ------------------------------------------------------------------------------


def unwrapped(messages: DataFrame, envelope: str) -> DataFrame:
    return cdc.unwrap_array(messages) if envelope == "array" else cdc.unwrap_object(messages)


def ods_rows(messages: DataFrame, table: str) -> DataFrame:
    """Messages of one table's own topic in the shape the jobs below take."""
    return messages.drop("key", "topic").withColumns({"table": F.lit(table), "type": F.lit(None).cast("string")})


def reject_to(rows: DataFrame, folder: str, batch_id: int) -> None:
    rows.write.mode("overwrite").json(f"{folder}/batch_id={batch_id}")


def opened(batch: DataFrame, envelope: str | None, rejected: str, batch_id: int) -> DataFrame:
    """Rows of a batch of enveloped messages; unusable messages go to ``rejected``. Without an envelope kind the batch
    holds rows already."""
    if envelope is None:
        return batch
    reject_to(cdc.rejects(batch, envelope), f"{rejected}/envelope", batch_id)
    return unwrapped(batch, envelope)


def route_changes(
    messages: DataFrame,
    send: topics.Writer,
    rejected: str,
    checkpoint: str,
    envelope: str = "object",
    ledger: Ledger | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Split change events into one topic per table; unreadable ones go to the reject folder."""

    def handler(batch: DataFrame, batch_id: int) -> None:
        routed = cdc.route(unwrapped(batch, envelope)).drop("table", "type").withColumn("key", F.lit(None).cast("string"))
        send(routed, batch_id)
        reject_to(cdc.rejects(batch, envelope), rejected, batch_id)
        if ledger:
            ledger.record(batch, batch_id)

    return start(messages, handler, checkpoint, trigger)


# Positions of different partitions do not compare: the message time decides first.
def _arrival(rows: DataFrame) -> list[str]:
    return [c for c in ("timestamp", "partition", "offset") if c in rows.columns]


def keep_dimension(
    rows: DataFrame,
    name: str,
    table: KeyedTable,
    rejected: str,
    checkpoint: str,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    envelope: str | None = None,
    ledger: Ledger | None = None,
    compact_every: int = COMPACT_EVERY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Upsert one dimension from its change rows. Rows without a readable key are set aside."""
    key = DIMENSION_KEYS[name]

    def handler(batch: DataFrame, batch_id: int) -> None:
        found = opened(batch, envelope, rejected, batch_id)
        parsed = cdc.table_rows(found, name)
        winners = latest(parsed.where(F.col(key).isNotNull()), [key], _arrival(parsed))
        table.compact_every(batch.sparkSession, batch_id, compact_every)
        together(
            batch.sparkSession,
            lambda: table.write(derive(winners) if derive else winners, batch_id),
            lambda: _set_aside(found, name, {key: "long"}, rejected, batch_id),
        )
        if ledger:
            ledger.record(batch, batch_id)

    return start(rows, handler, checkpoint, trigger)


def _unusable(fields: dict[str, str]) -> Column:
    """Whether one of the JSON fields in ``value`` cannot be read as its type."""
    tests = [F.get_json_object("value", f"$.{name}").try_cast(kind).isNull() for name, kind in fields.items()]
    return reduce(lambda a, b: a | b, tests)


def _set_aside(rows: DataFrame, name: str, fields: dict[str, str], rejected: str, batch_id: int) -> None:
    """Keep the text of rows of one table with a field that cannot be read."""
    reject_to(rows.where((F.upper("table") == name.upper()) & _unusable(fields)), rejected, batch_id)


@dataclass(frozen=True)
class Dimensions:
    """The dimension tables the fact jobs read in every batch."""

    province: KeyedTable
    users: KeyedTable
    sku: KeyedTable
    spu: KeyedTable
    trademark: KeyedTable
    category3: KeyedTable


# --- facts --------------------------------------------------------------------------------------


ORDER_NEEDS = {"id": "long", "create_time": "timestamp"}
LINE_NEEDS = {"id": "long", "order_id": "long", "create_time": "timestamp"}


def _usable(parsed: DataFrame, fields: dict[str, str]) -> DataFrame:
    return parsed.where(reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in fields]))


def publish_orders(
    rows: DataFrame,
    dimensions: Dimensions,
    state: KeyedTable,
    send: topics.Writer,
    rejected: str,
    checkpoint: str,
    envelope: str | None = None,
    ledger: Ledger | None = None,
    compact_every: int = COMPACT_EVERY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Orders with first-order flag and labels to their topic; new buyers to the state table. Orders without a readable id or
    creation time are set aside."""

    def handler(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = opened(batch, envelope, rejected, batch_id)
        parsed = _usable(cdc.table_rows(found, "order_info"), ORDER_NEEDS)
        # Kept, as keys, first orders and the orders themselves are read from it: one parse of the messages instead of three.
        once = earliest(parsed, ["id"], _arrival(parsed)).drop("type", "partition", "offset", "timestamp").persist()
        timed = orders.with_time_fields(once)
        buyers = timed.select(F.col("user_id").cast("string").alias("user_id"))
        state.compact_every(spark, batch_id, compact_every)
        flagged = orders.first_order_flag(timed, state.current(spark, before=batch_id, keys=buyers)).persist()
        try:
            users = dimensions.users.current(spark, keys=flagged.select(F.col("user_id").alias("id")))
            labelled = orders.enrich_orders(flagged, dimensions.province.current(spark), users)
            together(
                spark,
                lambda: _set_aside(found, "order_info", ORDER_NEEDS, rejected, batch_id),
                lambda: state.write(orders.new_buyers(flagged), batch_id),
                lambda: send(topics.as_messages(labelled, "DWD_ORDER_INFO", "id"), batch_id),
            )
            if ledger:
                ledger.record(batch, batch_id)
        finally:
            flagged.unpersist()
            once.unpersist()

    return start(rows, handler, checkpoint, trigger)


def publish_details(
    rows: DataFrame,
    dimensions: Dimensions,
    send: topics.Writer,
    rejected: str,
    checkpoint: str,
    envelope: str | None = None,
    ledger: Ledger | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Order lines with product columns to their topic, keyed by order. Lines without a readable id, order or creation time
    are set aside."""

    def handler(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = opened(batch, envelope, rejected, batch_id)
        parsed = _usable(cdc.table_rows(found, "order_detail"), LINE_NEEDS)
        once = earliest(parsed, ["order_id", "id"], _arrival(parsed)).drop("type", "partition", "offset", "timestamp").persist()
        product = dims.product(
            dimensions.sku.current(spark, keys=once.select(F.col("sku_id").alias("id"))),
            dimensions.spu.current(spark),
            dimensions.trademark.current(spark),
            dimensions.category3.current(spark),
        )
        labelled = orders.enrich_details(once, product)
        try:
            together(
                spark,
                lambda: _set_aside(found, "order_detail", LINE_NEEDS, rejected, batch_id),
                lambda: send(topics.as_messages(labelled, "DWD_ORDER_DETAIL", "order_id"), batch_id),
            )
            if ledger:
                ledger.record(batch, batch_id)
        finally:
            once.unpersist()

    return start(rows, handler, checkpoint, trigger)


def joined_lines(
    order_messages: DataFrame, detail_messages: DataFrame, within: str = "10 seconds", salt: int = 4, unmatched: bool = False
) -> DataFrame:
    """Stream-stream join of orders and lines created at most ``within`` of each other, one row per line.

    Copies are dropped on either side before the join. The lines of an order are spread over ``salt`` keys
    and the order is repeated for each, as no adaptive split exists for a streaming join.

    With ``unmatched`` a line whose order has not come when the watermark passes it is given out too, with its own ids and ``matched``
    false, so that every line that arrives ahead of the watermark is a row sooner or later.
    """
    order_rows = (
        typed_rows(order_messages.select("value"), ORDER_INFO)
        .withWatermark("create_time", within)
        .dropDuplicatesWithinWatermark(["id"])
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    )
    detail_rows = (
        wide.with_line_amount(
            typed_rows(detail_messages.select("value"), _DETAIL_MESSAGE).withWatermark("create_time", within)
        )
        .dropDuplicatesWithinWatermark(["order_id", "id"])
        .withColumn("_salt", F.pmod(F.hash("id"), F.lit(salt)))
    )
    near = F.expr(f"d.create_time BETWEEN o.create_time - INTERVAL {within} AND o.create_time + INTERVAL {within}")
    same = (F.col("o.id") == F.col("d.order_id")) & (F.col("o._salt") == F.col("d._salt"))
    if not unmatched:
        joined = order_rows.alias("o").join(detail_rows.alias("d"), same & near)
        return joined.select(*wide.wide_columns("o", "d"), F.col("d.line_amount"))
    joined = detail_rows.alias("d").join(order_rows.alias("o"), same & near, "left_outer")
    found = joined.select(*wide.wide_columns("o", "d"), F.col("d.line_amount"), F.col("d.order_id").alias("_asked"), F.col("d.create_time").alias("_line_time"))
    return found.withColumns(
        {
            "matched": F.col("order_id").isNotNull(),
            "order_id": F.col("_asked"),
            "create_time": F.coalesce("create_time", "_line_time"),
        }
    ).drop("_asked", "_line_time")


def publish_wide(
    lines: DataFrame,
    table: BatchTable,
    running: KeyedTable,
    send: topics.Writer,
    checkpoint: str,
    append: Callable[[DataFrame], None] | None = None,
    compact_every: int = COMPACT_EVERY,
    name: str | None = None,
    first_batch: int = 0,
    late: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Split joined lines and send them to the wide table, the topic and, if given, a JDBC append.

    ``late`` names a folder for the lines that never met their order, where ``lines`` holds them (``joined_lines(unmatched=True)``).
    """

    def handler(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if late:
            alone = batch.where(~F.col("matched")).select("order_id", "order_detail_id", "sku_id", "create_time", "line_amount")
            alone.write.mode("overwrite").json(f"{late}/batch_id={batch_id}")
            batch = batch.where("matched").drop("matched")
        running.compact_every(spark, batch_id, compact_every)
        seen = running.current(spark, before=batch_id, keys=batch.select("dt", "order_id"))
        divided, sums = split.split_arrivals(batch, seen)
        divided = divided.persist()
        try:
            rows = wide.final_columns(divided)
            together(
                spark,
                lambda: running.write(sums, batch_id),
                lambda: table.write(rows, batch_id),
                lambda: send(topics.as_messages(rows, "ADS_ORDER_WIDE", "order_id"), batch_id),
                *([lambda: append(rows)] if append else []),
            )
        finally:
            divided.unpersist()

    return start(lines, handler, checkpoint, trigger, name, first_batch)


LINE_KEY = ("dt", "order_id", "order_detail_id")
WIDE_NEEDS = {"dt": "date", "order_id": "long", "order_detail_id": "long"}
_SUMMED = type(ORDER_DETAIL_WIDE)([f for f in ORDER_DETAIL_WIDE if f.name in (*LINE_KEY, "tm_id", "tm_name", "final_detail_amount")])


def sum_brands(
    messages: DataFrame,
    table: BatchTable,
    counted: KeyedTable,
    rejected: str,
    checkpoint: str,
    stat_time: Column | None = None,
    ledger: Ledger | None = None,
    commits: Commits | None = None,
    first_batch: int = 0,
    keep_days: int | None = None,
    compact_every: int = COMPACT_EVERY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Brand sums of each batch, stamped with ``stat_time`` (the batch clock by default).

    A topic written at least once can hold a line twice, in one batch or in two. ``counted`` keeps the ids of the lines
    summed so far, by day; a line counts once however often and however late it comes, unless its day lies more than ``keep_days`` before the newest.
    Messages without a readable day, order or line are set aside.

    With ``commits``, shared by ``table``, ``counted`` and the ledger's table, sums and positions of a batch become visible
    together, by one marker written last. A batch that breaks off between them shows neither and is run again.
    """

    def handler(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        moment = F.current_timestamp() if stat_time is None else stat_time
        # Kept, as rejects, keys and sums are read from it: the messages are parsed once, and only for what the sums and ids need.
        message = F.when(F.col("_bad"), F.struct(*batch.columns)).alias("_message")
        once = typed_rows(batch.withColumn("_bad", _unusable(WIDE_NEEDS)).select("value", "_bad", message), _SUMMED).persist()
        lines = once.where(~F.col("_bad")).drop("_bad", "_message")
        counted.compact_every(spark, batch_id, compact_every, keep_days)
        known = counted.current(spark, before=batch_id, keys=lines.select(*LINE_KEY))
        fresh = lines.dropDuplicates(list(LINE_KEY)).join(known, list(LINE_KEY), "left_anti").persist()
        try:
            together(
                spark,
                lambda: reject_to(once.where("_bad").select("_message.*"), rejected, batch_id),
                lambda: counted.write(fresh, batch_id),
                lambda: table.write(brand.batch_sums(fresh, moment), batch_id),
            )
            if ledger:
                ledger.record(batch, batch_id)
            if commits:
                commits.mark(spark, batch_id)
        finally:
            fresh.unpersist()
            once.unpersist()

    return start(messages, handler, checkpoint, trigger, first_batch=first_batch)


_DETAIL_MESSAGE = type(ORDER_DETAIL)(ORDER_DETAIL.fields + LINE_AMOUNT.fields)


# --- logs ---------------------------------------------------------------------------------------


def route_logs(
    messages: DataFrame,
    send: topics.Writer,
    archive: str,
    checkpoint: str,
    ledger: Ledger | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Archive raw logs by day and split them into launch and event topics."""

    def handler(batch: DataFrame, batch_id: int) -> None:
        archived = logs.archive(batch).hint("rebalance", "dt")
        archived.write.mode("overwrite").partitionBy("dt").text(f"{archive}/batch_id={batch_id}")
        send(logs.route(batch), batch_id)
        if ledger:
            ledger.record(batch, batch_id)

    return start(messages, handler, checkpoint, trigger)


def count_devices(
    messages: DataFrame,
    table: KeyedTable,
    rejected: str,
    checkpoint: str,
    ledger: Ledger | None = None,
    first_days: KeyedTable | None = None,
    sketches: KeyedTable | None = None,
    compact_every: int = COMPACT_EVERY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """First launch per device and day into a table keyed by both. A batch adds only devices that are new
    for the day or launched earlier than known, so late logs still correct the hour. Launches without a readable device or time are set aside.

    ``first_days`` keeps the first day of every device, by day, so that the new devices of a day are read from that day alone.
    ``sketches`` keeps a mergeable sketch of the devices of every day, from which any span of days is counted approximately.
    """

    def handler(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        reject_to(logs.unreadable(batch), rejected, batch_id)
        firsts = dau.first_launches(logs.launches(batch), tie=("offset", "partition")).persist()
        try:
            table.compact_every(spark, batch_id, compact_every)
            known = table.current(spark, before=batch_id, keys=firsts.select("dt", "mid"))
            known = known.select("dt", "mid", F.col("ts").alias("_known"))
            fresh = firsts.join(known, ["dt", "mid"], "left")
            table.write(fresh.where(F.col("_known").isNull() | (F.col("ts") < F.col("_known"))), batch_id)
            if first_days:
                first_days.compact_every(spark, batch_id, compact_every)
                held = first_days.current(spark, before=batch_id, keys=firsts.select("mid")).where(~F.col("moved"))
                first_days.write(dau.first_days(firsts, held), batch_id)
            if sketches:
                sketches.compact_every(spark, batch_id, compact_every)
                held = sketches.current(spark, before=batch_id, keys=firsts.select("dt"))
                sketches.write(dau.day_sketches(firsts, held), batch_id)
            if ledger:
                ledger.record(batch, batch_id)
        finally:
            firsts.unpersist()

    return start(messages, handler, checkpoint, trigger)
