"""State-store variants of the keyed operators.

They keep their memory in Spark's state store instead of a table, for pipelines whose input arrives in time
order per key. Rows are thinned out ahead of the shuffle: a user's earliest order and an order's sums of each chunk meet the state of
their key, the other rows are spread over tasks. Only a few numbers per key are kept.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from orderloom.functions.money import from_cents
from orderloom.operators import split
from orderloom.session import settings

# The state functions travel with the plan, so Python workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep state on local disk rather than in executor memory, with changelog checkpoints. The
    session's settings are as before afterwards.

    Every store sets 4 MB of disk aside for its manifest: a join keeps its four in one, and those of an ended query are closed within seconds."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.join.stateFormatVersion": "3",
        "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
    }
    with settings(spark, wanted):
        yield


def first_seen_devices(launches: DataFrame, horizon: str = "24 hours") -> DataFrame:
    """Whichever launch of a device and day arrives first; state is dropped after ``horizon``."""
    return (
        launches.withColumn("event_time", F.timestamp_millis("ts"))
        .withWatermark("event_time", horizon)
        .dropDuplicatesWithinWatermark(["dt", "mid"])
        .drop("event_time")
    )


_LANES = 16
_PASSING = 256


def _grouped(key: Column, lane: Column) -> Column:
    """What rows are grouped by beside their lane: those that meet the state (lane -1) by their key, those that only pass by one of a few values, as
    every group costs a call. Rows of a key still go to as many tasks as it has lanes."""
    return F.when(lane < 0, key.cast("string")).otherwise(F.pmod(F.xxhash64(key), F.lit(_PASSING)).cast("string"))


def _earliest_ahead(chunks: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ahead of the shuffle: of a chunk only the earliest order of a user can be the first one and goes to the user's state (lane -1); the
    others are spread over lanes."""
    for chunk in chunks:
        if chunk.empty:
            continue
        rows = chunk.sort_values(["create_time", "id"], kind="stable")
        later = rows["buyer"].duplicated(keep="first")
        yield rows.assign(lane=(rows["id"] % _LANES).where(later, -1).astype("int32"))


class _FirstOrder(StatefulProcessor):
    """Emits every order of the user as it comes and holds back only the earliest one so far. A buyer is one value; with a time to live it
    expires that long after it was written."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bought = handle.getValueState("buyer", "if_consumed string", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        shown = lambda row, flag: Row(id=row.id, buyer=row.buyer, moment=row.moment, if_first_order=flag)
        rank = lambda row: (row.moment is None, row.moment or 0, row.id)
        known = key[1] >= 0 or self.bought.exists()
        held: Row | None = None
        for row in rows:
            if known:
                yield shown(row, "0")
            elif held is None:
                held = row
            else:
                held, later = (row, held) if rank(row) < rank(held) else (held, row)
                yield shown(later, "0")
        if held is not None:
            self.bought.update(("1",))
            yield shown(held, "1")

    def close(self) -> None:
        pass


def first_orders(orders: DataFrame, ttl_seconds: float | None = None) -> DataFrame:
    """First-order flag with one state value per buyer. ``orders`` has id, user_id and create_time, id without nulls; orders without a user
    are those of one buyer.

    With ``ttl_seconds`` a buyer is forgotten that long after the first order, and the next order counts as first again. Spark then runs batches without
    data for as long as the query lives, to let values expire: a query that should end when its input does needs
    ``spark.sql.streaming.noDataMicroBatches.enabled`` off. The query must be started in :func:`disk_state`. A hot user's state meets one row per chunk of ten thousand orders.
    """
    # Text, as a long key with nulls would turn into floating numbers in Python.
    rows = orders.select("id", F.coalesce(F.col("user_id").cast("string"), F.lit("")).alias("buyer"), "create_time")
    flagged = (
        rows.mapInPandas(_earliest_ahead, "id long, buyer string, create_time timestamp, lane int")
        .withColumns({"moment": F.unix_micros("create_time"), "state_key": _grouped(F.col("buyer"), F.col("lane"))})
        .groupBy("state_key", "lane")
        .transformWithState(
            _FirstOrder(None if ttl_seconds is None else int(ttl_seconds * 1000)),
            "id long, buyer string, moment long, if_first_order string",
            "Append",
            "None" if ttl_seconds is None else "ProcessingTime",
        )
    )
    user = F.nullif("buyer", F.lit("")).cast("long").alias("user_id")
    return flagged.select("id", user, F.timestamp_micros("moment").alias("create_time"), "if_first_order")


_SPLIT_ROW = (
    "order_id long, lane int, order_detail_id long, part long, origin long, given long, paid long, original long, "
    "newest long, create_time timestamp"
)


def _presummed(chunks: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ahead of the shuffle: the lines of a chunk, each on a lane of its order, and one row (lane -1) per order with the sums of the
    chunk and its line of highest id."""
    for chunk in chunks:
        if chunk.empty:
            continue
        rows = chunk.sort_values(["order_id", "order_detail_id"], kind="stable")
        last = ~rows["order_id"].duplicated(keep="last")
        sums = rows.groupby("order_id", dropna=False).agg(origin=("amount", "sum"), given=("share", "sum"), newest=("created_ms", "max"))
        held, lines = rows[last], rows[~last]
        shape = lambda of, lane, **more: pd.DataFrame(
            {
                "order_id": of["order_id"],
                "lane": lane,
                "order_detail_id": of["order_detail_id"],
                "part": of["share"].astype("int64"),
                **({"origin": 0, "given": 0, "newest": 0} | more),
                "paid": of["paid"],
                "original": of["original"],
                "create_time": of["create_time"],
            }
        )
        yield shape(lines, (lines["order_detail_id"] % _LANES).astype("int32"))
        yield shape(held, -1, **{name: sums[name].to_numpy() for name in sums})


class _SplitOrder(StatefulProcessor):
    """Running sums of one order, in cents, as in :func:`_split_order` and row by row: a frame for each order would cost more than its lines."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "origin long, given long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        shown = lambda row, part: Row(order_id=row.order_id, order_detail_id=row.order_detail_id, part=part)
        if key[1] >= 0:
            for row in rows:
                yield shown(row, row.part)
            return
        before = self.sums.get()
        origin, given = before or (0, 0)
        held: Row | None = None
        for row in rows:
            origin += row.origin
            given += row.given
            if held is None:
                held = row
                continue
            held, other = (row, held) if row.order_detail_id >= held.order_detail_id else (held, row)
            yield shown(other, other.part)
        if held is None:
            return
        complete = held.original == origin
        missing = held.paid - given if complete else 0
        yield shown(held, held.part + missing)
        if not complete:
            self.sums.update((origin, given + missing))
        elif before is not None:
            self.sums.clear()

    def close(self) -> None:
        pass


def _split_order(horizon_ms: int):
    """Running sums of one order, in cents, over the rows that carry sums. The batch that completes the order gives the rest to its line of
    highest id, which is held back until all chunks are seen."""

    def split_chunks(key: tuple, chunks: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        origin, given = state.get if state.exists else (0, 0)
        held: pd.DataFrame | None = None
        newest = 0
        for chunk in chunks:
            origin += int(chunk["origin"].sum())
            given += int(chunk["given"].sum())
            newest = max(newest, int(chunk["newest"].max()))
            rows = chunk if held is None else pd.concat([held, chunk])
            rows = rows.sort_values("order_detail_id")
            held, rest = rows.iloc[-1:], rows.iloc[:-1]
            yield rest[["order_id", "order_detail_id", "part"]]
        if held is None:
            return
        complete = int(held["original"].iloc[0]) == origin
        missing = int(held["paid"].iloc[0]) - given if complete else 0
        given += missing
        yield held.assign(part=held["part"] + missing)[["order_id", "order_detail_id", "part"]]
        if complete:
            if state.exists:
                state.remove()
            return
        state.update((origin, given))
        # The watermark is the epoch until a first batch has passed; the order's own time is a floor.
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), newest) + horizon_ms)

    return split_chunks


def split_lines(lines: DataFrame, scale: int = 2, horizon_hours: float | None = None) -> DataFrame:
    """Split of the paid amount with running sums per order in the state store. ``lines`` has the columns the
    batch split reads and a watermark on ``create_time``.

    Sums are kept until the order is complete. With ``horizon_hours`` an order that stays incomplete is forgotten that long
    after its latest creation time or the watermark, whichever is later; without, the query must be started in :func:`disk_state`. Lines are summed up ahead of the shuffle: a row per order and chunk of
    ten thousand lines meets the order's state, and the lines themselves are spread over ``_LANES`` lanes of the order. With a horizon the lines of an
    order go through one task.
    """
    rows = split.with_share(lines, scale).select(
        "order_id",
        "order_detail_id",
        "create_time",
        F.coalesce(F.unix_millis("create_time"), F.lit(0)).alias("created_ms"),
        F.col("_amount").alias("amount"),
        F.col("_paid").alias("paid"),
        F.col("_original").alias("original"),
        F.col("_share").alias("share"),
    )
    horizon_ms = None if horizon_hours is None else int(horizon_hours * 3600 * 1000)
    if horizon_ms is None:
        summed = rows.mapInPandas(_presummed, _SPLIT_ROW)
        grouped = summed.withColumn("state_key", _grouped(F.col("order_id"), F.col("lane"))).groupBy("state_key", "lane")
        parts = grouped.transformWithState(
            _SplitOrder(), "order_id long, order_detail_id long, part long", "Append", "None"
        )
    else:
        # Timeouts need the watermark, which a column made in Python no longer has: every line carries its own sums.
        summed = rows.select(
            "order_id", "order_detail_id", F.col("share").alias("part"), F.col("amount").alias("origin"),
            F.col("share").alias("given"), "paid", "original", F.col("created_ms").alias("newest"), "create_time",
        )
        parts = summed.groupBy("order_id").applyInPandasWithState(
            _split_order(horizon_ms),
            "order_id long, order_detail_id long, part long",
            "origin long, given long",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    return parts.select("order_id", "order_detail_id", from_cents(F.col("part")).alias("final_detail_amount"))
