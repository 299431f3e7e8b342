"""App logs: route launches and events, and read launch records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import clock
from orderloom.functions.text import open_json

LAUNCH_TOPIC = "START_LOG"
EVENT_TOPIC = "EVENT_LOG"

_LOG = "start string, common struct<mid string, uid string, ar string, ch string, vc string>, ts string, mid string"


def _device() -> Column:
    return F.coalesce(F.col("common.mid"), F.col("mid"))


def _millis() -> Column:
    return F.col("ts").try_cast("long")


def route(messages: DataFrame) -> DataFrame:
    """Key each log by its device and send it to the launch topic when ``start`` is non-empty."""
    carried = [c for c in messages.columns if c not in ("key", "value", "topic")]
    topic = F.when(F.length("start") > 0, LAUNCH_TOPIC).otherwise(EVENT_TOPIC)
    logs = open_json(messages, "value", _LOG)
    return logs.select(_device().alias("key"), "value", topic.alias("topic"), *carried)


def launches(messages: DataFrame) -> DataFrame:
    """Launch records with event day and hour; the minute is the constant "00"."""
    carried = [c for c in messages.columns if c in ("partition", "offset", "timestamp")]
    moment = clock.from_millis(_millis())
    logs = open_json(messages, "value", _LOG).where(_device().isNotNull() & _millis().isNotNull())
    return logs.select(
        _device().alias("mid"),
        *[F.col(f"common.{name}").alias(name) for name in ("uid", "ar", "ch", "vc")],
        clock.day(moment).alias("dt"),
        clock.hour(moment).alias("hr"),
        F.lit("00").alias("mi"),
        _millis().alias("ts"),
        *carried,
    )


def unreadable(messages: DataFrame) -> DataFrame:
    """Logs :func:`launches` leaves out, for want of a device or a time, as they came."""
    logs = open_json(messages, "value", _LOG)
    return logs.where(_device().isNull() | _millis().isNull()).select(*messages.columns)


def archive(messages: DataFrame) -> DataFrame:
    """The raw text of every log with its day, for a sink partitioned by ``dt``. A log without a
    readable time goes to the null day, so nothing is lost."""
    logs = open_json(messages, "value", _LOG)
    return logs.select("value", clock.day(clock.from_millis(_millis())).alias("dt"))
