"""Daily active devices: first launch per device and day, totals, hourly series, headline figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import clock
from orderloom.operators.keyed import earliest
from orderloom.schemas import DAU_INFO

# Ids and labels of the two headline figures.
KPI_ACTIVE = ("dau", "新增日活")
KPI_NEW = ("new_mid", "新增设备")
HOURS = 24


def first_launches(launches: DataFrame, tie: Sequence[str] = ("offset",)) -> DataFrame:
    """One row per day and device: the launch with the smallest time, then the smallest ``tie``."""
    order = ["ts", *[c for c in tie if c in launches.columns]]
    return earliest(launches, ["dt", "mid"], order).select(*DAU_INFO.fieldNames())


def devices_per_day(launches: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct devices per day; ``approximate`` trades exactness for a fixed-size sketch."""
    if approximate:
        return launches.groupBy("dt").agg(F.approx_count_distinct("mid").alias("devices"))
    return launches.select("dt", "mid").distinct().groupBy("dt").agg(F.count("*").alias("devices"))


# Fixed value: 2^12 registers, a standard error of 1.6 % per sketch, 2 kB each.
SKETCH_BITS = 12


def day_sketches(launches: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A mergeable sketch of the devices of every day. ``known`` holds earlier sketches of these days, which are merged in: a launch
    counted twice changes nothing."""
    sketches = launches.groupBy("dt").agg(F.hll_sketch_agg("mid", F.lit(SKETCH_BITS)).alias("sketch"))
    return sketches if known is None else merge_sketches(sketches.unionByName(known.select("dt", "sketch")), "dt")


def merge_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """One sketch per group of days, a union of theirs."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_devices(sketches: DataFrame) -> DataFrame:
    """The sketch replaced by its estimate of distinct devices."""
    return sketches.withColumn("devices", F.hll_sketch_estimate("sketch")).drop("sketch")


def total(dau: DataFrame, dt: str) -> DataFrame:
    """Active devices of one day. ``dau`` has one row per day and device, partitioned by ``dt``."""
    return dau.where(F.col("dt") == dt).agg(F.count("*").alias("dau_total"))


def hourly(dau: DataFrame, dt: str) -> DataFrame:
    """Devices per hour of first launch, fullest hour first, at most 24 rows."""
    return (
        dau.where(F.col("dt") == dt)
        .groupBy("hr")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "hr")
        .limit(HOURS)
    )


def _all_hours(spark: SparkSession) -> DataFrame:
    return spark.range(HOURS).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hr"))


def dense_hours(counts: DataFrame) -> DataFrame:
    """All 24 hours; every column other than ``hr`` is 0 where the hour is missing."""
    return _all_hours(counts.sparkSession).join(counts, "hr", "left").na.fill(0)


def compare(dau: DataFrame, dt: str) -> DataFrame:
    """Hours seen on ``dt`` or the day before, with both counts, from one scan of two day partitions."""
    before = clock.previous_day(dt)
    count_of = lambda day: F.count(F.when(F.col("dt") == day, 1))
    return (
        dau.where(F.col("dt").isin(dt, before))
        .groupBy("hr")
        .agg(count_of(before).alias("yesterday"), count_of(dt).alias("today"))
    )


def compare_json(comparison: DataFrame) -> DataFrame:
    """The two series as one JSON document, hours with no device left out as in the series itself."""
    hours: dict[str, Column] = {}
    for side in ("yesterday", "today"):
        pairs = F.collect_list(F.when(F.col(side) > 0, F.struct("hr", F.col(side).alias("n"))))
        hours[side] = F.map_from_entries(F.array_sort(pairs))
    document = F.to_json(F.struct(*[series.alias(side) for side, series in hours.items()]))
    return comparison.agg(document.alias("response"))


def new_devices(dau: DataFrame, dt: str) -> DataFrame:
    """Devices never seen before ``dt``."""
    first_days = dau.where(F.col("dt") <= dt).groupBy("mid").agg(F.min(F.to_date("dt")).alias("first_dt"))
    return first_days.where(F.col("first_dt") == F.to_date(F.lit(dt))).agg(F.count("*").alias("new_mid"))


def kpis(dau: DataFrame, dt: str) -> DataFrame:
    """Headline figures of a day as (id, name, value), from one pass over the devices up to ``dt``."""
    devices = (
        dau.where(F.col("dt") <= dt)
        .groupBy("mid")
        .agg(F.min(F.to_date("dt")).alias("first_dt"), F.max(F.to_date("dt")).alias("last_dt"))
    )
    counts = devices.agg(
        F.count(F.when(F.col("last_dt") == F.to_date(F.lit(dt)), 1)).alias("active"),
        F.count(F.when(F.col("first_dt") == F.to_date(F.lit(dt)), 1)).alias("fresh"),
    )
    figures = F.array(
        *[
            F.struct(F.lit(ident).alias("id"), F.lit(label).alias("name"), F.col(value).alias("value"))
            for (ident, label), value in ((KPI_ACTIVE, "active"), (KPI_NEW, "fresh"))
        ]
    )
    return counts.select(F.inline(figures))


def first_days(firsts: DataFrame, known: DataFrame) -> DataFrame:
    """Changes to the kept first days: devices seen for the first time, and, for a device whose first launch comes late, the earlier day
    and the end of the day it had. ``known`` has the days that hold now, of these devices at least."""
    earliest_here = firsts.groupBy("mid").agg(F.min("dt").alias("dt"))
    held = known.select("mid", F.col("dt").alias("_held"))
    changed = earliest_here.join(held, "mid", "left").where(F.col("_held").isNull() | (F.col("dt") < F.col("_held")))
    days = F.array(
        F.struct(F.col("dt"), F.lit(False).alias("moved")),
        F.when(F.col("_held").isNotNull(), F.struct(F.col("_held").alias("dt"), F.lit(True).alias("moved"))),
    )
    return changed.select("mid", F.explode(F.array_compact(days)).alias("day")).select("day.dt", "mid", "day.moved")


def kept_kpis(active: DataFrame, fresh: DataFrame) -> DataFrame:
    """The figures of :func:`kpis` from one day of the kept tables: the devices of the day, and those whose first day it is."""
    figure = lambda rows, of: rows.agg(F.count("*").alias("value")).select(
        F.lit(of[0]).alias("id"), F.lit(of[1]).alias("name"), "value"
    )
    return figure(active, KPI_ACTIVE).union(figure(fresh, KPI_NEW))
