"""Dates and hours from epoch milliseconds and timestamps, in the session time zone."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def hour(moment: Column) -> Column:
    return F.date_format(moment, "HH")


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def previous_day(dt: str) -> str:
    """The day before ``dt``; a malformed date raises ``ValueError`` before any job starts."""
    return (date.fromisoformat(dt) - timedelta(days=1)).isoformat()
