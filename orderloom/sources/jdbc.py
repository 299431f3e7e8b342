"""JDBC scans and appends; driver and URL are the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Rows per round trip, isolation and parallel writers of the wide-table sink.
APPEND_OPTIONS = {"batchsize": "100", "isolationLevel": "NONE", "numPartitions": "4"}


def query_options(url: str, driver: str, query: str, **extra: str) -> dict[str, str]:
    return {"url": url, "driver": driver, "query": query, **extra}


def read_query(spark: SparkSession, url: str, driver: str, query: str, **extra: str) -> DataFrame:
    """Result of ``query``, typed by the database. Pass ``partitionColumn`` and bounds with ``dbtable``
    through ``read_table`` for a result too large for one connection."""
    return spark.read.format("jdbc").options(**query_options(url, driver, query, **extra)).load()


def read_table(
    spark: SparkSession, url: str, driver: str, table: str, column: str, lower: int, upper: int, partitions: int
) -> DataFrame:
    """A table read over several connections, split by a numeric column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, driver=driver, dbtable=table, partitionColumn=column)
        .options(lowerBound=lower, upperBound=upper, numPartitions=partitions)
        .load()
    )


def append(rows: DataFrame, url: str, driver: str, table: str, **extra: str) -> None:
    options = {**APPEND_OPTIONS, "driver": driver, **extra}
    rows.write.mode("append").options(**options).jdbc(url, table)
