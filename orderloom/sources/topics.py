"""Message topics: Kafka in production, JSON files of the same layout elsewhere.

A topic frame has the columns of ``schemas.MESSAGE``. A file topic is a folder with one ``batch_id=N`` folder
per writing batch, overwritten when the batch is replayed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.text import record_json
from orderloom.schemas import MESSAGE


# Takes the messages of one batch (key, value, topic and perhaps position columns) and the batch id.
Writer = Callable[[DataFrame, int], None]
EARLIEST = -2  # reader code for the oldest offset of a partition
# Messages repeat their field names: packed at the quickest level they take about a seventh of the disk. Readers tell by the file name.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def kafka_options(
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str = "latest",
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options. ``starting`` counts only for a query without a checkpoint, which otherwise resumes."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group:
        options["kafka.group.id"] = group
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def starting_offsets(ledger: DataFrame, group: str, topic: str, partitions: Iterable[int] = ()) -> str:
    """Stored positions as reader JSON, or "latest" where none are stored. The reader wants every partition of the
    topic: those in ``partitions`` that the ledger does not know start at their oldest offset."""
    rows = ledger.where((F.col("group_id") == group) & (F.col("topic") == topic)).collect()
    if not rows:
        return "latest"
    known = {p: EARLIEST for p in partitions} | {r.partition_id: r.topic_offset for r in rows}
    return json.dumps({topic: {str(p): known[p] for p in sorted(known)}})


def from_kafka(frame: DataFrame) -> DataFrame:
    """Kafka rows, whose key and value are binary, as messages."""
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MESSAGE])


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return from_kafka(spark.readStream.format("kafka").options(**options).load())


def read_files(spark: SparkSession, path: str, max_files: int | None = None, since: int | None = None) -> DataFrame:
    """Stream of a file topic, or of several given by a glob.

    A message without a position of its own stands in partition 0, at the number of the batch that wrote it. ``since`` leaves out positions before it,
    for a reader without a checkpoint; the writer's batches are its unit, so those with the first position are read whole.
    """
    reader = spark.readStream.schema(MESSAGE).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    written = F.regexp_extract("_metadata.file_path", "batch_id=([0-9]+)", 1).try_cast("long")
    filled = {"partition": F.coalesce("partition", F.when(written.isNotNull(), 0)), "offset": F.coalesce("offset", written)}
    messages = reader.json(path).select(*[filled.get(f.name, F.col(f.name)).alias(f.name) for f in MESSAGE])
    return messages if since is None else messages.where(F.col("offset") >= since)


def next_position(ledger: DataFrame, group: str, topic: str) -> int | None:
    """Where a reader of a file topic goes on, None if the ledger does not know the topic."""
    known = ledger.where((F.col("group_id") == group) & (F.col("topic") == topic) & (F.col("partition_id") == 0))
    row = known.select("topic_offset").first()
    return row and row.topic_offset


def as_messages(rows: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """Records as keyed JSON messages."""
    message_key = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return rows.select(message_key.alias("key"), record_json(rows).alias("value"), F.lit(topic).alias("topic"))


def to_kafka(servers: str) -> Writer:
    """Writer to Kafka; delivery is at least once, so readers remove duplicates."""

    def write(messages: DataFrame, batch_id: int) -> None:
        messages.select("key", "value", "topic").write.format("kafka").option("kafka.bootstrap.servers", servers).save()

    return write


def to_files(path: str, split_by_topic: bool = False) -> Writer:
    """Writer to a file topic."""
    return lambda messages, batch_id: write_files(messages, path, batch_id, split_by_topic)


def write_files(messages: DataFrame, path: str, batch_id: int, split_by_topic: bool = False) -> None:
    """Write a batch as files. With ``split_by_topic`` each topic gets its own folder; the rebalance keeps
    the number of files near the data size and splits a topic that dominates the batch."""
    target = f"{path}/batch_id={batch_id}"
    if split_by_topic:
        messages.hint("rebalance", "topic").write.mode("overwrite").partitionBy("topic").options(**PACKED).json(target)
    else:
        messages.write.mode("overwrite").options(**PACKED).json(target)


def topic_path(root: str, topic: str) -> str:
    """Where :func:`write_files` puts one topic of a split write."""
    return f"{root}/batch_id=*/topic={topic}"


def to_console(messages: DataFrame, rows: int = 1000):
    """Stream writer that prints the first rows of each batch."""
    return messages.writeStream.format("console").option("numRows", rows).option("truncate", "false")
