"""Position ledger: how far each job has read every topic partition.

Positions get there on two ways. A job whose batches hold the messages records them itself, with its batch. For any other query, such as a
join of two topics, :class:`Positions` takes them from the progress Spark reports after each batch: the end offsets of sources that have topic
partitions, and for file topics what :func:`watched` has observed on the way.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from orderloom.schemas import PROGRESS
from orderloom.sources.tables import Commits, KeyedTable

_WATCHED = "position of "


def ledger(path: str, commits: Commits | None = None) -> KeyedTable:
    return KeyedTable(path, PROGRESS, ["group_id", "topic", "partition_id"], commits=commits)


def positions(messages: DataFrame, group: str) -> DataFrame:
    """Next offset per topic partition after these messages."""
    return messages.groupBy("topic", F.col("partition").alias("partition_id")).agg(
        (F.max("offset") + 1).alias("topic_offset")
    ).select(F.lit(group).alias("group_id"), "topic", "partition_id", "topic_offset")


def watched(messages: DataFrame, topic: str, partitions: int = 1) -> DataFrame:
    """The messages, with the next offset of each partition of the topic observed in every batch."""
    reached = [F.max(F.when(F.col("partition") == p, F.col("offset") + 1)).alias(str(p)) for p in range(partitions)]
    return messages.observe(_WATCHED + topic, *reached)


def reached(progress, group: str) -> list[tuple[str, str, int, int]]:
    """Ledger rows of one progress report."""
    rows = {}
    for source in progress.sources:
        end = json.loads(source.endOffset) if source.endOffset else None
        for topic, partitions in end.items() if isinstance(end, dict) else ():
            if isinstance(partitions, dict):  # a file source has a number here
                rows |= {(topic, int(p)): offset for p, offset in partitions.items()}
    for name, row in progress.observedMetrics.items():
        if name.startswith(_WATCHED):
            topic = name.removeprefix(_WATCHED)
            rows |= {(topic, int(p)): offset for p, offset in row.asDict().items() if offset is not None}
    return [(group, topic, partition, offset) for (topic, partition), offset in rows.items()]


class Positions(StreamingQueryListener):
    """Writes the positions of the queries it follows into their ledgers, after each batch.

    A position is behind until its batch has ended: a job that goes on from it reads again, never less.
    """

    def __init__(self, spark: SparkSession, compact_every: int = 100):
        self.spark, self.compact_every = spark, compact_every
        self._followed: dict[str, tuple[KeyedTable, str, int]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._error: Exception | None = None

    def follow(self, name: str, table: KeyedTable, group: str, first_batch: int = 0) -> None:
        """``name`` is the query's; to be called before it starts."""
        self._followed[name] = table, group, first_batch

    def _end(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        followed = self._followed.get(event.progress.name)
        if not followed:
            return
        table, group, first_batch = followed
        batch_id = event.progress.batchId + first_batch
        try:
            rows = reached(event.progress, group)
            if rows:
                table.write(self.spark.createDataFrame(rows, PROGRESS), batch_id)
                table.compact_every(self.spark, batch_id, self.compact_every)
        except Exception as error:  # a listener's errors reach nobody else
            self._error = error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def settle(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until everything an ended query has reported is written."""
        if not self._end(query.runId).wait(seconds):
            raise TimeoutError(f"no end of query {query.runId} was reported")
        if self._error:
            raise self._error
